"""Language identification by segmentation-marginalised unigrams.

Each language has a probability for every piece of a fixed public vocabulary.
The probability of a word is the sum, over all its segmentations into pieces,
of the product of their probabilities (forward algorithm); a text's score under
a language is the sum over its words of the logarithm, and the languages'
scores become probabilities (all languages alike before a word is seen). Words
are runs of letters in lower case, of the whole text; nothing else of a
document is looked at.

Learning is expectation maximisation: ``ROUNDS`` times, each word of the
learning texts spreads its count over its segmentations by forward and
backward, in parallel over the texts, and only the sums per language and piece
(at most the vocabulary's size per language) come to the driver. It may use a
bounded sample: about ``train_rows`` rows, chosen by a digest of ``doc_id``: all
of the rarer languages and as many of each common one as leaves that sum. With
fewer rows all are used.

The score only compares the learned languages. How well the most likely one
fits at all is said by ``fit``: by how many standard deviations the text's log
probability is above (below 0: under) what its bytes let expect, against the
spread over words and over whole texts of the language's learning texts. A word
counts with the learned language that fits it best, as texts may mix them, and
the worst tenth of the words, one at least, is left out (keys, names).

Defined cases: a null, empty or letterless text is ``und`` with score 0; rows
with null ``lang`` or text teach nothing, and where no row teaches anything
every text is ``und``; equal scores go to the language first in order;
repeated rows count each. Only the named columns are read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.llm.pieces import VOCABULARY, Pieces, by_length, expected_pieces, log_marginal, shared_pieces
from railyard.llm.tables import TEXT_BATCH, crc_mod, materialise, python_tasks

WORD = re.compile(r"[^\W\d_]+")
UNDETERMINED = "und"
TRAIN_ROWS = 20_000
ROUNDS = 2
#: Added to every piece's expected count, so that no piece is impossible.
SMOOTHING = 0.1
#: Distinct words held at once by a learning task.
HELD_WORDS = 200_000
#: Bytes that a scoring worker keeps of words and their values, with what Python needs for each.
HELD_BYTES, ENTRY_BYTES = 40 << 20, 160
#: Of the mean log probability of a byte, the part by which texts of a language are taken to differ at least.
LEAST_SPREAD = 0.05
RESULT = T.StructType([T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType()), T.StructField("fit", T.DoubleType())])
#: Sums over a language's learning texts, from which its spread follows.
SUMS = ("words", "bytes", "logs", "word_bb", "word_lb", "word_ll", "text_bb", "text_lb", "text_ll")


class Model(NamedTuple):
    languages: list[str]
    logp: np.ndarray  # piece x language
    #: Language x mean log probability per byte, variance of a word, variance per squared byte of a text.
    fit: np.ndarray | None = None


def words_of(text: str | None) -> list[str]:
    found = WORD.findall(text.lower()) if text else []
    if not found or text.isascii():
        return found
    # The pattern takes numbers that are no decimal digits for letters.
    return [x for w in found for x in ([w] if w.isalpha() else "".join(c if c.isalpha() else " " for c in w).split())]


def spelled(word: str) -> bytes:
    """A word as the vocabulary spells it, after white space."""
    return b" " + word.encode()


def first_guess(pieces: Pieces, n_languages: int) -> np.ndarray:
    """Before learning: probabilities by the pieces' rank in the vocabulary, the same for every language."""
    p = 1.0 / (10.0 + np.arange(len(pieces.scores)))
    return np.repeat(np.log(p / p.sum())[:, None], n_languages, 1)


def spread(pieces: Pieces, counts: Counter[str], logp: np.ndarray) -> np.ndarray:
    """Expected uses of each piece over these words."""
    total = np.zeros(len(pieces.scores))
    weight = {spelled(w): n for w, n in counts.items()}
    for group, m in by_length(weight):
        total += expected_pieces(pieces, m, np.array([weight[w] for w in group], float), logp)
    return total


def piece_counts(train: DataFrame, pieces, languages: list[str], logp: np.ndarray) -> np.ndarray:
    """One round: expected piece counts per language, summed by Spark."""
    index = {x: k for k, x in enumerate(languages)}
    known = train.sparkSession.sparkContext.broadcast(logp)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, total = [Counter() for _ in languages], np.zeros((len(languages), len(logp)))

        def flush() -> None:
            for k, words in enumerate(held):
                total[k] += spread(pieces.value, words, known.value[:, k])
                words.clear()

        for frame in batches:
            for lang, text in zip(frame["lang"], frame["text"], strict=True):
                held[index[lang]].update(words_of(text))
            if sum(map(len, held)) > HELD_WORDS:
                flush()
        flush()
        k, piece = np.nonzero(total)
        yield pd.DataFrame({"k": k, "piece": piece, "n": total[k, piece]})

    sums = train.mapInPandas(count, "k long, piece long, n double").groupBy("k", "piece").agg(F.sum("n").alias("n"))
    found = sums.toPandas()  # at most languages x vocabulary
    known.unpersist()
    out = np.zeros((len(logp), len(languages)))
    out[found["piece"], found["k"]] = found["n"]
    return out


def learned_fit(train: DataFrame, pieces, model: Model) -> np.ndarray:
    """The spread of the learning texts of each language; 0 for a language without any."""
    index = {x: k for k, x in enumerate(model.languages)}
    known = train.sparkSession.sparkContext.broadcast(model)

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer, total = Scorer(pieces.value, known.value), np.zeros((len(index), len(SUMS)))
        for frame in batches:
            split = [words_of(t) for t in frame["text"]]
            scorer.hold(split)
            for lang, words in zip(frame["lang"], split, strict=True):
                if words:
                    n, log = scorer.bytes_and_logs(words)
                    log = log[:, index[lang]]
                    b, v = n.sum(), log.sum()
                    total[index[lang]] += (len(words), b, v, n @ n, n @ log, log @ log, b * b, b * v, v * v)
        yield pd.DataFrame(total, columns=SUMS).assign(k=np.arange(len(index)))

    sums = train.mapInPandas(add, ", ".join(f"{c} double" for c in SUMS) + ", k long").groupBy("k").agg(*[F.sum(c).alias(c) for c in SUMS])
    out = np.zeros((len(index), 3))
    rows = sums.filter("words > 0").collect()  # one row per language
    known.unpersist()
    for r in rows:
        mean = r["logs"] / r["bytes"]
        word, text = (r[f"{x}_ll"] - 2 * mean * r[f"{x}_lb"] + mean * mean * r[f"{x}_bb"] for x in ("word", "text"))
        out[r["k"]] = mean, max(word, 0) / r["words"], max((text - word) / r["text_bb"], (LEAST_SPREAD * mean) ** 2)
    return out


def most_rows(by_lang: dict[str, int], train_rows: int) -> float:
    """The number of rows up to which a language gives all of its, and beyond which it gives that many."""
    left = float(train_rows)
    for k, n in enumerate(sorted(by_lang.values())):
        if n * (len(by_lang) - k) > left:
            return left / (len(by_lang) - k)
        left -= n
    return float("inf")


def learn(docs: DataFrame, train_rows: int = TRAIN_ROWS, rounds: int = ROUNDS, vocabulary: str = VOCABULARY, with_fit: bool = False) -> Model:
    """Learn from ``doc_id, text, lang``, of which about ``train_rows`` rows; ``with_fit`` the spread of the learning texts too."""
    spark = docs.sparkSession
    python_tasks(spark, TEXT_BATCH)
    rows = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("doc_id", "text", "lang")
    by_lang = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    most = most_rows(by_lang, train_rows)
    parts = {lang: int(most / n * (1 << 30)) for lang, n in by_lang.items() if n > most}
    if parts:
        draw = F.pmod(F.xxhash64(F.lit("train"), "doc_id"), F.lit(1 << 30))
        least = F.create_map(*[F.lit(x) for pair in parts.items() for x in pair])
        rows = rows.filter(draw < F.coalesce(least[F.col("lang")], F.lit(1 << 30)))
    rows = materialise(rows.select("lang", "text"), "lang-train")
    languages = sorted(by_lang)
    pieces = shared_pieces(spark, vocabulary)
    logp = first_guess(pieces.value, len(languages))
    for _ in range(rounds if languages else 0):
        n = piece_counts(rows, pieces, languages, logp) + SMOOTHING
        logp = np.log(n / n.sum(0))
    model = Model(languages, logp)
    return model._replace(fit=learned_fit(rows, pieces, model)) if with_fit and languages else model


class Scorer:
    def __init__(self, pieces: Pieces, model: Model):
        self.pieces, self.model = pieces, model
        self.known: dict[str, int] = {}
        self.values = np.zeros((1024, len(model.languages)))  # of which the first len(known) are used
        self.held = 0

    def learn(self, words: Iterable[str]) -> None:
        new = {spelled(w): w for w in words}
        need = len(self.known) + len(new)
        if need > len(self.values):
            self.values = np.concatenate([self.values[:len(self.known)], np.zeros((need + need // 4 - len(self.known), self.values.shape[1]))])
        for group, m in by_length(new):
            at = len(self.known)
            self.values[at:at + len(group)] = log_marginal(self.pieces, m, self.model.logp)
            self.known.update(zip(map(new.__getitem__, group), range(at, at + len(group))))
        self.held += self.bytes_of(new)

    def bytes_of(self, words: Iterable[str]) -> int:
        n = [len(w) for w in words]
        return sum(n) + len(n) * (ENTRY_BYTES + 10 * self.values.shape[1])

    def hold(self, split: list[list[str]]) -> None:
        every = set().union(*split)
        new = every.difference(self.known)
        if self.held + self.bytes_of(new) > HELD_BYTES:
            self.known, self.held, new = {}, 0, every
        self.learn(new)

    def bytes_and_logs(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Per word its bytes, and its log probability in each language."""
        return np.array([len(spelled(w)) for w in words], float), self.values[list(map(self.known.__getitem__, words))]

    def fit(self, words: list[str], best: int) -> float:
        mean, word, text = self.model.fit[best]
        n, log = self.bytes_and_logs(words)
        above = log.max(1) - mean * n
        kept = np.argsort(above, kind="stable")[-(-len(words) // 10):]
        spread = np.sqrt(len(kept) * word + text * n[kept].sum() ** 2)
        return float(above[kept].sum() / spread) if spread > 0 else 0.0

    def score(self, texts: Iterable[str | None]) -> pd.DataFrame:
        split = [words_of(t) for t in texts]
        self.hold(split)
        out = []
        for words in split:
            if not words or not self.model.languages:
                out.append((UNDETERMINED, 0.0, None))
                continue
            total = self.values[list(map(self.known.__getitem__, words))].sum(0)
            odds = np.exp(total - total.max())
            best = int(np.argmax(total))
            fit = None if self.model.fit is None else self.fit(words, best)
            out.append((self.model.languages[best], float(odds[best] / odds.sum()), fit))
        return pd.DataFrame(out, columns=["lang_pred", "score", "fit"]).astype({"fit": "float64"})


def predictor(spark: SparkSession, model: Model, vocabulary: str = VOCABULARY):
    """A function of a text column: a struct of ``lang_pred``, ``score`` and, if the model has one, ``fit``. The model's size is bounded by the vocabulary."""
    pieces, shared = shared_pieces(spark, vocabulary), spark.sparkContext.broadcast(model)

    @F.pandas_udf(RESULT)
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(pieces.value, shared.value)
        for texts in batches:
            yield scorer.score(texts)

    return predict


def held_out(doc_id: Column, folds: int = 4, fold: int = 2) -> Column:
    return crc_mod(doc_id, folds) == fold


def identify(docs: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """``doc_id, held_out, lang_pred, score`` for every document; rows that are held out teach nothing."""
    spark = docs.sparkSession
    model = learn(docs.filter(~held_out(F.col("doc_id"))), train_rows)
    python_tasks(spark, TEXT_BATCH)
    p = predictor(spark, model)
    return docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), p(F.col("text")).alias("p")) \
        .select("doc_id", "held_out", "p.lang_pred", "p.score")
