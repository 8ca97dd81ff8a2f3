"""Quality classifier: regularised quadratic discriminant over statistics of a document.

Each whole text is reduced to a few transformed statistics (``FEATURES``).
Per class the mean and covariance are learned from all labelled learning rows,
as sums that Spark adds up; a covariance is shrunk towards a diagonal one of
the pooled variances. A text's score is the logistic function of the difference
of the classes' log densities, whose Mahalanobis terms use Cholesky factors that
are computed once, and of the log of the classes' shares.

Defined cases: null and empty texts have the statistics of a text without
words and are scored like any other; labels that are null or without a
document teach nothing, repeated rows count each; with no label at all every
score is 0.5, with one class only it is that class (0 or 1); a null ``doc_id``
joins no label. Only the named columns are read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from railyard.llm.tables import crc_mod, materialise, python_tasks

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SHRINKAGE = 0.1
FEATURES = ("log_chars", "log_words", "word_length", "word_length_spread", "upper", "digit", "symbol", "bar", "shout",
            "upper_words", "symbol_words", "bare_symbols", "distinct_words", "commonest_word", "repeated_next",
            "log_lines", "repeated_lines", "letter_entropy", "stops")


def logit(part: float, whole: float) -> float:
    """Log odds of a share, kept finite by half a count."""
    return math.log((part + 0.5) / (max(whole - part, 0.0) + 0.5))


def statistics(text: str | None) -> list[float]:
    """The transformed statistics of one text, in the order of ``FEATURES``."""
    text = text or ""
    words = WORD.findall(text)
    n, w = len(text), len(words)
    letters = sum(map(str.isalpha, text))
    upper = sum(map(str.isupper, text))
    digits = sum(map(str.isdigit, text))
    spaces = n - sum(map(len, words))
    lengths = list(map(len, words))
    mean = sum(lengths) / w if w else 0.0
    spread = math.sqrt(sum((x - mean) ** 2 for x in lengths) / w) if w else 0.0
    counts = Counter(words)
    lines = [x for x in text.split("\n") if x.strip()]
    chars = Counter(text.lower())
    entropy = -sum(c / n * math.log(c / n) for c in chars.values()) if n else 0.0
    return [
        math.log1p(n), math.log1p(w), math.log1p(mean), math.log1p(spread),
        logit(upper, letters), logit(digits, n), logit(n - letters - digits - spaces, n), logit(text.count("|"), n),
        logit(text.count("!"), n), logit(sum(map(str.isupper, words)), w),
        logit(sum(not x[-1].isalnum() for x in words), w),
        logit(sum(c for x, c in counts.items() if not any(map(str.isalnum, x))), w),
        logit(len(counts), w), logit(max(counts.values(), default=0), w),
        logit(sum(a == b for a, b in zip(words, words[1:], strict=False)), w),
        math.log1p(len(lines)), logit(len(lines) - len(set(lines)), len(lines)), entropy,
        logit(text.count(".") + text.count(","), w),
    ]


@F.pandas_udf(T.ArrayType(T.DoubleType()))
def features(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for texts in batches:
        yield pd.Series([np.array(statistics(t)) for t in texts], dtype="object")


class Discriminant(NamedTuple):
    """Per class: mean and inverse Cholesky factor of the standardised statistics, and the constant of its log density."""

    shift: np.ndarray
    scale: np.ndarray
    means: np.ndarray
    factors: np.ndarray
    constants: np.ndarray

    def scores(self, x: np.ndarray) -> np.ndarray:
        z = (x - self.shift) / self.scale
        d = [c - 0.5 * np.square((z - m) @ f.T).sum(1) for m, f, c in zip(self.means, self.factors, self.constants, strict=True)]
        return 1.0 / (1.0 + np.exp(np.clip(d[0] - d[1], -700, 700)))


def moments(labelled: DataFrame) -> np.ndarray:
    """Per class (rows 0 and 1) the sums of ``(1, x)`` times its transpose, over ``quality`` and ``x``."""
    d = len(FEATURES) + 1

    def sums(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((2, d, d))
        for f in frames:
            x = np.column_stack([np.ones(len(f)), np.stack(f["x"].to_list())]) if len(f) else np.zeros((0, d))
            for k in (0, 1):
                y = x[f["quality"].to_numpy() == k]
                total[k] += y.T @ y
        yield pd.DataFrame({"k": np.arange(total.size), "v": total.ravel()})

    found = labelled.mapInPandas(sums, "k long, v double").groupBy("k").agg(F.sum("v").alias("v")).toPandas()
    out = np.zeros(2 * d * d)
    out[found["k"]] = found["v"]
    return out.reshape(2, d, d)


def fit(total: np.ndarray, shrinkage: float = SHRINKAGE) -> Discriminant | float:
    """The discriminant from the sums, or one score for all where a class is missing."""
    n = total[:, 0, 0]
    if n.min() == 0:
        return 0.5 if n.max() == 0 else float(n[1] > 0)
    shift = total[:, 0, 1:].sum(0) / n.sum()
    pooled = total[:, 1:, 1:].sum(0) / n.sum() - np.outer(shift, shift)
    scale = np.sqrt(np.maximum(np.diag(pooled), 1e-9))
    means, factors, constants = [], [], []
    for k in (0, 1):
        mean = total[k, 0, 1:] / n[k]
        cov = (total[k, 1:, 1:] / n[k] - np.outer(mean, mean)) / np.outer(scale, scale)
        # A class with few rows leans more on the pooled variances (1 on the diagonal after standardising).
        a = min(1.0, shrinkage + len(shift) / (len(shift) + n[k]))
        lower = np.linalg.cholesky((1 - a) * (cov + cov.T) / 2 + (a + 1e-6) * np.eye(len(shift)))
        means.append((mean - shift) / scale)
        factors.append(np.linalg.inv(lower))
        constants.append(math.log(n[k] / n.sum()) - np.log(np.diag(lower)).sum())
    return Discriminant(shift, scale, np.array(means), np.array(factors), np.array(constants))


def score_column(model: Discriminant | float, x: Column) -> Column:
    if isinstance(model, float):
        return F.lit(model)

    @F.pandas_udf(T.DoubleType())
    def score(rows: pd.Series) -> pd.Series:
        return pd.Series(model.scores(np.stack(rows.to_list())) if len(rows) else [], dtype="float64")

    return score(x)


def held_out(doc_id: Column, folds: int = 3, fold: int = 1) -> Column:
    return crc_mod(doc_id, folds) == fold


def classify(docs: DataFrame, labels: DataFrame, shrinkage: float = SHRINKAGE) -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document; labels of held-out rows are not looked at."""
    python_tasks(docs.sparkSession)
    rows = materialise(docs.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), features(F.col("text")).alias("x")),
                       "quality-features")
    taught = labels.filter(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select("doc_id", "quality")
    model = fit(moments(rows.filter("NOT held_out").join(taught, "doc_id").select("quality", "x")), shrinkage)
    return rows.select("doc_id", "held_out", score_column(model, F.col("x")).alias("score")) \
        .withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
