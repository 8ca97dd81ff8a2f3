"""Language identification and quality: held-out accuracy, programmes against brute force, odd rows."""

import math
import random
import zlib

import numpy as np
import pytest

from railyard.llm import language_id, pieces, quality

ALPHABETS = {"xx": "aeioulmnr", "yy": "kztpgdbuo", "zz": "éèaeinrst"}


def text_of(lang, r, n=30):
    return " ".join("".join(r.choice(ALPHABETS[lang]) for _ in range(r.randrange(2, 9))) for _ in range(n)).capitalize() + "."


def test_marginal_and_expected_counts_against_all_segmentations():
    p = pieces.Pieces.load()
    logp = language_id.first_guess(p, 2)
    logp[:, 1] = np.roll(logp[:, 0], 7)
    index = {s: i for i, s in enumerate(p.spelling) if s and i not in p.byte_ids}

    def segmentations(word):
        if not word:
            yield []
        for k in range(1, len(word) + 1):
            if word[:k] in index:
                for rest in segmentations(word[k:]):
                    yield [index[word[:k]], *rest]

    for word in (b" the", b" station", b"ab"):
        _, m = next(pieces.by_length([word]))
        every = list(segmentations(word))
        for column in (0, 1):
            weight = [math.exp(sum(logp[i, column] for i in s)) for s in every]
            assert pieces.log_marginal(p, m, logp)[0, column] == pytest.approx(math.log(sum(weight)))
            counts = pieces.expected_pieces(p, m, np.array([3.0]), logp[:, column])
            expect = np.zeros(len(counts))
            for s, w in zip(every, weight):
                np.add.at(expect, s, 3 * w / sum(weight))
            assert counts == pytest.approx(expect)


def test_languages_held_out(make_docs):
    r = random.Random(1)
    rows = [(k, text_of(lang, r), lang, "a") for k in range(240) for lang in [r.choice(list(ALPHABETS))]]
    truth = {row[0]: row[2] for row in rows}
    rows += [(1000, None, "xx", "a"), (1001, "", "xx", "a"), (1002, "12 !! 3", "xx", "a"), (None, rows[0][1], None, "a"),
             (1003, text_of("yy", r, 9000), None, "a"), (1004, rows[1][1], "xx", "a"), (1004, rows[1][1], "xx", "a")]
    got = language_id.identify(make_docs(rows)).collect()
    assert len(got) == len(rows)
    for x in got:
        assert x.held_out == (zlib.crc32(str("" if x.doc_id is None else x.doc_id).encode()) % 4 == 2) and 0 <= x.score <= 1
    by_id = {x.doc_id: x for x in got}
    assert all(by_id[k].lang_pred == "und" and by_id[k].score == 0 for k in (1000, 1001, 1002))
    assert by_id[None].lang_pred == rows[0][2] and by_id[1003].lang_pred == "yy"
    assert sum(by_id[k].lang_pred == v for k, v in truth.items() if by_id[k].held_out) >= 0.97 * sum(x.held_out for x in got if x.doc_id in truth)


def test_languages_without_anything_to_learn(make_docs):
    assert language_id.identify(make_docs([])).collect() == []
    got = language_id.identify(make_docs([(k, "some text", None, "a") for k in range(5)])).collect()
    assert {(x.lang_pred, x.score) for x in got} == {("und", 0.0)}


def test_numbers_are_no_letters():
    from railyard.llm.language_id import words_of
    assert words_of("½ ² Ⅷ ① 7 _ ٣") == [] and words_of("aⅧb é½ über x² ñandú Straße") == ["a", "b", "é", "über", "x", "ñandú", "straße"]


def test_bounded_sample_is_enough(make_docs):
    r = random.Random(2)
    rows = [(k, text_of(lang, r), lang, "a") for k in range(200) for lang in [r.choice(list(ALPHABETS))]]
    truth = {row[0]: row[2] for row in rows}
    got = language_id.identify(make_docs(rows), train_rows=60).collect()
    assert sum(truth[x.doc_id] == x.lang_pred for x in got) >= 190


def test_every_language_is_learned_from_a_bounded_sample(make_docs):
    r = random.Random(6)
    rows = [(k, text_of("xx", r, 4), "xx", "a") for k in range(3000)] + [(5000 + k, text_of("zz", r), "zz", "a") for k in range(6)]
    model = language_id.learn(make_docs(rows), train_rows=60)
    assert model.languages == ["xx", "zz"] and np.ptp(model.logp[:, 1]) > 1
    whole = language_id.learn(make_docs(rows[3000:]))
    assert model.logp[:, 1] == pytest.approx(whole.logp[:, 0])
    assert language_id.most_rows({"a": 5, "b": 100, "c": 1000}, 65) == 30 and language_id.most_rows({"a": 5}, 5) == float("inf")


def quality_rows(words, n=400):
    r = random.Random(3)
    rows, labels = [], []
    for k in range(n):
        good = k % 3 != 0
        text = " ".join(r.choice(words) for _ in range(r.randrange(5, 120)))
        rows.append((k, text.capitalize() + "." if good else "!! ".join(text.upper().split()), "en", "a"))
        labels.append((k, int(good), 0))
    return rows, labels


LABELS = "doc_id long, quality int, toxic int"


def test_quality_held_out(spark, make_docs, words):
    rows, labels = quality_rows(words)
    rows += [(900, None, "en", "a"), (901, "", "en", "a"), (None, "Some text.", "en", "a"), (902, "word " * 20000, "en", "a"), (902, "x", "en", "a")]
    wrong = [(k, 1 - q, t) if zlib.crc32(str(k).encode()) % 3 == 1 else (k, q, t) for k, q, t in labels]
    odd = [(None, 1, 0), (5000, 1, 0), (3, None, 0)]
    got = quality.classify(make_docs(rows), spark.createDataFrame(labels + odd, LABELS)).collect()
    assert len(got) == len(rows) and all(0 <= x.score <= 1 and x.predicted == (x.score >= 0.5) for x in got)
    truth = dict((k, q) for k, q, _ in labels)
    held = [x for x in got if x.held_out and x.doc_id in truth]
    assert held and sum(x.predicted == truth[x.doc_id] for x in held) >= 0.97 * len(held)
    # Labels of held-out rows change nothing.
    again = quality.classify(make_docs(rows), spark.createDataFrame(wrong + odd, LABELS)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_quality_without_a_class(spark, make_docs, words):
    rows, labels = quality_rows(words, 30)
    docs = make_docs(rows)
    score = lambda x: {r.score for r in quality.classify(docs, spark.createDataFrame(x, LABELS)).collect()}
    assert score([]) == {0.5} and score([x for x in labels if x[1]]) == {1.0} and score([x for x in labels if not x[1]]) == {0.0}
    assert quality.classify(make_docs([]), spark.createDataFrame(labels, LABELS)).collect() == []


def test_discriminant_against_densities():
    r = np.random.default_rng(0)
    d = len(quality.FEATURES)
    x = [r.normal(size=(300, d)), r.normal(size=(500, d)) * 1.5 + 0.3]
    total = np.array([np.column_stack([np.ones(len(y)), y]).T @ np.column_stack([np.ones(len(y)), y]) for y in x])
    model = quality.fit(total)
    log = []
    for k, y in enumerate(x):
        z = (y - model.shift) / model.scale
        a = min(1.0, quality.SHRINKAGE + d / (d + len(y)))
        cov = (1 - a) * np.cov(z.T, bias=True) + (a + 1e-6) * np.eye(d)
        q = (x[1][:20] - model.shift) / model.scale - z.mean(0)
        log.append(math.log(len(y) / 800) - 0.5 * np.linalg.slogdet(cov)[1] - 0.5 * np.einsum("ni,ij,nj->n", q, np.linalg.inv(cov), q))
    assert model.scores(x[1][:20]) == pytest.approx(1 / (1 + np.exp(log[0] - log[1])))
