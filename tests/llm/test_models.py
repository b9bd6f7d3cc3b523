"""Fitted operators, by held-out accuracy, and their answers on odd input."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from keyflow.llm import langid, quality, toxicity


def syllables(rng, n, parts):
    return " ".join("".join(rng.choice(parts) for _ in range(rng.randrange(1, 4))) for _ in range(n)).capitalize() + "."


ENGLISH, GERMAN, FRENCH = ["the", "and", "ing", "tion", "er"], ["ung", "sch", "der", "ein", "ß"], ["que", "eau", "é", "les", "ou"]


@pytest.fixture(scope="module")
def labelled(spark):
    rng, bad = random.Random(8), ["zorgon", "flimsex", "quirbat"]
    rows, labels = [], []
    for i in range(900):
        words = syllables(rng, rng.randrange(30, 120), ENGLISH).split()
        toxic = i % 6 == 0
        if toxic:
            for _ in range(1 + len(words) // 25):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
        rows.append((i, " ".join(words), 9.0))
        labels += [(i, int(toxic))] * (1 + i % 2)
    rows += [(5000, None, None), (5001, "", None), (5001, "", None), (None, "zorgon flimsex quirbat zorgon flimsex", None)]
    labels += [(None, 1), (3, None), (9999, 1)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, toxicity double"), spark.createDataFrame(labels, "doc_id bigint, toxic int")


def test_toxicity(labelled, spark):
    docs, labels = labelled
    out = toxicity.score(docs, labels).withColumnRenamed("toxicity", "s").collect()
    assert len(out) == docs.count()
    assert all(0 <= r.s <= 1 for r in out)
    import zlib

    held = [r for r in out if r.doc_id is not None and r.doc_id < 900 and zlib.crc32(str(r.doc_id).encode()) % 3 == 1]
    right = sum((r.s >= 0.5) == (r.doc_id % 6 == 0) for r in held)
    assert right >= 0.95 * len(held)
    assert all(r.s < 0.5 for r in out if r.doc_id in (5000, 5001))
    assert {r.toxicity for r in toxicity.score(docs, labels.limit(0)).collect()} == {0.0}
    assert toxicity.score(docs.limit(0), labels).collect() == []


def test_language(spark):
    rng = random.Random(9)
    rows = [(i, syllables(rng, rng.randrange(3, 80), parts), lang) for i in range(600) for lang, parts in [[("en", ENGLISH), ("de", GERMAN), ("fr", FRENCH)][i % 3]]]
    odd = [(1000, None, "en"), (1001, "123 456 !!", "de"), (1002, "", None), (1003, "², ٣", "en"), (None, rows[0][1], None), (1004, rows[1][1] * 500, None)]
    docs = spark.createDataFrame(rows + odd + rows[:2], "doc_id bigint, text string, lang string")
    out = langid.identify(docs).collect()
    truth = {i: lang for i, _, lang in rows}
    known = [r for r in out if r.doc_id in truth]
    assert sum(r.lang_pred == truth[r.doc_id] for r in known) >= 0.97 * len(known)
    assert {(r.lang_pred, r.score) for r in out if r.doc_id in (1000, 1001, 1002, 1003)} == {("und", 0.0)}
    assert [r.lang_pred for r in out if r.doc_id == 1004] == ["de"]
    assert {r.lang_pred for r in langid.identify(docs.withColumn("lang", docs["lang"].substr(0, 0)).filter("doc_id is null")).collect()} == {"und"}
    assert langid.identify(docs.limit(0)).collect() == []


def test_a_rare_language_is_learnt(spark, monkeypatch):
    monkeypatch.setattr(langid, "FIT_ROWS", 200)
    rng = random.Random(12)
    rows = [(i, syllables(rng, rng.randrange(20, 80), GERMAN if i % 100 == 0 else ENGLISH), "de" if i % 100 == 0 else "en") for i in range(6000)]
    out = langid.identify(spark.createDataFrame(rows + rows[:1] * 300, "doc_id bigint, text string, lang string")).collect()
    right = [r.lang_pred == ("de" if r.doc_id % 100 == 0 else "en") for r in out]
    rare = [x for x, r in zip(right, out) if r.doc_id and r.doc_id % 100 == 0]
    assert len(rare) == 59 and sum(rare) >= 56 and sum(right) >= 0.97 * len(right)


def test_a_language_of_long_texts_only_is_learnt(spark):
    rng = random.Random(13)
    rows = [(i, syllables(rng, rng.randrange(20, 80), ENGLISH), "en") for i in range(300)]
    rows += [(1000 + i, syllables(rng, 4000, GERMAN), "de") for i in range(60)]
    out = langid.identify(spark.createDataFrame(rows, "doc_id bigint, text string, lang string")).collect()
    assert min(len(t.encode()) for i, t, _ in rows if i >= 1000) > 16_384
    assert sum(r.lang_pred == ("de" if r.doc_id >= 1000 else "en") for r in out) >= 0.97 * len(rows)


def test_long_texts_count_for_the_toxicity_calibration(spark):
    rng, bad = random.Random(14), ["zorgon", "flimsex", "quirbat"]
    rows, labels = [], []
    for i in range(600):
        words = [rng.choice(ENGLISH) + str(rng.randrange(5000)) for _ in range(6000 if i % 20 == 1 else rng.randrange(30, 120))]
        if i % 6 in (0, 1) and i % 4 < 2:
            for _ in range(1 + len(words) // 25):
                words.insert(rng.randrange(len(words)), rng.choice(bad))
            labels.append((i, 1))
        else:
            labels.append((i, 0))
        rows.append((i, " ".join(words)))
    docs, marks = spark.createDataFrame(rows, "doc_id bigint, text string"), spark.createDataFrame(labels, "doc_id bigint, toxic int")
    learnt, long = toxicity.sample(docs, marks, "doc_id", "text", "toxic", lambda c: F.col(c) >= 0)
    assert len(long[0]) + len(long[1]) == 30 and long[1] and all(len(t) > 16_384 for t in long[0] + long[1])
    truth = dict(labels)
    out = toxicity.score(docs, marks).collect()
    assert sum((r.toxicity >= 0.5) == bool(truth[r.doc_id]) for r in out) >= 0.95 * len(rows)
    assert all((r.toxicity >= 0.5) == bool(truth[r.doc_id]) for r in out if r.doc_id % 20 == 1)


def test_network_gradients():
    rng = np.random.default_rng(1)
    net = langid.Network(3)
    net.filters = [f.astype(float) for f in net.filters]
    x, y = rng.integers(1, 256, (5, langid.WINDOW)).astype(np.uint8), np.array([0, 1, 2, 1, 0])

    def loss():
        return -net.log_probabilities(x)[np.arange(5), y].mean()

    found = net.gradients(x, y)
    for weights, gradient in zip([*net.filters, net.out, net.bias], found):
        at = np.unravel_index(np.abs(gradient).argmax(), gradient.shape)
        step = 1e-3
        weights[at] += step
        high = loss()
        weights[at] -= 2 * step
        low = loss()
        weights[at] += step
        assert (high - low) / (2 * step) == pytest.approx(gradient[at], rel=0.05, abs=1e-4)


def test_quality(spark):
    rng = random.Random(10)
    rows, truth = [], {}
    for i in range(700):
        words = [w for _ in range(8) for w in syllables(rng, 12, [*ENGLISH, *FRENCH]).split()]
        kind = i % 10
        if kind == 0:
            words = [w + rng.choice(["###", "%%%"]) for w in words]
        elif kind == 1:
            words = [w.upper() + "!!" for w in words[:12]] * 6
        rows.append((i, " ".join(words), 1))
        truth[i] = kind > 1
    rows += [(800, None, 1), (801, "", 1), (None, rows[5][1], 1), rows[6], (802, rows[5][1] * 300, 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, quality_score int")
    out = quality.classify(docs).collect()
    assert len(out) == len(rows)
    assert sum(r.quality_kept == truth[r.doc_id] for r in out if r.doc_id in truth) >= 0.97 * 700
    assert quality.classify(docs.limit(0)).collect() == []
    assert len(quality.classify(docs.filter("doc_id = 5")).collect()) == 1
