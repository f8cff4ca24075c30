"""Operator 13: features, attention and gradient against plain versions, held-out accuracy, odd rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickspark.llm import quality_mil as q
from tickspark.llm.common import id_bucket

WORDS = ["river", "table", "green", "window", "paper", "market", "garden", "letter", "é"]


def text(rng, bad):
    lines = [" ".join(rng.choices(WORDS, k=rng.randint(5, 60))) + "." for _ in range(rng.randint(1, 6))]
    if bad:
        lines[rng.randrange(len(lines))] = rng.choice(["river " * 30, " | ".join(rng.choices(WORDS, k=20)), "TABLE!! " * 9])
    return "\n".join(lines)


def plain_passages(t):
    """Cut a text by lines and PASSAGE bytes; (bytes, words that start there)."""
    out, data = [], t.encode()
    for line in data.splitlines(keepends=True):
        for k in range(0, len(line), q.PASSAGE):
            starts = [j for j in range(k, min(k + q.PASSAGE, len(line))) if line[j] not in b" \t\n\x0b\x0c\r" and (j == 0 or line[j - 1] in b" \t\n\x0b\x0c\r")]
            out.append((line[k:k + q.PASSAGE], [line[j:].split(maxsplit=1)[0] for j in starts]))
    return [(part, words) for part, words in out if words]


def test_features_against_a_plain_version():
    rng = random.Random(1)
    texts = [text(rng, k % 2) for k in range(30)] + ["", None, " \n ", "a" * 2000 + " b\n" * 3, "x\n" * 50]
    rows = {}
    for row, doc, x in q.bags(pa.array(texts)):
        for d, f in zip(doc + row, x):
            rows.setdefault(int(d), []).append(f)
    assert sorted(rows) == list(range(len(texts)))
    for k, t in enumerate(texts):
        want = plain_passages(t or "")
        if not want:
            assert np.array_equal(rows[k], np.zeros((1, q.N_FEATURES + 1)))
            continue
        assert len(rows[k]) == len(want)
        before, told = [], []
        for (part, words), f in zip(want, rows[k]):
            n = len(words)
            assert f[0] == pytest.approx(sum(65 <= b <= 90 for b in part) / len(part))
            assert f[q.N_CLASSES] == pytest.approx(np.log1p(len(part))) and f[q.N_CLASSES + 1] == pytest.approx(np.log1p(n))
            assert f[q.N_CLASSES + 2] == pytest.approx(np.mean([len(w) for w in words]))
            assert f[q.N_CLASSES + 3] == pytest.approx(np.std([len(w) for w in words]), abs=1e-6)
            said = told + words
            assert f[q.N_CLASSES + 4] == pytest.approx(sum(said[i] == said[i - 1] for i in range(max(len(told), 1), len(said))) / n)
            assert f[q.N_CLASSES + 5] == pytest.approx(sum(said[i] == said[i - 2] for i in range(max(len(told), 2), len(said))) / n)
            assert f[q.N_CLASSES + 6] == pytest.approx(len(set(words)) / n)
            assert f[-1] == (words in before)
            before.append(words)
            told = said


def model(seed=4):
    rng = np.random.default_rng(seed)
    return q.Model(np.full(q.N_FEATURES + 1, 0.1), np.full(q.N_FEATURES + 1, 0.7), {k: rng.normal(0, 0.5, s) for k, s in q.Model.SHAPES.items()})


def plain_score(m, x):
    p, s = m.weights, np.clip((x - m.mean) / m.scale, -8, 8)
    h = [np.tanh(r @ p["W"] + p["b"]) for r in s]
    a = [sum(np.tanh(r @ p["V"] + p["v"]) * (1 / (1 + np.exp(-(r @ p["U"] + p["u"])))) * p["w"]) for r in h]
    e = np.exp(np.array(a) - max(a))
    return 1 / (1 + np.exp(-(sum(w * r for w, r in zip(e / e.sum(), h)) @ p["o"] + p["c"][0])))


def test_scores_against_plain_attention_also_in_pieces(monkeypatch):
    rng = random.Random(2)
    texts = [text(rng, k % 3 == 0) for k in range(12)] + [None, "word " * 4000, "x" * 3000]
    m, bag = model(), {}
    for step in (q.STEP, 1000):
        monkeypatch.setattr(q, "STEP", step)
        bag = {}
        for row, doc, x in q.bags(pa.array(texts)):
            for d, f in zip(doc + row, x):
                bag.setdefault(int(d), []).append(f)
        want = [plain_score(m, np.array(bag[k])) for k in range(len(texts))]
        assert np.allclose(m.scores(pa.array(texts)), want)


def test_gradient_against_differences():
    rng = np.random.default_rng(3)
    m, x, begin, y = model(), rng.normal(size=(9, q.N_FEATURES + 1)), np.array([0, 3, 4]), np.array([1.0, 0.0, 1.0])
    _, grad = m.gradient(x, begin, y)
    for name, w in m.weights.items():
        for at in [tuple(rng.integers(0, s) for s in w.shape) for _ in range(4)]:
            keep = w[at]
            w[at] = keep + 1e-6
            up = m.gradient(x, begin, y)[0]
            w[at] = keep - 1e-6
            down = m.gradient(x, begin, y)[0]
            w[at] = keep
            assert grad[name][at] == pytest.approx((up - down) / 2e-6, abs=1e-5)


def test_held_out_accuracy_and_odd_rows(spark, docs_of):
    rng = random.Random(6)
    bad = [k % 4 == 0 for k in range(600)]
    texts = [text(rng, b) for b in bad] + [None, "", "word " * 100_000, "long" * 50_000]
    ids = [*range(len(texts) - 1), None]
    docs = docs_of(texts + texts[:2], [*ids, 0, 1]).withColumn("QUALITY_score", F.lit("clash"))
    labels = spark.createDataFrame([(k, int(not b), 0) for k, b in enumerate(bad)] + [(None, 1, 0), (3, None, 0)],
                                   "doc_id long, quality int, toxic int")
    may = id_bucket(F.col("doc_id"), 5) != 0
    out = q.score_quality(docs, labels, may, epochs=25)
    assert out.columns == [*docs.columns, "quality_score_"]
    rows = out.withColumn("held", ~may).collect()
    assert len(rows) == len(texts) + 2 and all(0 <= r.quality_score_ <= 1 for r in rows)
    held = [(r.quality_score_ >= 0.3) != bad[r.doc_id] for r in rows if r.held and r.doc_id is not None and r.doc_id < 600]
    assert len(held) > 80 and sum(held) / len(held) > 0.95


def test_held_out_labels_and_columns_teach_nothing(spark, docs_of):
    rng = random.Random(7)
    texts = [text(rng, k % 3 == 0) for k in range(120)]
    may = id_bucket(F.col("doc_id"), 5) != 0

    def scores(flip, source):
        labels = spark.createDataFrame([(k, int((k % 3 != 0) != (flip and flipped[k])), 0) for k in range(120)], "doc_id long, quality int, toxic int")
        out = q.score_quality(docs_of(texts, sources=[source] * 120), labels, may, epochs=2)
        return sorted((r.doc_id, r.quality_score) for r in out.collect())

    flipped = [r.held for r in docs_of(texts).select("doc_id", (~may).alias("held")).orderBy("doc_id").collect()]
    assert any(flipped) and scores(False, "s") == scores(True, "t")


def test_sample_bounds_one_class_and_empty_tables(spark, docs_of):
    labels = spark.createDataFrame([(k, k % 2, 0) for k in range(40)], "doc_id long, quality int, toxic int")
    docs = docs_of(["x" * 10] * 40)
    sample = q.labelled_sample(docs, labels, F.lit(True), "doc_id", "text", "quality", 20, 100)
    assert sample.count() == 10
    ones = labels.where("quality = 1")
    assert {r.quality_score for r in q.score_quality(docs, ones).collect()} == {1.0}
    assert {r.quality_score for r in q.score_quality(docs, ones.limit(0)).collect()} == {0.5}
    assert q.score_quality(docs_of([]), labels).collect() == []
