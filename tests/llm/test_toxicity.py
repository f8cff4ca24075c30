"""Operator 2: held-out accuracy on a small planted set, and odd rows."""

import random

from pyspark.sql import functions as F

from tickspark.llm.common import id_bucket
from tickspark.llm.toxicity import Features, reject_toxic, score_toxicity


def corpus(n=400):
    rng = random.Random(3)
    words = ["river", "table", "green", "window", "paper", "market", "garden", "letter"]
    texts, labels = [], []
    for i in range(n):
        own = rng.choices(words, k=40)
        bad = i % 5 == 0
        if bad:
            own[rng.randrange(40)] = "you"
            for _ in range(3):
                own[rng.randrange(40)] = rng.choice(["blorgh", "snarfel"])
        texts.append(" ".join(own))
        labels.append(int(bad))
    return texts, labels


def test_held_out_accuracy_and_odd_rows(spark, docs_of):
    texts, labels = corpus()
    texts += [None, "", "word " * 30_000, texts[0], texts[0]]
    ids = [*range(len(texts) - 2), 0, None]
    lab = spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)] + [(None, 1, 1), (3, 1, None)],
                                "doc_id long, quality int, toxic int")
    docs = docs_of(texts, ids).withColumn("x", F.lit(1))
    may = id_bucket(F.col("doc_id"), 4) != 2
    out = score_toxicity(docs, lab, may)
    assert out.columns == [*docs.columns, "tox_score"]
    rows = out.withColumn("held", ~may).collect()
    assert len(rows) == len(texts) and all(0 <= r.tox_score <= 1 for r in rows)
    held = [(r.tox_score >= 0.3, labels[r.doc_id]) for r in rows if r.held and r.doc_id is not None and r.doc_id < len(labels)]
    assert sum(a == bool(b) for a, b in held) / len(held) > 0.95
    kept = reject_toxic(docs, lab, may_learn=may)
    assert kept.columns == docs.columns
    assert kept.count() == sum(r.tox_score < 0.3 for r in rows)


def test_one_class_and_empty_tables(spark, docs_of):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [r.tox_score for r in score_toxicity(docs_of(["a", None]), none).collect()] == [0.0, 0.0]
    assert score_toxicity(docs_of([]), none).collect() == []


def test_features_find_obfuscated_words():
    f = Features({"blorgh": 3.0})
    assert f.of("you BL0RGH now")[11] > 0 and f.of("you blorgh now")[6] > 0
    assert f.of(None)[:12] == [0.0] * 12


def test_a_column_of_that_name_stays(spark, docs_of):
    texts, labels = corpus(200)
    lab = spark.createDataFrame([(i, 1, y) for i, y in enumerate(labels)], "doc_id long, quality int, toxic int")
    docs = docs_of(texts).withColumn("TOX_score", F.lit(0.77))
    assert score_toxicity(docs, lab).columns == [*docs.columns, "tox_score_"]
    assert {r.TOX_score for r in reject_toxic(docs, lab).collect()} == {0.77}
