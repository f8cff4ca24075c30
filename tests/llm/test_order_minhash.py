"""Operator 7 against brute force over all pairs."""

import random

import numpy as np
import pyarrow as pa

from tickspark.llm import common, order_minhash
from tickspark.llm.common import numbered
from tickspark.llm.order_minhash import aligned, components, keep_one, labelled, near_classes, similarity, sketch


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = row[:]
        for j, y in enumerate(b):
            row[j + 1] = last[j] + 1 if x == y else max(row[j], last[j + 1])
    return row[-1]


def test_alignment_is_the_longest_common_subsequence():
    rng = random.Random(1)
    for _ in range(200):
        a, b = rng.sample(range(40), rng.randrange(1, 30)), rng.sample(range(40), rng.randrange(1, 30))
        assert aligned(np.array(a, np.uint64), np.array(b, np.uint64), band=10.0) == lcs(a, b)


def test_sketches_notice_order():
    keys = np.arange(1, 60, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    same, turned = sketch(keys, 24, 3), sketch(keys[::-1].copy(), 24, 3)
    assert (sketch(keys.copy(), 24, 3) == same).all() and (same == turned).mean() < 0.2


def edited(rng, words, n):
    out = list(words)
    for _ in range(n):
        out[rng.randrange(len(out))] = f"new{rng.getrandbits(40)}"
    return out


def corpus():
    rng = random.Random(9)
    texts = []
    for g in range(30):
        base = [f"w{rng.getrandbits(24)}" for _ in range(rng.randrange(150, 400))]
        texts.append(" ".join(base))
        for n in (1, 2, 4, 40):
            texts.append(" ".join(edited(rng, base, n)))
        texts.append(" ".join(base).upper() + "!")
        texts.append(" ".join(reversed(base)))
    return texts + [None, "", "...", "one two", "One, two", "two one", "x " * 20_000]


def test_classes_equal_brute_force(docs_of):
    texts = corpus()
    rows = {r.doc_id: r for r in near_classes(docs_of(texts)).collect()}
    assert len(rows) == len(texts)

    def word_ids(t):
        import pyarrow as pa
        from tickspark.llm.common import hashed_words
        return next(hashed_words(pa.array([t], pa.string())))[1]

    words = [word_ids(t) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(max(0, i - 8), i):  # copies stand within a group of seven
            if similarity(words[i], words[j], 5) >= 0.8:
                parent[find(i)] = find(j)
    for i in range(len(texts)):
        for j in range(i):
            assert (rows[i].class_row == rows[j].class_row) == (find(i) == find(j)), (i, j)


def test_repeated_passages_are_one_class(docs_of):
    rng = random.Random(4)
    texts = []
    for _ in range(12):
        passage = " ".join(f"w{rng.getrandbits(24)}" for _ in range(60))
        texts += [passage, " ".join([passage] * 3), " ".join([passage] * 10)]
    rows = {r.doc_id: r.class_row for r in near_classes(docs_of(texts)).collect()}
    assert [len({rows[k] for k in range(g, g + 3)}) for g in range(0, 36, 3)] == [1] * 12
    assert len(set(rows.values())) == 12


def test_close_pairs_inside_a_large_family(docs_of):
    """300 texts of 30 slots with two fillings, mostly 0.6 alike, so no shingle belongs to few
    texts; every second is a copy of the one before with five slots turned."""
    rng = random.Random(6)

    def text(slots):
        return " ".join(f"{'ab'[slots[k // 10]] if k % 10 == 5 else 'w'}{k}" for k in range(300))

    texts = []
    for _ in range(150):
        slots = [rng.randrange(2) for _ in range(30)]
        turned = rng.sample(range(30), 5)
        texts += [text(slots), text([s ^ (k in turned) for k, s in enumerate(slots)])]
    rows = {r.doc_id: r.class_row for r in near_classes(docs_of(texts)).collect()}
    words = [np.array([hash(w) & 0xFFFFFFFF for w in t.split()], np.uint64) for t in texts]
    parent = list(range(len(texts)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(texts)):
        for j in range(i):
            if similarity(words[i], words[j], 5) >= 0.8:
                parent[find(i)] = find(j)
    groups = {}
    for i in range(len(texts)):
        groups.setdefault(find(i), set()).add(i)
    got = {}
    for i, c in rows.items():
        got.setdefault(c, set()).add(i)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, groups.values()))


def test_keep_one_and_empty_table(docs_of):
    docs = docs_of(["a b c d e f", "A b c d e f.", None, "", "g h"], ids=[5, 5, None, 7, 8])
    kept = keep_one(docs)
    assert kept.columns == docs.columns and kept.count() == 3
    assert keep_one(docs_of([])).collect() == []


def test_components_of_a_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(40)] + [(100, 101)], "a long, b long")
    got = {r["row"]: r["class"] for r in components(edges).collect()}
    assert got == {**{k: 0 for k in range(41)}, 100: 100, 101: 100}


def test_occurrence_labels_tell_repeats_apart():
    keys = np.array([5, 7, 5, 5, 9, 7], np.uint64)
    named = labelled(keys)
    assert len(set(named.tolist())) == 6
    # The k-th occurrence has the same label whatever stands around it.
    assert set(labelled(np.array([5, 5], np.uint64)).tolist()) == set(named[[0, 2]].tolist())
    assert labelled(keys[:0]).tolist() == []


def test_row_numbers_do_not_change_with_the_cores(spark, tmp_path):
    spark.range(4000).repartition(9).selectExpr("id as doc_id", "cast(id as string) as text").write.parquet(str(tmp_path / "t"))
    read = spark.read.parquet(str(tmp_path / "t"))
    seen = []
    for size in ("1k", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        seen.append(sorted(map(tuple, numbered(read, "n").select("doc_id", "n").collect())))
    spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] and len({n for _, n in seen[0]}) == 4000
    assert len({r.n for r in numbered(read.where("doc_id > 10").distinct(), "n").collect()}) == 3989


def test_keep_one_keeps_columns_of_its_own_names(docs_of):
    docs = docs_of(["one two three four five six seven"] * 3 + ["another text of words here"]).withColumnRenamed("row", "__row")
    kept = keep_one(docs)
    assert kept.columns == docs.columns and sorted(r["__row"] for r in kept.collect()) == ["extra", "extra"]


def test_texts_are_not_shuffled_to_be_chosen(spark, docs_of, tmp_path):
    docs_of([f"text {k % 40} of words that are their own {k % 40}" for k in range(80)]).write.parquet(str(tmp_path / "t"))
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as if no side were small
    try:
        kept = keep_one(spark.read.parquet(str(tmp_path / "t")))
        plan = kept._jdf.queryExecution().executedPlan().toString()
        assert kept.count() == 40
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    assert "hashpartitioning" not in plan and "SortMergeJoin" not in plan


def test_chosen_rows_are_those_named(spark, monkeypatch):
    rows = [0, 1, 7, 8, 32767, 32768, 32769, (3 << 40) + 5, (1 << 33) + 2]
    docs = spark.createDataFrame([(r + d, str(r)) for r in rows for d in (0, 100_000)], "n long, __bits string")
    ids = spark.createDataFrame([(r,) for r in [*rows, rows[0], None, 99]], "x long")
    for most in (common.BROADCAST_BITS, 0):
        monkeypatch.setattr(common, "BROADCAST_BITS", most)
        got = common.among(docs, ids, "n")
        assert got.columns == ["n", "__bits"] and sorted(r.n for r in got.collect()) == sorted(rows)


def test_components_go_on_with_the_edges_between_ends(spark, monkeypatch):
    seen = []

    def stored(df, name):
        out = common.stored(df, name)
        if name == "cc-edges":
            seen.append(out.count())
        return out

    monkeypatch.setattr(order_minhash, "stored", stored)
    rng = random.Random(2)
    edges = [tuple(sorted(rng.sample(range(200), 2))) for _ in range(800)] + [(500, 500), (7, 900)]
    got = {r["row"]: r["class"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    parent = {x: x for e in edges for x in e}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        low, high = sorted((find(a), find(b)))
        parent[high] = low
    assert got == {x: find(x) for x in parent}
    assert seen[0] == len(set(edges)) and seen[-1] == 0 and sum(seen[1:]) < seen[0] / 4


def test_sketches_come_in_small_batches():
    texts = pa.array([f"some words of text {k}" for k in range(1200)])
    batch = pa.RecordBatch.from_arrays([pa.array(range(1200)), pa.array(range(1200)), texts], ["row", "doc_id", "text"])
    made = list(order_minhash._sketch_rows(5, 24, 8, 3)([batch]))
    assert sum(b.num_rows for b in made) == 1200 and max(b.num_rows for b in made) <= 500
