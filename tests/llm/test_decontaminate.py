"""Operator 4 against brute-force greedy string tiling."""

import random

import numpy as np

from tickspark.llm.decontaminate import drop_contaminated, find_leaks, find_pairs, tile


def brute_tiles(a, b, least):
    fa, fb, out = [True] * len(a), [True] * len(b), []
    while True:
        best = []
        for i in range(len(a)):
            for j in range(len(b)):
                n = 0
                while i + n < len(a) and j + n < len(b) and a[i + n] == b[j + n] and fa[i + n] and fb[j + n]:
                    n += 1
                if n >= least:
                    best.append((n, i, j))
        if not best:
            return out
        longest = max(best)[0]
        for n, i, j in sorted((m for m in best if m[0] == longest), key=lambda m: (m[2], m[1])):
            if all(fa[i:i + n]) and all(fb[j:j + n]):
                fa[i:i + n] = [False] * n
                fb[j:j + n] = [False] * n
                out.append((i, j, n))


def test_tiles_equal_brute_force():
    rng = random.Random(5)
    for _ in range(150):
        a = [rng.randrange(3) for _ in range(rng.randrange(1, 40))]
        b = [rng.randrange(3) for _ in range(rng.randrange(3, 25))]
        got = tile(np.array(a, np.uint64), np.array(b, np.uint64), 3)
        assert sorted(got) == sorted(brute_tiles(a, b, 3))


ITEM = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho sigma tau upsilon"


def cases():
    w = ITEM.split()
    filler = " ".join(f"filler{k}" for k in range(3000))
    return {0: ITEM, 1: f"{filler} {ITEM.upper()}! {filler}", 2: " ".join(w[10:] + ["so"] + w[:10]), 3: " ".join(w[:10]),
            4: None, 5: "", 6: filler, 7: " ".join(w[::2]), 8: ITEM}


def test_leaks_reordered_partial_and_odd_rows(spark, docs_of):
    bench = spark.createDataFrame([(1, ITEM, "x"), (2, None, "x"), (3, "", "x"), (4, "two words", "x")], "item_id long, text string, doc_id string")
    docs = docs_of([*cases().values(), "here are two words only"], [*list(cases())[:-1], None, 9])
    for limit in (10**6, 0):  # broadcast index, then joined windows
        got = sorted(((r.doc_id if r.doc_id is not None else -1), r.item_id) for r in find_leaks(docs, bench, broadcast_words=limit).collect())
        assert got == [(-1, 1), (0, 1), (1, 1), (2, 1), (9, 4)]
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [3, 4, 5, 6, 7]  # the null id and 9 go as well


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert find_pairs(docs_of(["a b c d e f"]), bench).collect() == []
    assert find_pairs(docs_of([]), bench).collect() == []


def test_one_word_everywhere_is_tiled_in_time():
    import time
    start = time.perf_counter()
    same = np.full(40_000, 7, np.uint64)
    assert tile(same, same[:9_000], 5) == [(0, 0, 9_000)]
    rng = np.random.default_rng(1)
    few = rng.integers(0, 2, 4_000).astype(np.uint64)
    tiles = tile(few, few[::-1][:800].copy(), 5)
    assert all((few[d:d + n] == few[::-1][i:i + n]).all() for d, i, n in tiles)
    assert time.perf_counter() - start < 20


def test_unspaced_benchmark_counts_by_its_bytes_and_names_may_clash(spark, docs_of):
    docs = docs_of([ITEM, "clean text of some other words"]).withColumnRenamed("row", "__row")
    bench = spark.createDataFrame([(1, ITEM), (2, "x" * 5000)], "item_id long, text string")
    for words in (10, 2_000_000):
        assert [r.doc_id for r in find_leaks(docs, bench, broadcast_words=words).collect()] == [0]
    kept = drop_contaminated(docs, bench)
    assert kept.columns == docs.columns and [(r.doc_id, r["__row"]) for r in kept.collect()] == [(1, "extra")]
