"""Operator 10: deadlines and deviation of the schedule, by brute force."""

import random

import pytest

from tickspark.llm.pfair_mix import mix, one_period, schedule, shares


@pytest.mark.parametrize("seed", range(6))
def test_every_block_meets_its_deadline(seed):
    rng = random.Random(seed)
    whole = shares({f"s{k}": rng.random() ** 3 for k in range(rng.randrange(1, 25))})
    period = sum(whole.values())
    served = dict.fromkeys(whole, 0)
    rows = one_period(whole)
    assert [r[4] for r in rows] == list(range(period))
    for s, i, release, due, slot in rows:
        assert i == served[s] and release <= slot < due
        served[s] += 1
        assert all(abs(served[x] * period - whole[x] * (slot + 1)) < period for x in whole)
    assert served == whole


def test_schedule_of_documents(spark, docs_of):
    rng = random.Random(3)
    texts = ["x" * rng.randrange(0, 200) for _ in range(900)]
    sources = [rng.choice(["big"] * 6 + ["mid", "mid", "small", None]) for _ in texts]
    docs = docs_of(texts, sources=sources)
    rows = schedule(docs, weights={"big": 0.5, "mid": 0.25, "small": 0.2, None: 0.05}, block_chars=500, bucket_rows=50).collect()
    assert sorted(r.doc_id for r in rows) == list(range(900))
    by = {}
    for r in rows:
        assert r.__getitem__("__release") <= r["__slot"] < r["__deadline"] and r["__block"] == r["__start"] // 500
        by.setdefault(r.source, []).append(r)
    period = sum({r.source: r["__weight"] for r in rows}.values())
    for own in by.values():
        own.sort(key=lambda r: r["__start"])
        at = 0
        for r in own:  # starts are the running sums of sizes: no gap, no overlap
            assert r["__start"] == at
            at += max(1, len(r.text))
    horizon = min(max(r["__slot"] for r in own) for own in by.values())
    for t in range(1, horizon, 7):
        for own in by.values():
            blocks = {r["__block"] for r in own}
            done = sum(1 for b in range(max(blocks) + 1) if _slot(own, b, period) < t)
            assert abs(done - own[0]["__weight"] * t / period) < 1


def _slot(own, block, period):
    got = [r["__slot"] for r in own if r["__block"] == block]
    if got:
        return got[0]
    # a block inside one long text has no start of its own; its place lies between its neighbours'
    return min(r["__slot"] for r in own if r["__block"] > block) - 1


def test_mix_keeps_rows_and_order(spark, docs_of, tmp_path):
    docs = docs_of([f"t{k} " * 50 for k in range(200)], sources=["a" if k % 3 else "b" for k in range(200)])
    mixed = mix(docs, block_chars=500)
    assert mixed.columns == docs.columns
    assert sorted(map(tuple, mixed.collect())) == sorted(map(tuple, docs.collect()))
    place = {r.doc_id: (r["__slot"], r["__start"]) for r in schedule(docs, block_chars=500).collect()}
    order = [place[r.doc_id] for r in mixed.collect()]
    assert order == sorted(order)


def test_repeated_rows_and_empty_table(docs_of):
    docs = docs_of([None, "", "a", "a"], ids=[1, 1, None, None], sources=[None, None, "s", "s"])
    assert len(schedule(docs).collect()) == 4
    assert schedule(docs_of([])).collect() == []


def test_mix_keeps_columns_of_any_name(spark):
    from tickspark.llm.pfair_mix import mix
    docs = spark.createDataFrame([(k, "t" * (k + 1), "s", "mine") for k in range(5)], "doc_id long, text string, source string, __source string")
    out = mix(docs)
    assert out.columns == docs.columns and {r["__source"] for r in out.collect()} == {"mine"} and out.count() == 5
