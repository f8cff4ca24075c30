"""Positions over ranges against plain sorting: hot groups, nulls, ties, clashing names."""

import random

from pyspark.sql import functions as F

from tickspark.operators.ranking import ranked


def test_ranks_equal_plain_sorting(spark):
    rng = random.Random(5)
    rows = [(rng.choice([None, "a", "b", "hot", "hot", "hot"]), rng.choice([None, *range(40)]), k, "x") for k in range(3000)]
    df = spark.createDataFrame(rows, "g string, v int, k int, __at string").repartition(7)
    out = ranked(df, ["g"], [F.col("v").asc_nulls_first(), F.col("k").asc()], rank="r", size="n")
    assert out.columns == ["g", "v", "k", "__at", "r", "n"]
    want = {}
    for g in {r[0] for r in rows}:
        group = sorted((r for r in rows if r[0] == g), key=lambda r: (r[1] is not None, r[1] or 0, r[2]))
        want |= {r[2]: (g, i, len(group)) for i, r in enumerate(group)}
    got = {r.k: (r.g, r.r, r.n) for r in out.collect()}
    assert got == want


def test_no_groups_equal_rows_and_empty(spark):
    df = spark.createDataFrame([(1,)] * 50, "v int").repartition(4)
    out = ranked(df, [], [F.col("v")])
    assert sorted(r.rank for r in out.collect()) == list(range(50)) and {r.size for r in out.collect()} == {50}
    assert ranked(df.where("v > 1"), [], [F.col("v")]).collect() == []
