"""Exact quantiles by rank selection against plain interpolation."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tickspark.functions.quantiles import magnitude
from tickspark.operators import stats
from tickspark.operators.quantiles import exact_quantiles

PROBS = (0.0, 0.25, 0.5, 0.95, 0.99, 1.0)


def same(a, b):
    return a == b or (math.isnan(a) and math.isnan(b)) or a == pytest.approx(b, rel=1e-14, abs=1e-300)


def plain(values, p):
    v = sorted(values, key=lambda x: (math.isnan(x), x))
    at = (len(v) - 1) * p
    low = math.floor(at)
    return v[low] if at == low else v[low] * (1 - (at - low)) + v[low + 1] * (at - low)


@pytest.mark.parametrize("one_task", [1 << 22, 0])
def test_groups_columns_nulls_and_ties(spark, one_task):
    rng = random.Random(8)
    rows = []
    for _ in range(4000):
        g = rng.choice([None, "a", "hot", "hot", "hot"])
        rows.append((g, rng.choice([None, rng.gauss(0, 1), rng.gauss(100, 1e-9), 100.0, 10 ** rng.uniform(-300, 300), 0.0, -0.0]),
                     rng.randint(0, 5)))
    rows += [("none", None, None), ("one", 5.0, 7)]
    df = spark.createDataFrame(rows, "g string, x double, k int").repartition(5)
    got = {r.g: r for r in exact_quantiles(df, ["x", "k"], PROBS, ["g"], one_task).collect()}
    assert set(got) == {None, "a", "hot", "one"}
    for g, r in got.items():
        for c, i in (("x", 1), ("k", 2)):
            want = [plain([float(row[i]) for row in rows if row[0] == g and row[i] is not None], p) for p in PROBS]
            assert all(same(a, b) for a, b in zip(r[c], want)), (g, c)


@pytest.mark.parametrize("values", [
    [1.0 + k * 2.0 ** -52 for k in range(500)],                                  # neighbours among doubles
    [math.inf, -math.inf, math.nan, 0.0, 5e-324, -5e-324, 1.7e308, -1.7e308, 1.0],  # ends of the range
    [-3.0] * 9, [2.0 ** k for k in range(-1000, 1000, 7)]])
def test_odd_values(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(3)
    for one_task in (1 << 22, 0):
        (row,) = exact_quantiles(df, ["x"], (0.0, 0.5, 1.0), one_task=one_task).collect()
        assert all(same(a, plain(values, p)) for a, p in zip(row.x, (0.0, 0.5, 1.0)))


def test_magnitudes_never_fall(spark):
    values = sorted({s * m * 2.0 ** e for s in (1, -1) for e in range(-1074, 1023, 3) for m in (1.0, 1.01, 1.999)} | {0.0})
    rows = spark.createDataFrame([(v,) for v in values], "x double").withColumn("m", magnitude(F.col("x"))).collect()
    got = [r.m for r in sorted(rows, key=lambda r: r.x)]
    assert got == sorted(got) and max(got) - min(got) < 1 << 19


def test_reports_over_empty_and_null_groups(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 4.0), (None, 2.0), ("n", None)], "g string, x double")
    got = {r.g: r for r in stats.describe(df, "x", keys=["g"]).collect()}
    assert got["a"].median == 2.5 and got[None].median == 2.0 and got["n"].median is None
    (none,) = stats.describe(df.where("false"), "x").collect()
    assert none.median is None and none.min is None
    (q,) = stats.quantiles(df, "x", (0.5, 0.9)).collect()
    assert q.median == 2.0 and q.n == 3 and q.p90 == pytest.approx(np.quantile([1, 2, 4], 0.9))


def test_no_map_of_a_whole_group_in_the_plan(spark):
    df = spark.range(1000).select((F.col("id") % 97).cast("double").alias("x"))
    plan = stats.describe(df, "x")._jdf.queryExecution().executedPlan().toString().lower()
    assert not any(word in plan for word in ("percentile(", "median(", "cartesian", "nestedloop"))


@pytest.mark.parametrize("one_task", [1 << 22, 0])
def test_consistency_from_partial_sums(spark, one_task, monkeypatch):
    from tickspark.operators import quantiles
    monkeypatch.setattr(quantiles.quantiles_of_counts, "__defaults__", ((), one_task, ()))
    rng = random.Random(4)
    rows = [(rng.choice(["A", "B", None]), rng.choice([None, 0.01, 0.02, 0.05]), rng.choice([None, rng.gauss(0, 0.1)]),
             rng.choice(["within_spread", "below_bid", "above_ask"]), rng.randint(1, 9)) for _ in range(500)] + [("one", 0.5, 0.1, "below_bid", 3)]
    df = spark.createDataFrame(rows, "symbol string, spread double, price_vs_mid_pct double, price_location string, size int")
    for r in stats.symbol_consistency(df).collect():
        own = [row for row in rows if row[0] == r.symbol]
        spreads, devs = [row[1] for row in own if row[1] is not None], [row[2] for row in own if row[2] is not None]
        assert r.total_trades == len(own) and r.total_volume == sum(row[4] for row in own)
        assert r.median_spread == pytest.approx(np.median(spreads)) and r.mean_spread == pytest.approx(np.mean(spreads))
        assert r.mean_abs_deviation_pct == pytest.approx(np.mean(np.abs(devs))) and r.max_price_deviation_pct == max(devs)
        assert r.below_bid_count == sum(row[3] == "below_bid" for row in own)
        if len(own) == 1:
            assert r.std_spread is None and r.std_price_deviation_pct is None
        else:
            assert r.std_spread == pytest.approx(np.std(spreads, ddof=1)) and r.std_price_deviation_pct == pytest.approx(np.std(devs, ddof=1))
