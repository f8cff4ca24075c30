"""Resolution levels: appends in any order, late ticks, compaction, choice of the level."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickspark.operators import bars, pyramid
from tickspark.session import scratch_path
from tickspark.sources import listing

TICKS = "trade_date date, symbol string, ts_event timestamp_ntz, qu_seqnum long, best_bid double, best_ask double"


def quotes(spark, n, seed):
    rng = random.Random(seed)
    start = dt.datetime(2024, 1, 2, 9, 30)
    rows = []
    for k in range(n):
        at = start + dt.timedelta(milliseconds=rng.randrange(30_000))
        rows.append((at.date(), rng.choice(["A", "B"]), at, seed * 10_000 + k, rng.choice([None, rng.random()]), rng.random()))
    return spark.createDataFrame(rows, TICKS)


def test_levels_equal_direct_aggregates_after_appends(spark):
    root = scratch_path(spark, "lod")
    parts = [quotes(spark, 300, seed) for seed in (3, 1, 2)]
    for k, part in enumerate(parts):
        pyramid.append(part, root, "quotes", f"load-{k}")
    pyramid.append(parts[0], root, "quotes", "load-0")      # again: replaces itself
    every = parts[0].unionByName(parts[1]).unionByName(parts[2])
    for level in pyramid.LEVELS:
        want = sorted(map(tuple, bars.lod_quotes(every, level, keys=["trade_date", "symbol"]).collect()), key=str)
        assert sorted(map(tuple, pyramid.read_level(spark, root, "quotes", level).collect()), key=str) == want
        pyramid.compact(spark, root, "quotes", level, ["2024-01-02"])
        assert sorted(map(tuple, pyramid.read_level(spark, root, "quotes", level).collect()), key=str) == want
        files = listing.lake_files(listing.partition_folders(spark, root, f"lod_quotes_{level}")).collect()
        assert sum(f.n_rows for f in files) == len(want)


def test_window_picks_its_level_and_prunes(spark):
    root = scratch_path(spark, "lod")
    raw = quotes(spark, 100, 1)
    pyramid.append(raw, root, "quotes", "x")
    level, rows = pyramid.read_window(spark, root, "quotes", "2024-01-02 09:30:00", "2024-01-02 09:50:00", raw, symbols=["A"])
    assert level == "100ms" and rows.where("symbol <> 'A'").count() == 0 and rows.agg(F.sum("n_updates")).first()[0] == raw.where("symbol = 'A'").count()
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trade_date" in plan and "time_bucket" in plan[plan.index("PushedFilters"):]
    assert [pyramid.level_for(s) for s in (0, 119.9, 120, 1800, 1800.1)] == ["raw", "raw", "100ms", "100ms", "1s"]
    assert pyramid.read_window(spark, root, "quotes", "2024-01-02 09:30:00", "2024-01-02 09:31:00", raw)[0] == "raw"


def test_levels_have_to_divide(spark):
    with pytest.raises(ValueError, match="divide"):
        pyramid.append(quotes(spark, 1, 1), scratch_path(spark, "lod"), "quotes", "x", levels=("300ms", "1s"))
