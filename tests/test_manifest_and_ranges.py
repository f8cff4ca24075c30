"""Stored manifests, daily QC and local time ranges that prune."""

import datetime as dt

from pyspark.sql import functions as F

from tickspark.operators import manifest as man
from tickspark.operators import qc
from tickspark.session import scratch_path
from tickspark.sources import lake

DAY = dt.date(2024, 3, 8)
TICKS = "trade_date date, symbol string, ts_event timestamp_ntz, price double, size int, tr_seqnum long"


def ticks(spark, prices, symbol="A", day=DAY, start=dt.datetime(2024, 3, 8, 14, 30)):
    rows = [(day, symbol, start + dt.timedelta(minutes=k), p, 10, k) for k, p in enumerate(prices)]
    return spark.createDataFrame(rows, TICKS)


def statuses(spark, root):
    return {(r.trade_date, r.symbol): r.status for r in man.verify(spark, root, "trades").collect()}


def test_manifest_sees_values_that_change_rows_but_not_files(spark):
    root = scratch_path(spark, "r")
    lake.write_partitioned(ticks(spark, [1.0, 2.0, 3.0]), root, "trades")
    lake.write_partitioned(ticks(spark, [4.0, 5.0], "B"), root, "trades", mode="append")
    man.publish(spark, root, "trades", spark.createDataFrame([("A",)], "symbol string"))
    got = {r.symbol: r for r in man.read_manifest(spark, root, "trades").collect()}
    assert (got["A"].n_rows, got["A"].requested, got["B"].requested, got["A"].n_files) == (3, True, False, 1)
    assert got["A"].min_ts == dt.datetime(2024, 3, 8, 14, 30) and got["A"].files[0].endswith(".parquet")
    assert [r.trade_date for r in man.marked_dates(spark, root, "trades").collect()] == [DAY]
    assert lake.read_lake(spark, root, "trades").count() == 5   # neither manifest nor marker is data
    assert set(statuses(spark, root).values()) == {"ok"}
    # the same rows in other files are ok; two swapped prices are not
    lake.overwrite_partitions(spark, ticks(spark, [1.0, 2.0, 3.0]).repartition(3), ticks(spark, [1.0]), root, "trades")
    assert statuses(spark, root)[DAY, "A"] == "ok"
    lake.overwrite_partitions(spark, ticks(spark, [2.0, 1.0, 3.0]), ticks(spark, [1.0]), root, "trades")
    lake.write_partitioned(ticks(spark, [7.0], "C"), root, "trades", mode="append")
    lake.delete_partitions(spark, root, "trades", spark.createDataFrame([(DAY, "B")], "trade_date date, symbol string"))
    assert statuses(spark, root) == {(DAY, "A"): "changed", (DAY, "B"): "missing", (DAY, "C"): "unlisted"}


def test_publishing_one_date_keeps_the_others(spark):
    root = scratch_path(spark, "r")
    other = dt.date(2024, 3, 11)
    lake.write_partitioned(ticks(spark, [1.0]).unionByName(ticks(spark, [2.0], day=other)), root, "trades")
    man.publish(spark, root, "trades")
    lake.write_partitioned(ticks(spark, [9.0], day=other), root, "trades", mode="append")
    man.publish(spark, root, "trades", dates=spark.createDataFrame([(other,)], "trade_date date"))
    assert {r.trade_date: r.n_rows for r in man.read_manifest(spark, root, "trades").collect()} == {DAY: 1, other: 2}


def test_empty_ranges_of_a_session(spark):
    at = [dt.datetime(2024, 3, 8, 9, 29), dt.datetime(2024, 3, 8, 9, 30), dt.datetime(2024, 3, 8, 9, 30, 59), dt.datetime(2024, 3, 8, 15, 58),
          dt.datetime(2024, 3, 8, 16, 0)]
    df = spark.createDataFrame([(DAY, "A", t) for t in at] + [(DAY, "early", at[0])], "trade_date date, symbol string, ts_event timestamp_ntz")
    got = sorted((r.symbol, r.first_minute, r.last_minute, r.n_minutes) for r in qc.empty_ranges(df).collect())
    assert got == [("A", 571, 957, 387), ("A", 959, 959, 1), ("early", 570, 959, 390)]


def test_local_ranges_prune_dates_and_row_groups(spark):
    root = scratch_path(spark, "r")
    days = [dt.date(2024, 3, 8), dt.date(2024, 3, 11)]      # daylight saving starts between them
    every = None
    for day, utc_open in zip(days, (14, 13)):
        part = ticks(spark, [float(k) for k in range(390)], day=day, start=dt.datetime.combine(day, dt.time(utc_open, 30)))
        every = part if every is None else every.unionByName(part)
    lake.write_partitioned(every, root, "trades")
    spark.conf.set("spark.sql.maxMetadataStringLength", 2000)
    df = lake.load_trades(spark, root, local_range=("2024-03-11 10:00:00", "2024-03-11 10:04:00")).select("price", "ts_event")
    plan = df._jdf.queryExecution().executedPlan().toString()
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "trade_date" in scan[scan.index("PartitionFilters"):scan.index("PushedFilters")]
    assert "GreaterThanOrEqual(ts_event,2024-03-11T14:00)" in scan and "LessThanOrEqual(ts_event,2024-03-11T14:04)" in scan
    assert sorted(r.price for r in df.collect()) == [30.0, 31.0, 32.0, 33.0, 34.0]
    w = lake.load_trades(spark, root, daily_window=("10:00:00", "10:01:00"))
    assert sorted((r.trade_date, r.price) for r in w.collect()) == [(d, p) for d in days for p in (30.0, 31.0)]
    plan = w._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [trade_date" in plan or "PartitionFilters: [(" in plan
    assert lake.load_trades(spark, root, trade_date="2024-03-08", daily_window=("09:30:00", "09:30:00")).count() == 1


def test_bounds_across_a_clock_change():
    assert lake.utc_bounds("2024-11-03 01:30:00", "2024-11-03 01:30:00") == (dt.datetime(2024, 11, 3, 5, 30), dt.datetime(2024, 11, 3, 6, 30))
    assert lake.utc_bounds("2024-07-01 09:30:00", "2024-07-01 16:00:00") == (dt.datetime(2024, 7, 1, 13, 30), dt.datetime(2024, 7, 1, 20, 0))
