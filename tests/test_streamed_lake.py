"""Streams and batches in one lake, closing of streams, overwrite by tasks, listed folders."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickspark.operators import bars
from tickspark.session import scratch_path
from tickspark.sources import lake, listing
from tickspark.streaming import ingest, minute

TICKS = "trade_date date, symbol string, ts_event timestamp_ntz, price double, size int"
DAY = dt.date(2024, 1, 2)


def ticks(spark, n, symbol="A", day=DAY, price=1.0):
    return spark.createDataFrame([(day, symbol, dt.datetime(2024, 1, 2, 10, 0) + dt.timedelta(seconds=k), price, 1) for k in range(n)], TICKS)


def stream(spark, landing, root, ck, **kw):
    schema = spark.createDataFrame([], TICKS).schema
    ingest.run_to_end(ingest.ingest_stream(spark, landing, schema, root, "trades", ck, fmt="parquet", **kw))


def test_batches_and_streams_share_a_dataset(spark):
    landing, root, ck = (scratch_path(spark, n) for n in ("l", "r", "c"))
    ticks(spark, 30).write.parquet(landing)
    stream(spark, landing, root, ck, max_files_per_trigger=1)
    assert lake.write_partitioned(ticks(spark, 5), root, "trades", mode="append") == 5
    read = lake.read_lake(spark, root, "trades")
    assert read.count() == 35 and "load" not in read.columns
    for _ in range(2):   # a named load replaces itself
        lake.write_partitioned(ticks(spark, 7, "B"), root, "trades", mode="append", load="backfill")
    assert lake.read_lake(spark, root, "trades").count() == 42
    ticks(spark, 3, "C").write.mode("append").parquet(landing)
    stream(spark, landing, root, ck)
    assert {r.symbol: r["count"] for r in lake.read_lake(spark, root, "trades").groupBy("symbol").count().collect()} == {"A": 35, "B": 7, "C": 3}
    # overwrite of a streamed partition drops all its loads; others stay
    lake.overwrite_partitions(spark, ticks(spark, 2, "A", price=9.0), ticks(spark, 1, "A").unionByName(ticks(spark, 1, "B")), root, "trades")
    got = lake.read_lake(spark, root, "trades").groupBy("symbol", "price").count().collect()
    assert {(r.symbol, r.price): r["count"] for r in got} == {("A", 9.0): 2, ("C", 1.0): 3}


def test_a_batch_that_is_run_again_adds_nothing(spark):
    """The stream dies after the write and before its commit: the same batch number comes again."""
    landing, root, ck = (scratch_path(spark, n) for n in ("l", "r", "c"))
    ticks(spark, 12).write.parquet(landing)
    schema = spark.createDataFrame([], TICKS).schema
    real, calls = lake.write_partitioned, []

    def dies(*a, **kw):
        calls.append(real(*a, **kw))
        raise RuntimeError("lost after the write")

    lake.write_partitioned = dies
    try:
        with pytest.raises(Exception, match="lost after the write"):
            ingest.run_to_end(ingest.ingest_stream(spark, landing, schema, root, "trades", ck, fmt="parquet"))
    finally:
        lake.write_partitioned = real
    assert calls == [12] and lake.read_lake(spark, root, "trades").count() == 12
    stream(spark, landing, root, ck)
    assert lake.read_lake(spark, root, "trades").count() == 12


def test_a_hot_symbol_day_spans_tasks(spark):
    landing, root, ck = (scratch_path(spark, n) for n in ("l", "r", "c"))
    hot = spark.range(200_000).select(F.lit(DAY).alias("trade_date"), F.lit("HOT").alias("symbol"),
                                      F.lit(dt.datetime(2024, 1, 2)).cast("timestamp_ntz").alias("ts_event"),
                                      F.rand(3).alias("price"), F.col("id").cast("int").alias("size"))
    hot.write.parquet(landing)
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "500k")
    try:
        stream(spark, landing, root, ck)
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    files = listing.lake_files(listing.partition_folders(spark, root, "trades")).collect()
    assert len(files) > 2 and sum(f.n_rows for f in files) == 200_000


def test_named_loads_need_their_own_dataset(spark):
    root = scratch_path(spark, "r")
    lake.write_partitioned(ticks(spark, 2), root, "trades")
    with pytest.raises(ValueError, match="without loads"):
        lake.write_partitioned(ticks(spark, 2), root, "trades", mode="append", load="x")


def test_open_windows_are_emitted_and_close_later(spark):
    landing, out, ck = (scratch_path(spark, n) for n in ("l", "o", "c"))
    every = ticks(spark, 1000).unionByName(ticks(spark, 500, "B"))
    first = every.where("ts_event < timestamp_ntz'2024-01-02 10:09:00'")
    first.write.parquet(landing)

    def run():
        src = spark.readStream.schema(every.schema).parquet(landing)
        ingest.run_to_end(minute.write_append(minute.minute_vwap_stream(src), out, ck))
        return minute.all_vwap(spark, out, ck)

    assert sorted(run().collect()) == sorted(bars.vwap(first).collect())
    every.where("ts_event >= timestamp_ntz'2024-01-02 10:09:00'").write.mode("append").parquet(landing)
    assert sorted(run().collect()) == sorted(bars.vwap(every).collect())


def test_overwrite_evaluates_its_rows_once_and_meets_legacy_folders(spark):
    root = scratch_path(spark, "r")
    lake.write_partitioned(ticks(spark, 3, "('A',)").unionByName(ticks(spark, 2, "B/x:y")).unionByName(ticks(spark, 1, "C")), root, "trades")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    fresh = ticks(spark, 5, "A", price=2.0).mapInArrow(count, TICKS)
    asked = spark.createDataFrame([(DAY, "('A',)"), (DAY, "B/x:y"), (DAY, "absent")], "trade_date date, symbol string")
    assert lake.overwrite_partitions(spark, fresh, asked, root, "trades") == 5
    assert seen.value == 5
    got = lake.read_lake(spark, root, "trades").groupBy("symbol", "price").count().collect()
    assert {(r.symbol, r.price): r["count"] for r in got} == {("A", 2.0): 5, ("C", 1.0): 1}
    assert lake.delete_partitions(spark, root, "trades", spark.createDataFrame([(DAY,)], "trade_date date")) == 2


def test_folders_and_footers(spark):
    root = scratch_path(spark, "r")
    lake.write_partitioned(ticks(spark, 3, "A").unionByName(ticks(spark, 2, "B=1")).unionByName(ticks(spark, 4, None)), root, "trades")
    folders = listing.partition_folders(spark, root, "trades")
    assert {(r.trade_date, r.symbol) for r in folders.collect()} == {(DAY, "A"), (DAY, "B=1"), (DAY, None)}
    assert {r.symbol: r.n_rows for r in listing.lake_files(folders).collect()} == {"A": 3, "B=1": 2, None: 4}
    assert listing.partition_folders(spark, root, "nothing").collect() == []
