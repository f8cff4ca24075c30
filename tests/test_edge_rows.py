"""Rows that a friendly fixture lacks: NULL keys and sequences, close stamps, escapes."""

import datetime as dt

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.operators.asof import asof_join
from tickspark.operators.downsample import downsample, envelope
from tickspark.operators.stats import boxplot, histogram
from tickspark.sources import lake, registry, rest
from tickspark.streaming.dedupe import dedupe_stream

TS = dt.datetime(2024, 5, 1, 10, 0)
TICK = "symbol string, ts_event timestamp_ntz, qu_seqnum long, best_bid double"


def test_asof_ignores_null_keys_and_times(spark):
    t = spark.createDataFrame([(None, 1, 10), ("A", 2, 10), ("A", 3, None)], "symbol string, seq int, t long")
    q = spark.createDataFrame([(None, 5, 1.0), ("A", 5, 2.0), ("A", None, 3.0)], "symbol string, t long, bid double")
    for bucket in (None, 4):
        j = asof_join(t, q, ["symbol"], "t", right_cols=["bid"], bucket=bucket)
        assert j.columns == ["symbol", "seq", "t", "bid"]
        assert {r.seq: r.bid for r in j.collect()} == {1: None, 2: 2.0, 3: None}


def test_asof_on_nanoseconds_does_not_look_ahead(spark):
    t = spark.createDataFrame([("A", 1_000_000_100)], "symbol string, ns long")
    q = spark.createDataFrame([("A", 1_000_000_050, 1.0), ("A", 1_000_000_400, 2.0)], "symbol string, ns long, bid double")
    j = asof_join(t, q, ["symbol"], "ns", right_cols=["bid"], ts_unit_per_us=1000)
    assert [r.bid for r in j.collect()] == [1.0]


@pytest.mark.parametrize("required", [False, True])
def test_asof_filters_reach_every_scan(spark, tmp_path, required):
    day = F.to_date(F.lit("2024-05-01"))
    base = spark.range(20).select(F.concat(F.lit("S"), F.col("id") % 3).alias("symbol"), day.alias("trade_date"),
                                  F.col("id").alias("ns"), F.col("id").cast("double").alias("bid"))
    for name in ("trades", "nbbo"):
        base.write.partitionBy("trade_date", "symbol").parquet(str(tmp_path / name))
    t, q = (spark.read.parquet(str(tmp_path / name)) for name in ("trades", "nbbo"))
    j = asof_join(t.drop("bid"), q, ["symbol", "trade_date"], "ns", right_cols=["bid"], ts_unit_per_us=1000, right_required=required)
    plan = j.where("symbol = 'S1' and trade_date = '2024-05-01'")._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    assert scans
    for line in scans:
        part = line[line.index("PartitionFilters"):line.index("PushedFilters")]
        assert "symbol" in part and "trade_date" in part, line


def test_downsample_keeps_rows_within_budget(spark):
    rows = [("A", TS, None, float(k)) for k in range(5)] + [(None, TS, 1, 9.0)]
    out = downsample(spark.createDataFrame(rows, TICK), max_points=10).collect()
    assert len(out) == 6
    assert sorted(r.best_bid for r in out) == [0.0, 1.0, 2.0, 3.0, 4.0, 9.0]


def test_downsample_and_envelope_keep_null_keys(spark):
    rows = [(s, TS + dt.timedelta(seconds=k), k, float(k)) for s in ("A", None) for k in range(40)]
    df = spark.createDataFrame(rows, TICK)
    got = downsample(df, max_points=10).groupBy("symbol").count().collect()
    assert {r.symbol for r in got} == {"A", None} and len({r["count"] for r in got}) == 1
    assert {r.symbol: r.s for r in envelope(df, ["best_bid"], max_points=10).groupBy("symbol").agg(F.sum("n").alias("s")).collect()} \
        == {"A": 40, None: 40}


def test_histogram_and_boxplot_keep_null_keys(spark):
    df = spark.createDataFrame([(s, float(k)) for s in ("A", None) for k in range(8)], "symbol string, x double")
    assert {r.symbol: r.n for r in histogram(df, "x", 4, ["symbol"]).groupBy("symbol").agg(F.sum("count").alias("n")).collect()} \
        == {"A": 8, None: 8}
    assert {r.symbol for r in boxplot(df, "x", ["symbol"]).collect()} == {"A", None}


def test_stream_dedupe_keeps_equal_sequences_of_two_days(spark, tmp_path):
    rows = [("A", k, TS.date() + dt.timedelta(days=d), TS + dt.timedelta(days=d, seconds=k)) for d in (0, 1) for k in range(3)]
    df = spark.createDataFrame(rows, "symbol string, tr_seqnum long, trade_date date, ts_event timestamp_ntz")
    df.unionAll(df).coalesce(1).write.parquet(str(tmp_path / "in"))
    out = dedupe_stream(spark.readStream.schema(df.schema).parquet(str(tmp_path / "in")))
    q = (out.writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck"))
         .trigger(availableNow=True).start(str(tmp_path / "out")))
    q.awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 6


def test_overwrite_removes_escaped_symbols_after_the_write(spark, tmp_path):
    day = dt.date(2024, 5, 1)
    schema = "trade_date date, symbol string, ts_event timestamp_ntz, price double"
    lake.write_partitioned(spark.createDataFrame([(day, s, TS, 1.0) for s in ("BRK/B", "A", "C")], schema), str(tmp_path), "trades")
    asked = spark.createDataFrame([(day, "BRK/B"), (day, "A")], "trade_date date, symbol string")
    new = spark.createDataFrame([(day, "A", TS, 2.0)], schema)
    assert lake.overwrite_partitions(spark, new, asked, str(tmp_path), "trades") == 1
    got = {r.symbol: r.price for r in lake.read_lake(spark, str(tmp_path), "trades").collect()}
    assert got == {"A": 2.0, "C": 1.0}


def test_a_bad_file_fails_unless_skipped(spark, tmp_path):
    spark.range(3).write.parquet(str(tmp_path / "trades"))
    (tmp_path / "trades" / "part-bad.parquet").write_bytes(b"not parquet")
    schema = T.StructType([T.StructField("id", T.LongType())])
    assert lake.read_lake(spark, str(tmp_path), "trades", schema, skip_corrupt=True).count() == 3
    with pytest.raises(Exception, match="part-bad"):
        lake.read_lake(spark, str(tmp_path), "trades", schema).agg(F.sum("id")).collect()


def test_widening_keeps_values(spark):
    a = spark.createDataFrame([(16777217,)], "x long")
    b = spark.createDataFrame([(0.5,)], "x float")
    assert sorted(r.x for r in registry.union_sources({"a": a, "b": b}).collect()) == [0.5, 16777217.0]
    assert registry.wider(T.DecimalType(10, 4), T.DecimalType(12, 2)) == T.DecimalType(14, 4)


def test_rest_sizes_beyond_int(spark, tmp_path):
    (tmp_path / "page.json").write_text('{"symbol":"A","trades":[{"t":"2024-01-02T14:30:00Z","x":"V","p":1.5,"s":3000000000}]}\n')
    assert [r.size for r in rest.read_rest_trades(spark, str(tmp_path)).collect()] == [3_000_000_000]


def test_csv_columns_are_taken_by_header_name(spark, tmp_path):
    from pyspark.sql.types import StructType

    from tickspark.sources.csv import read_csv_drops

    (tmp_path / "trades_20240502.csv").write_text("price,sym_root,size,extra\n10.5,AAA,7,x\nbad,BBB,8,y\n")
    schema = StructType.fromDDL("sym_root string, size int, price double, ex string")
    got = read_csv_drops(spark, str(tmp_path), schema)
    rows = sorted((r.sym_root, r.size, r.price, r.ex, str(r.file_date)) for r in got.collect())
    assert rows == [("AAA", 7, 10.5, None, "2024-05-02"), ("BBB", 8, None, None, "2024-05-02")]
