"""Lake write/overwrite semantics, work plans, streaming reruns, property checks."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tickspark.operators import catalog as cat
from tickspark.plans import notebook as nb
from tickspark.session import scratch_path
from tickspark.sources import lake
from tests.conftest import SF_MID, SF_SMALL

Q = E.queries()


def test_overwrite_drops_requested_partition_without_new_rows(spark):
    root = scratch_path(spark, "t-lake")
    rows = [(dt.date(2024, 1, 2), "A", 1.0), (dt.date(2024, 1, 2), "B", 2.0), (dt.date(2024, 1, 2), "C", 3.0)]
    df = spark.createDataFrame(rows, "trade_date date, symbol string, price double")
    lake.write_partitioned(df, root, "trades", sort_cols=())
    fresh = spark.createDataFrame([(dt.date(2024, 1, 2), "A", 9.0)], "trade_date date, symbol string, price double")
    req = spark.createDataFrame([(dt.date(2024, 1, 2), "A"), (dt.date(2024, 1, 2), "B")], "trade_date date, symbol string")
    lake.overwrite_partitions(spark, fresh, req, root, "trades", sort_cols=())
    got = sorted((r["symbol"], r["price"]) for r in lake.read_lake(spark, root, "trades").collect())
    assert got == [("A", 9.0), ("C", 3.0)]


def test_write_returns_row_count_and_append(spark):
    root = scratch_path(spark, "t-lake")
    df = spark.createDataFrame([(dt.date(2024, 1, 2), "A", 1.0)] * 3, "trade_date date, symbol string, price double")
    assert lake.write_partitioned(df, root, "x", sort_cols=()) == 3
    assert lake.write_partitioned(df, root, "x", mode="append", sort_cols=()) == 3
    assert lake.read_lake(spark, root, "x").count() == 6


def test_resume_with_nothing_missing_is_empty(spark):
    g = spark.createDataFrame([(dt.date(2024, 1, 2), "A", "trades")], "trade_date date, symbol string, data_type string")
    c = spark.createDataFrame([("taq", "trades", dt.date(2024, 1, 2), "A", 5)],
                              "source string, data_type string, trade_date date, symbol string, n_rows long")
    assert cat.missing(g, c, "taq").count() == 0


def test_stream_ingest_rerun_is_noop(spark):
    from pyspark.sql import types as T
    from tickspark.streaming import ingest
    landing = scratch_path(spark, "t-landing")
    spark.range(100).select(F.col("id").cast("string").alias("v"), F.lit("2024-01-02").alias("trade_date"),
                            F.lit("A").alias("symbol")).write.option("header", True).csv(landing)
    root, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in ("v", "trade_date", "symbol")])
    for _ in range(2):
        ingest.run_to_end(ingest.ingest_stream(spark, landing, schema, root, "trades", ck))
    assert lake.read_lake(spark, root, "trades").count() == 100


def test_streaming_vwap_equals_batch(spark):
    s = Q["stream_vwap_1m"](spark, SF_SMALL)
    b = Q["vwap_1m"](spark, SF_SMALL)
    assert s.exceptAll(b).count() == 0 and b.exceptAll(s).count() == 0


def test_location_counts_add_up(spark):
    mix = {r["price_location"]: r["count"] for r in Q["price_location_mix"](spark, SF_MID).collect()}
    assert sum(mix.values()) == nb.enriched(spark, SF_MID).count() == 3334
    # FIXTURES.md: as-of location below / within / above at sf0.01
    assert (mix["below_bid"], mix["within_spread"], mix["above_ask"]) == (348, 2639, 347)


def test_bars_properties(spark):
    b = Q["bars_1m"](spark, SF_MID)
    assert b.count() == 2482
    bad = b.where((F.col("low") > F.col("open")) | (F.col("open") > F.col("high")) | (F.col("low") > F.col("close"))
                  | (F.col("close") > F.col("high")) | (F.col("vwap") < F.col("low") - 1e-6)
                  | (F.col("vwap") > F.col("high") + 1e-6))
    assert bad.count() == 0


def test_histogram_counts_add_up(spark):
    h = Q["spread_histogram"](spark, SF_MID)
    assert h.agg(F.sum("count")).first()[0] == nb.valid_nbbo(spark, SF_MID).count()


def test_fixture_counts(spark):
    from tickspark.sources.fixtures import fx_catalog, fx_nbbo, fx_trades
    t = fx_trades(spark, SF_MID)
    assert t.count() == 3334 and t.select("symbol").distinct().count() == 12
    q = fx_nbbo(spark, SF_MID)
    assert q.count() == 6666
    assert q.where(F.col("best_ask") < F.col("best_bid")).count() == 137
    c = fx_catalog(spark, SF_MID)
    assert c.count() == 1213 and c.agg(F.sum("n_rows")).first()[0] == 14553


def test_lake_scan_prunes_partitions_columns_and_time(spark):
    root = scratch_path(spark, "t-lake")
    rows = [(dt.date(2024, 1, d), s, dt.datetime(2024, 1, d, 15, m), float(m), m)
            for d in (2, 3) for s in ("A", "B") for m in range(10)]
    df = spark.createDataFrame(rows, "trade_date date, symbol string, ts_event timestamp_ntz, price double, size int")
    lake.write_partitioned(df, root, "trades")
    q = lake.load_trades(spark, root, trade_date="2024-01-02", symbols=["A"],
                         utc_range=("2024-01-02 15:02:00", "2024-01-02 15:05:00")).select("ts_event", "price")
    plan = q._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "trade_date" in plan and "symbol" in plan
    assert "PushedFilters: [IsNotNull(ts_event), GreaterThanOrEqual(ts_event" in plan
    assert "ReadSchema: struct<ts_event:timestamp_ntz,price:double>" in plan
    got = sorted(r["price"] for r in q.collect())
    assert got == [2.0, 3.0, 4.0, 5.0]


def test_lake_read_skips_corrupt_files_only_on_request(spark):
    import os
    root = scratch_path(spark, "t-lake")
    df = spark.createDataFrame([(dt.date(2024, 1, 2), "A", 1.0)] * 5, "trade_date date, symbol string, price double")
    lake.write_partitioned(df, root, "trades", sort_cols=())
    part = os.path.join(root.replace("file:", ""), "trades", "trade_date=2024-01-02", "symbol=A")
    with open(os.path.join(part, "part-99999-junk.parquet"), "wb") as f:
        f.write(b"not a parquet file")
    assert lake.read_lake(spark, root, "trades", skip_corrupt=True).count() == 5
    with pytest.raises(Exception, match="not a Parquet file"):
        lake.read_lake(spark, root, "trades").count()


def test_time_bounds_fall_back_to_nbbo(spark):
    from tickspark.operators.reports import time_bounds
    sch = "ts_event timestamp_ntz"
    empty = spark.createDataFrame([], sch)
    q = spark.createDataFrame([(dt.datetime(2024, 1, 2, 9, 30),), (dt.datetime(2024, 1, 2, 16, 0),)], sch)
    r = time_bounds(empty, q).first()
    assert r["min_ts"] == dt.datetime(2024, 1, 2, 9, 30) and r["max_ts"] == dt.datetime(2024, 1, 2, 16, 0)
    r2 = time_bounds(q.where(F.col("ts_event") == dt.datetime(2024, 1, 2, 9, 30)), q).first()
    assert r2["min_ts"] == r2["max_ts"] == dt.datetime(2024, 1, 2, 9, 30)


def test_lake_to_operators_end_to_end(spark):
    """The README flow: canonical lake (UTC instants) → load → as-of → consistency."""
    from tickspark.functions.columns import spread
    from tickspark.functions.filters import nonneg_spread
    from tickspark.operators import stats
    from tickspark.operators.asof import asof_join
    from tickspark.sources.fixtures import fxd_nbbo, fxd_trades
    root = scratch_path(spark, "t-e2e")
    t = fxd_trades(spark, SF_SMALL).select("tr_seqnum", "trade_date", "symbol",
                                           F.col("ts_event_utc").alias("ts_event"), "price", "size")
    q = fxd_nbbo(spark, SF_SMALL).select("qu_seqnum", "trade_date", "symbol", F.col("ts_event_utc").alias("ts_event"),
                                         "best_bid", "best_ask", "best_bidsizeshares", "best_asksizeshares")
    lake.write_partitioned(t, root, "trades")
    lake.write_partitioned(q, root, "nbbo")
    trades = lake.load_trades(spark, root).drop("ts_event_utc")
    quotes = lake.load_nbbo(spark, root).where(nonneg_spread()).withColumn("spread", spread())
    enriched = stats.with_deviation(asof_join(
        trades, quotes, by=["symbol", "trade_date"], left_ts="ts_event",
        right_cols=["best_bid", "best_ask", "spread"], left_seq="tr_seqnum", right_seq="qu_seqnum"))
    from tickspark.plans.registry import round_doubles
    got = round_doubles(stats.symbol_consistency(enriched))
    want = Q["symbol_consistency"](spark, SF_SMALL)
    assert got.count() == want.count() == 12
    assert got.exceptAll(want.select(*got.columns)).count() == 0


def test_streaming_churn_equals_batch_on_closed_windows(spark):
    from tickspark.operators import bars
    from tickspark.sources.fixtures import fxd_nbbo
    from tickspark.streaming import ingest, minute
    q = fxd_nbbo(spark, SF_SMALL).select("symbol", "ts_event", "qu_seqnum")
    landing = scratch_path(spark, "t-landing")
    q.write.parquet(landing)
    out, ck = scratch_path(spark, "t-out"), scratch_path(spark, "t-ck")
    src = spark.readStream.schema(q.schema).parquet(landing)
    ingest.run_to_end(minute.write_append(minute.minute_churn_stream(src), out, ck))
    s = spark.read.parquet(out)
    b = bars.churn(q, "1m")
    wm = q.agg(F.max("ts_event")).first()[0] - dt.timedelta(minutes=2)
    closed = b.where(F.col("time_bucket") + F.expr("INTERVAL 1 MINUTE") <= F.lit(wm))
    assert s.exceptAll(closed).count() == 0 and closed.exceptAll(s).count() == 0


def test_rest_pages_defaults_and_nanoseconds(spark):
    import json
    import os
    from tickspark.sources import rest
    path = scratch_path(spark, "t-rest")
    os.makedirs(path.replace("file:", ""), exist_ok=True)
    page = {"symbol": "AAPL", "next_page_token": None, "trades": [
        {"t": "2024-07-02T13:30:00.123456789Z", "x": "V", "p": 210.5, "s": 100},
        {"t": "2024-01-02T14:30:01Z"}]}                       # missing x, p, s; whole second
    with open(os.path.join(path.replace("file:", ""), "page-0.json"), "w") as f:
        f.write(json.dumps(page) + "\n")
    rows = sorted(rest.read_rest_trades(spark, path).collect(), key=lambda r: r["ts_event_ns"])
    winter, summer = rows
    assert (winter["ex"], winter["price"], winter["size"], winter["tr_source"]) == ("", 0.0, 0, "ALPACA")
    assert summer["ts_event_ns"] % 1_000_000_000 == 123456789 and summer["time_m_nano"] == 123456789
    assert summer["date"] == dt.date(2024, 7, 2) and summer["time_m_us"] == (9 * 3600 + 30 * 60) * 10**6   # EDT
    assert winter["time_m_us"] == (9 * 3600 + 30 * 60 + 1) * 10**6 and winter["time_m_nano"] == 0       # EST
