"""Structured Streaming queries: landing files are written by Spark from the fixture
ticks into the shared scratch folder, a stream drains them with
``trigger(availableNow=True)`` into a Parquet sink, and the sink is read back."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.operators.enrich import enrich
from tickspark.plans.ingest import CSV_COLS, CSV_TYPES, INGEST_TS, RUN_ID, warehouse_trades
from tickspark.plans.registry import oracle, query
from tickspark.session import scratch_path
from tickspark.sources import csv as csvsrc
from tickspark.sources import lake
from tickspark.sources.fixtures import fxd_nbbo, fxd_trades
from tickspark.streaming import dedupe, ingest, minute

TRADE_COLS = ["tr_seqnum", "trade_date", "symbol", "ts_event", "price", "size"]


def _land_parquet(spark, df, name: str, mode: str = "overwrite") -> str:
    path = scratch_path(spark, name)
    df.write.mode(mode).parquet(path)
    return path


@query("stream_ingest", oracle("""
select tr_seqnum, trade_date, symbol, ts_event_utc as ts_event, epoch_us(ts_event_utc) * 1000 + tr_seqnum % 1000
       as ts_event_ns, price, size from fx_trades""", ["price"]), ids="ST1")
def q_stream_ingest(spark, d):
    w = warehouse_trades(spark, d)
    landing = scratch_path(spark, "landing-csv")
    (w.select(*[F.col(c).cast("string").alias(c) for c in CSV_COLS])
     .write.mode("overwrite").option("header", True).csv(landing))
    root, ck = scratch_path(spark, "stream-lake"), scratch_path(spark, "stream-ck")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLS])

    def to_canonical(df):
        e = enrich(csvsrc.typed(df, CSV_TYPES), RUN_ID, INGEST_TS)
        return e.select("tr_seqnum", "trade_date", "symbol", "ts_event", "ts_event_ns", "price", "size")

    ingest.run_to_end(ingest.ingest_stream(spark, landing, schema, root, "trades", ck, to_canonical))
    return lake.read_lake(spark, root, "trades").select("tr_seqnum", "trade_date", "symbol", "ts_event", "ts_event_ns",
                                          "price", "size")


@query("stream_vwap_1m", oracle("""
select symbol, date_trunc('minute', ts_event) as time_bucket, sum(price * size) as total_price_volume,
       cast(sum(size) as bigint) as total_volume, sum(price * size) / nullif(sum(size), 0) as vwap
from fxd_trades group by 1, 2""", ["total_price_volume", "vwap"]), ids="ST2")
def q_stream_vwap_1m(spark, d):
    t = fxd_trades(spark, d).select(*TRADE_COLS)
    landing = _land_parquet(spark, t, "landing-trades")
    src = spark.readStream.schema(t.schema).parquet(landing)
    out, ck = scratch_path(spark, "stream-vwap"), scratch_path(spark, "stream-ck")
    ingest.run_to_end(minute.write_append(minute.minute_vwap_stream(src), out, ck))
    return minute.all_vwap(spark, out, ck)


@query("stream_churn_1m", oracle("""
select symbol, date_trunc('minute', ts_event) as time_bucket, count(*) as churn from fxd_nbbo group by 1, 2"""), ids="ST2")
def q_stream_churn_1m(spark, d):
    q = fxd_nbbo(spark, d).select("qu_seqnum", "symbol", "ts_event")
    landing = _land_parquet(spark, q, "landing-nbbo")
    src = spark.readStream.schema(q.schema).parquet(landing)
    out, ck = scratch_path(spark, "stream-churn"), scratch_path(spark, "stream-ck")
    ingest.run_to_end(minute.write_append(minute.minute_churn_stream(src), out, ck))
    return minute.all_churn(spark, out, ck)


@query("stream_and_batch_lake", oracle("""
select tr_seqnum, trade_date, symbol, ts_event, price, size from fxd_trades""", ["price"]), ids="ST1, K2")
def q_stream_and_batch_lake(spark, d):
    """Half the ticks by stream, half by a batch append to the same dataset; both run twice."""
    t = fxd_trades(spark, d).select(*TRADE_COLS)
    landing = _land_parquet(spark, t.where(F.pmod("tr_seqnum", F.lit(2)) == 0), "landing-trades")
    root, ck = scratch_path(spark, "stream-lake"), scratch_path(spark, "stream-ck")
    for _ in range(2):
        ingest.run_to_end(ingest.ingest_stream(spark, landing, t.schema, root, "trades", ck, fmt="parquet"))
        lake.write_partitioned(t.where(F.pmod("tr_seqnum", F.lit(2)) == 1), root, "trades", mode="append", load="backfill")
    return lake.read_lake(spark, root, "trades").select(*TRADE_COLS)


@query("stream_dedupe", oracle("select tr_seqnum, trade_date, symbol, ts_event, price, size from fxd_trades",
                               ["price"]), ids="ST3")
def q_stream_dedupe(spark, d):
    t = fxd_trades(spark, d).select(*TRADE_COLS)
    landing = _land_parquet(spark, t, "landing-trades")
    # a re-delivery of part of the feed lands next to the first delivery
    t.where(F.pmod("tr_seqnum", F.lit(5)) == 0).write.mode("append").parquet(landing)
    src = spark.readStream.schema(t.schema).parquet(landing)
    out, ck = scratch_path(spark, "stream-dedupe"), scratch_path(spark, "stream-ck")
    q = (dedupe.dedupe_stream(src).writeStream.format("parquet").option("checkpointLocation", ck)
         .outputMode("append").trigger(availableNow=True).start(out))
    ingest.run_to_end(q)
    return spark.read.parquet(out).select(*TRADE_COLS)
