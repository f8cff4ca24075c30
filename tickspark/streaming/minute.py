"""ST2: minute VWAP / volume / churn on a stream with event-time watermarks.

The watermark column must be TIMESTAMP (Spark rejects NTZ), so local NTZ event
times are cast in and the window start is cast back; one-minute windows are the
same grid in every whole-minute-offset zone. Append mode emits a window once the
watermark passes its end, and evicts its state, so state stays bounded.

Windows that the watermark has not passed yet are in the stream's state only.
``all_vwap`` and ``all_churn`` read them from the checkpoint by Spark's state reader and
add them to what was written: together they are the batch result over all input so
far. Nothing in the checkpoint changes; the stream can go on and close them later.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def minute_vwap_stream(trades: DataFrame, ts: str = "ts_event", delay: str = "2 minutes",
                       window: str = "1 minute", keys=("symbol",)) -> DataFrame:
    ev = trades.withColumn("_ev", F.col(ts).cast("timestamp")).withWatermark("_ev", delay)
    agg = (ev.groupBy(*keys, F.window("_ev", window).alias("_w"))
           .agg(F.sum(F.col("price") * F.col("size")).alias("total_price_volume"),
                F.sum("size").cast("long").alias("total_volume")))
    return _vwap(agg, keys)


def _vwap(agg: DataFrame, keys) -> DataFrame:
    return agg.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("time_bucket"),
                      "total_price_volume", "total_volume",
                      F.try_divide("total_price_volume", "total_volume").alias("vwap"))


def minute_churn_stream(nbbo: DataFrame, ts: str = "ts_event", delay: str = "2 minutes",
                        window: str = "1 minute", keys=("symbol",)) -> DataFrame:
    ev = nbbo.withColumn("_ev", F.col(ts).cast("timestamp")).withWatermark("_ev", delay)
    return _churn(ev.groupBy(*keys, F.window("_ev", window).alias("_w")).agg(F.count(F.lit(1)).alias("churn")), keys)


def _churn(agg: DataFrame, keys) -> DataFrame:
    return agg.select(*keys, F.col("_w.start").cast("timestamp_ntz").alias("time_bucket"), "churn")


def _open_windows(spark: SparkSession, checkpoint: str, keys, totals) -> DataFrame:
    """Key, window and running totals of every window that the stream still holds."""
    held = spark.read.format("statestore").load(checkpoint)
    # The totals share a name there; a struct cast goes by position.
    named = F.col("value").cast(f"struct<{', '.join(f'{n}: {t}' for n, t in totals.items())}>")
    return held.select("key.*", named.alias("_v")).toDF(*keys, "_w", "_v").select(*keys, "_w", "_v.*")


def all_vwap(spark: SparkSession, out_path: str, checkpoint: str, keys=("symbol",)) -> DataFrame:
    """Closed windows as written by ``minute_vwap_stream`` plus those still open."""
    still = _vwap(_open_windows(spark, checkpoint, keys, {"total_price_volume": "double", "total_volume": "bigint"}), keys)
    return spark.read.schema(still.schema).parquet(out_path).unionByName(still)


def all_churn(spark: SparkSession, out_path: str, checkpoint: str, keys=("symbol",)) -> DataFrame:
    """Closed windows as written by ``minute_churn_stream`` plus those still open."""
    still = _churn(_open_windows(spark, checkpoint, keys, {"churn": "bigint"}), keys)
    return spark.read.schema(still.schema).parquet(out_path).unionByName(still)


def write_append(df: DataFrame, out_path: str, checkpoint: str, available_now: bool = True):
    w = df.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start(out_path)
