"""Summary reports: dataset profiles, code counts, summary tables."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickspark.functions.columns import epoch_micros
from tickspark.functions.filters import nonneg_spread


def profile(df: DataFrame, name: str, volume: str | None = "size", ts: str = "ts_event") -> DataFrame:
    """Rows, exact distinct symbols, time bounds, duration (µs), total volume."""
    vol = F.sum(volume).cast("long") if volume else F.lit(None).cast("long")
    return df.agg(F.lit(name).alias("dataset"), F.count(F.lit(1)).alias("n_rows"),
                  F.count_distinct("symbol").alias("n_symbols"), F.min(ts).alias("min_ts"),
                  F.max(ts).alias("max_ts"),
                  (F.max(epoch_micros(ts)) - F.min(epoch_micros(ts))).alias("duration_us"),
                  vol.alias("total_volume"))


def code_counts(df: DataFrame, cols: Sequence[str], top: int = 20) -> DataFrame:
    """Value counts of several code columns in ONE pass (grouping sets), top-n each."""
    cols = list(cols)
    g = df.groupingSets([[c] for c in cols], *cols).agg(
        F.count(F.lit(1)).alias("count"), *[F.grouping(c).alias(f"_g_{c}") for c in cols])
    field = F.lit(None).cast("string")
    for c in reversed(cols):
        field = F.when(F.col(f"_g_{c}") == 0, F.lit(c)).otherwise(field)
    g = g.select(field.alias("field"), F.coalesce(*[F.col(c) for c in cols]).alias("value"), "count")
    w = Window.partitionBy("field").orderBy(F.desc("count"), "value")
    return g.withColumn("rank", F.row_number().over(w).cast("long")).where(F.col("rank") <= top)


def summary_table(trades: DataFrame, nbbo: DataFrame, ts: str = "ts_event") -> DataFrame:
    """One typed row each for trades, NBBO and valid NBBO."""
    t = trades.agg(F.lit("Trades").alias("dataset"), F.count(F.lit(1)).alias("total_records"),
                   F.count_distinct("symbol").alias("unique_symbols"),
                   F.sum("size").cast("long").alias("total_volume"), F.avg("size").alias("avg_trade_size"),
                   F.lit(None).cast("double").alias("avg_spread"), F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))
    q = nbbo.agg(F.lit("NBBO").alias("dataset"), F.count(F.lit(1)).alias("total_records"),
                 F.count_distinct("symbol").alias("unique_symbols"), F.lit(None).cast("long").alias("total_volume"),
                 F.lit(None).cast("double").alias("avg_trade_size"), F.lit(None).cast("double").alias("avg_spread"),
                 F.min(ts).alias("min_ts"), F.max(ts).alias("max_ts"))
    v = nbbo.where(nonneg_spread()).agg(
        F.lit("NBBO (valid spreads)").alias("dataset"), F.count(F.lit(1)).alias("total_records"),
        F.count_distinct("symbol").alias("unique_symbols"), F.lit(None).cast("long").alias("total_volume"),
        F.lit(None).cast("double").alias("avg_trade_size"),
        F.avg(F.col("best_ask") - F.col("best_bid")).alias("avg_spread"),
        F.lit(None).cast(nbbo.schema[ts].dataType).alias("min_ts"),
        F.lit(None).cast(nbbo.schema[ts].dataType).alias("max_ts"))
    return t.unionByName(q).unionByName(v)


def time_bounds(trades: DataFrame, nbbo: DataFrame, ts: str = "ts_event") -> DataFrame:
    """(min_ts, max_ts) of the trades, falling back to the NBBO when there are none.
    One row; both inputs are reduced by partial aggregation to a single row first."""
    t = trades.agg(F.min(ts).alias("t_lo"), F.max(ts).alias("t_hi"))
    q = nbbo.agg(F.min(ts).alias("q_lo"), F.max(ts).alias("q_hi"))
    return t.select(F.coalesce("t_lo", q.select("q_lo").scalar()).alias("min_ts"),
                    F.coalesce("t_hi", q.select("q_hi").scalar()).alias("max_ts"))
