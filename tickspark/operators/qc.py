"""Daily quality control of trades and NBBO."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickspark.functions.columns import SESSION_MINUTES, SESSION_OPEN_US, micros_of_day, time_bucket
from tickspark.functions.filters import crossed, regular_trade

DAY = ("trade_date", "symbol")
_OPEN = SESSION_OPEN_US // 60_000_000


def daily(trades: DataFrame, nbbo: DataFrame, keys: Sequence[str] = DAY) -> DataFrame:
    """Per symbol-day: trades, share corrected, conditions, minutes with trades and their share of
    the session, NBBO updates and share crossed. Days with only one of the two are kept."""
    t = trades.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_trades"), F.count_if(~regular_trade()).alias("n_corrected"),
        F.count_distinct("tr_scond").alias("n_conditions"), F.count_distinct(time_bucket("ts_event", "1m")).alias("bar_minutes"))
    q = nbbo.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_nbbo"), F.count_if(crossed()).alias("n_crossed"))
    counts = {c: F.coalesce(c, F.lit(0).cast("long")) for c in ("n_trades", "n_corrected", "n_conditions", "bar_minutes", "n_nbbo", "n_crossed")}
    return t.join(q, list(keys), "full_outer").withColumns({
        "pct_corrected": F.try_divide(F.col("n_corrected") * 100.0, F.col("n_trades")),
        "pct_crossed": F.try_divide(F.col("n_crossed") * 100.0, F.col("n_nbbo"))}).withColumns(
        counts).withColumn("bar_coverage_pct", F.col("bar_minutes") * 100.0 / SESSION_MINUTES)


def empty_ranges(ticks: DataFrame, keys: Sequence[str] = DAY, ts: str = "ts_event") -> DataFrame:
    """Runs of session minutes without a tick, per symbol-day that has any tick: first and last
    minute of day and their number. A day with ticks outside the session only is one run.

    At most 390 minutes a symbol-day reach the window; the ticks are combined before."""
    minute = F.floor(micros_of_day(ts) / 60_000_000).cast("int")
    inside = F.when((minute >= _OPEN) & (minute < _OPEN + SESSION_MINUTES), minute)
    held = ticks.groupBy(*keys, inside.alias("m")).agg(F.lit(1).alias("one"))
    closing = held.select(*keys).distinct().withColumn("m", F.lit(_OPEN + SESSION_MINUTES))
    along = Window.partitionBy(*keys).orderBy("m")
    rows = held.where(F.col("m").isNotNull()).select(*keys, "m").unionByName(closing)
    rows = rows.withColumn("first_minute", F.coalesce(F.lag("m").over(along) + 1, F.lit(_OPEN)))
    return rows.where(F.col("m") > F.col("first_minute")).select(
        *keys, "first_minute", (F.col("m") - 1).alias("last_minute"), (F.col("m") - F.col("first_minute")).alias("n_minutes"))


def code_mix(ticks: DataFrame, code: str, keys: Sequence[str] = DAY) -> DataFrame:
    """Per symbol-day and code: ticks and their share of the symbol-day (A16, A17 by day).
    The total is a window over one row per code."""
    n = ticks.groupBy(*keys, code).agg(F.count(F.lit(1)).alias("n_ticks"))
    return n.withColumn("pct", F.col("n_ticks") * 100.0 / F.sum("n_ticks").over(Window.partitionBy(*keys)))
