"""Multi-resolution tables of a lake (A44): written levels, each built from the finer one.

A level holds mergeable rows per (date, symbol, bucket): quotes keep the last values with
their time and sequence and a count, trades keep price × size, size and a count. An
append turns new ticks into rows of the finest level, derives the coarser levels from
those rows alone, and writes each as a load of its dataset (``sources/lake.py``), so
nothing older is read or rewritten and a repeated append replaces itself. Readers merge
the loads' rows of a bucket: the result equals the aggregate over all ticks.
``compact`` rewrites dates to one row per bucket.
"""

from __future__ import annotations

from datetime import datetime
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions.columns import bucket_micros, time_bucket
from tickspark.session import scratch_path
from tickspark.sources import lake

#: The levels, and up to which window (in seconds) each finer one is read.
LEVELS = ("100ms", "1s")
RAW_BELOW, FINE_UP_TO = 120, 1800
KEYS = ("trade_date", "symbol")
QUOTE_COLS = ("best_bid", "best_ask")


def _dataset(kind: str, level: str) -> str:
    return f"lod_{kind}_{level}"


def _merge(rows: DataFrame, kind: str, bucket: Column, cols: Sequence[str]) -> DataFrame:
    """Rows of a level (or finer) → one row per bucket; sums add up and the last one wins."""
    grouped = rows.groupBy(*KEYS, bucket.alias("time_bucket"))
    if kind == "trades":
        return grouped.agg(*(F.sum(c).alias(c) for c in ("price_volume", "volume", "trade_count")))
    last = F.struct("last_ts", "last_seq")
    return grouped.agg(*(F.max_by(c, last).alias(c) for c in cols), F.sum("n_updates").alias("n_updates"),
                       F.max(last).alias("_last")).select(*KEYS, "time_bucket", *cols, "n_updates", "_last.last_ts", "_last.last_seq")


def _rows(ticks: DataFrame, kind: str, ts: str, seq: str, cols: Sequence[str], price: str, size: str) -> DataFrame:
    if kind == "trades":
        return ticks.select(*KEYS, F.col(ts).alias("time_bucket"), (F.col(price) * F.col(size)).alias("price_volume"),
                            F.col(size).cast("long").alias("volume"), F.lit(1).cast("long").alias("trade_count"))
    return ticks.select(*KEYS, F.col(ts).alias("time_bucket"), *cols, F.lit(1).cast("long").alias("n_updates"), F.col(ts).alias("last_ts"),
                        F.col(seq).cast("long").alias("last_seq"))


def append(ticks: DataFrame, root: str, kind: str, load: str, levels: Sequence[str] = LEVELS, ts: str = "ts_event", seq: str = "qu_seqnum",
           cols: Sequence[str] = QUOTE_COLS, price: str = "price", size: str = "size") -> None:
    """Adds ``ticks`` (``kind`` quotes or trades) to every level under ``root`` as ``load``.

    Widths must divide one another. Each level is written and the next is made from what was
    written: the ticks are read once."""
    spark, rows = ticks.sparkSession, _rows(ticks, kind, ts, seq, cols, price, size)
    widths = [bucket_micros(level) for level in levels]
    if any(b % a for a, b in zip(widths, widths[1:])):
        raise ValueError(f"each level has to divide the next one: {tuple(levels)}")
    for level in levels:
        made = _merge(rows, kind, time_bucket("time_bucket", level), cols)
        path = scratch_path(spark, "lod")
        made.write.option("compression", "zstd").parquet(path)
        rows = spark.read.schema(made.schema).parquet(path)
        lake.write_partitioned(rows, root, _dataset(kind, level), partition_by_symbol=False, mode="append", sort_cols=("symbol", "time_bucket"),
                               load=load)


def read_level(spark: SparkSession, root: str, kind: str, level: str, where: Column | None = None, cols: Sequence[str] = QUOTE_COLS) -> DataFrame:
    """A level as one row per bucket: quotes with their last values and ``n_updates``, trades with
    ``vwap``, ``volume`` and ``trade_count``. ``where``: a condition on date, symbol and
    ``time_bucket``, which reaches the scan."""
    rows = lake.read_lake(spark, root, _dataset(kind, level))
    rows = rows if where is None else rows.where(where)
    merged = _merge(rows, kind, F.col("time_bucket"), cols)
    if kind == "trades":
        return merged.select(*KEYS, "time_bucket", F.try_divide("price_volume", "volume").alias("vwap"), "volume", "trade_count")
    return merged.select(*KEYS, "time_bucket", *cols, "n_updates")


def level_for(seconds: float, levels: Sequence[str] = LEVELS) -> str:
    """Which level a window of so many seconds is read from; ``raw`` for short ones."""
    return "raw" if seconds < RAW_BELOW else levels[0] if seconds <= FINE_UP_TO else levels[-1]


def read_window(spark: SparkSession, root: str, kind: str, start, end, raw: DataFrame | None = None, symbols=None,
                ts: str = "ts_event") -> tuple[str, DataFrame]:
    """The level of a window's length and its rows between ``start`` and ``end`` (both inclusive,
    in the ticks' own clock). ``raw``: the ticks, for windows too short for a level."""
    lo, hi = (datetime.fromisoformat(str(x)) for x in (start, end))
    level = level_for((hi - lo).total_seconds())
    at = ts if level == "raw" else "time_bucket"
    where = F.col(at).between(F.lit(str(lo)).cast("timestamp_ntz"), F.lit(str(hi)).cast("timestamp_ntz"))
    where &= F.col("trade_date").between(F.lit(str(lo.date())).cast("date"), F.lit(str(hi.date())).cast("date"))
    if symbols is not None:
        where &= F.col("symbol").isin(list(symbols))
    return level, raw.where(where) if level == "raw" else read_level(spark, root, kind, level, where)


def compact(spark: SparkSession, root: str, kind: str, level: str, dates: Sequence, cols: Sequence[str] = QUOTE_COLS) -> None:
    """Rewrites ``dates`` of a level to one load with one row per bucket."""
    day = F.col("trade_date").isin([F.lit(str(d)).cast("date") for d in dates])
    merged = _merge(lake.read_lake(spark, root, _dataset(kind, level)).where(day), kind, F.col("time_bucket"), cols)
    path = scratch_path(spark, "lod-compact")
    merged.write.option("compression", "zstd").parquet(path)
    lake.write_partitioned(spark.read.schema(merged.schema).parquet(path), root, _dataset(kind, level), partition_by_symbol=False,
                           mode="overwrite", sort_cols=("symbol", "time_bucket"))
