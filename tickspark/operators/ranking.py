"""Exact positions of rows in ordered groups, without a task that holds a group.

A window over a group sorts it in one task. Here rows are dealt by ranges of
(group, order), so a group of any size spans tasks; every range is numbered alone
and a small table of one row per (group, range) adds what lies before it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.session import scratch_path


def fresh(taken: Sequence[str], name: str) -> str:
    """``name``, with underscores until it is no column of ``taken`` (case aside)."""
    low = {c.lower() for c in taken}
    while name.lower() in low:
        name += "_"
    return name


def ranked(rows: DataFrame, by: Sequence[str], order: Sequence[Column], rank: str = "rank", size: str = "size",
           name: str = "ranked") -> DataFrame:
    """``rows`` plus the 0-based ``rank`` of each in its group and the group's ``size``.

    Groups are the distinct values of ``by`` (null is a value). Rows that tie in
    ``order`` share one range and get distinct ranks in no stated order, so the order
    should name every column that tells rows apart. The dealt rows are written to the
    shared scratch folder: a range keeps its number however often it is read, and a
    lost executor costs no resorting.
    """
    keys = [F.col(c).asc_nulls_first() for c in by]
    spark, at, part = rows.sparkSession, fresh(rows.columns, "__at"), fresh(rows.columns, "__part")
    dealt = rows.repartitionByRange(*keys, *order).sortWithinPartitions(*keys, *order).withColumn(at, F.monotonically_increasing_id())
    path = scratch_path(spark, name)
    dealt.write.option("compression", "zstd").parquet(path)
    kept = spark.read.schema(dealt.schema).parquet(path).withColumn(part, F.shiftright(at, 33))
    ranges = kept.groupBy(*by, part).agg(F.min(at).alias("__first"), F.count(F.lit(1)).alias("__n"))
    group = Window.partitionBy(*([F.col(c) for c in by] or [F.lit(0)]))
    before = F.coalesce(F.sum("__n").over(group.orderBy(part).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(*(F.col(c).alias(f"__by{k}") for k, c in enumerate(by)), F.col(part).alias("__range"),
                           (before - F.col("__first")).alias("__shift"), F.sum("__n").over(group).alias("__size"))
    same = F.col(part) == F.col("__range")
    for k, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"__by{k}"))
    return kept.join(ranges, same).select(*rows.columns, (F.col(at) + F.col("__shift")).alias(rank), F.col("__size").alias(size))
