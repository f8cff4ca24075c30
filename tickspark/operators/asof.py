"""Backward as-of join (J2, J3, J8): for each left row, the last right row with
``right_ts <= left_ts`` under the same ``by`` keys. Unmatched left rows keep NULLs.

Spark has no public as-of join, so it is composed from DataFrame operations:

* plain: union both sides, one window per ``by`` group ordered by
  ``(ts, side, seq)``, ``last(quote_struct, ignorenulls)``; right rows sort before
  left rows at the same instant, so an equal-time quote is visible ("at or before").
  The quote is carried as one struct, so NULL fields inside a matched quote are
  never filled from older quotes.
* bucketed (default): the window is additionally partitioned by a time bucket,
  so one hot ``by`` group (say a symbol-day with a third of all rows) is spread
  over many tasks. Each bucket receives the quote carried in from earlier buckets
  as a synthetic first row; that carry is computed on a pre-aggregated table of
  one row per (by, bucket), so no raw rows are collected anywhere.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.columns import bucket_micros, epoch_micros, from_epoch_micros

_MIN_LONG = -(2 ** 63)


def _as_long_time(df: DataFrame, c: str):
    """Ordering key as LONG: NTZ/TIMESTAMP → epoch micros, integral → itself."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.TimestampNTZType,)):
        return epoch_micros(c)
    if isinstance(dt, T.TimestampType):
        return F.unix_micros(F.col(c))
    return F.col(c).cast("long")


def asof_join(left: DataFrame, right: DataFrame, by: Sequence[str], left_ts: str,
              right_ts: str | None = None, right_cols: Sequence[str] | dict | None = None,
              left_seq: str | None = None, right_seq: str | None = None,
              bucket: str | int | None = "1m", ts_unit_per_us: int = 1,
              right_required: bool = False) -> DataFrame:
    """Backward as-of join of ``right`` onto ``left``.

    ``right_cols``: names (or ``{name: alias}``) of right columns to bring over.
    ``bucket``: time-bucket width for the skew-safe plan (``None`` = plain plan).
    ``ts_unit_per_us``: 1000 when the ts columns are LONG nanoseconds; join ticks on
    those, or a quote up to a microsecond later can be taken for an earlier one.
    A NULL key or time matches nothing; such left rows keep NULLs. The ``by`` columns
    come straight from the window keys, so filters on them reach every scan.
    ``right_required``: drop left rows whose ``by`` group has no right row at all (the
    "present on both sides" restriction), decided inside the same plan — no extra join.
    """
    by = list(by)
    right_ts = right_ts or left_ts
    if right_cols is None:
        right_cols = [c for c in right.columns if c not in by and c != right_ts]
    if not isinstance(right_cols, dict):
        right_cols = {c: c for c in right_cols}
    lcols = left.columns
    carried = [c for c in lcols if c not in by]
    right = right.where(reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in (*by, right_ts)]))

    L = left.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)],
                    _as_long_time(left, left_ts).alias("_t"),
                    F.lit(1).alias("_side"),
                    (F.col(left_seq).cast("long") if left_seq else F.lit(0).cast("long")).alias("_seq"),
                    F.struct(*carried).alias("_l"))
    R = right.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(by)],
                     _as_long_time(right, right_ts).alias("_t"),
                     F.lit(0).alias("_side"),
                     (F.col(right_seq).cast("long") if right_seq else F.lit(0).cast("long")).alias("_seq"),
                     F.struct(*[F.col(c).alias(a) for c, a in right_cols.items()]).alias("_r"))
    keys = [f"_k{i}" for i in range(len(by))]

    if bucket is None:
        U = L.unionByName(R, allowMissingColumns=True)
        part = keys
        if right_required:  # any right row in the group: same partitioning, no new exchange
            U = U.withColumn("_keep", F.max(1 - F.col("_side")).over(Window.partitionBy(*keys)))
    else:
        width = bucket_micros(bucket) * ts_unit_per_us
        # bucket key = bucket start, in exact integer arithmetic (ts may be LONG nanos)
        L = L.withColumn("_b", F.col("_t") - F.pmod(F.col("_t"), F.lit(width)))
        R = R.withColumn("_b", F.col("_t") - F.pmod(F.col("_t"), F.lit(width)))
        # last right row per (by, bucket): partial aggregation before the shuffle, one row per
        # key-bucket (sort-based: max_by over a struct has no hash-aggregation buffer)
        r_last = (R.groupBy(*keys, "_b")
                  .agg(F.max_by("_r", F.struct("_t", "_seq")).alias("_r"))
                  .withColumn("_o", F.lit(1)))
        # buckets that hold left rows
        l_buckets = L.select(*keys, "_b").distinct().withColumn("_o", F.lit(0))
        # carry-in = last right row of any strictly earlier bucket
        wk = (Window.partitionBy(*keys).orderBy("_b", "_o")
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
        carry = (l_buckets.unionByName(r_last, allowMissingColumns=True)
                 .withColumn("_c", F.last("_r", ignorenulls=True).over(wk)))
        if right_required:
            # a carry row (possibly with no quote yet) marks buckets of groups with any right row
            carry = (carry.withColumn("_anyr", F.max(F.col("_o")).over(Window.partitionBy(*keys)))
                     .where((F.col("_o") == 0) & (F.col("_anyr") == 1)))
        else:
            carry = carry.where((F.col("_o") == 0) & F.col("_c").isNotNull())
        carry = carry.select(*keys, "_b", F.lit(_MIN_LONG).alias("_t"), F.lit(0).alias("_side"),
                             F.lit(_MIN_LONG).alias("_seq"), F.col("_c").alias("_r"),
                             F.lit(1).alias("_keep"))
        U = L.unionByName(R, allowMissingColumns=True).unionByName(carry, allowMissingColumns=True)
        part = keys + ["_b"]

    w = (Window.partitionBy(*part).orderBy("_t", "_side", "_seq")
         .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    out = U.withColumn("_m", F.last("_r", ignorenulls=True).over(w))
    if right_required and bucket is not None:
        # the carry row sorts first in its bucket, so a running max sees it on every row
        out = out.withColumn("_keep", F.max("_keep").over(w))
    out = out.where((F.col("_side") == 1) & (F.col("_keep") == 1) if right_required else (F.col("_side") == 1))
    return out.select(*[F.col(f"_k{by.index(c)}").alias(c) if c in by else F.col("_l")[c].alias(c) for c in lcols],
                      *[F.col("_m")[a].alias(a) for a in right_cols.values()])


def next_time(df: DataFrame, by: Sequence[str], ts: str, seq: str | None = None,
              bucket: str | int | None = "1m", out: str = "next_ts",
              ts_unit_per_us: int = 1) -> DataFrame:
    """Add the time of the next row of the same ``by`` group (``lead``), NULL for the last.

    Skew-safe like ``asof_join``: the window runs per (by, bucket) and the last row of
    each bucket takes the first time of the next non-empty bucket, found on a
    one-row-per-bucket table. ``ts`` may be NTZ or LONG; ``out`` has the same type.
    """
    by = list(by)
    tcol = _as_long_time(df, ts)
    is_ntz = isinstance(df.schema[ts].dataType, T.TimestampNTZType)
    s = F.col(seq).cast("long") if seq else F.lit(0).cast("long")
    if bucket is None:
        w = Window.partitionBy(*by).orderBy(tcol, s)
        nxt = F.lead(tcol).over(w)
        res = df.withColumn("_nt", nxt)
    else:
        width = bucket_micros(bucket) * ts_unit_per_us
        base = (df.withColumn("_t", tcol).withColumn("_s", s)
                .withColumn("_b", F.col("_t") - F.pmod(F.col("_t"), F.lit(width))))
        firsts = base.groupBy(*by, "_b").agg(F.min("_t").alias("_f"))
        wb = Window.partitionBy(*by).orderBy("_b")
        nb = firsts.withColumn("_nf", F.lead("_f").over(wb))
        # synthetic last row of each bucket carries the first time of the next bucket
        sentinel = nb.select(*by, "_b", F.lit(2 ** 63 - 1).alias("_t"), F.lit(2 ** 63 - 1).alias("_s"),
                             F.col("_nf").alias("_v"), F.lit(True).alias("_syn"))
        rows = base.withColumn("_v", F.col("_t")).withColumn("_syn", F.lit(False))
        u = rows.unionByName(sentinel, allowMissingColumns=True)
        w = Window.partitionBy(*by, "_b").orderBy("_t", "_s")
        res = (u.withColumn("_nt", F.lead("_v").over(w)).where(~F.col("_syn"))
               .drop("_t", "_s", "_b", "_v", "_syn"))
    if is_ntz:
        res = res.withColumn(out, from_epoch_micros("_nt"))
    else:
        res = res.withColumn(out, F.col("_nt"))
    return res.drop("_nt")
