"""Adaptive point budget and time-bucket downsampling.

The reference decides by row count at run time; here the decision is data: one
stats row per group (count, min, max → bucket width) is joined back, so there is
no driver action and every symbol gets its own width in the same job. Groups
within budget go around the aggregate unchanged. The join is null-safe, and each
group's row is repeated per salt, so ticks never meet on the symbol alone.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.columns import epoch_micros, from_epoch_micros

# Fixed values from the reference's chart budget: (window shorter than s, points).
BUDGET_STEPS = [(30, 5000), (120, 10000), (600, 15000), (1800, 10000)]
BUDGET_DEFAULT = 10000
TRADES_MULTIPLIER = 2


def adaptive_max_points(total_seconds, data_type) -> Column:
    """A4: <30 s 5k, <120 s 10k, <600 s 15k, <1800 s 10k, else 10k; ×2 for trades."""
    s = F.col(total_seconds) if isinstance(total_seconds, str) else total_seconds
    dt = F.col(data_type) if isinstance(data_type, str) and data_type not in ("trades", "nbbo") else F.lit(data_type)
    base = F.lit(BUDGET_DEFAULT)
    for limit, pts in reversed(BUDGET_STEPS):
        base = F.when(s < limit, F.lit(pts)).otherwise(base)
    return (base * F.when(dt == "trades", F.lit(TRADES_MULTIPLIER)).otherwise(F.lit(1))).cast("int")


def bucket_width_us(total_seconds: Column, max_points: Column) -> Column:
    """Bucket = max(1 ms, seconds/max_points), snapped to whole s / 100 ms / 10 ms / 1 ms."""
    b = F.greatest(F.lit(0.001), total_seconds / max_points)
    return (F.when(b >= 1, F.floor(b) * 1_000_000)
            .when(b >= 0.1, F.lit(100_000))
            .when(b >= 0.01, F.lit(10_000))
            .otherwise(F.lit(1_000))).cast("long")


def _group_widths(df: DataFrame, keys, ts, max_points, data_type, start, end) -> DataFrame:
    st = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"),
                               F.min(epoch_micros(ts)).alias("_lo"), F.max(epoch_micros(ts)).alias("_hi"))
    if start is not None and end is not None:
        secs = (epoch_micros(F.lit(end).cast("timestamp_ntz")) - epoch_micros(F.lit(start).cast("timestamp_ntz"))) / 1e6
    else:
        secs = (F.col("_hi") - F.col("_lo")) / 1e6
    mp = F.lit(max_points) if max_points is not None else adaptive_max_points(secs, data_type)
    return st.select(*keys, F.when(F.col("_n") <= mp, F.lit(0).cast("long"))
                     .otherwise(bucket_width_us(secs, mp)).alias("_w"))


SALTS = 32


def _with_widths(df: DataFrame, widths: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Joins each group's ``_w`` to its rows, a hot group over SALTS tasks."""
    right = widths.select(*[F.col(k).alias(f"_g{i}") for i, k in enumerate(keys)], "_w",
                          F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_gs"))
    left = df.withColumn("_s", F.pmod(F.xxhash64(*df.columns), F.lit(SALTS)).cast("int"))
    cond = left["_s"] == right["_gs"]
    for i, k in enumerate(keys):
        cond = cond & left[k].eqNullSafe(right[f"_g{i}"])
    return left.join(right, cond).select(*[left[c] for c in df.columns], "_w")


def downsample(df: DataFrame, ts: str = "ts_event", keys: Sequence[str] = ("symbol",),
               seq: str = "qu_seqnum", max_points: int | None = None, data_type: str = "nbbo",
               start=None, end=None, last_types=(T.IntegerType, T.LongType, T.DoubleType, T.FloatType)) -> DataFrame:
    """A3: per group, if rows > budget, keep one row per time bucket: numeric columns
    take the bucket's last value, other columns the first (ordered by ts, seq);
    the time becomes the bucket start. Groups within budget are returned unchanged.
    """
    keys = list(keys)
    widths = _group_widths(df, keys, ts, max_points, data_type, start, end)
    j = _with_widths(df, widths, keys)
    us = epoch_micros(ts)
    bucket = us - F.pmod(us, F.col("_w"))
    order = F.struct(F.col(ts), F.col(seq))
    aggs = []
    for f in df.schema.fields:
        if f.name in keys or f.name == ts:
            continue
        fn = F.max_by if isinstance(f.dataType, tuple(last_types)) else F.min_by
        aggs.append(fn(f.name, order).alias(f.name))
    out = (j.where("_w > 0").groupBy(*keys, bucket.alias("_bk")).agg(*aggs)
           .withColumn(ts, from_epoch_micros("_bk")).drop("_bk"))
    return out.select(*df.columns).unionByName(j.where("_w = 0").select(*df.columns))


def envelope(df: DataFrame, value_cols: Sequence[str], ts: str = "ts_event",
             keys: Sequence[str] = ("symbol",), max_points: int | None = None,
             data_type: str = "nbbo") -> DataFrame:
    """Min and max of each value per bucket (same width rule as ``downsample``)."""
    keys = list(keys)
    widths = _group_widths(df, keys, ts, max_points, data_type, None, None)
    us = epoch_micros(ts)
    w = F.when(F.col("_w") == 0, F.lit(1)).otherwise(F.col("_w"))
    j = _with_widths(df, widths, keys).withColumn("_bk", us - F.pmod(us, w))
    aggs = [F.count(F.lit(1)).alias("n")]
    for c in value_cols:
        aggs += [F.min(c).alias(f"min_{c}"), F.max(c).alias(f"max_{c}")]
    return (j.groupBy(*keys, "_bk").agg(*aggs)
            .withColumn("time_bucket", from_epoch_micros("_bk")).drop("_bk"))
