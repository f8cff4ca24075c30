"""Profiles, distributions and per-symbol consistency.

All statistics but quantiles are single ``agg`` passes: Spark aggregates partially on
each map task and merges after the shuffle. Quantiles are exact and found by rank
selection (``operators/quantiles.py``), so no group's values meet in one task's map.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tickspark.functions.columns import mid, pct_dev, price_location
from tickspark.operators.quantiles import counts_of, exact_quantiles, quantiles_of_counts, with_quantiles
from tickspark.session import stored


def describe(df: DataFrame, c: str, keys: Sequence[str] = (), once: bool = False) -> DataFrame:
    """min, max, mean, median, std (sample) of one column, per group of ``keys``.

    ``once``: ``df`` is costly (a join, say); its columns are written and read twice."""
    df = stored(df.select(*keys, c), "described") if once else df
    rest = df.groupBy(*keys).agg(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean"), F.stddev_samp(c).alias("std"))
    return with_quantiles(rest, df, {c: "median"}, keys=keys).select(*keys, "min", "max", "mean", "median", "std")


def with_deviation(df: DataFrame, price: str = "price", bid: str = "best_bid",
                   ask: str = "best_ask") -> DataFrame:
    """Deviation of the trade price from bid, ask and mid (%), and its location."""
    return df.withColumns({
        "price_vs_bid_pct": pct_dev(price, bid),
        "price_vs_ask_pct": pct_dev(price, ask),
        "price_vs_mid_pct": pct_dev(price, mid(bid, ask)),
        "price_location": price_location(price, bid, ask),
    })


def symbol_consistency(enriched: DataFrame, keys: Sequence[str] = ("symbol",)) -> DataFrame:
    """A27 + P16: per-symbol trade/NBBO consistency metrics (16 aggregates + ratios).

    The trades are read once, into partial sums per (key, spread): on a price grid a few
    rows a symbol. They are written, and the totals as well as the exact median spread
    come from them. Deviations are centred on zero, so their squares can be summed as
    they are.
    """
    loc, dev = F.col("price_location"), F.col("price_vs_mid_pct")
    seen = Observation("consistency")
    part = stored(enriched.groupBy(*keys, "spread").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("size").cast("long").alias("_volume"),
        *(F.count_if(loc == name).alias(f"_{name}") for name in ("within_spread", "below_bid", "above_ask")),
        F.count(dev).alias("_nd"), F.sum(dev).alias("_d"), F.sum(dev * dev).alias("_dd"), F.min(dev).alias("_min"), F.max(dev).alias("_max"),
        F.sum(F.abs(dev)).alias("_abs"), F.max(F.abs(dev)).alias("_maxabs"))
        .observe(seen, F.count(F.lit(1)).alias("rows")), "consistency")
    spread, n = F.col("spread"), F.when(F.col("spread").isNotNull(), F.col("_n"))
    totals = [
        F.sum("_n").alias("total_trades"), F.sum("_volume").alias("total_volume"),
        *(F.sum(f"_{name}").alias(f"{name}_count") for name in ("within_spread", "below_bid", "above_ask")),
        F.try_divide(F.sum(spread * n), F.sum(n)).alias("mean_spread"),
        _std(F.sum(n), F.sum(spread * n), F.sum(spread * spread * n)).alias("std_spread"),
        F.min("spread").alias("min_spread"), F.max("spread").alias("max_spread"),
        F.try_divide(F.sum("_d"), F.sum("_nd")).alias("mean_price_deviation_pct"),
        _std(F.sum("_nd"), F.sum("_d"), F.sum("_dd")).alias("std_price_deviation_pct"),
        F.min("_min").alias("min_price_deviation_pct"), F.max("_max").alias("max_price_deviation_pct"),
        F.try_divide(F.sum("_abs"), F.sum("_nd")).alias("mean_abs_deviation_pct"), F.max("_maxabs").alias("max_abs_deviation_pct")]
    counts = part.withColumns({"_c": F.lit(0), "_x": spread.cast("double")})
    agg = quantiles_of_counts(counts, int(seen.get["rows"]), 1, (0.5,), keys, also=totals)
    return agg.withColumn("median_spread", F.element_at("_q0", 1)).drop("_q0").withColumns({
        "pct_within_spread": F.try_divide(F.col("within_spread_count") * 100.0, F.col("total_trades")),
        "pct_below_bid": F.try_divide(F.col("below_bid_count") * 100.0, F.col("total_trades")),
        "pct_above_ask": F.try_divide(F.col("above_ask_count") * 100.0, F.col("total_trades")),
        "spread_range": F.col("max_spread") - F.col("min_spread"),
        "spread_cv": F.try_divide(F.col("std_spread"), F.col("mean_spread")),
        "deviation_range": F.col("max_price_deviation_pct") - F.col("min_price_deviation_pct"),
    })


def _std(n: Column, total: Column, squares: Column) -> Column:
    """Sample deviation from sums; NULL for one row, as ``stddev_samp``."""
    return F.when(n > 1, F.sqrt(F.greatest(squares - total * total / n, F.lit(0.0)) / (n - 1)))


def location_mix(enriched: DataFrame) -> DataFrame:
    """Count and share of each price location (share via a total window)."""
    return (enriched.groupBy("price_location").agg(F.count(F.lit(1)).alias("count"))
            .withColumn("percentage", F.col("count") * 100.0 / F.sum("count").over(Window.partitionBy())))


def quantiles(df: DataFrame, c: str, probs: Sequence[float] = (0.5, 0.95, 0.99), keys: Sequence[str] = ()) -> DataFrame:
    """Mean, count and exact linear-interpolated quantiles; groups without values have no row."""
    names = [f"p{int(round(p * 100))}" if p != 0.5 else "median" for p in probs]
    counts, distinct = counts_of(df, [c], keys)
    total = F.sum("_n")
    out = quantiles_of_counts(counts, distinct, 1, probs, keys, also=[
        F.try_divide(F.sum(F.col("_x") * F.col("_n")), total).alias("mean"), F.coalesce(total, F.lit(0)).alias("n")])
    out = out.withColumnRenamed("_q0", "_qs")
    return out.select(*keys, "mean", "n", *[F.col("_qs")[i].alias(n) for i, n in enumerate(names)])


def _join_null_safe(rows: DataFrame, per_key: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join in which a NULL key is a group like any other."""
    right = per_key.withColumnsRenamed({k: f"_g_{k}" for k in keys})
    cond = F.lit(True)
    for k in keys:
        cond = cond & rows[k].eqNullSafe(right[f"_g_{k}"])
    return rows.join(right, cond).drop(*[f"_g_{k}" for k in keys])


def histogram(df: DataFrame, c: str, bins: int, keys: Sequence[str] = (), once: bool = False) -> DataFrame:
    """Equal-width bins over [min, max]; the last bin is closed; all-equal → one bin.

    The one-row (min, max) per key is joined back; it is bounded by the number of keys.
    ``once``: ``df`` is costly; its columns are written and read twice.
    """
    keys = list(keys)
    df = stored(df.select(*keys, c), "histogram") if once else df
    j = df.where(F.col(c).isNotNull()).select(*keys, c)
    if keys:
        bounds = df.groupBy(*keys).agg(F.min(c).alias("_lo"), F.max(c).alias("_hi"))
        j = _join_null_safe(j, bounds, keys)
    else:  # global bounds as one merged scalar subquery (one partial aggregate)
        j = j.withColumns({"_lo": df.agg(F.min(c)).scalar(), "_hi": df.agg(F.max(c)).scalar()})
    width = (F.col("_hi") - F.col("_lo")) / F.lit(bins)
    b = F.when(F.col("_hi") == F.col("_lo"), F.lit(0)).otherwise(
        F.least(F.floor((F.col(c) - F.col("_lo")) / width), F.lit(bins - 1))).cast("int")
    return (j.withColumn("bin", b)
            .groupBy(*keys, "bin")
            .agg(F.count(F.lit(1)).alias("count"), F.first("_lo").alias("_lo"), F.first("_hi").alias("_hi"))
            .withColumn("bin_lo", F.col("_lo") + F.col("bin") * (F.col("_hi") - F.col("_lo")) / F.lit(bins))
            .withColumn("bin_hi", F.col("_lo") + (F.col("bin") + 1) * (F.col("_hi") - F.col("_lo")) / F.lit(bins))
            .drop("_lo", "_hi"))


def boxplot(df: DataFrame, c: str, keys: Sequence[str] = ()) -> DataFrame:
    """Quartiles, 1.5·IQR whiskers (most extreme points inside the fences), outlier count."""
    keys = list(keys)
    j = df.select(*keys, c)
    quartiles = exact_quantiles(df, [c], (0.25, 0.5, 0.75), keys).withColumnRenamed(c, "_q")
    if keys:
        j = _join_null_safe(j, quartiles, keys)
    else:  # quartiles as one scalar subquery
        j = j.withColumn("_q", quartiles.scalar())
    j = j.withColumns({"q1": F.col("_q")[0], "median": F.col("_q")[1], "q3": F.col("_q")[2]}).drop("_q")
    j = j.withColumn("iqr", F.col("q3") - F.col("q1")) \
         .withColumn("lo_fence", F.col("q1") - 1.5 * F.col("iqr")) \
         .withColumn("hi_fence", F.col("q3") + 1.5 * F.col("iqr"))
    x = F.col(c)
    inside = (x >= F.col("lo_fence")) & (x <= F.col("hi_fence"))
    return j.groupBy(*keys, "q1", "median", "q3", "iqr", "lo_fence", "hi_fence").agg(
        F.min(F.when(inside, x)).alias("whisker_lo"),
        F.max(F.when(inside, x)).alias("whisker_hi"),
        F.count_if(x.isNotNull() & ~inside).alias("n_outliers"))


def correlation_long(df: DataFrame, metrics: Sequence[str]) -> DataFrame:
    """Pearson correlation of every metric pair, in long form (metric_a, metric_b, r)."""
    pairs = [(a, b) for i, a in enumerate(metrics) for b in metrics[i + 1:]]
    row = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    stack = ", ".join(f"'{a}', '{b}', `{a}__{b}`" for a, b in pairs)
    return row.selectExpr(f"stack({len(pairs)}, {stack}) as (metric_a, metric_b, r)")
