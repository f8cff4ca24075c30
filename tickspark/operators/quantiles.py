"""Exact quantiles of groups of any size, by rank selection.

``median`` and ``percentile`` keep all distinct values of a group in one task's map.
Here the distinct values are counted (partial sums before the shuffle), the counts are
written to the shared scratch folder once, and the wanted ranks are looked up by running
totals over them. Where no group has more than ``ONE_TASK`` distinct values (counted
first), one window per group orders them. Beyond, a rank is found by narrowing:

1. counts per order of magnitude (at most 2**18 a group) and their running total tell
   which magnitude holds the rank;
2. counts per 2**20 equal steps between the smallest and largest value of that
   magnitude tell which step holds it;
3. only the values of that step are put in order. A step spans less than 2**-26 of its
   values, so it holds at most 2**26 of all doubles there are; no task sorts more,
   whatever the table's size, and what it sorts can spill.

Both ways give the same values. The input is evaluated once.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tickspark.functions.quantiles import interpolate, magnitude, wanted_ranks
from tickspark.session import stored

STEPS = 1 << 20
ONE_TASK = 1 << 22


def _same(left: DataFrame, right: DataFrame, names: Sequence[str]) -> DataFrame:
    """Inner join on ``names``, a NULL being a value like any other; ``right``'s copies go."""
    other = right.withColumnsRenamed({c: f"_r_{c}" for c in names})
    on = F.lit(True)
    for c in names:
        on = on & F.col(c).eqNullSafe(F.col(f"_r_{c}"))
    return left.join(other, on).drop(*(f"_r_{c}" for c in names))


def _hits(counts: DataFrame, group: Sequence[str], order: str, ranks: Column, start: Column | None = None) -> DataFrame:
    """Rows of ``counts`` (with ``_n`` rows each, in ``order``) that hold a wanted rank, with
    the ranks they hold and the rows of the whole group ``_before`` them."""
    along = Window.partitionBy(*(group or [F.lit(0)])).orderBy(order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    upto = F.sum("_n").over(along) + (F.lit(0) if start is None else start)
    rows = counts.withColumns({"_upto": upto, "_ranks": ranks})
    before = F.col("_upto") - F.col("_n")
    mine = F.filter("_ranks", lambda r: (r >= before) & (r < F.col("_upto")))
    return rows.withColumns({"_ranks": mine, "_before": before}).drop("_upto").where(F.size("_ranks") > 0)


def value_counts(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """keys, _c (number of the column), _x (its value, as a double; no NULLs) and _n rows."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("_c"), F.col(c).cast("double").alias("_x")) for k, c in enumerate(columns))))
    values = (df.select(*keys, F.lit(0).alias("_c"), F.col(columns[0]).cast("double").alias("_x")) if len(columns) == 1
              else df.select(*keys, each.alias("_v")).select(*keys, "_v._c", "_v._x"))
    return values.where(F.col("_x").isNotNull()).groupBy(*keys, "_c", "_x").agg(F.count(F.lit(1)).alias("_n"))


def _narrowed(counts: DataFrame, group: Sequence[str], probs: Sequence[float]) -> DataFrame:
    counts = counts.withColumn("_m", magnitude(F.col("_x")))
    # 1. magnitudes
    sizes = counts.groupBy(*group, "_m").agg(F.sum("_n").alias("_n"), F.min("_x").alias("_lo"), F.max("_x").alias("_hi"))
    sizes = sizes.withColumn("_all", F.sum("_n").over(Window.partitionBy(*group)))
    first = _hits(sizes, group, "_m", wanted_ranks(F.col("_all"), probs)).drop("_n")
    # 2. steps of the magnitudes that hold a rank
    place = F.floor((F.col("_x") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (STEPS - 1))
    step = F.when(F.col("_hi") > F.col("_lo"), place).otherwise(0).cast("long")
    inside = _same(counts, first, [*group, "_m"]).withColumn("_s", step)
    steps = inside.groupBy(*group, "_m", "_s").agg(F.sum("_n").alias("_n"), *(
        F.first(c).alias(c) for c in ("_lo", "_hi", "_before", "_ranks", "_all")))
    second = _hits(steps, [*group, "_m"], "_s", F.col("_ranks"), F.col("_before")).drop("_n").withColumnRenamed("_s", "_at")
    # 3. values of the steps that hold a rank
    picked = _same(counts, second, [*group, "_m"]).withColumn("_s", step).where(F.col("_s") == F.col("_at"))
    return _hits(picked, [*group, "_m", "_s"], "_x", F.col("_ranks"), F.col("_before"))


def _ordered(counts: DataFrame, keys: Sequence[str], n_columns: int, probs: Sequence[float], also: Sequence[Column]) -> DataFrame:
    """One window per group; the value of a rank is the smallest one with more rows up to it."""
    by = [*keys, "_c"] if n_columns > 1 else (list(keys) or [F.lit(0)])
    group, n = Window.partitionBy(*by), F.when(F.col("_x").isNotNull(), F.col("_n"))
    upto = F.sum(n).over(group.orderBy("_x").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    rows = counts.withColumns({"_upto": upto, "_all": F.sum(n).over(group)})

    def of(c):
        mine, out = F.col("_c") == c, []
        for p in probs:
            at = (F.col("_all") - 1) * F.lit(float(p))
            low, part = F.floor(at).cast("long"), F.max(F.when(mine, at - F.floor(at)))
            first, second = (F.min(F.when(mine & (F.col("_upto") > rank), F.col("_x"))) for rank in (low, low + 1))
            out.append(F.when(part == 0, first).otherwise(first * (1 - part) + second * part))
        return F.when(F.count_if(mine & F.col("_x").isNotNull()) > 0, F.array(*out)).alias(f"_q{c}")

    return rows.groupBy(*keys).agg(*(of(c) for c in range(n_columns)), *also)


def _narrow(counts: DataFrame, keys: Sequence[str], n_columns: int, probs: Sequence[float]) -> DataFrame:
    at = _narrowed(counts, [*keys, "_c"], probs).select(*keys, "_c", "_all", F.explode("_ranks").alias("_r"), "_x")

    def of(c):
        mine = F.col("_c") == c
        values = F.map_from_entries(F.collect_set(F.when(mine, F.struct("_r", "_x"))))
        return F.struct(F.max(F.when(mine, F.col("_all"))).alias("n"), values.alias("at")).alias(f"_q{c}")

    quantile = [F.when(F.col(f"_q{c}.n").isNotNull(), interpolate(F.col(f"_q{c}.n"), probs, lambda r, c=c: F.element_at(f"_q{c}.at", r)))
                for c in range(n_columns)]
    return at.groupBy(*keys).agg(*(of(c) for c in range(n_columns))).select(*keys, *(q.alias(f"_q{c}") for c, q in enumerate(quantile)))


def quantiles_of_counts(counts: DataFrame, distinct: int, n_columns: int, probs: Sequence[float], keys: Sequence[str] = (),
                        one_task: int = ONE_TASK, also: Sequence[Column] = ()) -> DataFrame:
    """``keys`` and an array of quantiles ``_q0`` … per column, from a written table of
    ``value_counts`` with ``distinct`` rows, and the aggregates ``also`` of that table.
    Rows without a value count for ``also`` only; without it they and their groups are left out."""
    if distinct > one_task:  # all groups together; only then the largest is looked for
        per = counts.groupBy(*keys, "_c").agg(F.count(F.lit(1)).alias("_d"))
        distinct = per.agg(F.max("_d")).first()[0]
    if distinct <= one_task:
        found = _ordered(counts, keys, n_columns, probs, also)
    else:
        found = _narrow(counts.where(F.col("_x").isNotNull()).select(*keys, "_c", "_x", "_n"), keys, n_columns, probs)
        found = join_groups(counts.groupBy(*keys).agg(*also), found, keys) if also else found
    return found if also else found.where(" or ".join(f"_q{c} is not null" for c in range(n_columns)))


def counts_of(df: DataFrame, columns: Sequence[str], keys: Sequence[str] = ()) -> tuple[DataFrame, int]:
    """The written ``value_counts`` and its number of rows."""
    seen = Observation("value_counts")
    counts = stored(value_counts(df, columns, keys).observe(seen, F.count(F.lit(1)).alias("rows")), "value-counts")
    return counts, int(seen.get["rows"])


def exact_quantiles(df: DataFrame, columns: Sequence[str], probs: Sequence[float], keys: Sequence[str] = (),
                    one_task: int = ONE_TASK) -> DataFrame:
    """``keys`` and, per column, an array of its quantiles ``probs`` by linear interpolation.

    NULL values are ignored, a NULL key is a group. Groups without any value have no
    row, and a column without values in a group that has a row is NULL there. NaN is
    the largest value.
    """
    counts, distinct = counts_of(df, columns, keys)
    found = quantiles_of_counts(counts, distinct, len(columns), probs, keys, one_task)
    return found.select(*keys, *(F.col(f"_q{k}").alias(c) for k, c in enumerate(columns)))


def join_groups(rows: DataFrame, found: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``rows`` (one per group) plus the other columns of ``found`` (at most one row per group)."""
    if not keys:
        # One row each: the second is a scalar subquery of the first.
        one = found.select(F.struct(*found.columns)).scalar()
        return rows.withColumn("_one", one).select(*rows.columns, *(F.col("_one")[c].alias(c) for c in found.columns))
    named = found.withColumnsRenamed({k: f"_r_{k}" for k in keys})
    on = F.lit(True)
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    return rows.join(named, on, "left").drop(*(f"_r_{k}" for k in keys))


def with_quantiles(rows: DataFrame, df: DataFrame, columns: dict[str, str], probs: Sequence[float] = (0.5,),
                   keys: Sequence[str] = ()) -> DataFrame:
    """``rows`` (one per group of ``df``) plus the quantiles of ``columns`` (column -> new name):
    an array, or the value itself where there is one probability."""
    found = exact_quantiles(df, list(columns), probs, keys)
    value = (lambda c: F.element_at(c, 1)) if len(probs) == 1 else (lambda c: c)
    return join_groups(rows, found.select(*keys, *(value(F.col(c)).alias(n) for c, n in columns.items())), keys)
