"""Ranks and interpolation of exact quantiles, as column expressions."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def wanted_ranks(n: Column, probs: Sequence[float]) -> Column:
    """The distinct 0-based ranks that linear interpolation of ``probs`` over n rows needs."""
    at = [(n - 1) * F.lit(float(p)) for p in probs]
    return F.array_distinct(F.array(*(f(a).cast("long") for a in at for f in (F.floor, F.ceil))))


def interpolate(n: Column, probs: Sequence[float], value) -> Column:
    """One value per probability; ``value(rank)`` is the value of a 0-based rank."""
    out = []
    for p in probs:
        at = (n - 1) * F.lit(float(p))
        low, part = F.floor(at).cast("long"), at - F.floor(at)
        # No rank above is read where the position is a whole one: infinities stay as they are.
        out.append(F.when(part == 0, value(low)).otherwise(value(low) * (1 - part) + value(low + 1) * part))
    return F.array(*out)


def magnitude(x: Column) -> Column:
    """A non-decreasing LONG of a DOUBLE: sign and 1/64 powers of two. At most 2**18 values.

    Minus infinity is first, plus infinity last but for NaN, as Spark orders them.
    """
    step = F.floor((F.log2(F.abs(x)) + 1100) * 64).cast("long") + 1
    edge = F.lit(1 << 20).cast("long")
    return (F.when(F.isnan(x), edge + 1).when(x == float("inf"), edge).when(x == float("-inf"), -edge)
            .when(x == 0, F.lit(0).cast("long")).when(x > 0, step).otherwise(-step))
