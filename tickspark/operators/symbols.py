"""Restriction of ticks to a list of symbols without shuffling them by symbol."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Names in a literal list (pushed to the scan); names broadcast, at most MAX_NAME bytes each.
LITERALS, BROADCAST, MAX_NAME = 2_000, 500_000, 64
SALTS = 32


def keep_symbols(ticks: DataFrame, symbols, col: str = "symbol", literals: int = LITERALS, broadcast: int = BROADCAST) -> DataFrame:
    """Rows of ``ticks`` whose ``col`` is in ``symbols`` (a name, a list, a DataFrame's first
    column, or None for all).

    The distinct names are counted first. Few become a literal list, which reaches the
    scan and its partitions; more are broadcast, a size the count bounds; beyond that both
    sides meet on (symbol, salt), so that a hot symbol is spread over ``SALTS`` tasks.
    """
    if symbols is None:
        return ticks
    if isinstance(symbols, (str, list, tuple, set, frozenset)):
        names = sorted({symbols} if isinstance(symbols, str) else set(symbols))
        if len(names) <= literals:
            return ticks.where(F.col(col).isin(names))
        symbols = ticks.sparkSession.createDataFrame([(n,) for n in names], "symbol string")
    asked = symbols.select(F.col(symbols.columns[0]).cast("string").alias("_name")).where("_name is not null").distinct()
    found = [r[0] for r in asked.limit(literals + 1).collect()]
    if len(found) <= literals:
        return ticks.where(F.col(col).isin(sorted(found)))
    n, longest = asked.agg(F.count(F.lit(1)), F.max(F.octet_length("_name"))).first()
    if n <= broadcast and longest <= MAX_NAME:
        return ticks.join(F.broadcast(asked), F.col(col) == F.col("_name"), "left_semi")
    salted = asked.select("_name", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"))
    salt = F.pmod(F.xxhash64(*ticks.columns), F.lit(SALTS)).cast("int")
    return ticks.join(salted, (F.col(col) == F.col("_name")) & (salt == F.col("_salt")), "left_semi")


def symbol_ranges(symbols: Sequence[str], tasks: int) -> list[str]:
    """Bounds that cut the sorted names into at most ``tasks`` runs of equal length."""
    names = sorted(set(symbols))
    step = max(1, -(-len(names) // max(1, tasks)))
    return names[step::step]
