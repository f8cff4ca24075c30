"""Sources held against each other (J7, A32-A34). Inputs carry a ``source`` column where
several sources meet; every side is combined to one row per key before it is joined."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

KEYS = ("symbol", "trade_date")


def _totals(trades: DataFrame, keys: Sequence[str], trades_as: str, volume_as: str) -> DataFrame:
    return trades.groupBy(*keys).agg(F.count(F.lit(1)).alias(trades_as), F.sum("size").cast("long").alias(volume_as))


def source_compare(trades: DataFrame, left: str, right: str, keys: Sequence[str] = KEYS) -> DataFrame:
    """Trades and volume per key of two sources, side by side, and their differences. Keys
    that only one of them has are kept, with a difference against zero."""
    sides = [_totals(trades.where(F.col("source") == s), keys, f"{s}_trades", f"{s}_volume") for s in (left, right)]
    joined = sides[0].join(sides[1], list(keys), "full_outer")
    zero = F.lit(0).cast("long")
    return joined.withColumns({f"diff_{c}": F.coalesce(f"{left}_{c}", zero) - F.coalesce(f"{right}_{c}", zero) for c in ("trades", "volume")})


def summary_by_date_source(trades: DataFrame, nbbo: DataFrame) -> DataFrame:
    """Trades, volume and NBBO rows per date and source; NULL where a side has none."""
    keys = ["trade_date", "source"]
    return _totals(trades, keys, "n_trades", "volume").join(nbbo.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_nbbo")), keys, "full_outer")


def summary_by_symbol(symbols: DataFrame, trades: DataFrame, nbbo: DataFrame) -> DataFrame:
    """Every asked symbol with its trades, volume and NBBO rows, NULL where there are none."""
    quotes = nbbo.groupBy("symbol").agg(F.count(F.lit(1)).alias("n_nbbo"))
    return (symbols.select("symbol").distinct().join(_totals(trades, ["symbol"], "n_trades", "volume"), "symbol", "left")
            .join(quotes, "symbol", "left"))


def price_range(trades: DataFrame, nbbo: DataFrame, margin: float = 0.05) -> DataFrame:
    """Least and greatest of all prices, bids and asks, and the axis ``margin`` beyond them.
    A side without rows does not narrow the other's range."""
    t = trades.agg(F.min("price").alias("lo"), F.max("price").alias("hi"))
    q = nbbo.agg(F.least(F.min("best_bid"), F.min("best_ask")).alias("lo"), F.greatest(F.max("best_bid"), F.max("best_ask")).alias("hi"))
    lo, hi = F.least("lo", q.select("lo").scalar()), F.greatest("hi", q.select("hi").scalar())
    return t.select(lo.alias("min_price"), hi.alias("max_price")).withColumns(
        {"axis_lo": F.col("min_price") * (1 - margin), "axis_hi": F.col("max_price") * (1 + margin)})
