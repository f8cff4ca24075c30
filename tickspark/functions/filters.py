"""Predicates (F1–F13). Each returns a boolean ``Column`` for ``where``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickspark.functions.columns import (SESSION_CLOSE_US, SESSION_OPEN_US, col,
                                         micros_of_day)


def regular_trade(corr="tr_corr") -> Column:
    """correction code '00'."""
    return col(corr) == F.lit("00")


def in_session(ts_local: str = "ts_event", open_us: int = SESSION_OPEN_US,
               close_us: int = SESSION_CLOSE_US) -> Column:
    """open ≤ local time of day ≤ close (both ends inclusive)."""
    return micros_of_day(ts_local).between(F.lit(open_us), F.lit(close_us))


def in_session_half_open(ts_local: str = "ts_event", open_us: int = SESSION_OPEN_US,
                         close_us: int = SESSION_CLOSE_US) -> Column:
    """[open, close) local."""
    m = micros_of_day(ts_local)
    return (m >= F.lit(open_us)) & (m < F.lit(close_us))


def valid_quote(bid="bid", ask="ask") -> Column:
    """strict — bid>0, ask>0, bid<ask."""
    return (col(bid) > 0) & (col(ask) > 0) & (col(bid) < col(ask))


def valid_nbbo(bid="best_bid", ask="best_ask") -> Column:
    """locked allowed — best_bid>0, best_ask>0, best_ask≥best_bid."""
    return (col(bid) > 0) & (col(ask) > 0) & (col(ask) >= col(bid))


def nonneg_spread(bid="best_bid", ask="best_ask") -> Column:
    """ask − bid ≥ 0."""
    return (col(ask) - col(bid)) >= 0


def crossed(bid="best_bid", ask="best_ask") -> Column:
    """F7 building block: ask − bid < 0."""
    return (col(ask) - col(bid)) < 0


def time_range(ts: str, start, end) -> Column:
    """inclusive on both ends."""
    return col(ts).between(start, end)


def min_size(size: str = "size", n: int | None = 0) -> Column:
    """size ≥ n; 0 or None keeps everything."""
    if not n:
        return F.lit(True)
    return col(size) >= F.lit(n)


def symbol_in(symbols, c: str = "symbol") -> Column:
    """F8/F9 for a short literal list (long lists: use a left_semi join)."""
    if isinstance(symbols, str):
        symbols = [symbols]
    return col(c).isin(list(symbols))


def invalid_quote(bid="best_bid", ask="best_ask") -> Column:
    """ask<bid or a non-positive price (flag; raw data is never dropped)."""
    return (col(ask) < col(bid)) | (col(bid) <= 0) | (col(ask) <= 0)
