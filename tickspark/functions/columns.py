"""Column-level helpers (projections P1–P22). Each returns a ``Column``.

All time arithmetic is done on ``timestamp_ntz`` values with ``timestampdiff`` /
``timestampadd`` so results do not depend on the session time zone. Local wall
times are NTZ; UTC instants are carried as NTZ in UTC or as ``*_ns`` longs.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values that must equal the reference's behaviour.
EXCHANGE_TZ = "America/New_York"
SESSION_OPEN_US = (9 * 3600 + 30 * 60) * 1_000_000   # 09:30:00 local
SESSION_CLOSE_US = 16 * 3600 * 1_000_000             # 16:00:00 local
SESSION_MINUTES = 390


def _epoch() -> Column:
    return F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# ---------------------------------------------------------------- symbols

def canonical_symbol(root="sym_root", suffix="sym_suffix") -> Column:
    """Trimmed root; a null or blank suffix gives the root, else ``root.suffix``."""
    r, s = F.trim(col(root)), col(suffix)
    return (F.when(s.isNull() | (F.trim(s) == ""), r)
            .otherwise(F.concat(r, F.lit("."), F.trim(s))))


def clean_symbol_key(c="symbol") -> Column:
    """Legacy partition names such as ``('AAPL',)`` or ``("AAPL",)`` → ``AAPL``."""
    return F.regexp_replace(col(c), r"""^\(['"](.*)['"],\)$""", "$1")


# ---------------------------------------------------------------- time

def epoch_micros(ts) -> Column:
    """Micros since 1970-01-01 of an NTZ value (its wall clock, no zone)."""
    return F.timestamp_diff("MICROSECOND", _epoch(), col(ts))


def from_epoch_micros(us) -> Column:
    return F.timestamp_add("MICROSECOND", col(us), _epoch())


def day_start(ts) -> Column:
    """Local midnight (NTZ) of an NTZ value or a date."""
    return F.to_date(col(ts)).cast("timestamp_ntz")


def micros_of_day(ts) -> Column:
    """Micros since local midnight of an NTZ wall-clock value."""
    return F.timestamp_diff("MICROSECOND", day_start(ts), col(ts))


def local_time(ts_utc, tz: str = EXCHANGE_TZ) -> Column:
    """UTC instant (NTZ in UTC) → exchange wall clock (NTZ), DST aware."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), col(ts_utc))


def utc_time(ts_local, tz: str = EXCHANGE_TZ) -> Column:
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), col(ts_local))


def canonical_ts_ns(date="date", time_us="time_m_us", nano="time_m_nano", tz: str = EXCHANGE_TZ) -> Column:
    """Local date + micros of day (+ nano residue) → UTC epoch nanoseconds.

    One formula for both encodings: warehouse (micros in time, residue in nano)
    and REST (whole seconds in time, sub-second nanos in nano).
    """
    local = F.timestamp_add("MICROSECOND", col(time_us), day_start(date))
    return epoch_micros(utc_time(local, tz)) * F.lit(1000) + F.coalesce(col(nano).cast("long"), F.lit(0))


def floor_div(x, n: int) -> Column:
    """Exact integral floor division of a LONG (``/`` would go through a double and lose
    digits above 2^53, e.g. epoch nanoseconds)."""
    x = col(x)
    return ((x - F.pmod(x, F.lit(n))).cast("decimal(38,0)") / F.lit(n)).cast("long")


def ns_to_ts(ns) -> Column:
    """UTC epoch nanos → NTZ (UTC) at micro precision."""
    return from_epoch_micros(floor_div(ns, 1000))


_BUCKET_RE = re.compile(r"^\s*(\d+)\s*(ms|s|m|min|h|d)\s*$")
_UNIT_US = {"ms": 1_000, "s": 1_000_000, "m": 60_000_000, "min": 60_000_000,
            "h": 3_600_000_000, "d": 86_400_000_000}


def bucket_micros(width: str | int) -> int:
    """``'1m'``, ``'1min'``, ``'5m'``, ``'1h'``, ``'37s'``, ``'100ms'`` → micros."""
    if isinstance(width, int):
        return width
    m = _BUCKET_RE.match(width)
    if not m:
        raise ValueError(f"unsupported bucket width {width!r}")
    return int(m.group(1)) * _UNIT_US[m.group(2)]


def time_bucket(ts, width: str | int | Column) -> Column:
    """Floor a local NTZ time to a grid starting at the local epoch (§4.4 D8)."""
    w = F.lit(bucket_micros(width)) if not isinstance(width, Column) else width
    us = epoch_micros(ts)
    return from_epoch_micros(us - F.pmod(us, w))


def session_start(day_ts, open_us: int = SESSION_OPEN_US) -> Column:
    """Start of the session on the date of ``day_ts``."""
    return F.timestamp_add("MICROSECOND", F.lit(open_us), day_start(day_ts))


# ---------------------------------------------------------------- quotes

def mid(bid="best_bid", ask="best_ask") -> Column:
    return (col(bid) + col(ask)) / F.lit(2)


def spread(bid="best_bid", ask="best_ask") -> Column:
    return col(ask) - col(bid)


def spread_bps(bid="best_bid", ask="best_ask") -> Column:
    return F.try_divide(spread(bid, ask), mid(bid, ask)) * F.lit(10000)


def pct_dev(price, ref) -> Column:
    """(price − ref) / ref × 100; NULL when ref is 0 or NULL."""
    return F.try_divide(col(price) - col(ref), col(ref)) * F.lit(100)


def price_location(price="price", bid="best_bid", ask="best_ask") -> Column:
    """below_bid / above_ask / within_spread — a NULL quote falls to within_spread."""
    p = col(price)
    return (F.when(p < col(bid), F.lit("below_bid"))
            .when(p > col(ask), F.lit("above_ask"))
            .otherwise(F.lit("within_spread")))


def quality_tier(pct) -> Column:
    """>95 green, >90 orange, else red."""
    p = col(pct)
    return F.when(p > 95, F.lit("green")).when(p > 90, F.lit("orange")).otherwise(F.lit("red"))



def session_bounds(min_ts, max_ts, open_us: int = SESSION_OPEN_US, minutes: int = SESSION_MINUTES):
    """The default 09:30 + 390-minute window of the data's date, clipped to the data
    (``greatest(open, min)``, ``least(open + duration, max)``); returns (start, end)."""
    start = session_start(min_ts, open_us)
    end = F.timestamp_add("MINUTE", F.lit(minutes), start)
    return F.greatest(start, col(min_ts)), F.least(end, col(max_ts))
