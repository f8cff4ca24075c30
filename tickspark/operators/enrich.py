"""Enrichment with the derived canonical columns.

``enrich`` is the DataFrame → DataFrame callback the ingest jobs apply with
``DataFrame.transform`` (the reference's per-chunk ``enrich_fn``).
"""

from __future__ import annotations

import datetime as _dt
import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.functions.columns import EXCHANGE_TZ, canonical_symbol, canonical_ts_ns, ns_to_ts
from tickspark.functions.times import with_time_micros


def new_run_id() -> str:
    return str(uuid.uuid4())


def utc_now_naive() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)


def enrich(df: DataFrame, run_id: str | None = None, ingest_ts: _dt.datetime | None = None,
           trade_date=None, tz: str = EXCHANGE_TZ) -> DataFrame:
    """Add trade_date, symbol, ts_event_ns, ts_event (UTC), extract_run_id, ingest_ts.

    ``trade_date``: a literal date for single-day extracts; default is the row's ``date``.
    ``time_m`` may be TIME, text or a timestamp; it becomes ``time_m_us`` and ``time_m_nano``.
    """
    df = with_time_micros(df)
    if "time_m_nano" not in df.columns:
        df = df.withColumn("time_m_nano", F.lit(0))
    if "sym_suffix" not in df.columns:
        df = df.withColumn("sym_suffix", F.lit(None).cast("string"))
    run_id = run_id or new_run_id()
    ingest_ts = ingest_ts or utc_now_naive()
    ns = canonical_ts_ns("date", "time_m_us", "time_m_nano", tz)
    td = F.lit(trade_date).cast("date") if trade_date is not None else F.col("date")
    return (df.withColumns({
        "trade_date": td,
        "symbol": canonical_symbol("sym_root", "sym_suffix"),
        "ts_event_ns": ns,
    }).withColumns({
        "ts_event": ns_to_ts("ts_event_ns"),
        "extract_run_id": F.lit(run_id),
        # a string literal parses to NTZ without consulting any time zone
        "ingest_ts": F.lit(ingest_ts.isoformat(sep=" ")).cast("timestamp_ntz"),
    }))


def decompose_utc(ts_utc_ns: str, tz: str = EXCHANGE_TZ):
    """UTC instant (ns) → (local date, whole-second micros of day, sub-second nanos)."""
    from tickspark.functions.columns import floor_div, from_epoch_micros, local_time, micros_of_day
    us = floor_div(ts_utc_ns, 1000)
    local = local_time(from_epoch_micros(us), tz)
    mod = micros_of_day(local)
    whole = mod - F.pmod(mod, F.lit(1_000_000))
    nano = F.pmod(F.col(ts_utc_ns), F.lit(1_000_000_000)).cast("int")
    return F.to_date(local), whole, nano
