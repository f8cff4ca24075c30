"""Canonical tick schemas (§1.3) and ``conform``.

Times of day are stored as micros of day (``*_us BIGINT``): Spark cannot write its
TIME type to Parquet. ``ts_event_ns`` carries the nanosecond instant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

PRICE = T.DecimalType(10, 4)

DERIVED = [
    T.StructField("trade_date", T.DateType()),
    T.StructField("symbol", T.StringType()),
    T.StructField("ts_event", T.TimestampNTZType()),      # UTC instant at micro precision
    T.StructField("ts_event_ns", T.LongType()),
    T.StructField("extract_run_id", T.StringType()),
    T.StructField("ingest_ts", T.TimestampNTZType()),     # UTC
]


def _s(*fields) -> T.StructType:
    return T.StructType([T.StructField(n, t) for n, t in fields] + DERIVED)


TRADES = _s(("date", T.DateType()), ("time_m_us", T.LongType()), ("time_m_nano", T.IntegerType()),
            ("part_time_us", T.LongType()), ("part_time_nano", T.IntegerType()),
            ("trf_time_us", T.LongType()), ("trf_time_nano", T.IntegerType()),
            ("sym_root", T.StringType()), ("sym_suffix", T.StringType()), ("ex", T.StringType()),
            ("price", PRICE), ("size", T.IntegerType()), ("tr_corr", T.StringType()), ("tr_id", T.LongType()),
            ("tr_rf", T.StringType()), ("tr_scond", T.StringType()), ("tr_seqnum", T.LongType()),
            ("tr_source", T.StringType()), ("tr_stop_ind", T.StringType()), ("tte_ind", T.StringType()))

QUOTES = _s(("date", T.DateType()), ("time_m_us", T.LongType()), ("time_m_nano", T.IntegerType()),
            ("sym_root", T.StringType()), ("sym_suffix", T.StringType()), ("ex", T.StringType()),
            ("bid", PRICE), ("bidsiz", T.IntegerType()), ("ask", PRICE), ("asksiz", T.IntegerType()),
            ("qu_seqnum", T.LongType()), ("qu_cancel", T.StringType()), ("qu_source", T.StringType()))

NBBO = _s(("date", T.DateType()), ("time_m_us", T.LongType()), ("time_m_nano", T.IntegerType()),
          ("sym_root", T.StringType()), ("sym_suffix", T.StringType()),
          ("best_bid", PRICE), ("best_bidsiz", T.IntegerType()), ("best_ask", PRICE), ("best_asksiz", T.IntegerType()),
          ("best_bidex", T.StringType()), ("best_askex", T.StringType()), ("nbbo_qu_cond", T.StringType()),
          ("secstat_ind", T.StringType()), ("luld_indicator", T.StringType()), ("luld_bbo_cqs", PRICE),
          ("luld_bbo_uts", PRICE), ("qu_cond", T.StringType()), ("natbbo_ind", T.StringType()),
          ("qu_source", T.StringType()), ("best_bidsizeshares", T.IntegerType()),
          ("best_asksizeshares", T.IntegerType()), ("qu_seqnum", T.LongType()))

SCHEMAS = {"trades": TRADES, "quotes": QUOTES, "nbbo": NBBO}


def conform(df: DataFrame, schema: T.StructType, keep_extra: bool = True, also: list | tuple = ()) -> DataFrame:
    """Project onto ``schema`` — missing columns become typed NULLs, present ones are
    ``try_cast`` (bad values → NULL), extra columns are kept after the canonical ones, and
    ``also`` are added as they are."""
    have = set(df.columns)
    cols = []
    for f in schema.fields:
        if f.name in have:
            c = F.col(f.name)
            if df.schema[f.name].dataType != f.dataType:
                c = c.try_cast(f.dataType)
            cols.append(c.alias(f.name))
        else:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
    extra = [F.col(c) for c in df.columns if c not in {f.name for f in schema.fields}] if keep_extra else []
    return df.select(*cols, *extra, *also)


def text_schema(schema: T.StructType, names: list[str] | None = None) -> T.StructType:
    """All-string version of the original (non-derived) columns: the CSV drop layout."""
    derived = {f.name for f in DERIVED}
    fields = [f for f in schema.fields if f.name not in derived and (names is None or f.name in names)]
    return T.StructType([T.StructField(f.name, T.StringType()) for f in fields])
