"""Times of day as they come: TIME, text, timestamps or numbers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.columns import floor_div, micros_of_day

_TEXT = r"^\s*(\d{1,2}):(\d{2}):(\d{2})(?:\.(\d{1,9}))?\s*$"


def text_time_ns(text: Column) -> Column:
    """``9:30:00.123456789`` → nanoseconds of the day; NULL for other text and times past 23:59:59."""
    h, m, s, part = (F.regexp_extract(text, _TEXT, k) for k in (1, 2, 3, 4))
    h, m, s = (x.try_cast("long") for x in (h, m, s))
    ns = (h * 3600 + m * 60 + s) * 1_000_000_000 + F.rpad(part, 9, "0").try_cast("long")
    return F.when((h < 24) & (m < 60) & (s < 60), ns)


def time_of_day_ns(col: Column, kind: T.DataType) -> Column:
    """Nanoseconds of the day of a column of type ``kind``: timestamps by their wall clock,
    whole numbers as microseconds of the day, TIME and text by their digits."""
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return micros_of_day(col.cast("timestamp_ntz")) * 1000
    if isinstance(kind, T.IntegralType):
        return col.cast("long") * 1000
    return text_time_ns(col.cast("string"))


def with_time_micros(df: DataFrame, names=("time_m", "part_time", "trf_time")) -> DataFrame:
    """For each time ``name``: ``{name}_us`` (micros of the day) and ``{name}_nano`` (the given
    residue plus the digits beyond microseconds). Columns that have ``{name}_us`` stay."""
    for name in names:
        if name not in df.columns or f"{name}_us" in df.columns:
            continue
        ns = time_of_day_ns(F.col(name), df.schema[name].dataType)
        given = F.coalesce(F.col(f"{name}_nano").try_cast("int"), F.lit(0)) if f"{name}_nano" in df.columns else F.lit(0)
        df = df.withColumn("_ns", ns).withColumns({
            f"{name}_us": floor_div("_ns", 1000), f"{name}_nano": (F.pmod("_ns", F.lit(1000)) + given).cast("int")}).drop("_ns", name)
    return df


def any_date(col: Column, kind: T.DataType) -> Column:
    """A DATE from a date, a timestamp, ``2024-01-02`` or ``20240102``; other text is NULL."""
    if isinstance(kind, T.DateType):
        return col
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        return F.to_date(col)
    text = F.trim(col.cast("string"))
    return F.coalesce(F.try_to_date(F.substring(text, 1, 10), "yyyy-MM-dd"), F.when(F.length(text) == 8, F.try_to_date(text, "yyyyMMdd")))
