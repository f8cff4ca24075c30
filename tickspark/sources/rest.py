"""REST landing pages → canonical ticks.

Pages are landed as JSON (one page per line); a typed schema read + ``explode``
replaces the reference's per-record Python loop. Two feeds share the mapping and
differ only by the ``source`` tag (S15).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.columns import epoch_micros
from tickspark.operators.enrich import decompose_utc, enrich
from tickspark.schemas import SCHEMAS, conform

TRADE_REC = T.StructType([T.StructField("t", T.StringType()), T.StructField("x", T.StringType()),
                          T.StructField("p", T.DoubleType()), T.StructField("s", T.LongType())])
QUOTE_REC = T.StructType([T.StructField("t", T.StringType()), T.StructField("bp", T.DoubleType()),
                          T.StructField("bs", T.LongType()), T.StructField("ap", T.DoubleType()),
                          T.StructField("as", T.LongType()), T.StructField("bx", T.StringType()),
                          T.StructField("ax", T.StringType())])
TRADES_PAGE = T.StructType([T.StructField("symbol", T.StringType()),
                            T.StructField("trades", T.ArrayType(TRADE_REC)),
                            T.StructField("next_page_token", T.StringType())])
QUOTES_PAGE = T.StructType([T.StructField("symbol", T.StringType()),
                            T.StructField("quotes", T.ArrayType(QUOTE_REC)),
                            T.StructField("next_page_token", T.StringType())])

TAG = "ALPACA"


def rfc3339_to_ns(c: str = "t"):
    """``2024-01-02T14:30:00.123456789Z`` → UTC epoch nanoseconds (all 9 digits kept)."""
    base = F.to_timestamp_ntz(F.regexp_extract(F.col(c), r"^(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2})", 1),
                              F.lit("yyyy-MM-dd'T'HH:mm:ss"))
    frac = F.rpad(F.regexp_extract(F.col(c), r"\.(\d{1,9})", 1), 9, "0")
    return epoch_micros(base) * 1000 + frac.cast("long")


def _common(rec: DataFrame) -> DataFrame:
    ns = rfc3339_to_ns("r.t")
    rec = rec.withColumn("ts_event_ns", ns)
    d, whole, nano = decompose_utc("ts_event_ns")
    return rec.withColumns({"date": d, "time_m_us": whole, "time_m_nano": nano})


def read_rest_trades(spark: SparkSession, path: str, source: str = "alpaca") -> DataFrame:
    """Trade pages → canonical trade columns (defaults "", 0.0, 0; ``tr_source`` tag)."""
    pages = spark.read.schema(TRADES_PAGE).json(path)
    rec = _common(pages.select("symbol", F.explode("trades").alias("r")))
    return rec.select(
        "date", "time_m_us", "time_m_nano", F.col("symbol").alias("sym_root"),
        F.lit(None).cast("string").alias("sym_suffix"),
        F.coalesce(F.col("r.x"), F.lit("")).alias("ex"),
        F.coalesce(F.col("r.p"), F.lit(0.0)).alias("price"),
        F.coalesce(F.col("r.s"), F.lit(0).cast("long")).alias("size"),
        F.lit(TAG).alias("tr_source"), "ts_event_ns", F.lit(source).alias("source"))


#: Roots and feed tags differ; the mapping is one.
FEEDS = ("alpaca", "alpaca_iex")


def canonical_rest(spark: SparkSession, path: str, data_type: str, source: str = "alpaca", run_id: str | None = None,
                   ingest_ts=None) -> DataFrame:
    """Pages of a feed as the canonical columns of ``trades`` or ``nbbo``: what a
    feed does not send is a typed NULL, sizes stay 64 bit, and ``source`` names the feed."""
    raw = (read_rest_trades if data_type == "trades" else read_rest_quotes)(spark, path, source)
    rows = enrich(raw.drop("ts_event_ns"), run_id, ingest_ts)
    wide = [T.StructField(f.name, T.LongType() if f.name in raw.columns and raw.schema[f.name].dataType == T.LongType() else f.dataType)
            for f in SCHEMAS[data_type].fields]
    prices = {"price", "best_bid", "best_ask"}
    wide = [T.StructField(f.name, T.DoubleType()) if f.name in prices else f for f in wide]
    return conform(rows, T.StructType(wide), keep_extra=False, also=["source"])


def read_feeds(spark: SparkSession, paths: dict[str, str], data_type: str, **args) -> DataFrame:
    """Several feeds (name -> folder of pages) as one canonical table."""
    return reduce(DataFrame.unionByName, (canonical_rest(spark, path, data_type, feed, **args) for feed, path in paths.items()))


def read_rest_quotes(spark: SparkSession, path: str, source: str = "alpaca") -> DataFrame:
    """Quote pages → canonical NBBO columns; sizes are duplicated in ``*sizeshares``."""
    pages = spark.read.schema(QUOTES_PAGE).json(path)
    rec = _common(pages.select("symbol", F.explode("quotes").alias("r")))
    bs = F.coalesce(F.col("r.bs"), F.lit(0))
    as_ = F.coalesce(F.col("r.as"), F.lit(0))
    return rec.select(
        "date", "time_m_us", "time_m_nano", F.col("symbol").alias("sym_root"),
        F.lit(None).cast("string").alias("sym_suffix"),
        F.coalesce(F.col("r.bp"), F.lit(0.0)).alias("best_bid"), bs.alias("best_bidsiz"),
        F.coalesce(F.col("r.ap"), F.lit(0.0)).alias("best_ask"), as_.alias("best_asksiz"),
        F.coalesce(F.col("r.bx"), F.lit("")).alias("best_bidex"),
        F.coalesce(F.col("r.ax"), F.lit("")).alias("best_askex"),
        bs.alias("best_bidsizeshares"), as_.alias("best_asksizeshares"),
        F.lit(TAG).alias("qu_source"), "ts_event_ns", F.lit(source).alias("source"))
