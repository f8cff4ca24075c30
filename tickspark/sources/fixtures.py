"""Tick-shaped views over the driver's test tables (see FIXTURES.md §2).

``fx_*`` spread the ``events`` rows over 30+ days; ``fxd_*`` re-time the same
ticks into dense 390-minute sessions. The DuckDB twins of these views live in
``tickspark.plans.oracle``; both must stay row-for-row identical.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Views are pure functions of (session, data dir): build each logical plan once per
# session, like registering a temp view, instead of re-analysing it for every query.
view = functools.lru_cache(maxsize=256)


@view
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _sym_no(c="user_id"):
    return F.pmod(F.col(c), F.lit(12))


def _symbol():
    n = _sym_no()
    return F.when(n == 5, F.lit("S5.A")).otherwise(F.concat(F.lit("S"), n.cast("string")))


@view
def fx_base(spark, sf_dir) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", "ts",
        (F.col("ts") - F.expr("INTERVAL 5 HOURS")).alias("ts_local"),
        "user_id", "event_type", "value",
        F.regexp_extract("props", "[0-9]+", 0).cast("int").alias("k"))


@view
def fxd_base(spark, sf_dir) -> DataFrame:
    b = fx_base(spark, sf_dir)
    start = F.lit("2024-01-02 09:30:00").cast("timestamp_ntz")
    # whole days and milliseconds as one microsecond offset (NTZ has no DST)
    days = F.floor(F.col("event_id") / 10000).cast("int").cast("long")
    ms = (F.pmod(F.col("event_id"), F.lit(10000)) * 2340 + F.pmod(F.col("user_id") * 37, F.lit(997))).cast("int")
    local = F.timestamp_add("MICROSECOND", days * 86_400_000_000 + ms.cast("long") * 1000, start)
    return b.select("event_id", (local + F.expr("INTERVAL 5 HOURS")).alias("ts"), local.alias("ts_local"),
                    "user_id", "event_type", "value", "k")


def _trades_from(base: DataFrame) -> DataFrame:
    n = _sym_no()
    return base.where(F.pmod("event_id", F.lit(3)) == 0).select(
        F.col("event_id").alias("tr_seqnum"),
        F.to_date("ts_local").alias("trade_date"),
        F.col("ts").alias("ts_event_utc"),
        F.col("ts_local").alias("ts_event"),
        F.concat(F.lit("S"), n.cast("string")).alias("sym_root"),
        F.when(n == 5, F.lit("A")).when(n == 7, F.lit(" ")).alias("sym_suffix"),
        _symbol().alias("symbol"),
        F.upper(F.substring("event_type", 1, 1)).alias("ex"),
        (F.lit(100) + F.col("value") / 500).alias("price"),
        ((F.col("k") + 1) * 10).alias("size"),
        F.when(F.pmod("event_id", F.lit(17)) == 0, F.lit("01")).otherwise(F.lit("00")).alias("tr_corr"),
        F.col("event_type").alias("tr_scond"))


def _nbbo_from(base: DataFrame) -> DataFrame:
    off = (F.col("k") - 2).cast("double") / 200
    return base.where(F.pmod("event_id", F.lit(3)) != 0).select(
        F.col("event_id").alias("qu_seqnum"),
        F.to_date("ts_local").alias("trade_date"),
        F.col("ts").alias("ts_event_utc"),
        F.col("ts_local").alias("ts_event"),
        _symbol().alias("symbol"),
        (F.lit(100) + F.col("value") / 500 - off).alias("best_bid"),
        (F.lit(100) + F.col("value") / 500 + off).alias("best_ask"),
        ((F.pmod("event_id", F.lit(50)) + 1) * 100).cast("int").alias("best_bidsizeshares"),
        ((F.pmod("event_id", F.lit(70)) + 1) * 100).cast("int").alias("best_asksizeshares"),
        F.col("event_type").alias("nbbo_qu_cond"),
        F.substring("event_type", 1, 1).alias("qu_cond"),
        F.when(F.pmod("event_id", F.lit(5)) == 0, F.lit("G")).otherwise(F.lit("A")).alias("natbbo_ind"),
        F.when(F.pmod("event_id", F.lit(2)) == 0, F.lit("C")).otherwise(F.lit("N")).alias("qu_source"))


@view
def fx_trades(spark, sf_dir) -> DataFrame:
    return _trades_from(fx_base(spark, sf_dir))


@view
def fx_nbbo(spark, sf_dir) -> DataFrame:
    return _nbbo_from(fx_base(spark, sf_dir))


@view
def fxd_trades(spark, sf_dir) -> DataFrame:
    return _trades_from(fxd_base(spark, sf_dir))


@view
def fxd_nbbo(spark, sf_dir) -> DataFrame:
    return _nbbo_from(fxd_base(spark, sf_dir))


@view
def fx_quotes(spark, sf_dir) -> DataFrame:
    q = fx_nbbo(spark, sf_dir)
    return (q.withColumnsRenamed({"best_bid": "bid", "best_ask": "ask",
                                  "best_bidsizeshares": "bidsiz", "best_asksizeshares": "asksiz"})
            .withColumn("qu_cancel", F.when(F.pmod("qu_seqnum", F.lit(29)) == 0, F.lit("C"))))


@view
def fx_catalog(spark, sf_dir) -> DataFrame:
    """Partition catalog ``(source, data_type, trade_date, symbol, n_rows)``."""
    t = fx_trades(spark, sf_dir)
    q = fx_nbbo(spark, sf_dir)

    def cat(df, source, dtype):
        return (df.groupBy("trade_date", "symbol").agg(F.count(F.lit(1)).alias("n_rows"))
                .select(F.lit(source).alias("source"), F.lit(dtype).alias("data_type"),
                        "trade_date", "symbol", "n_rows"))

    return (cat(t, "taq", "trades")
            .unionByName(cat(q, "taq", "nbbo"))
            .unionByName(cat(t.where((F.col("symbol") != "S3") & (F.pmod("tr_seqnum", F.lit(4)) != 0)),
                             "alpaca", "trades"))
            .unionByName(cat(q.where(F.col("trade_date") < F.lit("2024-01-11").cast("date")), "csv", "nbbo")))


@view
def fx_names(spark, sf_dir) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return (o.groupBy("o_custkey")
            .agg(F.min("o_orderdate").cast("date").alias("namedt"),
                 F.max("o_orderdate").cast("date").alias("nameendt"))
            .select(F.col("o_custkey").alias("permno"),
                    F.concat(F.lit("T"), F.pmod("o_custkey", F.lit(400)).cast("string")).alias("ticker"),
                    "namedt", "nameendt"))


@view
def fx_members(spark, sf_dir) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    return (c.where(F.pmod("c_custkey", F.lit(3)) == 0)
            .select(F.col("c_custkey").alias("permno"),
                    F.lit("1995-06-01").cast("date").alias("start"),
                    F.when(F.pmod("c_custkey", F.lit(4)) == 0, F.lit(None).cast("date"))
                    .otherwise(F.lit("1999-12-31").cast("date")).alias("ending")))
