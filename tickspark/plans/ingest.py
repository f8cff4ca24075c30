"""Ingest-side queries: canonical projections, warehouse extracts, REST pages, CSV drops
and lake scans. Landing files are written by Spark from the fixture ticks into the
shared scratch folder and read back through the source operators."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.functions.columns import (canonical_symbol, canonical_ts_ns, clean_symbol_key, epoch_micros,
                                         micros_of_day, ns_to_ts)
from tickspark.functions.filters import in_session_half_open, invalid_quote
from tickspark.operators.enrich import enrich
from tickspark.operators.symbols import keep_symbols
from tickspark.plans.registry import oracle, query
from tickspark.session import scratch_path
from tickspark.sources import csv as csvsrc
from tickspark.sources import lake, rest, warehouse
from tickspark.sources.fixtures import fx_nbbo, fx_quotes, fx_trades, table

RUN_ID = "run-fixture"
INGEST_TS = _dt.datetime(2024, 2, 1, 0, 0, 0)

NS_SQL = "epoch_us(ts_event_utc) * 1000 + tr_seqnum % 1000"
MOD_SQL = "(epoch_us(ts_event) - epoch_us(cast(trade_date as timestamp)))"
EXTRACT_SYMBOLS_SQL = "select distinct concat('S', cast(user_id % 9 as varchar)) from events"


def warehouse_trades(spark, d) -> DataFrame:
    """fx_trades in the warehouse layout: local date, micros of day, nano residue."""
    t = fx_trades(spark, d)
    return t.select("tr_seqnum", F.col("trade_date").alias("date"), micros_of_day("ts_event").alias("time_m_us"),
                    F.pmod("tr_seqnum", F.lit(1000)).cast("int").alias("time_m_nano"), "sym_root", "sym_suffix",
                    "ex", "price", "size", "tr_corr", "tr_scond")


def real_trades(spark, d) -> DataFrame:
    """``warehouse_trades`` with ``time_m`` as the daily tables and drops write it: text."""
    us = F.timestamp_add("MICROSECOND", F.col("time_m_us"), F.col("date").cast("timestamp_ntz"))
    return warehouse_trades(spark, d).withColumn("time_m", F.date_format(us, "HH:mm:ss.SSSSSS")).drop("time_m_us")


def extract_symbols(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select(F.concat(F.lit("S"), F.pmod("user_id", F.lit(9)).cast("string")).alias("symbol")).distinct()


# ----------------------------------------------------------------------------- projections

@query("canonical_symbol", oracle("""
select tr_seqnum, sym_root, sym_suffix,
       case when sym_suffix is null or trim(sym_suffix) = '' then trim(sym_root)
            else concat(trim(sym_root), '.', trim(sym_suffix)) end as canonical
from fx_trades"""), ids="P1")
def q_canonical_symbol(spark, d):
    return fx_trades(spark, d).select("tr_seqnum", "sym_root", "sym_suffix", canonical_symbol().alias("canonical"))


@query("canonical_ts", oracle(f"""
select tr_seqnum, {NS_SQL} as ts_event_ns, {NS_SQL} as ts_event_ns_rest, ts_event_utc as ts_event from fx_trades"""),
       ids="P2")
def q_canonical_ts(spark, d):
    w = warehouse_trades(spark, d)
    ns = canonical_ts_ns("date", "time_m_us", "time_m_nano")
    # the REST encoding: whole seconds in time, all sub-second digits in nano
    rest_time = F.col("time_m_us") - F.pmod("time_m_us", F.lit(1_000_000))
    rest_nano = (F.pmod("time_m_us", F.lit(1_000_000)) * 1000 + F.col("time_m_nano")).cast("int")
    r = w.withColumns({"_rt": rest_time, "_rn": rest_nano})
    return r.select("tr_seqnum", ns.alias("ts_event_ns"),
                    canonical_ts_ns("date", "_rt", "_rn").alias("ts_event_ns_rest"),
                    ns_to_ts(ns).alias("ts_event"))


@query("enrich_trades", oracle(f"""
select tr_seqnum, trade_date, symbol, ts_event_utc as ts_event, {NS_SQL} as ts_event_ns,
       '{RUN_ID}' as extract_run_id, timestamp '{INGEST_TS}' as ingest_ts from fx_trades"""), ids="P3, P4")
def q_enrich_trades(spark, d):
    e = warehouse_trades(spark, d).transform(lambda df: enrich(df, RUN_ID, INGEST_TS))
    return e.select("tr_seqnum", "trade_date", "symbol", "ts_event", "ts_event_ns", "extract_run_id", "ingest_ts")


@query("normalize_trade_date", oracle("select tr_seqnum, trade_date, ts_event, price from fx_trades", ["price"]),
       ids="S4, P21")
def q_normalize_trade_date(spark, d):
    t = fx_trades(spark, d)
    # older files carry text dates and times; newer ones are typed
    old = t.where(F.pmod("tr_seqnum", F.lit(2)) == 0).select(
        "tr_seqnum", F.date_format("trade_date", "yyyy-MM-dd").alias("trade_date"),
        F.date_format("ts_event", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts_event"), "price")
    new = t.where(F.pmod("tr_seqnum", F.lit(2)) != 0).select("tr_seqnum", "trade_date", "ts_event", "price")
    old = lake.normalize_trade_date(old).withColumn(
        "ts_event", F.try_to_timestamp("ts_event", F.lit("yyyy-MM-dd HH:mm:ss.SSSSSS")).cast("timestamp_ntz"))
    return old.unionByName(new)


@query("clean_symbol_key", oracle("""
select tr_seqnum, raw_key, regexp_replace(raw_key, '^\\([''"](.*)[''"],\\)$', '\\1') as symbol
from (select tr_seqnum, case tr_seqnum % 3 when 0 then concat('(''', symbol, ''',)')
                                           when 1 then concat('("', symbol, '",)') else symbol end as raw_key
      from fx_trades) r"""), ids="K8")
def q_clean_symbol_key(spark, d):
    t = fx_trades(spark, d)
    m = F.pmod("tr_seqnum", F.lit(3))
    raw = (F.when(m == 0, F.concat(F.lit("('"), "symbol", F.lit("',)")))
           .when(m == 1, F.concat(F.lit('("'), "symbol", F.lit('",)'))).otherwise(F.col("symbol")))
    return t.select("tr_seqnum", raw.alias("raw_key")).withColumn("symbol", clean_symbol_key("raw_key"))


@query("session_half_open", oracle(f"""
select tr_seqnum, symbol, ts_event from fx_trades where {MOD_SQL} >= 34200000000 and {MOD_SQL} < 57600000000"""),
       ids="F3")
def q_session_half_open(spark, d):
    return fx_trades(spark, d).where(in_session_half_open("ts_event")).select("tr_seqnum", "symbol", "ts_event")


@query("flag_invalid_quotes", oracle("""
select qu_seqnum, symbol, qu_cancel is not null as is_cancelled, (ask < bid or bid <= 0 or ask <= 0) as is_invalid
from fx_quotes"""), ids="F13")
def q_flag_invalid_quotes(spark, d):
    q = fx_quotes(spark, d)
    return q.select("qu_seqnum", "symbol", F.col("qu_cancel").isNotNull().alias("is_cancelled"),
                    invalid_quote("bid", "ask").alias("is_invalid"))


# ----------------------------------------------------------------------------- warehouse extracts

@query("taq_trades_extract", oracle(f"""
select tr_seqnum, symbol, trade_date, ts_event_utc as ts_event, {NS_SQL} as ts_event_ns, price, size from fx_trades
where tr_corr = '00' and {MOD_SQL} between 34200000000 and 57600000000
  and sym_root in ({EXTRACT_SYMBOLS_SQL})""", ["price"]), ids="S9, F1, F2, F8")
def q_taq_trades_extract(spark, d):
    x = warehouse.extract_trades(real_trades(spark, d), extract_symbols(spark, d))
    e = enrich(x, RUN_ID, INGEST_TS)
    return e.select("tr_seqnum", "symbol", "trade_date", "ts_event", "ts_event_ns", "price", "size")


@query("taq_quotes_extract", oracle(f"""
select qu_seqnum, symbol, trade_date, ts_event, bid, ask, bidsiz, asksiz from fx_quotes
where bid > 0 and ask > 0 and bid < ask and {MOD_SQL} between 34200000000 and 57600000000
  and symbol in ({EXTRACT_SYMBOLS_SQL})""", ["bid", "ask"]), ids="S10, F4")
def q_taq_quotes_extract(spark, d):
    # a TIME column as a JDBC driver hands it over: a timestamp on the epoch's day
    q = fx_quotes(spark, d).withColumn("time_m", F.timestamp_add("MICROSECOND", micros_of_day("ts_event"),
                                                                 F.lit("1970-01-01").cast("timestamp_ntz")))
    x = warehouse.extract_quotes(q, extract_symbols(spark, d), sym_col="symbol")
    return x.select("qu_seqnum", "symbol", "trade_date", "ts_event", "bid", "ask", "bidsiz", "asksiz")


@query("taq_nbbo_extract", oracle(f"""
select qu_seqnum, symbol, trade_date, ts_event, best_bid, best_ask from fx_nbbo
where best_bid > 0 and best_ask > 0 and best_ask >= best_bid and {MOD_SQL} between 34200000000 and 57600000000
  and symbol in ({EXTRACT_SYMBOLS_SQL})""", ["best_bid", "best_ask"]), ids="S11, F5")
def q_taq_nbbo_extract(spark, d):
    q = fx_nbbo(spark, d).withColumn("time_m", F.date_format("ts_event", "H:mm:ss.SSSSSS"))
    x = warehouse.extract_nbbo(q, extract_symbols(spark, d), sym_col="symbol")
    return x.select("qu_seqnum", "symbol", "trade_date", "ts_event", "best_bid", "best_ask")


# ----------------------------------------------------------------------------- REST pages

def _rfc3339(ts_utc: str, extra_ns):
    frac = F.lpad(F.pmod(epoch_micros(ts_utc), F.lit(1_000_000)).cast("string"), 6, "0")
    return F.concat(F.date_format(ts_utc, "yyyy-MM-dd'T'HH:mm:ss"), F.lit("."), frac,
                    F.lpad(extra_ns.cast("string"), 3, "0"), F.lit("Z"))


def _land_pages(df: DataFrame, seq: str, rec, key: str, path: str) -> None:
    """Land ticks as REST-style JSON pages; a page spans 3,000 sequence ids, so its size is bounded."""
    page = F.floor(F.col(seq) / 3000)
    (df.groupBy("symbol", page.alias("_page"))
     .agg(F.sort_array(F.collect_list(F.struct(F.col(seq).alias("_o"), rec))).alias("_recs"))
     .select("symbol", F.transform("_recs", lambda r: r["r"]).alias(key),
             F.concat(F.col("symbol"), F.lit("-"), F.col("_page").cast("string")).alias("next_page_token"))
     .write.mode("overwrite").json(path))


REST_TRADES_SQL = f"""
select symbol as sym_root, trade_date as date, ({MOD_SQL} // 1000000) * 1000000 as time_m_us,
       cast((epoch_us(ts_event_utc) % 1000000) * 1000 + tr_seqnum % 1000 as int) as time_m_nano,
       ex, price, size::bigint as size, 'ALPACA' as tr_source, {NS_SQL} as ts_event_ns, {NS_SQL} as ts_event_ns_from_parts
from fx_trades"""


@query("rest_trades_normalize", oracle(REST_TRADES_SQL, ["price"]), ids="S13, P14, P15, S15")
def q_rest_trades_normalize(spark, d):
    t = fx_trades(spark, d)
    path = scratch_path(spark, "rest-trades")
    rec = F.struct(_rfc3339("ts_event_utc", F.pmod("tr_seqnum", F.lit(1000))).alias("t"), F.col("ex").alias("x"),
                   F.col("price").alias("p"), F.col("size").alias("s")).alias("r")
    _land_pages(t, "tr_seqnum", rec, "trades", path)
    r = rest.read_rest_trades(spark, path)
    return r.select("sym_root", "date", "time_m_us", "time_m_nano", "ex", "price", "size", "tr_source", "ts_event_ns",
                    canonical_ts_ns("date", "time_m_us", "time_m_nano").alias("ts_event_ns_from_parts"))


@query("rest_quotes_normalize", oracle(f"""
select symbol as sym_root, trade_date as date, ({MOD_SQL} // 1000000) * 1000000 as time_m_us,
       cast((epoch_us(ts_event_utc) % 1000000) * 1000 + qu_seqnum % 1000 as int) as time_m_nano,
       best_bid, best_bidsizeshares::bigint as best_bidsiz, best_ask, best_asksizeshares::bigint as best_asksiz,
       upper(qu_cond) as best_bidex, qu_source as best_askex, best_bidsizeshares::bigint as best_bidsizeshares,
       best_asksizeshares::bigint as best_asksizeshares,
       'ALPACA' as qu_source_tag, epoch_us(ts_event_utc) * 1000 + qu_seqnum % 1000 as ts_event_ns
from fx_nbbo""", ["best_bid", "best_ask"]), ids="S14")
def q_rest_quotes_normalize(spark, d):
    q = fx_nbbo(spark, d)
    path = scratch_path(spark, "rest-quotes")
    rec = F.struct(_rfc3339("ts_event_utc", F.pmod("qu_seqnum", F.lit(1000))).alias("t"),
                   F.col("best_bid").alias("bp"), F.col("best_bidsizeshares").alias("bs"),
                   F.col("best_ask").alias("ap"), F.col("best_asksizeshares").alias("as"),
                   F.upper("qu_cond").alias("bx"), F.col("qu_source").alias("ax")).alias("r")
    _land_pages(q, "qu_seqnum", rec, "quotes", path)
    r = rest.read_rest_quotes(spark, path)
    return r.select("sym_root", "date", "time_m_us", "time_m_nano", "best_bid", "best_bidsiz", "best_ask",
                    "best_asksiz", "best_bidex", "best_askex", "best_bidsizeshares", "best_asksizeshares",
                    F.col("qu_source").alias("qu_source_tag"), "ts_event_ns")


# ----------------------------------------------------------------------------- CSV drops and lake scans

def _land_csv(spark, d) -> str:
    """Land warehouse-layout trades as text CSV drops, one per date; some sizes are junk."""
    w = warehouse_trades(spark, d)
    bad = F.when(F.pmod("tr_seqnum", F.lit(101)) == 0, F.lit("n/a")).otherwise(F.col("size").cast("string"))
    txt = w.select(*[F.col(c).cast("string").alias(c) for c in w.columns if c != "size"], bad.alias("size"),
                   F.col("date").alias("_d"))
    root = scratch_path(spark, "csv-drops")
    csvsrc.write_csv_drops(txt, root, "trades", "_d")
    return root


CSV_COLS = ["tr_seqnum", "date", "time_m_us", "time_m_nano", "sym_root", "sym_suffix", "ex", "price", "tr_corr",
            "tr_scond", "size"]
CSV_TYPES = {"tr_seqnum": "long", "date": "date", "time_m_us": "long", "time_m_nano": "int", "price": "double",
             "size": "int"}


def _csv_schema():
    from pyspark.sql import types as T
    return T.StructType([T.StructField(c, T.StringType()) for c in CSV_COLS])


@query("csv_dates", oracle("select trade_date as file_date, count(*) as n_rows from fx_trades group by trade_date"),
       ids="S7")
def q_csv_dates(spark, d):
    root = _land_csv(spark, d)
    df = csvsrc.read_csv_drops(spark, root, _csv_schema())
    return df.groupBy("file_date").agg(F.count(F.lit(1)).alias("n_rows"))


@query("csv_ingest_trades", oracle(f"""
select tr_seqnum, trade_date, symbol, ts_event_utc as ts_event, {NS_SQL} as ts_event_ns, price,
       case when tr_seqnum % 101 = 0 then null else size end as size
from fx_trades where symbol in ({EXTRACT_SYMBOLS_SQL})""", ["price"]), ids="S6, S8")
def q_csv_ingest_trades(spark, d):
    root = _land_csv(spark, d)
    raw = csvsrc.typed(csvsrc.read_csv_drops(spark, root, _csv_schema()), CSV_TYPES)
    e = keep_symbols(raw.transform(lambda df: enrich(df, RUN_ID, INGEST_TS)), extract_symbols(spark, d))  # F8 on the canonical symbol
    out = scratch_path(spark, "lake-csv")
    lake.write_partitioned(e.select("tr_seqnum", "trade_date", "symbol", "ts_event", "ts_event_ns", "price", "size"),
                           out, "trades")
    return lake.read_lake(spark, out, "trades").select("tr_seqnum", "trade_date", "symbol", "ts_event",
                                                       "ts_event_ns", "price", "size")


def _land_mixed_drops(spark, d) -> str:
    """Drops of two types in one folder. Trades of odd days have text times, other columns and
    another order than those of even days; one more prefix must not be read."""
    root = scratch_path(spark, "csv-mixed")
    text = lambda df: df.select(*(F.col(c).cast("string").alias(c) for c in df.columns if c != "_d"), "_d")
    t = warehouse_trades(spark, d).withColumn("_d", F.col("date"))
    odd = F.dayofmonth("date") % 2 == 1
    csvsrc.write_csv_drops(text(t.where(~odd)), root, "taq_trade", "_d")
    late = real_trades(spark, d).where(odd).withColumn("_d", F.col("date"))
    late = late.select("price", "time_m", "time_m_nano", F.date_format("date", "yyyyMMdd").alias("date"), "sym_suffix", "sym_root", "tr_seqnum",
                       "size", F.lit("x").alias("unknown"), "_d")
    csvsrc.write_csv_drops(text(late), root, "taq_trade", "_d", mode="append")
    csvsrc.write_csv_drops(text(late), root, "other_trade", "_d", mode="append")
    q = fx_nbbo(spark, d).select("qu_seqnum", F.col("trade_date").alias("date"), F.date_format("ts_event", "HH:mm:ss.SSSSSS").alias("time_m"),
                                 F.col("symbol").alias("sym_root"), "best_bid", "best_ask", F.col("trade_date").alias("_d"))
    csvsrc.write_csv_drops(text(q), root, "taq_nbbo", "_d", mode="append")
    return root


_MIXED_DATES = ("2024-01-03", "2024-01-20")


@query("csv_mixed_drops", oracle(f"""
select 'trades' as data_type, tr_seqnum as seqnum, trade_date, symbol, ts_event_utc as ts_event, {NS_SQL} as ts_event_ns,
       case when day(trade_date) % 2 = 0 then tr_scond end as cond
from fx_trades where trade_date between date '{_MIXED_DATES[0]}' and date '{_MIXED_DATES[1]}'
union all
select 'nbbo', qu_seqnum, trade_date, symbol, ts_event_utc, epoch_us(ts_event_utc) * 1000, null
from fx_nbbo where trade_date in (date '{_MIXED_DATES[0]}', date '{_MIXED_DATES[1]}')"""), ids="S6, S7, S8, P2, P15")
def q_csv_mixed_drops(spark, d):
    """Drops picked by type, prefix and date, with several headers and times, in the canonical schema."""
    root = _land_mixed_drops(spark, d)
    t = enrich(csvsrc.read_drops(spark, root, "trades", _MIXED_DATES), RUN_ID, INGEST_TS)
    q = enrich(csvsrc.read_drops(spark, root, "nbbo", list(_MIXED_DATES)), RUN_ID, INGEST_TS)

    def part(df, kind, seq, cond):
        return df.select(F.lit(kind).alias("data_type"), F.col(seq).alias("seqnum"), "trade_date", "symbol", "ts_event", "ts_event_ns",
                         cond.alias("cond"))

    return part(t, "trades", "tr_seqnum", F.col("tr_scond")).unionByName(part(q, "nbbo", "qu_seqnum", F.lit(None).cast("string")))


@query("csv_drop_list", oracle("""
select prefix, file_date, cast(min(k) as int) as n_columns from (
  select distinct 'taq_trade' as prefix, trade_date as file_date, case when day(trade_date) % 2 = 0 then 12 else 10 end as k from fx_trades
  union all select distinct 'other_trade', trade_date, 10 from fx_trades where day(trade_date) % 2 = 1
  union all select distinct 'taq_nbbo', trade_date, 7 from fx_nbbo) x group by prefix, file_date"""), ids="S7")
def q_csv_drop_list(spark, d):
    """What is in a drop folder: prefix, date and columns of every file."""
    drops = csvsrc.find_drops(spark, _land_mixed_drops(spark, d))
    return drops.groupBy("prefix", "file_date").agg(F.min(F.size(F.split("header", ","))).alias("n_columns"))


# A table list as an information schema gives it: early days in the year's schema, days divisible
# by three in the other one as well or only, quotes missing every fourth day.
_TABLES_SQL = """
select distinct case when day(trade_date) % 3 = 0 then 'taqmsec' else 'taqm_' || year(trade_date) end as schema,
       case t.data_type when 'trades' then 'ctm_' when 'quotes' then 'cqm_' else 'complete_nbbo_' end || strftime(trade_date, '%Y%m%d') as "table",
       trade_date, t.data_type
from fx_trades, (values ('trades'), ('quotes'), ('nbbo')) t(data_type) where t.data_type <> 'quotes' or day(trade_date) % 4 <> 0"""


def _table_list(spark, d) -> DataFrame:
    days = fx_trades(spark, d).select("trade_date").distinct()
    kinds = F.explode(F.array(*map(F.lit, ("trades", "quotes", "nbbo")))).alias("data_type")
    day = F.dayofmonth("trade_date")
    rows = days.select("trade_date", kinds).where((F.col("data_type") != "quotes") | (day % 4 != 0))
    schema = F.when(day % 3 == 0, F.lit("TAQMSEC")).otherwise(F.concat(F.lit("taqm_"), F.year("trade_date").cast("string")))
    stem = F.when(F.col("data_type") == "trades", "ctm_").when(F.col("data_type") == "quotes", "cqm_").otherwise("complete_nbbo_")
    return rows.select(schema.alias("schema"), F.concat(stem, F.date_format("trade_date", "yyyyMMdd")).alias("table"))


def _table_requests(spark, d) -> DataFrame:
    kinds = F.explode(F.array(*map(F.lit, ("trades", "quotes", "nbbo")))).alias("data_type")
    return fx_trades(spark, d).select("trade_date").distinct().select("trade_date", kinds)


@query("table_catalog", oracle(f"""
select r.trade_date, r.data_type, l.schema, l."table" from (
  select distinct trade_date, t.data_type from fx_trades, (values ('trades'), ('quotes'), ('nbbo')) t(data_type)) r
left join ({_TABLES_SQL}) l on r.trade_date = l.trade_date and r.data_type = l.data_type"""), ids="S12")
def q_table_catalog(spark, d):
    """The schema that holds each day's table, by the order of schemas to try."""
    return warehouse.resolve_tables(_table_requests(spark, d), _table_list(spark, d))


@query("table_dates", oracle("select distinct trade_date from fx_trades where day(trade_date) % 4 <> 0"), ids="S12")
def q_table_dates(spark, d):
    """Dates whose three tables are all there."""
    found = warehouse.resolve_tables(_table_requests(spark, d), _table_list(spark, d))
    return warehouse.dates_with_all_types(found.where(F.col("schema").isNotNull()))


@query("rest_canonical", oracle(f"""
select f.source, t.tr_seqnum % 1000 as residue, t.trade_date, t.symbol, t.ts_event_utc as ts_event, {NS_SQL} as ts_event_ns, t.price,
       t.size::bigint as size, 'ALPACA' as tr_source, null::varchar as tr_scond, null::bigint as tr_seqnum
from fx_trades t join (values ('alpaca', 0), ('alpaca_iex', 1)) f(source, k) on t.tr_seqnum % 2 = f.k""", ["price"]), ids="S13, S15, S18, P15, U1")
def q_rest_canonical(spark, d):
    """Two feeds' pages as one canonical table, null-filled."""
    t = fx_trades(spark, d)
    rec = F.struct(_rfc3339("ts_event_utc", F.pmod("tr_seqnum", F.lit(1000))).alias("t"), F.col("ex").alias("x"),
                   F.col("price").alias("p"), F.col("size").alias("s")).alias("r")
    paths = {}
    for k, feed in enumerate(rest.FEEDS):
        paths[feed] = scratch_path(spark, f"rest-{feed}")
        _land_pages(t.where(F.pmod("tr_seqnum", F.lit(2)) == k), "tr_seqnum", rec, "trades", paths[feed])
    r = rest.read_feeds(spark, paths, "trades", run_id=RUN_ID, ingest_ts=INGEST_TS)
    return r.select("source", F.pmod("ts_event_ns", F.lit(1000)).alias("residue"), "trade_date", "symbol", "ts_event", "ts_event_ns", "price",
                    "size", "tr_source", "tr_scond", "tr_seqnum")


@query("scan_trades", oracle("""
select tr_seqnum, trade_date, symbol, ts_event_utc, ts_event_utc - interval 5 hours as ts_event, price, size
from fx_trades""", ["price"]), ids="S1, S3, S5")
def q_scan_trades(spark, d):
    root = scratch_path(spark, "lake-scan")
    t = fx_trades(spark, d).select("tr_seqnum", "trade_date", "symbol", F.col("ts_event_utc").alias("ts_event"),
                                   "price", "size")
    lake.write_partitioned(t, root, "trades")
    return lake.load_trades(spark, root).select("tr_seqnum", "trade_date", "symbol", "ts_event_utc", "ts_event",
                                                "price", "size")


@query("scan_nbbo", oracle("""
select qu_seqnum, trade_date, symbol, ts_event_utc, ts_event_utc - interval 5 hours as ts_event, best_bid, best_ask,
       (best_bid + best_ask) / 2 as mid_price, best_ask - best_bid as spread from fx_nbbo""",
                           ["best_bid", "best_ask", "mid_price", "spread"]), ids="S2, P6")
def q_scan_nbbo(spark, d):
    root = scratch_path(spark, "lake-scan")
    q = fx_nbbo(spark, d).select("qu_seqnum", "trade_date", "symbol", F.col("ts_event_utc").alias("ts_event"),
                                 "best_bid", "best_ask")
    lake.write_partitioned(q, root, "nbbo")
    return lake.load_nbbo(spark, root).select("qu_seqnum", "trade_date", "symbol", "ts_event_utc", "ts_event",
                                              "best_bid", "best_ask", "mid_price", "spread")
