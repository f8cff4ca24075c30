"""Catalog, availability, incremental planning and multi-source queries.

The catalog is ``fx_catalog`` (three sources with different coverage). The
requested universe is derived from the data too: symbols ``S0..S13`` from
``events`` (S5, S12, S13 never exist as written), trading days between the first
and last trade date.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.operators import catalog as cat
from tickspark.operators import compare
from tickspark.plans.registry import oracle, query
from tickspark.session import scratch_path, stored
from tickspark.sources import lake, warehouse
from tickspark.sources.fixtures import fx_catalog, fx_members, fx_names, fx_nbbo, fx_trades, fxd_nbbo, fxd_trades, table

SOURCES = ["taq", "alpaca", "csv"]


def requested_symbols(spark, d) -> DataFrame:
    ev = table(spark, d, "events")
    return ev.select(F.concat(F.lit("S"), F.pmod("user_id", F.lit(14)).cast("string")).alias("symbol")).distinct()


def _bounds(spark, d):
    t = fx_trades(spark, d)
    return t.agg(F.min("trade_date")).scalar(), t.agg(F.max("trade_date")).scalar()


def trading_days(spark, d) -> DataFrame:
    """Weekdays between the first and last trade date (one-row aggregate → sequence)."""
    b = fx_trades(spark, d).agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    return b.select(F.explode(F.sequence("lo", "hi")).alias("trade_date")).where(cat.is_weekday())


def grid(spark, d, types=cat.DATA_TYPES) -> DataFrame:
    lo, hi = _bounds(spark, d)
    return cat.requested_grid(requested_symbols(spark, d), lo, hi, types)


def source_trades(spark, d) -> DataFrame:
    t = fx_trades(spark, d)
    return (t.withColumn("source", F.lit("taq"))
            .unionByName(t.where((F.col("symbol") != "S3") & (F.pmod("tr_seqnum", F.lit(4)) != 0))
                         .withColumn("source", F.lit("alpaca"))))


def source_nbbo(spark, d) -> DataFrame:
    q = fx_nbbo(spark, d)
    return (q.withColumn("source", F.lit("taq"))
            .unionByName(q.where(F.col("trade_date") < F.lit("2024-01-11").cast("date"))
                         .withColumn("source", F.lit("csv"))))


# ----------------------------------------------------------------------------- oracle pieces

REQ = {
    "req": "select distinct concat('S', cast(user_id % 14 as varchar)) as symbol from events",
    "days": """select cast(d as date) as trade_date
               from (select unnest(generate_series(cast((select min(trade_date) from fx_trades) as timestamp),
                                                   cast((select max(trade_date) from fx_trades) as timestamp),
                                                   interval 1 day)) as d) g
               where isodow(d) <= 5""",
    "grid": """select r.symbol, days.trade_date, t.data_type
               from req r, days, (values ('trades'), ('quotes'), ('nbbo')) t(data_type)""",
    "taqp": """select distinct data_type, trade_date, symbol from fx_catalog where source = 'taq' and n_rows > 0""",
}

SRC = {
    "st": """select *, 'taq' as source from fx_trades
             union all select *, 'alpaca' from fx_trades where symbol <> 'S3' and tr_seqnum % 4 <> 0""",
    "sq": """select *, 'taq' as source from fx_nbbo
             union all select *, 'csv' from fx_nbbo where trade_date < date '2024-01-11'""",
}


# ----------------------------------------------------------------------------- dates

@query("trading_days", oracle("select trade_date from days", ctes=REQ), ids="C14, C15")
def q_trading_days(spark, d):
    return trading_days(spark, d)


@query("dates_with_data", oracle("""
select cast(d as date) as trade_date,
       case when cast(d as date) in (select trade_date from fx_catalog where data_type in ('trades', 'nbbo') and n_rows > 0)
            then 'kept' else 'removed' end as status
from (select unnest(generate_series(cast((select min(trade_date) from fx_trades) - 2 as timestamp),
                                    cast((select max(trade_date) from fx_trades) + 2 as timestamp), interval 1 day)) as d) g"""),
       ids="C16, U5, U6")
def q_dates_with_data(spark, d):
    b = fx_trades(spark, d).agg(F.min("trade_date").alias("lo"), F.max("trade_date").alias("hi"))
    req = b.select(F.explode(F.sequence(F.date_sub("lo", 2), F.date_add("hi", 2))).alias("trade_date"))
    return cat.dates_with_data(req, fx_catalog(spark, d))


@query("available_dates", oracle("""
select source, data_type, trade_date, rank, first_date, last_date from (
  select source, data_type, trade_date, row_number() over (partition by source, data_type order by trade_date desc) as rank,
         min(trade_date) over (partition by source, data_type) as first_date,
         max(trade_date) over (partition by source, data_type) as last_date
  from (select distinct source, data_type, trade_date from fx_catalog where n_rows > 0) a) r
where rank <= 10"""), ids="C7, O9, C18")
def q_available_dates(spark, d, max_days: int = 10):
    from tickspark.operators.topk import top_k_per_group
    a = cat.present(fx_catalog(spark, d)).select("source", "data_type", "trade_date").distinct()
    b = a.groupBy("source", "data_type").agg(F.min("trade_date").alias("first_date"),
                                             F.max("trade_date").alias("last_date"))
    return top_k_per_group(a, max_days, ["source", "data_type"], [F.desc("trade_date")]).join(b, ["source", "data_type"])


@query("closest_date", oracle("""
select source, data_type, symbol, target_date, avail_date as closest_date, distance from (
  select tg.*, av.avail_date, abs(av.avail_date - tg.target_date) as distance,
         row_number() over (partition by tg.source, tg.data_type, tg.symbol, tg.target_date
                            order by abs(av.avail_date - tg.target_date), av.avail_date desc) as rn
  from (select k.source, k.data_type, k.symbol, days.trade_date as target_date
        from (select distinct source, data_type, symbol from fx_catalog) k, days) tg
  join (select distinct source, data_type, symbol, trade_date as avail_date from fx_catalog where n_rows > 0) av
    on tg.source = av.source and tg.data_type = av.data_type and tg.symbol = av.symbol
   and abs(av.avail_date - tg.target_date) <= 30) x
where rn = 1""", ctes=REQ), ids="C8")
def q_closest_date(spark, d, max_days_away: int = 30):
    c = fx_catalog(spark, d)
    lo, hi = _bounds(spark, d)
    keys = ["source", "data_type", "symbol"]
    targets = (c.select(*keys).distinct()
               .select(*keys, F.explode(F.sequence(lo, hi)).alias("target_date"))
               .where(cat.is_weekday("target_date")))
    return cat.closest_dates(cat.present(c), targets, keys, max_days_away)


@query("suggest_alternatives", oracle("""
with tgt as (select max(trade_date) as d from fx_trades),
av as (select distinct source, trade_date from fx_catalog where data_type = 'nbbo' and n_rows > 0),
cl as (select source, trade_date, row_number() over (partition by source order by abs(trade_date - (select d from tgt)),
                                                      trade_date desc) as rn
       from av where abs(trade_date - (select d from tgt)) <= 30)
select 'closest_date' as kind, source, trade_date as suggested_date from cl where source = 'csv' and rn = 1
union all
select 'available_date', source, trade_date from (
  select *, row_number() over (order by trade_date desc) as rn from av where source = 'csv') r where rn <= 10
union all
select 'alternative_source', source, trade_date from cl where source <> 'csv' and rn = 1"""), ids="C10")
def q_suggest_alternatives(spark, d, target_source: str = "csv", data_type: str = "nbbo"):
    target = fx_trades(spark, d).agg(F.max("trade_date")).scalar()
    return cat.suggest_alternatives(fx_catalog(spark, d), target_source, data_type, target)


# ----------------------------------------------------------------------------- ingestion / planning

@query("ingestion_status", oracle("""
select g.trade_date, g.symbol, g.data_type, p.symbol is not null as ingested
from grid g left join taqp p on g.trade_date = p.trade_date and g.symbol = p.symbol and g.data_type = p.data_type""",
                                  ctes=REQ), ids="C2, C1")
def q_ingestion_status(spark, d):
    return cat.ingestion_status(grid(spark, d), fx_catalog(spark, d), "taq")


@query("missing_symbols", oracle("""
select trade_date, symbol, data_type from grid g
where not exists (select 1 from taqp p where g.trade_date = p.trade_date and g.symbol = p.symbol
                  and g.data_type = p.data_type)""", ctes=REQ), ids="C3, J5, U5")
def q_missing_symbols(spark, d):
    return cat.missing(grid(spark, d), fx_catalog(spark, d), "taq").select("trade_date", "symbol", "data_type")


@query("fully_ingested", oracle("""
select g.trade_date, bool_and(p.symbol is not null) as fully_ingested, count(*) filter (where p.symbol is null) as n_missing
from grid g left join taqp p on g.trade_date = p.trade_date and g.symbol = p.symbol and g.data_type = p.data_type
group by g.trade_date""", ctes=REQ), ids="C4")
def q_fully_ingested(spark, d):
    st = cat.ingestion_status(grid(spark, d), fx_catalog(spark, d), "taq")
    return st.groupBy("trade_date").agg(F.bool_and("ingested").alias("fully_ingested"),
                                        F.count_if(~F.col("ingested")).alias("n_missing"))


@query("work_plan", oracle("""
with miss as (select trade_date, symbol, data_type from grid g
              where not exists (select 1 from taqp p where g.trade_date = p.trade_date and g.symbol = p.symbol
                                and g.data_type = p.data_type))
select 'warehouse_normal' as mode, * from miss
union all select 'warehouse_resume', * from miss
union all select 'rest_resume', * from miss
union all select 'rest_normal', trade_date, symbol, data_type from grid
union all select 'overwrite', trade_date, symbol, data_type from grid""", ctes=REQ), ids="C5")
def q_work_plan(spark, d):
    return _plans(grid(spark, d), fx_catalog(spark, d))


def _plans(requested: DataFrame, catalog: DataFrame) -> DataFrame:
    """Every mode's plan of one request, told apart by ``mode``."""
    kinds = [("warehouse_normal", "normal", "warehouse"), ("warehouse_resume", "resume", "warehouse"), ("rest_resume", "resume", "rest"),
             ("rest_normal", "normal", "rest"), ("overwrite", "overwrite", "warehouse")]
    plans = [cat.plan_work(requested, catalog, "taq", mode, feed).select(F.lit(name).alias("mode"), "trade_date", "symbol", "data_type")
             for name, mode, feed in kinds]
    return reduce(DataFrame.unionByName, plans)


_LAKE = {
    "lc": """select 'taq' as source, 'trades' as data_type, trade_date, symbol, count(*) as n_rows from fxd_trades group by all
             union all select 'taq', 'nbbo', trade_date, symbol, count(*) from fxd_nbbo group by all""",
    "lreq": REQ["req"],
    "lgrid": """select r.symbol, d.trade_date, t.data_type from lreq r, (select distinct trade_date from fxd_trades) d,
                (values ('trades'), ('quotes'), ('nbbo')) t(data_type)""",
}


def _lake(spark, d) -> str:
    """The dense sessions as a lake: trades by (date, symbol), NBBO by date alone."""
    root = scratch_path(spark, "catalog-lake")
    lake.write_partitioned(fxd_trades(spark, d).select("tr_seqnum", "trade_date", "symbol", "ts_event", "price", "size"), root, "trades")
    lake.write_partitioned(fxd_nbbo(spark, d).select("qu_seqnum", "trade_date", "symbol", "ts_event", "best_bid", "best_ask"), root, "nbbo",
                           partition_by_symbol=False, sort_cols=("symbol", "ts_event"))
    return root


@query("lake_catalog", oracle("select * from lc", ctes=_LAKE), ids="C1, C2, S17")
def q_lake_catalog(spark, d):
    """The catalog of a written lake, from its folders and footers."""
    return cat.catalog_from_lake(spark, _lake(spark, d), "taq")


@query("lake_work_plan", oracle("""
with miss as (select trade_date, symbol, data_type from lgrid g
              where not exists (select 1 from lc where g.trade_date = lc.trade_date and g.symbol = lc.symbol
                                and g.data_type = lc.data_type))
select 'warehouse_normal' as mode, * from miss
union all select 'warehouse_resume', * from miss
union all select 'rest_resume', * from miss
union all select 'rest_normal', trade_date, symbol, data_type from lgrid
union all select 'overwrite', trade_date, symbol, data_type from lgrid""", ctes=_LAKE), ids="C5, C1")
def q_lake_work_plan(spark, d):
    """Work plans of a request against a written lake, all modes."""
    days = fxd_trades(spark, d).select("trade_date").distinct()
    types = F.explode(F.array(*map(F.lit, cat.DATA_TYPES))).alias("data_type")
    lo, hi = days.agg(F.min("trade_date")).scalar(), days.agg(F.max("trade_date")).scalar()
    asked = (requested_symbols(spark, d).select("symbol", F.explode(F.sequence(lo, hi)).alias("trade_date"))
             .join(days, "trade_date", "left_semi").select("symbol", "trade_date", types))
    return _plans(asked, stored(cat.catalog_from_lake(spark, _lake(spark, d), "taq"), "lake-catalog"))


@query("ingest_summary", oracle("""
select data_type, trade_date, count(*) as n_partitions, cast(sum(n_rows) as bigint) as total_rows,
       grouping(data_type, trade_date) as level
from fx_catalog where source = 'taq' group by rollup(data_type, trade_date)"""), ids="C17")
def q_ingest_summary(spark, d):
    c = fx_catalog(spark, d).where(F.col("source") == "taq")
    return c.rollup("data_type", "trade_date").agg(
        F.count(F.lit(1)).alias("n_partitions"), F.sum("n_rows").cast("long").alias("total_rows"),
        F.grouping_id("data_type", "trade_date").cast("long").alias("level"))


@query("dates_with_all_types", oracle("""
select source, trade_date from fx_catalog where n_rows > 0 and data_type in ('trades', 'nbbo')
group by source, trade_date having count(distinct data_type) = 2"""), ids="S12")
def q_dates_with_all_types(spark, d, types=("trades", "nbbo")):
    return warehouse.dates_with_all_types(cat.present(fx_catalog(spark, d)), types, ("source",))


# ----------------------------------------------------------------------------- availability across sources

@query("available_symbols", oracle("""
select distinct source, data_type, trade_date, symbol from fx_catalog where n_rows > 0"""), ids="S17, C9")
def q_available_symbols(spark, d):
    return cat.present(fx_catalog(spark, d)).distinct()


_AVAIL = dict(REQ, sg="""select r.symbol, days.trade_date, s.source, t.data_type
                         from req r, days, (values ('taq'), ('alpaca'), ('csv')) s(source), (values ('trades'), ('nbbo')) t(data_type)""",
              anyp="""select distinct source, data_type, trade_date, symbol from fx_catalog where n_rows > 0""")


def _availability(spark, d) -> DataFrame:
    lo, hi = _bounds(spark, d)
    return cat.availability(requested_symbols(spark, d), lo, hi, SOURCES, fx_catalog(spark, d))


@query("availability_matrix", oracle("""
select g.trade_date, g.symbol, g.source, g.data_type, p.symbol is not null as available
from sg g left join anyp p on g.source = p.source and g.trade_date = p.trade_date and g.symbol = p.symbol
                          and g.data_type = p.data_type""", ctes=_AVAIL), ids="C11, J6, C6")
def q_availability_matrix(spark, d):
    return _availability(spark, d).select("trade_date", "symbol", "source", "data_type", "available")


@query("data_available", oracle("""
select g.source, g.trade_date, null::varchar as symbol, g.data_type,
       exists (select 1 from anyp p where g.source = p.source and g.trade_date = p.trade_date and g.data_type = p.data_type) as available
from (select distinct source, trade_date, data_type from sg) g""", ctes=_AVAIL), ids="C6")
def q_data_available(spark, d):
    """Is there any symbol of a type on a date?, per source."""
    asked = (trading_days(spark, d).withColumn("source", F.explode(F.array(*map(F.lit, SOURCES))))
             .withColumn("data_type", F.explode(F.array(F.lit("trades"), F.lit("nbbo")))))
    return cat.data_available(asked.select("source", "trade_date", F.lit(None).cast("string").alias("symbol"), "data_type"), fx_catalog(spark, d))


@query("source_availability", oracle("""
select source, n_dates, n_dates > 0 as available,
       n_dates > 0 and row_number() over (order by n_dates = 0, source <> 'taq', source) = 1 as is_default
from (select s.source, count(distinct c.trade_date) as n_dates
      from (select distinct source from fx_catalog) s
      left join (select * from fx_catalog where n_rows > 0 and data_type in ('trades', 'nbbo')
                 and trade_date in (select trade_date from days)) c on s.source = c.source group by s.source) n""", ctes=REQ), ids="C20")
def q_source_availability(spark, d):
    return cat.source_availability(fx_catalog(spark, d), trading_days(spark, d))


@query("common_sources", oracle("""
select g.trade_date, g.source, g.data_type, count(*) filter (where p.symbol is not null) as n_present,
       case when count(*) filter (where p.symbol is null) = 0 then 'all'
            when count(*) filter (where p.symbol is not null) > 0 then 'some' else 'none' end as status,
       coalesce(list_sort(list(g.symbol) filter (where p.symbol is null)), []::varchar[]) as missing_symbols
from sg g left join (select * from anyp) p on g.source = p.source and g.trade_date = p.trade_date and g.symbol = p.symbol
                                          and g.data_type = p.data_type
group by g.trade_date, g.source, g.data_type""", ctes=_AVAIL), ids="C12")
def q_common_sources(spark, d):
    return cat.common_sources(_availability(spark, d))


@query("symbols_across_dates", oracle("""
with pick as (select source, trade_date,
                     case when count(*) filter (where data_type = 'trades') > 0 then 'trades' else 'nbbo' end as dt
              from fx_catalog where n_rows > 0 group by source, trade_date),
sym as (select distinct c.trade_date, c.symbol from fx_catalog c join pick p
          on c.source = p.source and c.trade_date = p.trade_date and c.data_type = p.dt
        where c.n_rows > 0 and c.trade_date in (select trade_date from days))
select symbol from sym group by symbol having count(distinct trade_date) = (select count(*) from days)""", ctes=REQ),
       ids="C13")
def q_symbols_across_dates(spark, d):
    return cat.symbols_on_all_dates(fx_catalog(spark, d), trading_days(spark, d))


@query("source_coverage_rank", oracle("""
with pick as (select source, trade_date,
                     case when count(*) filter (where data_type = 'trades') > 0 then 'trades' else 'nbbo' end as dt
              from fx_catalog where n_rows > 0 group by source, trade_date),
cov as (select c.source, count(distinct c.symbol) as n_symbols from fx_catalog c join pick p
          on c.source = p.source and c.trade_date = p.trade_date and c.data_type = p.dt
        where c.n_rows > 0 and c.symbol in (select symbol from req) group by c.source)
select source, n_symbols, n_symbols = (select count(*) from req where symbol in (select symbol from fx_catalog)) as has_all,
       row_number() over (order by n_symbols desc, source) as rank from cov""", ctes=REQ), ids="C19")
def q_source_coverage_rank(spark, d):
    return cat.coverage_rank(fx_catalog(spark, d), requested_symbols(spark, d))


# ----------------------------------------------------------------------------- multi-source comparisons

@query("source_compare", oracle("""
with a as (select symbol, trade_date, count(*) as n, cast(sum(size) as bigint) as v from st where source = 'taq' group by all),
b as (select symbol, trade_date, count(*) as n, cast(sum(size) as bigint) as v from st where source = 'alpaca' group by all)
select coalesce(a.symbol, b.symbol) as symbol, coalesce(a.trade_date, b.trade_date) as trade_date,
       a.n as taq_trades, a.v as taq_volume, b.n as alpaca_trades, b.v as alpaca_volume,
       coalesce(a.n, 0) - coalesce(b.n, 0) as diff_trades, coalesce(a.v, 0) - coalesce(b.v, 0) as diff_volume
from a full outer join b on a.symbol = b.symbol and a.trade_date = b.trade_date""", ctes=SRC), ids="J7")
def q_source_compare(spark, d):
    return compare.source_compare(source_trades(spark, d), "taq", "alpaca")


@query("summary_by_date_source", oracle("""
with a as (select trade_date, source, count(*) as n_trades, cast(sum(size) as bigint) as volume from st group by all),
b as (select trade_date, source, count(*) as n_nbbo from sq group by all)
select coalesce(a.trade_date, b.trade_date) as trade_date, coalesce(a.source, b.source) as source,
       a.n_trades, a.volume, b.n_nbbo
from a full outer join b on a.trade_date = b.trade_date and a.source = b.source""", ctes=SRC), ids="A32")
def q_summary_by_date_source(spark, d):
    return compare.summary_by_date_source(source_trades(spark, d), source_nbbo(spark, d))


@query("summary_by_symbol", oracle("""
with a as (select symbol, count(*) as n_trades, cast(sum(size) as bigint) as volume from fx_trades group by symbol),
b as (select symbol, count(*) as n_nbbo from fx_nbbo group by symbol)
select r.symbol, a.n_trades, a.volume, b.n_nbbo from req r left join a using (symbol) left join b using (symbol)""",
                                   ctes=REQ), ids="A33")
def q_summary_by_symbol(spark, d):
    return compare.summary_by_symbol(requested_symbols(spark, d), fx_trades(spark, d), fx_nbbo(spark, d))


@query("price_range", oracle("""
with t as (select min(price) as lo, max(price) as hi from st),
q as (select least(min(best_bid), min(best_ask)) as lo, greatest(max(best_bid), max(best_ask)) as hi from sq)
select least(t.lo, q.lo) as min_price, greatest(t.hi, q.hi) as max_price,
       least(t.lo, q.lo) * 0.95 as axis_lo, greatest(t.hi, q.hi) * 1.05 as axis_hi from t, q""",
                             ["min_price", "max_price", "axis_lo", "axis_hi"], ctes=SRC), ids="A34")
def q_price_range(spark, d):
    return compare.price_range(source_trades(spark, d), source_nbbo(spark, d))


@query("multi_source_union", oracle("""
select 'taq' as source, tr_seqnum, trade_date, symbol, cast(price as double) as price, cast(size as bigint) as size
from fx_trades
union all
select 'alpaca', tr_seqnum, trade_date, symbol, cast(cast(price as float) as double), cast(size as bigint)
from fx_trades where symbol <> 'S3' and tr_seqnum % 4 <> 0""", ["price"]), ids="S18, U2, U1")
def q_multi_source_union(spark, d):
    from tickspark.sources.registry import union_sources
    t = fx_trades(spark, d)
    taq = t.select("tr_seqnum", "trade_date", "symbol", "price", "size", "ex", "tr_corr")
    # the REST feed carries float prices, 64-bit sizes and fewer columns
    alp = (t.where((F.col("symbol") != "S3") & (F.pmod("tr_seqnum", F.lit(4)) != 0))
           .select("tr_seqnum", "trade_date", "symbol", F.col("price").cast("float").alias("price"),
                   F.col("size").cast("long").alias("size")))
    return union_sources({"taq": taq, "alpaca": alp})


@query("read_sources", oracle("""
select 'taq' as source, tr_seqnum, trade_date, symbol, price, size::bigint as size from fxd_trades
union all
select 'alpaca', tr_seqnum, trade_date, symbol, price, size::bigint from fxd_trades where symbol <> 'S3' and tr_seqnum % 4 <> 0""",
                              ["price"]), ids="S18, U1, U2")
def q_read_sources(spark, d):
    """Two sources' lakes as one table; one of them is partitioned by date alone and has wider sizes."""
    from tickspark.sources.registry import read_sources
    t = fxd_trades(spark, d).select("tr_seqnum", "trade_date", "symbol", "ts_event", "price", "size", "ex")
    roots = {name: scratch_path(spark, f"source-{name}") for name in ("taq", "alpaca")}
    lake.write_partitioned(t, roots["taq"], "trades")
    other = t.where((F.col("symbol") != "S3") & (F.pmod("tr_seqnum", F.lit(4)) != 0)).drop("ex").withColumn("size", F.col("size").cast("long"))
    lake.write_partitioned(other, roots["alpaca"], "trades", partition_by_symbol=False)
    return read_sources(spark, roots, "trades").select("source", "tr_seqnum", "trade_date", "symbol", "price", "size")


# ----------------------------------------------------------------------------- universe and membership

_MEM = {"mem": """select t1.ticker from fx_names t1 join fx_members t2 on t1.permno = t2.permno
                  where t2.start <= date '1996-01-01' and (t2.ending >= date '1996-01-01' or t2.ending is null)
                    and t1.namedt <= date '1996-01-01' and t1.nameendt >= date '1996-01-01' and t1.ticker is not null"""}


@query("index_members_asof", oracle("select distinct ticker from mem", ctes=_MEM), ids="J1")
def q_index_members_asof(spark, d):
    return cat.index_members_asof(fx_names(spark, d), fx_members(spark, d), "1996-01-01")


@query("default_universe", oracle(
    "select ticker as symbol from mem union select unnest(["
    + ", ".join(f"'{e}'" for e in cat.TOP_ETFS) + "])", ctes=_MEM), ids="U4")
def q_default_universe(spark, d):
    members = cat.index_members_asof(fx_names(spark, d), fx_members(spark, d), "1996-01-01")
    etfs = members.sparkSession.createDataFrame([(e,) for e in cat.TOP_ETFS], "symbol string")
    return members.select(F.col("ticker").alias("symbol")).union(etfs).distinct()


@query("parse_symbols", oracle("""
select distinct symbol from (
  select upper(trim(unnest(string_split(line, ',')))) as symbol
  from (select case when event_id % 9 = 0 then '   '
                    else concat(' s', cast(user_id % 14 as varchar), ' ,', case when event_id % 3 = 0 then ' '
                         else concat('x', cast(user_id % 5 as varchar), '  ') end) end as line from events) l) s
where symbol <> ''"""), ids="S16")
def q_parse_symbols(spark, d):
    from tickspark.sources.symbols import parse_symbol_lines
    ev = table(spark, d, "events")
    # raw lines as a user would type them: mixed case, padding, blank entries, blank lines
    line = (F.when(F.pmod("event_id", F.lit(9)) == 0, F.lit("   "))
            .otherwise(F.concat(F.lit(" s"), F.pmod("user_id", F.lit(14)).cast("string"), F.lit(" ,"),
                                F.when(F.pmod("event_id", F.lit(3)) == 0, F.lit(" "))
                                .otherwise(F.concat(F.lit("x"), F.pmod("user_id", F.lit(5)).cast("string"),
                                                    F.lit("  "))))))
    return parse_symbol_lines(ev.select(line.alias("value"))).distinct()
