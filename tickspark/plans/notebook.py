"""Trade/NBBO analysis reports (the research notebook's data work, over all symbols).

Inputs are the dense fixture sessions ``fxd_trades`` / ``fxd_nbbo``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickspark.functions.columns import epoch_micros, mid, quality_tier, session_bounds, spread
from tickspark.functions.filters import crossed, nonneg_spread, regular_trade
from tickspark.operators import bars, stats
from tickspark.operators.asof import asof_join
from tickspark.operators.enriched import enriched_trades, read_enriched, write_enriched
from tickspark.operators.quantiles import with_quantiles
from tickspark.operators.symbols import keep_symbols
from tickspark.operators.topk import leaderboards, top_k
from tickspark.plans.registry import oracle, query
from tickspark.session import scratch_path, stored
from tickspark.sources.fixtures import fxd_nbbo, fxd_trades, view

BY = ["symbol", "trade_date"]
QUOTE_COLS = ["best_bid", "best_ask", "spread", "best_bidsizeshares", "best_asksizeshares"]


def trades(spark, d) -> DataFrame:
    return fxd_trades(spark, d)


def nbbo(spark, d) -> DataFrame:
    return fxd_nbbo(spark, d)


@view
def valid_nbbo(spark, d) -> DataFrame:
    """F6-filtered NBBO with spread and mid (the notebook's ``nbbo_valid``)."""
    return (nbbo(spark, d).where(nonneg_spread())
            .withColumn("spread", spread()).withColumn("mid_price", mid()))


@view
def asof_trades(spark, d, bucket="1m") -> DataFrame:
    """Each trade with the NBBO in force at its nanosecond (same symbol and date)."""
    return _asof(spark, d, bucket, False)


def _asof(spark, d, bucket, right_required) -> DataFrame:
    t = trades(spark, d).select("tr_seqnum", "symbol", "trade_date", "ts_event", "price", "size", event_ns("tr_seqnum"))
    q = valid_nbbo(spark, d).select(*BY, "qu_seqnum", *QUOTE_COLS, event_ns("qu_seqnum"))
    return asof_join(t, q, by=BY, left_ts="ts_event_ns", right_cols=QUOTE_COLS, left_seq="tr_seqnum", right_seq="qu_seqnum",
                     bucket=bucket, ts_unit_per_us=1000, right_required=right_required).drop("ts_event_ns")


def event_ns(seq: str):
    """Epoch nanoseconds of a fixture tick: its microsecond plus its sequence's residue."""
    return (epoch_micros("ts_event") * 1000 + F.pmod(F.col(seq), F.lit(1000))).alias("ts_event_ns")


@view
def enriched(spark, d, bucket="1m") -> DataFrame:
    """J4 + J2 + P11 + P12: as-of trades of symbol-days present in the valid NBBO, with deviations.

    The analysis of one date keeps symbols that have both trades and valid quotes on it;
    over many dates that is a rule on symbol-days. It is evaluated inside the as-of plan
    (``right_required``). ``enriched_trades`` (J3) keeps every trade."""
    return stats.with_deviation(_asof(spark, d, bucket, True))


# ----------------------------------------------------------------------------- oracle pieces

ENR = {
    "qv": """select symbol, trade_date, ts_event, qu_seqnum, best_bid, best_ask, best_ask - best_bid as spread,
                    epoch_us(ts_event) * 1000 + qu_seqnum % 1000 as ns, best_bidsizeshares, best_asksizeshares, (best_bid + best_ask) / 2 as mid_price
             from fxd_nbbo where best_ask - best_bid >= 0""",
    "aj": """select t.tr_seqnum, t.symbol, t.trade_date, t.ts_event, t.price, t.size,
                    q.best_bid, q.best_ask, q.spread, q.best_bidsizeshares, q.best_asksizeshares
             from fxd_trades t asof left join qv q
               on t.symbol = q.symbol and t.trade_date = q.trade_date
              and epoch_us(t.ts_event) * 1000 + t.tr_seqnum % 1000 >= q.ns""",
    "enr": """select *, (price - best_bid) / nullif(best_bid, 0) * 100 as price_vs_bid_pct,
                    (price - best_ask) / nullif(best_ask, 0) * 100 as price_vs_ask_pct,
                    (price - (best_bid + best_ask) / 2) / nullif((best_bid + best_ask) / 2, 0) * 100 as price_vs_mid_pct,
                    case when price < best_bid then 'below_bid' when price > best_ask then 'above_ask'
                         else 'within_spread' end as price_location
             from aj where exists (select 1 from qv where qv.symbol = aj.symbol and qv.trade_date = aj.trade_date)""",
}

CONS_SQL = """select symbol, count(*) as total_trades, cast(sum(size) as bigint) as total_volume,
       count(*) filter (where price_location = 'within_spread') as within_spread_count,
       count(*) filter (where price_location = 'below_bid') as below_bid_count,
       count(*) filter (where price_location = 'above_ask') as above_ask_count,
       avg(spread) as mean_spread, median(spread) as median_spread, stddev_samp(spread) as std_spread,
       min(spread) as min_spread, max(spread) as max_spread,
       avg(price_vs_mid_pct) as mean_price_deviation_pct, stddev_samp(price_vs_mid_pct) as std_price_deviation_pct,
       min(price_vs_mid_pct) as min_price_deviation_pct, max(price_vs_mid_pct) as max_price_deviation_pct,
       avg(abs(price_vs_mid_pct)) as mean_abs_deviation_pct, max(abs(price_vs_mid_pct)) as max_abs_deviation_pct
from enr group by symbol"""

CONS_FULL_SQL = """select *, within_spread_count * 100.0 / nullif(total_trades, 0) as pct_within_spread,
       below_bid_count * 100.0 / nullif(total_trades, 0) as pct_below_bid,
       above_ask_count * 100.0 / nullif(total_trades, 0) as pct_above_ask,
       max_spread - min_spread as spread_range, std_spread / nullif(mean_spread, 0) as spread_cv,
       max_price_deviation_pct - min_price_deviation_pct as deviation_range
from cons0"""

CONS = dict(ENR, cons0=CONS_SQL, cons=CONS_FULL_SQL)

CONS_DBL = ["mean_spread", "median_spread", "std_spread", "min_spread", "max_spread",
            "mean_price_deviation_pct", "std_price_deviation_pct", "min_price_deviation_pct",
            "max_price_deviation_pct", "mean_abs_deviation_pct", "max_abs_deviation_pct",
            "pct_within_spread", "pct_below_bid", "pct_above_ask", "spread_range", "spread_cv",
            "deviation_range"]


def consistency(spark, d) -> DataFrame:
    return stats.symbol_consistency(enriched(spark, d))


# ----------------------------------------------------------------------------- minute aggregates

@query("vwap_1m", oracle("""
select symbol, date_trunc('minute', ts_event) as time_bucket, sum(price * size) as total_price_volume,
       cast(sum(size) as bigint) as total_volume, sum(price * size) / nullif(sum(size), 0) as vwap
from fxd_trades group by all""", ["total_price_volume", "vwap"]), ids="A1, P10")
def q_vwap_1m(spark, d):
    return bars.vwap(trades(spark, d), "1m")


@query("churn_1m", oracle("""
select symbol, date_trunc('minute', ts_event) as time_bucket, count(*) as churn
from fxd_nbbo group by all"""), ids="A2")
def q_churn_1m(spark, d):
    return bars.churn(nbbo(spark, d), "1m")


@query("trades_per_minute", oracle("""
select date_trunc('minute', ts_event) as minute, count(*) as trade_count,
       cast(sum(size) as bigint) as total_volume, avg(price) as avg_price
from fxd_trades group by all""", ["avg_price"]), ids="A11")
def q_trades_per_minute(spark, d):
    return bars.trades_per_bucket(trades(spark, d), "1m")


@query("nbbo_per_minute", oracle("""
select date_trunc('minute', ts_event) as minute, count(*) as nbbo_update_count,
       avg(best_ask - best_bid) as avg_spread, avg((best_bid + best_ask) / 2) as avg_mid
from fxd_nbbo where best_ask - best_bid >= 0 group by all""", ["avg_spread", "avg_mid"]), ids="A12, F6")
def q_nbbo_per_minute(spark, d):
    return bars.nbbo_per_bucket(nbbo(spark, d), "1m")


_BUSY = {"tpm": """select date_trunc('minute', ts_event) as minute, count(*) as trade_count,
                          cast(sum(size) as bigint) as total_volume from fxd_trades group by all""",
         "npm": """select date_trunc('minute', ts_event) as minute, count(*) as nbbo_update_count
                   from fxd_nbbo where best_ask - best_bid >= 0 group by all"""}


@query("busiest_minutes", oracle("""
select * from (
  select 'by_trade_count' as board, row_number() over (order by trade_count desc, minute) as rank, minute,
         cast(trade_count as bigint) as value from tpm
  union all
  select 'by_volume', row_number() over (order by total_volume desc, minute), minute, total_volume from tpm
  union all
  select 'by_nbbo_updates', row_number() over (order by nbbo_update_count desc, minute), minute,
         nbbo_update_count from npm) x
where rank <= 10""", ctes=_BUSY), ids="O3")
def q_busiest_minutes(spark, d):
    t = bars.trades_per_bucket(trades(spark, d), "1m")
    q = bars.nbbo_per_bucket(nbbo(spark, d), "1m")
    return leaderboards({"by_trade_count": (t, "trade_count"), "by_volume": (t, "total_volume"), "by_nbbo_updates": (q, "nbbo_update_count")},
                        "minute", 10)


@query("edge_minutes", oracle("""
select * from (
  select 'first' as edge, row_number() over (order by minute) as rank, * from tpm2
  union all
  select 'last', row_number() over (order by minute desc), * from tpm2) x
where rank <= 10""", ["avg_price"], ctes={"tpm2": """select date_trunc('minute', ts_event) as minute,
  count(*) as trade_count, cast(sum(size) as bigint) as total_volume, avg(price) as avg_price
  from fxd_trades group by all"""}), ids="O6")
def q_edge_minutes(spark, d):
    tpm = bars.trades_per_bucket(trades(spark, d), "1m")
    cols = ["minute", "trade_count", "total_volume", "avg_price"]
    first = tpm.orderBy("minute").limit(10)
    last = tpm.orderBy(F.desc("minute")).limit(10)
    return (first.select(F.lit("first").alias("edge"),
                         F.row_number().over(Window.orderBy("minute")).cast("long").alias("rank"), *cols)
            .unionByName(last.select(F.lit("last").alias("edge"),
                                     F.row_number().over(Window.orderBy(F.desc("minute"))).cast("long").alias("rank"), *cols)))


@query("peak_minute", oracle("""
select (select minute from tpm order by trade_count desc, minute limit 1) as peak_trade_minute,
       (select max(trade_count) from tpm) as peak_trade_count,
       (select minute from npm order by nbbo_update_count desc, minute limit 1) as peak_nbbo_minute,
       (select max(nbbo_update_count) from npm) as peak_nbbo_count""", ctes=_BUSY), ids="O7")
def q_peak_minute(spark, d):
    from tickspark.functions.columns import epoch_micros
    tpm = bars.trades_per_bucket(trades(spark, d), "1m")
    npm = bars.nbbo_per_bucket(nbbo(spark, d), "1m")
    # ties go to the earliest minute: maximise (count, -minute)
    a = tpm.agg(F.max_by("minute", F.struct("trade_count", -epoch_micros("minute"))).alias("peak_trade_minute"),
                F.max("trade_count").alias("peak_trade_count"))
    b = npm.agg(F.max_by("minute", F.struct("nbbo_update_count", -epoch_micros("minute"))).alias("m"),
                F.max("nbbo_update_count").alias("c"))
    return a.withColumns({"peak_nbbo_minute": b.select("m").scalar(), "peak_nbbo_count": b.select("c").scalar()})


# ----------------------------------------------------------------------------- per-symbol / code profiles

@query("symbol_trade_stats", oracle("""
select symbol, count(*) as trade_count, cast(sum(size) as bigint) as total_volume, avg(price) as avg_price
from fxd_trades group by symbol order by trade_count desc, symbol limit 20""", ["avg_price"]), ids="A5, O2")
def q_symbol_trade_stats(spark, d):
    return (trades(spark, d).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("trade_count"), F.sum("size").cast("long").alias("total_volume"),
                 F.avg("price").alias("avg_price"))
            .orderBy(F.desc("trade_count"), "symbol").limit(20))


@query("top_volume", oracle("""
select symbol, count(*) as trade_count, cast(sum(size) as bigint) as total_volume, avg(price) as avg_price
from fxd_trades group by symbol order by total_volume desc, symbol limit 10""", ["avg_price"]), ids="A14, O2")
def q_top_volume(spark, d):
    return (trades(spark, d).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("trade_count"), F.sum("size").cast("long").alias("total_volume"),
                 F.avg("price").alias("avg_price"))
            .orderBy(F.desc("total_volume"), "symbol").limit(10))


def _five_sql(x, name, src, where=""):
    return f"""select min({x}) as min_{name}, max({x}) as max_{name}, avg({x}) as mean_{name},
       median({x}) as median_{name}, stddev_samp({x}) as std_{name} from {src} {where}"""


@query("price_stats", oracle(_five_sql("price", "price", "fxd_trades"),
                             ["min_price", "max_price", "mean_price", "median_price", "std_price"]), ids="A6")
def q_price_stats(spark, d):
    return stats.describe(trades(spark, d), "price").toDF(
        "min_price", "max_price", "mean_price", "median_price", "std_price")


@query("size_stats", oracle(_five_sql("size", "size", "fxd_trades"),
                            ["mean_size", "median_size", "std_size"]), ids="A7")
def q_size_stats(spark, d):
    return stats.describe(trades(spark, d), "size").toDF(
        "min_size", "max_size", "mean_size", "median_size", "std_size")


@query("spread_stats", oracle(_five_sql("best_ask - best_bid", "spread", "fxd_nbbo"),
                              ["min_spread", "max_spread", "mean_spread", "median_spread", "std_spread"]), ids="A9")
def q_spread_stats(spark, d):
    return stats.describe(nbbo(spark, d).withColumn("spread", spread()), "spread").toDF(
        "min_spread", "max_spread", "mean_spread", "median_spread", "std_spread")


@query("mid_stats", oracle(_five_sql("(best_bid + best_ask) / 2", "mid", "fxd_nbbo"),
                           ["min_mid", "max_mid", "mean_mid", "median_mid", "std_mid"]), ids="A10")
def q_mid_stats(spark, d):
    return stats.describe(nbbo(spark, d).withColumn("mid_price", mid()), "mid_price").toDF(
        "min_mid", "max_mid", "mean_mid", "median_mid", "std_mid")


@query("nbbo_counts", oracle("""
select symbol, count(*) as nbbo_count from fxd_nbbo group by symbol order by nbbo_count desc, symbol limit 20"""),
       ids="A8")
def q_nbbo_counts(spark, d):
    return (nbbo(spark, d).groupBy("symbol").agg(F.count(F.lit(1)).alias("nbbo_count"))
            .orderBy(F.desc("nbbo_count"), "symbol").limit(20))


@query("crossed_market", oracle("""
select count(*) as n_rows, count(*) filter (where best_ask - best_bid < 0) as n_crossed,
       count(*) filter (where best_ask - best_bid < 0) * 100.0 / nullif(count(*), 0) as pct_crossed
from fxd_nbbo""", ["pct_crossed"]), ids="F7")
def q_crossed_market(spark, d):
    return (nbbo(spark, d).agg(F.count(F.lit(1)).alias("n_rows"), F.count_if(crossed()).alias("n_crossed"))
            .withColumn("pct_crossed", F.try_divide(F.col("n_crossed") * 100.0, F.col("n_rows"))))


@query("dataset_profile", oracle("""
select 'trades' as dataset, count(*) as n_rows, count(distinct symbol) as n_symbols, min(ts_event) as min_ts,
       max(ts_event) as max_ts, epoch_us(max(ts_event)) - epoch_us(min(ts_event)) as duration_us,
       cast(sum(size) as bigint) as total_volume from fxd_trades
union all
select 'nbbo', count(*), count(distinct symbol), min(ts_event), max(ts_event),
       epoch_us(max(ts_event)) - epoch_us(min(ts_event)), null from fxd_nbbo"""), ids="A13, A35")
def q_dataset_profile(spark, d):
    from tickspark.operators.reports import profile
    return (profile(trades(spark, d), "trades", volume="size")
            .unionByName(profile(nbbo(spark, d), "nbbo", volume=None)))


@query("tr_corr_counts", oracle("""
select tr_corr, count(*) as count, cast(sum(size) as bigint) as total_volume from fxd_trades group by tr_corr"""),
       ids="A16")
def q_tr_corr_counts(spark, d):
    return (trades(spark, d).groupBy("tr_corr")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("size").cast("long").alias("total_volume")))


@query("tr_scond_counts", oracle("""
select tr_scond, count(*) as count, cast(sum(size) as bigint) as total_volume from fxd_trades
group by tr_scond order by count desc, tr_scond limit 20"""), ids="A17")
def q_tr_scond_counts(spark, d):
    return (trades(spark, d).groupBy("tr_scond")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("size").cast("long").alias("total_volume"))
            .orderBy(F.desc("count"), "tr_scond").limit(20))


@query("exchange_counts", oracle("""
select ex, count(*) as count, cast(sum(size) as bigint) as total_volume from fxd_trades
group by ex order by count desc, ex limit 20"""), ids="A18")
def q_exchange_counts(spark, d):
    return (trades(spark, d).groupBy("ex")
            .agg(F.count(F.lit(1)).alias("count"), F.sum("size").cast("long").alias("total_volume"))
            .orderBy(F.desc("count"), "ex").limit(20))


@query("regular_share", oracle("""
select count(*) as n_trades, count(*) filter (where tr_corr = '00') as n_regular,
       count(*) filter (where tr_corr = '00') * 100.0 / nullif(count(*), 0) as pct_regular,
       cast(sum(size) filter (where tr_corr = '00') as bigint) * 100.0 / nullif(sum(size), 0) as pct_regular_volume
from fxd_trades""", ["pct_regular", "pct_regular_volume"]), ids="A19")
def q_regular_share(spark, d):
    t = trades(spark, d)
    return (t.agg(F.count(F.lit(1)).alias("n_trades"), F.count_if(regular_trade()).alias("n_regular"),
                  F.sum(F.when(regular_trade(), F.col("size"))).cast("long").alias("_rv"),
                  F.sum("size").cast("long").alias("_v"))
            .select("n_trades", "n_regular",
                    F.try_divide(F.col("n_regular") * 100.0, F.col("n_trades")).alias("pct_regular"),
                    F.try_divide(F.col("_rv") * 100.0, F.col("_v")).alias("pct_regular_volume")))


NBBO_CODES = ["nbbo_qu_cond", "qu_cond", "natbbo_ind", "qu_source"]


@query("nbbo_condition_counts", oracle("""
select field, value, count, rank from (
  select field, value, count, row_number() over (partition by field order by count desc, value) as rank
  from (select case when grouping(nbbo_qu_cond) = 0 then 'nbbo_qu_cond' when grouping(qu_cond) = 0 then 'qu_cond'
                    when grouping(natbbo_ind) = 0 then 'natbbo_ind' else 'qu_source' end as field,
               coalesce(nbbo_qu_cond, qu_cond, natbbo_ind, qu_source) as value, count(*) as count
        from fxd_nbbo group by grouping sets ((nbbo_qu_cond), (qu_cond), (natbbo_ind), (qu_source))) g) r
where rank <= 20"""), ids="A20")
def q_nbbo_condition_counts(spark, d):
    from tickspark.operators.reports import code_counts
    return code_counts(nbbo(spark, d), NBBO_CODES, top=20)


@query("quote_size_stats", oracle("""
select min(best_bidsizeshares) as min_bid_size, max(best_bidsizeshares) as max_bid_size,
       avg(best_bidsizeshares) as mean_bid_size, median(best_bidsizeshares) as median_bid_size,
       min(best_asksizeshares) as min_ask_size, max(best_asksizeshares) as max_ask_size,
       avg(best_asksizeshares) as mean_ask_size, median(best_asksizeshares) as median_ask_size
from fxd_nbbo""", ["mean_bid_size", "median_bid_size", "mean_ask_size", "median_ask_size"]), ids="A21")
def q_quote_size_stats(spark, d):
    b, a = "best_bidsizeshares", "best_asksizeshares"
    rest = nbbo(spark, d).agg(
        F.min(b).alias("min_bid_size"), F.max(b).alias("max_bid_size"), F.avg(b).alias("mean_bid_size"),
        F.min(a).alias("min_ask_size"), F.max(a).alias("max_ask_size"), F.avg(a).alias("mean_ask_size"))
    return with_quantiles(rest, nbbo(spark, d), {b: "median_bid_size", a: "median_ask_size"})


@query("summary_table", oracle("""
select 'Trades' as dataset, count(*) as total_records, count(distinct symbol) as unique_symbols,
       cast(sum(size) as bigint) as total_volume, avg(size) as avg_trade_size, null::double as avg_spread,
       min(ts_event) as min_ts, max(ts_event) as max_ts from fxd_trades
union all
select 'NBBO', count(*), count(distinct symbol), null, null, null, min(ts_event), max(ts_event) from fxd_nbbo
union all
select 'NBBO (valid spreads)', count(*), count(distinct symbol), null, null, avg(best_ask - best_bid), null, null
from fxd_nbbo where best_ask - best_bid >= 0""", ["avg_trade_size", "avg_spread"]), ids="A22")
def q_summary_table(spark, d):
    from tickspark.operators.reports import summary_table
    return summary_table(trades(spark, d), nbbo(spark, d))


@query("top_symbol_nbbo", oracle("""
select q.symbol, count(*) as nbbo_records, avg(spread) as avg_spread, median(spread) as median_spread,
       avg(mid_price) as avg_mid, 100 * avg(spread) / nullif(avg(mid_price), 0) as spread_pct_of_mid
from qv q where q.symbol in (select symbol from fxd_trades group by symbol order by sum(size) desc, symbol limit 5)
group by q.symbol""", ["avg_spread", "median_spread", "avg_mid", "spread_pct_of_mid"], ctes={"qv": ENR["qv"]}),
       ids="A15, P8")
def q_top_symbol_nbbo(spark, d):
    top5 = (trades(spark, d).groupBy("symbol").agg(F.sum("size").alias("v"))
            .orderBy(F.desc("v"), "symbol").limit(5).select("symbol"))
    # the top-k result has at most 5 rows: a proven bound, so broadcasting it is safe
    q = valid_nbbo(spark, d).join(F.broadcast(top5), "symbol", "left_semi")
    rest = q.groupBy("symbol").agg(F.count(F.lit(1)).alias("nbbo_records"), F.avg("spread").alias("avg_spread"),
                                   F.avg("mid_price").alias("avg_mid"))
    return (with_quantiles(rest, q, {"spread": "median_spread"}, keys=["symbol"])
            .withColumn("spread_pct_of_mid", F.try_divide(100 * F.col("avg_spread"), F.col("avg_mid"))))


@query("spread_quantiles", oracle("""
select avg(best_ask - best_bid) as mean, count(*) as n, median(best_ask - best_bid) as median,
       quantile_cont(best_ask - best_bid, 0.95) as p95, quantile_cont(best_ask - best_bid, 0.99) as p99
from fxd_nbbo where best_ask - best_bid >= 0""", ["mean", "median", "p95", "p99"]), ids="A23")
def q_spread_quantiles(spark, d):
    return stats.quantiles(valid_nbbo(spark, d), "spread", (0.5, 0.95, 0.99))


# ----------------------------------------------------------------------------- as-of family

@query("asof_trades_nbbo", oracle("select * from aj", ["price", "best_bid", "best_ask", "spread"],
                                  ctes={"qv": ENR["qv"], "aj": ENR["aj"]}), ids="J2, W1, P20")
def q_asof_trades_nbbo(spark, d):
    return asof_trades(spark, d)


@query("enriched_trades", oracle("""
select tr_seqnum, symbol, trade_date, ts_event, price, size, best_bid, best_ask, spread,
       best_bidsizeshares, best_asksizeshares, (best_bid + best_ask) / 2 as mid_price,
       price_vs_bid_pct, price_vs_ask_pct, price_vs_mid_pct, price_location, best_bid is not null as has_quote
from every""", ["price", "best_bid", "best_ask", "spread", "mid_price", "price_vs_bid_pct", "price_vs_ask_pct",
              "price_vs_mid_pct"], ctes=ENR | {"every": ENR["enr"].partition("where exists")[0]}), ids="J3")
def q_enriched_trades(spark, d):
    """Every trade, also of symbol-days without a valid quote."""
    e = stats.with_deviation(asof_trades(spark, d))
    return e.select("tr_seqnum", "symbol", "trade_date", "ts_event", "price", "size", "best_bid", "best_ask",
                    "spread", "best_bidsizeshares", "best_asksizeshares", mid().alias("mid_price"),
                    "price_vs_bid_pct", "price_vs_ask_pct", "price_vs_mid_pct", "price_location",
                    F.col("best_bid").isNotNull().alias("has_quote"))


@query("enriched_lake", oracle("""
select t.tr_seqnum, t.symbol, t.trade_date, t.price, t.size, t.ex, q.best_bid, q.best_ask, q.best_bidsizeshares, q.best_asksizeshares,
       q.nbbo_qu_cond, q.natbbo_ind, q.qu_source, (q.best_bid + q.best_ask) / 2 as mid, q.best_ask - q.best_bid as spread,
       q.ns is not null as has_quote, epoch_us(t.ts_event) * 1000 + t.tr_seqnum % 1000 - q.ns as quote_age_ns,
       q.ns is not null and (q.best_ask < q.best_bid or q.best_bid <= 0 or q.best_ask <= 0) as nbbo_invalid
from fxd_trades t asof left join (select *, epoch_us(ts_event) * 1000 + qu_seqnum % 1000 as ns from fxd_nbbo) q
  on t.symbol = q.symbol and t.trade_date = q.trade_date and epoch_us(t.ts_event) * 1000 + t.tr_seqnum % 1000 >= q.ns""",
                                ["price", "best_bid", "best_ask", "mid", "spread"]), ids="J3, F13, K1")
def q_enriched_lake(spark, d):
    """Every trade with its NBBO snapshot and flags, written by date and symbol and read back."""
    t = trades(spark, d).select("tr_seqnum", "symbol", "trade_date", "ts_event", "price", "size", "ex", event_ns("tr_seqnum"))
    q = nbbo(spark, d).select("*", event_ns("qu_seqnum"))
    root = scratch_path(spark, "enriched")
    write_enriched(enriched_trades(t, q, invalid="flag"), root)
    return read_enriched(spark, root).select(
        "tr_seqnum", "symbol", "trade_date", "price", "size", "ex", "best_bid", "best_ask", "best_bidsizeshares", "best_asksizeshares",
        "nbbo_qu_cond", "natbbo_ind", "qu_source", "mid", "spread", "has_quote", "quote_age_ns", "nbbo_invalid")


@query("time_bounds", oracle("select min(ts_event) as min_ts, max(ts_event) as max_ts from fxd_trades"), ids="A35")
def q_time_bounds(spark, d):
    from tickspark.operators.reports import time_bounds
    return time_bounds(trades(spark, d), nbbo(spark, d))


@query("session_default", oracle("""
select trade_date, symbol, greatest(lo, cast(trade_date as timestamp) + interval '570 minutes') as start_ts,
       least(hi, cast(trade_date as timestamp) + interval '960 minutes') as end_ts
from (select trade_date, symbol, min(ts_event) as lo, max(ts_event) as hi from fxd_trades group by all) b"""), ids="P22, P13")
def q_session_default(spark, d):
    """The 390-minute window of each symbol-day, clipped to its data."""
    b = trades(spark, d).groupBy("trade_date", "symbol").agg(F.min("ts_event").alias("lo"), F.max("ts_event").alias("hi"))
    start, end = session_bounds("lo", "hi")
    return b.select("trade_date", "symbol", start.alias("start_ts"), end.alias("end_ts"))


@query("trade_deviation", oracle("""
select tr_seqnum, symbol, price_vs_bid_pct, price_vs_ask_pct, price_vs_mid_pct from enr""",
                                 ["price_vs_bid_pct", "price_vs_ask_pct", "price_vs_mid_pct"], ctes=ENR), ids="P11")
def q_trade_deviation(spark, d):
    return enriched(spark, d).select("tr_seqnum", "symbol", "price_vs_bid_pct", "price_vs_ask_pct",
                                     "price_vs_mid_pct")


@query("price_location", oracle("""
select tr_seqnum, symbol, price_location, best_bid is not null as has_quote from enr""", ctes=ENR), ids="P12")
def q_price_location(spark, d):
    return enriched(spark, d).select("tr_seqnum", "symbol", "price_location",
                                     F.col("best_bid").isNotNull().alias("has_quote"))


@query("price_location_mix", oracle("""
select price_location, count(*) as count, count(*) * 100.0 / sum(count(*)) over () as percentage
from enr group by price_location""", ["percentage"], ctes=ENR), ids="A24, W3, A36")
def q_price_location_mix(spark, d):
    return stats.location_mix(enriched(spark, d))


@query("deviation_stats", oracle(_five_sql("price_vs_mid_pct", "pct", "enr"),
                                 ["min_pct", "max_pct", "mean_pct", "median_pct", "std_pct"], ctes=ENR), ids="A25")
def q_deviation_stats(spark, d):
    return stats.describe(enriched(spark, d), "price_vs_mid_pct", once=True).toDF(
        "min_pct", "max_pct", "mean_pct", "median_pct", "std_pct")


@query("symbol_deep_dive", oracle("""
select symbol, count(*) as n_trades,
       count(*) filter (where price_location = 'within_spread') as within_spread,
       count(*) filter (where price_location = 'below_bid') as below_bid,
       count(*) filter (where price_location = 'above_ask') as above_ask,
       count(*) filter (where price_location = 'within_spread') * 100.0 / count(*) as pct_within_spread,
       avg(price_vs_mid_pct) as mean_deviation_pct, median(price_vs_mid_pct) as median_deviation_pct,
       stddev_samp(price_vs_mid_pct) as std_deviation_pct, avg(spread) as mean_spread, median(spread) as median_spread
from enr where symbol = (select coalesce(max(case when symbol = 'TSLA' then symbol end), min(symbol)) from enr)
group by symbol""", ["pct_within_spread", "mean_deviation_pct", "median_deviation_pct", "std_deviation_pct",
                     "mean_spread", "median_spread"], ctes=ENR), ids="A26, F9")
def q_symbol_deep_dive(spark, d, symbol: str = "TSLA"):
    # the symbol is picked from the symbol-days both sides have; as a literal it reaches all scans
    both = trades(spark, d).select(*BY).distinct().join(valid_nbbo(spark, d).select(*BY).distinct(), BY, "left_semi")
    pick = both.agg(F.coalesce(F.max(F.when(F.col("symbol") == symbol, F.col("symbol"))), F.min("symbol"))).first()[0]
    loc = F.col("price_location")
    one = stored(keep_symbols(enriched(spark, d), [pick] if pick is not None else [])
                 .select("symbol", "price_location", "price_vs_mid_pct", "spread"), "deep-dive")
    rest = one.groupBy("symbol").agg(
        F.count(F.lit(1)).alias("n_trades"),
        F.count_if(loc == "within_spread").alias("within_spread"),
        F.count_if(loc == "below_bid").alias("below_bid"),
        F.count_if(loc == "above_ask").alias("above_ask"),
        (F.count_if(loc == "within_spread") * 100.0 / F.count(F.lit(1))).alias("pct_within_spread"),
        F.avg("price_vs_mid_pct").alias("mean_deviation_pct"),
        F.stddev_samp("price_vs_mid_pct").alias("std_deviation_pct"),
        F.avg("spread").alias("mean_spread"))
    return with_quantiles(rest, one, {"price_vs_mid_pct": "median_deviation_pct", "spread": "median_spread"}, keys=["symbol"])


@query("symbol_consistency", oracle("select * from cons", CONS_DBL, ctes=CONS), ids="A27, P16, P17")
def q_symbol_consistency(spark, d):
    return consistency(spark, d)


@query("consistency_summary", oracle("""
select count(*) as n_symbols, avg(total_trades) as avg_trades, median(total_trades) as median_trades,
       avg(pct_within_spread) as avg_pct_within, median(pct_within_spread) as median_pct_within,
       avg(pct_below_bid) as avg_pct_below, avg(pct_above_ask) as avg_pct_above,
       avg(mean_spread) as avg_mean_spread, median(median_spread) as median_median_spread,
       avg(std_spread) as avg_std_spread, avg(mean_abs_deviation_pct) as avg_abs_deviation,
       median(mean_abs_deviation_pct) as median_abs_deviation
from cons""", ["avg_trades", "median_trades", "avg_pct_within", "median_pct_within", "avg_pct_below",
               "avg_pct_above", "avg_mean_spread", "median_median_spread", "avg_std_spread",
               "avg_abs_deviation", "median_abs_deviation"], ctes=CONS), ids="A28")
def q_consistency_summary(spark, d):
    c = consistency(spark, d)
    median = F.median  # over one row per symbol: a map bounded by the symbol universe
    return c.agg(F.count(F.lit(1)).alias("n_symbols"), F.avg("total_trades").alias("avg_trades"),
                 median("total_trades").alias("median_trades"),
                 F.avg("pct_within_spread").alias("avg_pct_within"),
                 median("pct_within_spread").alias("median_pct_within"),
                 F.avg("pct_below_bid").alias("avg_pct_below"), F.avg("pct_above_ask").alias("avg_pct_above"),
                 F.avg("mean_spread").alias("avg_mean_spread"),
                 median("median_spread").alias("median_median_spread"),
                 F.avg("std_spread").alias("avg_std_spread"),
                 F.avg("mean_abs_deviation_pct").alias("avg_abs_deviation"),
                 median("mean_abs_deviation_pct").alias("median_abs_deviation"))


CORR_METRICS = ["pct_within_spread", "pct_below_bid", "pct_above_ask", "mean_spread", "spread_cv",
                "mean_abs_deviation_pct", "total_trades"]


def _corr_sql():
    pairs = [(a, b) for i, a in enumerate(CORR_METRICS) for b in CORR_METRICS[i + 1:]]
    return "\nunion all\n".join(f"select '{a}' as metric_a, '{b}' as metric_b, corr({a}, {b}) as r from cons"
                                for a, b in pairs)


@query("metric_corr", oracle(_corr_sql(), ["r"], ctes=CONS), ids="A29")
def q_metric_corr(spark, d):
    return stats.correlation_long(consistency(spark, d), CORR_METRICS)


@query("quality_counts", oracle("""
select count(*) filter (where pct_within_spread > 95) as n_within_gt_95,
       count(*) filter (where pct_within_spread < 90) as n_within_lt_90,
       count(*) filter (where mean_spread > 0.10) as n_spread_gt_010,
       count(*) filter (where mean_spread < 0.01) as n_spread_lt_001,
       count(*) filter (where total_trades > 1000) as n_trades_gt_1000,
       count(*) filter (where total_trades < 100) as n_trades_lt_100
from cons""", ctes=CONS), ids="F12")
def q_quality_counts(spark, d):
    c = consistency(spark, d)
    return c.agg(F.count_if(F.col("pct_within_spread") > 95).alias("n_within_gt_95"),
                 F.count_if(F.col("pct_within_spread") < 90).alias("n_within_lt_90"),
                 F.count_if(F.col("mean_spread") > 0.10).alias("n_spread_gt_010"),
                 F.count_if(F.col("mean_spread") < 0.01).alias("n_spread_lt_001"),
                 F.count_if(F.col("total_trades") > 1000).alias("n_trades_gt_1000"),
                 F.count_if(F.col("total_trades") < 100).alias("n_trades_lt_100"))


@query("quality_rank", oracle("""
select symbol, pct_within_spread, row_number() over (order by pct_within_spread desc, symbol) as rank
from cons""", ["pct_within_spread"], ctes=CONS), ids="W2")
def q_quality_rank(spark, d):
    c = consistency(spark, d).select("symbol", "pct_within_spread")
    # one row per symbol: a global ordering of a table bounded by the symbol universe
    return c.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("pct_within_spread"), "symbol")).cast("long"))


@query("quality_tier", oracle("""
select symbol, pct_within_spread,
       case when pct_within_spread > 95 then 'green' when pct_within_spread > 90 then 'orange' else 'red' end as tier
from cons""", ["pct_within_spread"], ctes=CONS), ids="P18")
def q_quality_tier(spark, d):
    return consistency(spark, d).select("symbol", "pct_within_spread",
                                        quality_tier("pct_within_spread").alias("tier"))


@query("symbol_leaderboards", oracle("""
select * from (
  select 'most_consistent' as board, row_number() over (order by pct_within_spread desc, symbol) as rank,
         symbol, pct_within_spread as value from cons
  union all
  select 'least_consistent', row_number() over (order by pct_within_spread, symbol), symbol, pct_within_spread from cons
  union all
  select 'most_below_bid', row_number() over (order by pct_below_bid desc, symbol), symbol, pct_below_bid from cons
  union all
  select 'most_above_ask', row_number() over (order by pct_above_ask desc, symbol), symbol, pct_above_ask from cons) x
where (board in ('most_consistent', 'least_consistent') and rank <= 5)
   or (board in ('most_below_bid', 'most_above_ask') and rank <= 15)""",
                                     ["value"], ctes=CONS), ids="O8")
def q_symbol_leaderboards(spark, d):
    c = consistency(spark, d)
    return (top_k(c, 5, [F.desc("pct_within_spread"), "symbol"], "symbol", F.col("pct_within_spread"),
                  "most_consistent")
            .unionByName(top_k(c, 5, ["pct_within_spread", "symbol"], "symbol", F.col("pct_within_spread"),
                               "least_consistent"))
            .unionByName(top_k(c, 15, [F.desc("pct_below_bid"), "symbol"], "symbol", F.col("pct_below_bid"),
                               "most_below_bid"))
            .unionByName(top_k(c, 15, [F.desc("pct_above_ask"), "symbol"], "symbol", F.col("pct_above_ask"),
                               "most_above_ask")))


@query("common_symbols", oracle("""
select symbol from fxd_trades intersect select symbol from fxd_nbbo where best_ask - best_bid >= 0"""),
       ids="J4, U3")
def q_common_symbols(spark, d):
    return trades(spark, d).select("symbol").intersect(valid_nbbo(spark, d).select("symbol"))


# ----------------------------------------------------------------------------- distributions

def _hist_sql(x, src, bins, where="true"):
    return f"""
select bin, count(*) as count, lo + bin * (hi - lo) / {bins} as bin_lo, lo + (bin + 1) * (hi - lo) / {bins} as bin_hi
from (select case when hi = lo then 0 else cast(least(floor(({x} - lo) / ((hi - lo) / {bins})), {bins - 1}) as int) end as bin,
             lo, hi
      from (select {x} as {x}_v, * from {src} where {where}) s,
           (select min({x}) as lo, max({x}) as hi from {src} where {where}) b
      where {x} is not null) h
group by bin, lo, hi"""


@query("spread_histogram", oracle(_hist_sql("spread", "qv", 100), ["bin_lo", "bin_hi"], ctes={"qv": ENR["qv"]}),
       ids="A30")
def q_spread_histogram(spark, d):
    return stats.histogram(valid_nbbo(spark, d), "spread", 100)


@query("spread_histogram_50", oracle(_hist_sql("spread", "qv", 50), ["bin_lo", "bin_hi"], ctes={"qv": ENR["qv"]}), ids="A30")
def q_spread_histogram_50(spark, d):
    return stats.histogram(valid_nbbo(spark, d), "spread", 50)


HIST_METRICS = ["pct_within_spread", "mean_spread", "mean_abs_deviation_pct"]


def _metric_hist_sql(bins: int = 30) -> str:
    return "\nunion all\n".join(f"select '{m}' as metric, h.* from ({_hist_sql(m, 'cons', bins)}) h" for m in HIST_METRICS)


@query("metric_histograms", oracle(_metric_hist_sql(), ["bin_lo", "bin_hi"], ctes=CONS), ids="A30")
def q_metric_histograms(spark, d):
    """Distribution of the symbols over each consistency metric: one pass, keyed by the metric."""
    c = stored(consistency(spark, d).select(*HIST_METRICS), "metrics")
    long = c.select(F.explode(F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("x")) for m in HIST_METRICS))).alias("_m"))
    return stats.histogram(long.select("_m.metric", "_m.x"), "x", 30, ["metric"])


@query("deviation_histogram", oracle(_hist_sql("price_vs_mid_pct", "enr", 100), ["bin_lo", "bin_hi"], ctes=ENR),
       ids="A30")
def q_deviation_histogram(spark, d):
    return stats.histogram(enriched(spark, d), "price_vs_mid_pct", 100, once=True)


@query("size_histogram", oracle(_hist_sql("size", "fxd_trades", 50), ["bin_lo", "bin_hi"]), ids="A30")
def q_size_histogram(spark, d):
    return stats.histogram(trades(spark, d), "size", 50)


@query("spread_boxplot", oracle("""
select q[1] as q1, q[2] as median, q[3] as q3, q[3] - q[1] as iqr,
       q[1] - 1.5 * (q[3] - q[1]) as lo_fence, q[3] + 1.5 * (q[3] - q[1]) as hi_fence,
       min(spread) filter (where spread between q[1] - 1.5 * (q[3] - q[1]) and q[3] + 1.5 * (q[3] - q[1])) as whisker_lo,
       max(spread) filter (where spread between q[1] - 1.5 * (q[3] - q[1]) and q[3] + 1.5 * (q[3] - q[1])) as whisker_hi,
       count(*) filter (where spread not between q[1] - 1.5 * (q[3] - q[1]) and q[3] + 1.5 * (q[3] - q[1])) as n_outliers
from qv, (select quantile_cont(spread, [0.25, 0.5, 0.75]) as q from qv) p
group by q""", ["q1", "median", "q3", "iqr", "lo_fence", "hi_fence", "whisker_lo", "whisker_hi"],
                                  ctes={"qv": ENR["qv"]}), ids="A31")
def q_spread_boxplot(spark, d):
    return stats.boxplot(valid_nbbo(spark, d), "spread")
