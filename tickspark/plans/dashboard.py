"""Dashboard data queries: bars, downsampled panels, spreads, top-k tables, time filters
and multi-source summaries (the dashboard's data work, over all symbols and days)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.functions.columns import (epoch_micros, local_time, micros_of_day, mid, session_start,
                                         spread_bps, time_bucket)
from tickspark.functions.filters import min_size, time_range
from tickspark.operators import bars, downsample as ds, pyramid
from tickspark.operators.topk import largest, top_k_per_group
from tickspark.plans.registry import oracle, query
from tickspark.session import scratch_path
from tickspark.sources.fixtures import fx_trades, fxd_nbbo, fxd_trades, table

SMALL_CHART = 250  # an explicit point budget, as a caller with a small chart gives it


# ----------------------------------------------------------------------------- oracle helpers

def _widths_sql(src: str, mp: str) -> str:
    return f"""select symbol, case when n <= mp then 0 else
              case when b >= 1 then cast(floor(b) as bigint) * 1000000 when b >= 0.1 then 100000
                   when b >= 0.01 then 10000 else 1000 end end as w
       from (select symbol, n, mp, greatest(0.001, secs / mp) as b
             from (select symbol, count(*) as n, (epoch_us(max(ts_event)) - epoch_us(min(ts_event))) / 1e6 as secs,
                          {mp} as mp from {src} group by symbol) s0) s1"""


def _budget_sql(data_type: str) -> str:
    """The adaptive budget over a group's own span, as SQL on min and max of the time."""
    secs = "((epoch_us(max(ts_event)) - epoch_us(min(ts_event))) / 1e6)"
    steps = " ".join(f"when {secs} < {limit} then {points}" for limit, points in ds.BUDGET_STEPS)
    return f"(case {steps} else {ds.BUDGET_DEFAULT} end * {ds.TRADES_MULTIPLIER if data_type == 'trades' else 1})"


def _ds_sql(src: str, seq: str, last_cols: list[str], first_cols: list[str], mp: str, p: str = "") -> dict:
    aggs = [f"last({c} order by ts_event, {seq}) as {c}" for c in last_cols]
    aggs += [f"first({c} order by ts_event, {seq}) as {c}" for c in first_cols]
    return {
        f"{p}wd": _widths_sql(src, mp),
        f"{p}bk": f"""select s.*, case when w = 0 then epoch_us(ts_event) else epoch_us(ts_event) - epoch_us(ts_event) % w end as _bk,
                         case when w = 0 then {seq} end as _own
                  from {src} s join {p}wd using (symbol)""",
        f"{p}dsq": f"""select symbol, make_timestamp(_bk) as ts_event, {', '.join(aggs)} from {p}bk group by symbol, _bk, _own""",
    }


NBBO_LAST = ["qu_seqnum", "best_bid", "best_ask", "best_bidsizeshares", "best_asksizeshares"]
NBBO_FIRST = ["trade_date", "nbbo_qu_cond", "qu_cond", "natbbo_ind", "qu_source"]


# ----------------------------------------------------------------------------- bars and LOD tables

@query("bars_1m", oracle("""
select symbol, date_trunc('minute', ts_event) as time_bucket,
       first(price order by ts_event, tr_seqnum) as open, max(price) as high, min(price) as low,
       last(price order by ts_event, tr_seqnum) as close, cast(sum(size) as bigint) as volume,
       count(*) as num_trades, sum(price * size) / nullif(sum(size), 0) as vwap
from fxd_trades group by all""", ["open", "high", "low", "close", "vwap"]), ids="A40")
def q_bars_1m(spark, d):
    return bars.ohlc_bars(fxd_trades(spark, d), "1m")


_TW = {
    "qv": """select symbol, trade_date, ts_event, qu_seqnum, best_ask - best_bid as spr
             from fxd_nbbo where best_ask - best_bid >= 0""",
    "iv": """select *, epoch_us(ts_event) as s,
                    epoch_us(coalesce(lead(ts_event) over (partition by symbol, trade_date order by ts_event, qu_seqnum),
                                      greatest(cast(trade_date as timestamp) + interval 16 hours, ts_event))) as e
             from qv""",
    "sp": """select symbol, trade_date, spr, s, e, unnest(generate_series(s - s % 60000000, (e - 1) - (e - 1) % 60000000,
                                                                   60000000)) as bk
             from iv where e > s""",
    "tw": """select symbol, trade_date, make_timestamp(bk) as time_bucket,
                    sum(spr * (least(e, bk + 60000000) - greatest(s, bk))) / nullif(sum(least(e, bk + 60000000) - greatest(s, bk)), 0) as tw_spread,
                    cast(sum(least(e, bk + 60000000) - greatest(s, bk)) as bigint) as covered_us
             from sp group by all""",
}


@query("tw_spread", oracle("select * from tw", ["tw_spread"], ctes=_TW), ids="A41, W5")
def q_tw_spread(spark, d):
    return bars.tw_spread(fxd_nbbo(spark, d), "1m")


_BARS_NBBO = dict(_TW, **{
    "bars": """select symbol, trade_date, date_trunc('minute', ts_event) as time_bucket, count(*) as num_trades
               from fxd_trades group by all""",
    "qv2": """select symbol, trade_date, ts_event, best_bid, best_ask from fxd_nbbo where best_ask - best_bid >= 0""",
    "edges": """select symbol, trade_date, min(m) as lo, max(m) as hi
                from (select symbol, trade_date, date_trunc('minute', ts_event) as m from fxd_trades
                      union all select symbol, trade_date, date_trunc('minute', ts_event) from fxd_nbbo) e group by all""",
    "grid": """select g.symbol, g.trade_date, g.time_bucket, coalesce(b.num_trades, 0) as num_trades
               from (select symbol, trade_date, unnest(generate_series(lo, hi, interval 1 minute)) as time_bucket from edges) g
               left join bars b on g.symbol = b.symbol and g.trade_date = b.trade_date and g.time_bucket = b.time_bucket""",
    "cl": """select b.*, q.best_bid as close_bid, q.best_ask as close_ask
             from (select *, time_bucket + interval 1 minute as _close from grid) b
             asof left join qv2 q on b.symbol = q.symbol and b.trade_date = q.trade_date and b._close >= q.ts_event""",
    "cu": """select symbol, date_trunc('minute', ts_event) as time_bucket, count(*) as quote_updates
             from fxd_nbbo group by all""",
})


@query("bars_1m_nbbo", oracle("""
select cl.symbol, cl.trade_date, cl.time_bucket, cl.num_trades, cl.close_bid, cl.close_ask,
       (cl.close_bid + cl.close_ask) / 2 as close_mid, cl.close_ask - cl.close_bid as close_spread,
       coalesce(cu.quote_updates, 0) as quote_updates, tw.tw_spread
from cl left join cu on cl.symbol = cu.symbol and cl.time_bucket = cu.time_bucket
        left join tw on cl.symbol = tw.symbol and cl.trade_date = tw.trade_date and cl.time_bucket = tw.time_bucket""",
                                ["close_bid", "close_ask", "close_mid", "close_spread", "tw_spread"],
                                ctes=_BARS_NBBO), ids="A41, J8")
def q_bars_1m_nbbo(spark, d):
    t, q = fxd_trades(spark, d), fxd_nbbo(spark, d)
    grid = (t.groupBy("symbol", "trade_date", time_bucket("ts_event", "1m").alias("time_bucket"))
            .agg(F.count(F.lit(1)).alias("num_trades")))
    # one pass over the quotes for close NBBO, update count and time-weighted spread, on every
    # minute between a symbol-day's first and last tick
    f = bars.minute_nbbo_features(q, grid, "1m", fill=True)
    return f.select("symbol", "trade_date", "time_bucket",
                    F.coalesce("num_trades", F.lit(0).cast("long")).alias("num_trades"), "close_bid", "close_ask", "close_mid",
                    "close_spread", "quote_updates", "tw_spread")


@query("lod_quotes_1s", oracle("""
select symbol, make_timestamp(epoch_us(ts_event) - epoch_us(ts_event) % 1000000) as time_bucket,
       last(best_bid order by ts_event, qu_seqnum) as best_bid, last(best_ask order by ts_event, qu_seqnum) as best_ask,
       count(*) as n_updates
from fxd_nbbo group by all""", ["best_bid", "best_ask"]), ids="A44")
def q_lod_quotes_1s(spark, d):
    return bars.lod_quotes(fxd_nbbo(spark, d), "1s")


@query("lod_trades_1s", oracle("""
select symbol, make_timestamp(epoch_us(ts_event) - epoch_us(ts_event) % 1000000) as time_bucket,
       sum(price * size) / nullif(sum(size), 0) as vwap, cast(sum(size) as bigint) as volume, count(*) as trade_count
from fxd_trades group by all""", ["vwap"]), ids="A44")
def q_lod_trades_1s(spark, d):
    return bars.lod_trades(fxd_trades(spark, d), "1s")


def _bucket_sql(us: int) -> str:
    return f"make_timestamp(epoch_us(ts_event) - epoch_us(ts_event) % {us})"


def _quote_level_sql(us: int) -> str:
    return f"""select trade_date, symbol, {_bucket_sql(us)} as time_bucket,
       last(best_bid order by ts_event, qu_seqnum) as best_bid, last(best_ask order by ts_event, qu_seqnum) as best_ask,
       count(*) as n_updates from fxd_nbbo group by all"""


def _trade_level_sql(us: int) -> str:
    return f"""select trade_date, symbol, {_bucket_sql(us)} as time_bucket, sum(price * size) / nullif(sum(size), 0) as vwap,
       cast(sum(size) as bigint) as volume, count(*) as trade_count from fxd_trades group by all"""


_LEVEL_US = {"100ms": 100_000, "1s": 1_000_000}


def _pyramid(spark, d, kind: str) -> str:
    """Both levels, written in two appends that meet in the same buckets; the second comes twice."""
    root = scratch_path(spark, "pyramid")
    ticks, seq = (fxd_trades(spark, d), "tr_seqnum") if kind == "trades" else (fxd_nbbo(spark, d), "qu_seqnum")
    for load, rest in (("first", 0), ("second", 1), ("second", 1)):
        pyramid.append(ticks.where(F.pmod(F.floor(F.col(seq) / 3), F.lit(2)) == rest), root, kind, load, seq=seq)
    return root


def _all_levels(spark, root: str, kind: str) -> DataFrame:
    parts = [pyramid.read_level(spark, root, kind, level).withColumn("level", F.lit(level)) for level in pyramid.LEVELS]
    return parts[0].unionByName(parts[1])


@query("lod_pyramid_quotes", oracle("\nunion all\n".join(f"select *, '{n}' as level from ({_quote_level_sql(us)}) l" for n, us in _LEVEL_US.items()),
                                    ["best_bid", "best_ask"]), ids="A44")
def q_lod_pyramid_quotes(spark, d):
    """100 ms and 1 s quotes after appends, as written levels."""
    return _all_levels(spark, _pyramid(spark, d, "quotes"), "quotes")


@query("lod_pyramid_trades", oracle("\nunion all\n".join(f"select *, '{n}' as level from ({_trade_level_sql(us)}) l" for n, us in _LEVEL_US.items()),
                                    ["vwap"]), ids="A44")
def q_lod_pyramid_trades(spark, d):
    """100 ms and 1 s trades after appends, as written levels."""
    return _all_levels(spark, _pyramid(spark, d, "trades"), "trades")


_WINDOWS = (("2024-01-02 10:00:00", "2024-01-02 10:01:00"), ("2024-01-02 10:00:00", "2024-01-02 10:20:00"),
            ("2024-01-02 10:00:00", "2024-01-02 12:00:00"))


def _window_sql(k: int) -> str:
    lo, hi = (f"timestamp '{x}'" for x in _WINDOWS[k])
    if k == 0:
        return f"""select 'raw' as level, symbol, ts_event as time_bucket, best_bid, best_ask, 1::bigint as n_updates from fxd_nbbo
                   where ts_event between {lo} and {hi}"""
    name, us = list(_LEVEL_US.items())[k - 1]
    return f"""select '{name}', symbol, time_bucket, best_bid, best_ask, n_updates from ({_quote_level_sql(us)}) l{k}
               where time_bucket between {lo} and {hi}"""


@query("lod_window", oracle("\nunion all\n".join(map(_window_sql, range(3))), ["best_bid", "best_ask"]), ids="A44")
def q_lod_window(spark, d):
    """One, twenty and 120 minutes of quotes, each from the level of its length."""
    root, out = _pyramid(spark, d, "quotes"), None
    for lo, hi in _WINDOWS:
        level, rows = pyramid.read_window(spark, root, "quotes", lo, hi, fxd_nbbo(spark, d))
        at, n = ("ts_event", F.lit(1).cast("long")) if level == "raw" else ("time_bucket", F.col("n_updates"))
        part = rows.select(F.lit(level).alias("level"), "symbol", F.col(at).alias("time_bucket"), "best_bid", "best_ask", n.alias("n_updates"))
        out = part if out is None else out.unionByName(part)
    return out


@query("lod_choice", oracle("""
select k as window_seconds, case when k > 1800 then '1s' when k >= 120 then '100ms' else 'raw' end as level
from (select distinct event_id * 7 as k from events) e"""), ids="A44")
def q_lod_choice(spark, d):
    """The level of a window length, as an expression over a column of lengths."""
    k = (F.col("event_id") * 7).alias("window_seconds")
    return table(spark, d, "events").select(k).distinct().withColumn("level", bars.lod_choice("window_seconds"))


# ----------------------------------------------------------------------------- downsampling

def _nbbo_panel(spark, d) -> DataFrame:
    return fxd_nbbo(spark, d).select("symbol", "ts_event", *NBBO_LAST, *NBBO_FIRST)


@query("downsample_nbbo", oracle(f"select symbol, ts_event, {', '.join(NBBO_LAST + NBBO_FIRST)} from dsq",
                                 ["best_bid", "best_ask"],
                                 ctes=_ds_sql("fxd_nbbo", "qu_seqnum", NBBO_LAST, NBBO_FIRST, _budget_sql("nbbo"))),
       ids="A3, A4")
def q_downsample_nbbo(spark, d):
    return ds.downsample(_nbbo_panel(spark, d), "ts_event", ["symbol"], "qu_seqnum")


@query("downsample_nbbo_small", oracle(f"select symbol, ts_event, {', '.join(NBBO_LAST + NBBO_FIRST)} from dsq",
                                       ["best_bid", "best_ask"],
                                       ctes=_ds_sql("fxd_nbbo", "qu_seqnum", NBBO_LAST, NBBO_FIRST, str(SMALL_CHART))),
       ids="A3")
def q_downsample_nbbo_small(spark, d):
    """The same panel for a caller who asks for at most SMALL_CHART points a symbol."""
    return ds.downsample(_nbbo_panel(spark, d), "ts_event", ["symbol"], "qu_seqnum", max_points=SMALL_CHART)


_ADAPT = """case when secs < 30 then 5000 when secs < 120 then 10000 when secs < 600 then 15000
                 when secs < 1800 then 10000 else 10000 end * case when data_type = 'trades' then 2 else 1 end"""


@query("adaptive_points", oracle(f"""
select symbol, data_type, n_rows, secs as total_seconds, cast({_ADAPT} as int) as max_points
from (select symbol, 'trades' as data_type, count(*) as n_rows,
             (epoch_us(max(ts_event)) - epoch_us(min(ts_event))) / 1e6 as secs from fxd_trades group by symbol
      union all
      select symbol, 'nbbo', count(*), (epoch_us(max(ts_event)) - epoch_us(min(ts_event))) / 1e6
      from fxd_nbbo group by symbol) s""", ["total_seconds"]), ids="A4")
def q_adaptive_points(spark, d):
    def one(df, dt):
        return df.groupBy("symbol").agg(
            F.lit(dt).alias("data_type"), F.count(F.lit(1)).alias("n_rows"),
            ((F.max(epoch_micros("ts_event")) - F.min(epoch_micros("ts_event"))) / 1e6).alias("total_seconds"))
    u = one(fxd_trades(spark, d), "trades").unionByName(one(fxd_nbbo(spark, d), "nbbo"))
    return u.withColumn("max_points", ds.adaptive_max_points("total_seconds", "data_type"))


_ENVELOPE_SQL = """
select symbol, count(*) as n, min(best_bid) as min_best_bid, max(best_bid) as max_best_bid,
       min(best_ask) as min_best_ask, max(best_ask) as max_best_ask,
       make_timestamp(epoch_us(ts_event) - epoch_us(ts_event) % (case when w = 0 then 1 else w end)) as time_bucket
from fxd_nbbo join wd using (symbol) group by symbol, time_bucket"""
_ENVELOPE_DBL = ["min_best_bid", "max_best_bid", "min_best_ask", "max_best_ask"]


@query("downsample_envelope", oracle(_ENVELOPE_SQL, _ENVELOPE_DBL, ctes={"wd": _widths_sql("fxd_nbbo", _budget_sql("nbbo"))}),
       ids="A45, A4")
def q_downsample_envelope(spark, d):
    return ds.envelope(fxd_nbbo(spark, d), ["best_bid", "best_ask"])


@query("downsample_envelope_small", oracle(_ENVELOPE_SQL, _ENVELOPE_DBL, ctes={"wd": _widths_sql("fxd_nbbo", str(SMALL_CHART))}),
       ids="A45")
def q_downsample_envelope_small(spark, d):
    return ds.envelope(fxd_nbbo(spark, d), ["best_bid", "best_ask"], max_points=SMALL_CHART)


_SPREAD_DS = {
    "sb": """select symbol, ts_event, qu_seqnum,
                    (best_ask - best_bid) / nullif((best_bid + best_ask) / 2, 0) * 10000 as spread_bps from fxd_nbbo""",
}
_SPREAD_DS.update(_ds_sql("sb", "qu_seqnum", ["qu_seqnum", "spread_bps"], [], _budget_sql("nbbo")))


@query("spread_timeline", oracle("""
select symbol, 'spread_bps' as series, ts_event as ts, spread_bps as value from dsq
union all
select symbol, 'churn', date_trunc('minute', ts_event), cast(count(*) as double) from fxd_nbbo group by all""",
                                 ["value"], ctes=_SPREAD_DS), ids="A38, P7")
def q_spread_timeline(spark, d):
    q = fxd_nbbo(spark, d)
    sb = q.select("symbol", "ts_event", "qu_seqnum", spread_bps().alias("spread_bps"))
    dsq = ds.downsample(sb, "ts_event", ["symbol"], "qu_seqnum")
    ch = bars.churn(q, "1m")
    return (dsq.select("symbol", F.lit("spread_bps").alias("series"), F.col("ts_event").alias("ts"),
                       F.col("spread_bps").alias("value"))
            .unionByName(ch.select("symbol", F.lit("churn").alias("series"), F.col("time_bucket").alias("ts"),
                                   F.col("churn").cast("double").alias("value"))))


@query("spread_bps", oracle("""
select qu_seqnum, symbol, ts_event, (best_ask - best_bid) / nullif((best_bid + best_ask) / 2, 0) * 10000 as spread_bps
from fxd_nbbo""", ["spread_bps"]), ids="P7")
def q_spread_bps(spark, d):
    return fxd_nbbo(spark, d).select("qu_seqnum", "symbol", "ts_event", spread_bps().alias("spread_bps"))


_PANEL = _ds_sql("fxd_trades", "tr_seqnum", ["tr_seqnum", "price", "size"], [], _budget_sql("trades"), p="t_")
_PANEL.update(_ds_sql("fxd_nbbo", "qu_seqnum", ["qu_seqnum", "best_bid", "best_ask"], [], _budget_sql("nbbo")))


@query("price_panel_series", oracle("""
select symbol, 'trades' as layer, ts_event as ts, price as value, size from t_dsq
union all select symbol, 'bid', ts_event, best_bid, null from dsq
union all select symbol, 'ask', ts_event, best_ask, null from dsq
union all select symbol, 'mid', ts_event, (best_bid + best_ask) / 2, null from dsq
union all select symbol, 'vwap', date_trunc('minute', ts_event), sum(price * size) / nullif(sum(size), 0),
                 cast(sum(size) as bigint) from fxd_trades group by all""", ["value"], ctes=_PANEL), ids="A37")
def q_price_panel_series(spark, d):
    t, q = fxd_trades(spark, d), fxd_nbbo(spark, d)
    td = ds.downsample(t.select("symbol", "ts_event", "tr_seqnum", "price", "size").where(min_size("size", 0)),
                       "ts_event", ["symbol"], "tr_seqnum", data_type="trades")
    qd = ds.downsample(q.select("symbol", "ts_event", "qu_seqnum", "best_bid", "best_ask"),
                       "ts_event", ["symbol"], "qu_seqnum")
    vw = bars.vwap(t, "1m")
    none = F.lit(None).cast("long")
    # bid, ask and mid come from one downsampling: each kept quote becomes three points
    layers = F.explode(F.array(*(F.struct(F.lit(n).alias("layer"), c.alias("value"))
                                 for n, c in (("bid", F.col("best_bid")), ("ask", F.col("best_ask")), ("mid", mid())))))
    return (td.select("symbol", F.lit("trades").alias("layer"), F.col("ts_event").alias("ts"),
                      F.col("price").alias("value"), F.col("size").cast("long").alias("size"))
            .unionByName(qd.select("symbol", F.col("ts_event").alias("ts"), layers.alias("_l"))
                         .select("symbol", "_l.layer", "ts", "_l.value", none.alias("size")))
            .unionByName(vw.select("symbol", F.lit("vwap").alias("layer"), F.col("time_bucket").alias("ts"),
                                   F.col("vwap").alias("value"), F.col("total_volume").alias("size"))))


# ----------------------------------------------------------------------------- top-k tables

@query("top_churn_minutes", oracle("""
select symbol, trade_date, time_bucket, strftime(time_bucket, '%H:%M:%S') as time, churn, rank from (
  select *, row_number() over (partition by symbol, trade_date order by churn desc, time_bucket) as rank
  from (select symbol, trade_date, date_trunc('minute', ts_event) as time_bucket, count(*) as churn
        from fxd_nbbo group by all) c) r
where rank <= 20"""), ids="O4, W4, P19")
def q_top_churn_minutes(spark, d):
    c = bars.churn(fxd_nbbo(spark, d), "1m", keys=["symbol", "trade_date"])
    r = top_k_per_group(c, 20, ["symbol", "trade_date"], [F.desc("churn"), "time_bucket"])
    return r.select("symbol", "trade_date", "time_bucket", F.date_format("time_bucket", "HH:mm:ss").alias("time"),
                    "churn", "rank")


@query("largest_trades", oracle("""
select symbol, trade_date, rank, strftime(ts_event, '%H:%M:%S.%g') as time, round(price, 4) as price, size, ex, tr_seqnum
from (select *, row_number() over (partition by symbol, trade_date order by size desc nulls last, ts_event, tr_seqnum) as rank
      from fxd_trades) r where rank <= 100""", ["price"]), ids="O5, W4, P19")
def q_largest_trades(spark, d):
    t = fxd_trades(spark, d)
    r = largest(t, 100, ["symbol", "trade_date"])
    return r.select("symbol", "trade_date", "rank", F.date_format("ts_event", "HH:mm:ss.SSS").alias("time"),
                    F.round("price", 4).alias("price"), "size", "ex", "tr_seqnum")


@query("first_trades", oracle("""
select symbol, trade_date, rank, tr_seqnum, price from (
  select *, row_number() over (partition by symbol, trade_date order by ts_event, tr_seqnum) as rank from fxd_trades) r
where rank <= 100""", ["price"]), ids="O5")
def q_first_trades(spark, d):
    """The largest-trades table of ticks that have no size: the first 100."""
    return largest(fxd_trades(spark, d).drop("size"), 100, ["symbol", "trade_date"]).select("symbol", "trade_date", "rank", "tr_seqnum", "price")


# ----------------------------------------------------------------------------- filters and time projections

@query("min_trade_size", oracle("""
select symbol, count(*) as n_trades, cast(sum(size) as bigint) as volume from fxd_trades where size >= 500 group by symbol"""),
       ids="F11")
def q_min_trade_size(spark, d):
    return (fxd_trades(spark, d).where(min_size("size", 500)).groupBy("symbol")
            .agg(F.count(F.lit(1)).alias("n_trades"), F.sum("size").cast("long").alias("volume")))


@query("time_range_filter", oracle("""
select tr_seqnum, symbol, ts_event, price from fxd_trades
where ts_event between timestamp '2024-01-02 09:45:00' and timestamp '2024-01-02 11:15:30.5'"""), ids="F10")
def q_time_range_filter(spark, d):
    lo = F.lit("2024-01-02 09:45:00").cast("timestamp_ntz")
    hi = F.lit("2024-01-02 11:15:30.5").cast("timestamp_ntz")
    return fxd_trades(spark, d).where(time_range("ts_event", lo, hi)).select("tr_seqnum", "symbol", "ts_event", "price")


_BUCKETS = {"b_1m": "1m", "b_5m": "5m", "b_1h": "1h", "b_37s": "37s", "b_100ms": "100ms", "b_10ms": "10ms",
            "b_1ms": "1ms", "b_1min": "1min"}
_BUCKET_US = {"b_1m": 60000000, "b_5m": 300000000, "b_1h": 3600000000, "b_37s": 37000000, "b_100ms": 100000,
              "b_10ms": 10000, "b_1ms": 1000, "b_1min": 60000000}


@query("time_bucket", oracle("select tr_seqnum, ts_event, " + ", ".join(
    f"make_timestamp(epoch_us(ts_event) - epoch_us(ts_event) % {w}) as {k}" for k, w in _BUCKET_US.items())
    + " from fx_trades"), ids="P9")
def q_time_bucket(spark, d):
    t = fx_trades(spark, d)
    return t.select("tr_seqnum", "ts_event", *[time_bucket("ts_event", w).alias(k) for k, w in _BUCKETS.items()])


@query("local_time", oracle("""
select tr_seqnum, ts_event_utc, ts_event_utc - interval 5 hours as ts_local,
       cast(ts_event_utc - interval 5 hours as date) as local_date from fx_trades"""), ids="P5")
def q_local_time(spark, d):
    t = fx_trades(spark, d)
    loc = local_time("ts_event_utc")
    return t.select("tr_seqnum", "ts_event_utc", loc.alias("ts_local"), F.to_date(loc).alias("local_date"))


@query("session_per_day", oracle("""
select trade_date, cast(trade_date as timestamp) + interval '10 hours' as window_start,
       cast(trade_date as timestamp) + interval '11 hours 30 minutes' as window_end,
       count(*) as n_trades, cast(sum(size) as bigint) as volume
from fx_trades
where epoch_us(ts_event) - epoch_us(cast(trade_date as timestamp)) between 36000000000 and 41400000000
group by trade_date"""), ids="P13, P22")
def q_session_per_day(spark, d):
    # the 10:00–11:30 time-of-day window of a dashboard range, applied to every date
    start_us, end_us = 10 * 3600 * 10 ** 6, (11 * 3600 + 30 * 60) * 10 ** 6
    t = fx_trades(spark, d).where(micros_of_day("ts_event").between(start_us, end_us))
    return (t.groupBy("trade_date").agg(F.count(F.lit(1)).alias("n_trades"), F.sum("size").cast("long").alias("volume"))
            .withColumn("window_start", session_start("trade_date", start_us))
            .withColumn("window_end", session_start("trade_date", end_us)))
