"""Lake maintenance jobs: write / append / overwrite / by-date layouts, manifest and QC.
Each writes into a fresh directory under the shared checkpoint folder and returns
the data read back."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.operators import manifest as manifests
from tickspark.operators import qc
from tickspark.plans.registry import oracle, query
from tickspark.session import scratch_path
from tickspark.sources import lake
from tickspark.sources.fixtures import fxd_nbbo, fxd_trades, table

LAKE_COLS = ["tr_seqnum", "trade_date", "symbol", "ts_event", "price", "size", "ex", "tr_corr"]
LAKE_SQL = "select tr_seqnum, trade_date, symbol, ts_event, price, size, ex, tr_corr from fxd_trades"


def _ticks(spark, d) -> DataFrame:
    return fxd_trades(spark, d).select(*LAKE_COLS)


@query("lake_roundtrip", oracle(LAKE_SQL, ["price"]), ids="K1, K3, K7, O1")
def q_lake_roundtrip(spark, d, compression: str = "zstd"):
    root = scratch_path(spark, "lake")
    lake.write_partitioned(_ticks(spark, d), root, "trades", compression=compression)
    return lake.read_lake(spark, root, "trades").select(*LAKE_COLS)


@query("lake_append", oracle(LAKE_SQL, ["price"]), ids="K2")
def q_lake_append(spark, d):
    root = scratch_path(spark, "lake")
    t = _ticks(spark, d)
    # two chunks landed one after the other: the second is appended to the same partitions
    lake.write_partitioned(t.where(F.pmod("tr_seqnum", F.lit(2)) == 0), root, "trades", mode="overwrite")
    lake.write_partitioned(t.where(F.pmod("tr_seqnum", F.lit(2)) == 1), root, "trades", mode="append")
    return lake.read_lake(spark, root, "trades").select(*LAKE_COLS)


@query("lake_by_date", oracle(LAKE_SQL, ["price"]), ids="K5")
def q_lake_by_date(spark, d):
    root = scratch_path(spark, "lake")
    # one file set per date holding every symbol, sorted by (symbol, time) inside
    lake.write_partitioned(_ticks(spark, d), root, "trades", partition_by_symbol=False,
                           sort_cols=("symbol", "ts_event"))
    return lake.read_lake(spark, root, "trades").select(*LAKE_COLS)


@query("lake_overwrite", oracle("""
select tr_seqnum, trade_date, symbol, ts_event, price, size, ex, tr_corr from fxd_trades where symbol not in ('S1', 'S2')
union all
select tr_seqnum, trade_date, symbol, ts_event, price + 1, size, ex, tr_corr from fxd_trades where symbol = 'S1'""",
                                ["price"]), ids="K6")
def q_lake_overwrite(spark, d, symbols=("S1", "S2")):
    root = scratch_path(spark, "lake")
    t = _ticks(spark, d)
    lake.write_partitioned(t, root, "trades")
    requested = t.where(F.col("symbol").isin(*symbols)).select("trade_date", "symbol").distinct()
    # the re-extract returns new rows for S1 only; S2 had none and must disappear
    fresh = t.where(F.col("symbol") == symbols[0]).withColumn("price", F.col("price") + 1)
    lake.overwrite_partitions(spark, fresh, requested, root, "trades")
    return lake.read_lake(spark, root, "trades").select(*LAKE_COLS)


_MANIFEST_SQL = """
select trade_date, symbol, count(*) as n_rows, min(ts_event) as min_ts, max(ts_event) as max_ts, true as files_listed,
       cast(sum(tr_seqnum) as bigint) as seq_checksum, cast(sum(size) as bigint) as size_checksum,
       2 as schema_version,
       symbol in (select distinct concat('S', cast(user_id % 14 as varchar)) from events) as requested
from fxd_trades group by trade_date, symbol"""


@query("manifest", oracle(_MANIFEST_SQL), ids="K4, A42")
def q_manifest(spark, d):
    """The stored manifest of a lake whose partitions consist of several files."""
    root = scratch_path(spark, "lake")
    t = _ticks(spark, d)
    for k in range(2):
        lake.write_partitioned(t.where(F.pmod("tr_seqnum", F.lit(2)) == k), root, "trades", mode="append")
    ev = table(spark, d, "events")
    req = ev.select(F.concat(F.lit("S"), F.pmod("user_id", F.lit(14)).cast("string")).alias("symbol")).distinct()
    manifests.publish(spark, root, "trades", req)
    files = (F.size("files") == F.col("n_files")) & F.forall("files", lambda f: f.contains("symbol=") & f.endswith(".parquet"))
    return manifests.read_manifest(spark, root, "trades").select(
        "trade_date", "symbol", "n_rows", "min_ts", "max_ts", files.alias("files_listed"), "seq_checksum", "size_checksum",
        "schema_version", "requested")


@query("manifest_verify", oracle("""
select trade_date, symbol, case symbol when 'S1' then 'changed' when 'S2' then 'missing' when 'S3' then 'ok' else 'ok' end as status
from fxd_trades group by trade_date, symbol"""), ids="K4, A42")
def q_manifest_verify(spark, d):
    """A lake against its stored manifest: S1's largest and smallest price swap rows (all sums of the
    columns stay), S2 goes, S3 is rewritten as it was."""
    root = scratch_path(spark, "lake")
    t = _ticks(spark, d)
    lake.write_partitioned(t, root, "trades")
    manifests.publish(spark, root, "trades")
    symbol = F.col("symbol")
    edge = t.where(symbol == "S1").groupBy("trade_date").agg(
        F.max_by("tr_seqnum", F.struct("price", "tr_seqnum")).alias("top"), F.min_by("tr_seqnum", F.struct("price", "tr_seqnum")).alias("low"),
        F.max("price").alias("high_price"), F.min("price").alias("low_price"))
    swapped = t.where(symbol == "S1").join(edge, "trade_date").withColumn(
        "price", F.when(F.col("tr_seqnum") == F.col("top"), F.col("low_price")).when(F.col("tr_seqnum") == F.col("low"), F.col("high_price"))
        .otherwise(F.col("price"))).select(*t.columns)
    asked = t.where(symbol.isin("S1", "S2", "S3")).select("trade_date", "symbol").distinct()
    lake.overwrite_partitions(spark, swapped.unionByName(t.where(symbol == "S3")), asked, root, "trades")
    return manifests.verify(spark, root, "trades")


@query("marked_dates", oracle("select distinct trade_date from fxd_trades"), ids="K4")
def q_marked_dates(spark, d):
    """Dates whose marker stands after the manifest was stored."""
    root = scratch_path(spark, "lake")
    lake.write_partitioned(_ticks(spark, d), root, "trades")
    assert not manifests.marked_dates(spark, root, "trades").limit(1).count()
    manifests.publish(spark, root, "trades")
    return manifests.marked_dates(spark, root, "trades")


@query("qc_daily", oracle("""
with t as (select trade_date, symbol, count(*) as n_trades, count(*) filter (where tr_corr <> '00') as n_corrected,
                  count(distinct tr_scond) as n_conditions, count(distinct date_trunc('minute', ts_event)) as bar_minutes
           from fxd_trades group by all),
q as (select trade_date, symbol, count(*) as n_nbbo, count(*) filter (where best_ask - best_bid < 0) as n_crossed
      from fxd_nbbo group by all)
select coalesce(t.trade_date, q.trade_date) as trade_date, coalesce(t.symbol, q.symbol) as symbol,
       coalesce(n_trades, 0) as n_trades, coalesce(n_corrected, 0) as n_corrected,
       n_corrected * 100.0 / nullif(n_trades, 0) as pct_corrected, coalesce(n_conditions, 0) as n_conditions,
       coalesce(bar_minutes, 0) as bar_minutes, coalesce(bar_minutes, 0) * 100.0 / 390 as bar_coverage_pct,
       coalesce(n_nbbo, 0) as n_nbbo, coalesce(n_crossed, 0) as n_crossed,
       n_crossed * 100.0 / nullif(n_nbbo, 0) as pct_crossed
from t full outer join q on t.trade_date = q.trade_date and t.symbol = q.symbol""",
                          ["pct_corrected", "bar_coverage_pct", "pct_crossed"]), ids="A43")
def q_qc_daily(spark, d):
    return qc.daily(fxd_trades(spark, d), fxd_nbbo(spark, d)).select(
        "trade_date", "symbol", "n_trades", "n_corrected", "pct_corrected", "n_conditions", "bar_minutes", "bar_coverage_pct",
        "n_nbbo", "n_crossed", "pct_crossed")


@query("qc_empty_ranges", oracle("""
with have as (select trade_date, symbol, hour(ts_event) * 60 + minute(ts_event) as m from fxd_trades group by all),
want as (select trade_date, symbol, unnest(range(570, 960)) as m from (select distinct trade_date, symbol from fxd_trades) k),
lack as (select w.*, m - row_number() over (partition by trade_date, symbol order by m) as island from want w anti join have h
         using (trade_date, symbol, m))
select trade_date, symbol, cast(min(m) as int) as first_minute, cast(max(m) as int) as last_minute, cast(count(*) as int) as n_minutes
from lack group by trade_date, symbol, island"""), ids="A43")
def q_qc_empty_ranges(spark, d):
    return qc.empty_ranges(fxd_trades(spark, d))


@query("qc_condition_mix", oracle("""
select trade_date, symbol, tr_scond, count(*) as n_ticks,
       count(*) * 100.0 / sum(count(*)) over (partition by trade_date, symbol) as pct
from fxd_trades group by trade_date, symbol, tr_scond""", ["pct"]), ids="A43, A17")
def q_qc_condition_mix(spark, d):
    return qc.code_mix(fxd_trades(spark, d), "tr_scond")


@query("lake_time_range", oracle("""
select tr_seqnum, symbol, ts_event, price from fxd_trades
where ts_event between timestamp '2024-01-02 09:45:00' and timestamp '2024-01-02 11:15:30.5'""", ["price"]), ids="F10, S1, P5")
def q_lake_time_range(spark, d):
    """A local time range read from a lake of UTC instants: dates and row groups are pruned."""
    root = _utc_lake(spark, d)
    return lake.load_trades(spark, root, local_range=("2024-01-02 09:45:00", "2024-01-02 11:15:30.5")).select(
        "tr_seqnum", "symbol", "ts_event", "price")


@query("lake_session_window", oracle("""
select trade_date, count(*) as n_trades, cast(sum(size) as bigint) as volume from fxd_trades
where epoch_us(ts_event) - epoch_us(cast(trade_date as timestamp)) between 36000000000 and 41400000000
group by trade_date"""), ids="P13, F2, S3")
def q_lake_session_window(spark, d):
    """The 10:00-11:30 window of every date of a lake, as one range of instants per date."""
    root = _utc_lake(spark, d)
    t = lake.load_trades(spark, root, daily_window=("10:00:00", "11:30:00"))
    return t.groupBy("trade_date").agg(F.count(F.lit(1)).alias("n_trades"), F.sum("size").cast("long").alias("volume"))


def _utc_lake(spark, d) -> str:
    root = scratch_path(spark, "utc-lake")
    t = fxd_trades(spark, d).select("tr_seqnum", "trade_date", "symbol", F.col("ts_event_utc").alias("ts_event"), "price", "size")
    lake.write_partitioned(t, root, "trades", partition_by_symbol=False)
    return root
