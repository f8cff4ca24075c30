"""The canonical tick lake: Hive-partitioned Parquet ``{root}/{dataset}/trade_date=…/symbol=…``.

Write side (K1–K8): one distributed write per call; ``rebalance`` on the partition
keys lets AQE split a hot (date, symbol) into several files instead of one
straggler task; rows are sorted by time inside files so row-group min/max stats
prune time-range filters; Spark's commit protocol makes the publish atomic.

A dataset that streams write to has one level more, ``load=…``: every load (a
micro-batch, or a batch append) owns its folders and replaces only those, so writing
a load again adds nothing, and batch and streamed rows stand side by side.

Read side (S1–S5): partition pruning on ``trade_date``/``symbol``; an
unreadable file fails the job unless the caller asks to skip such files.
"""

from __future__ import annotations

import uuid
from datetime import datetime, timedelta, timezone
from typing import Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tickspark.functions.columns import EXCHANGE_TZ, clean_symbol_key, local_time, mid, spread
from tickspark.session import scratch_path
from tickspark.sources.listing import children, drop_folders, load_folders, open_uri, partition_folders

PARTS_BY_SYMBOL = ["trade_date", "symbol"]
PARTS_BY_DATE = ["trade_date"]
LOAD = "load"
#: O1: time, its nanoseconds and the sequence, as far as a table has them.
ORDER = ("ts_event", "ts_event_ns", "tr_seqnum", "qu_seqnum")
#: Hidden from readers; its presence says that the dataset has the load level.
_BY_LOAD = "_by_load"


def write_partitioned(df: DataFrame, root: str, dataset: str, partition_by_symbol: bool = True,
                      compression: str = "zstd", mode: str = "overwrite",
                      sort_cols: Sequence[str] = ORDER, load: str | None = None) -> int:
    """K1/K2/K5/K6/K7: write ``df`` under ``root/dataset``; returns the number of rows written.

    ``mode="overwrite"`` replaces only the partitions present in ``df`` (dynamic
    overwrite); ``mode="append"`` adds files (K2). ``load`` names the load: on a new
    dataset it asks for the load level, and an append of the same name replaces what
    that load wrote before. A dataset with that level gives unnamed loads a name.
    """
    parts = PARTS_BY_SYMBOL if partition_by_symbol else PARTS_BY_DATE
    spark, target = df.sparkSession, f"{root}/{dataset}"
    there = path_exists(spark, target)
    by_load = path_exists(spark, f"{target}/{_BY_LOAD}")
    if load is not None and there and not by_load:
        raise ValueError(f"{target} was written without loads; a named load needs a dataset of its own")
    if mode == "overwrite" and by_load:
        return _replace_loads(df, root, dataset, parts, compression, sort_cols, load)
    if load is not None or by_load:
        if not by_load:
            _mark_by_load(target)
        return _write(_with_load(df, load), target, [*parts, LOAD], compression, "overwrite", sort_cols)
    if mode == "overwrite" and not there:
        # nothing to replace: skip dynamic overwrite's staging and per-partition moves
        mode = "errorifexists"
    return _write(df, target, parts, compression, mode, sort_cols)


def _with_load(df: DataFrame, load: str | None) -> DataFrame:
    return df.withColumn(LOAD, F.lit(load or f"batch-{uuid.uuid4().hex}"))


def _mark_by_load(target: str) -> None:
    fs, path = open_uri(target)
    fs.create_dir(f"{path}/{_BY_LOAD}")


def _write(df: DataFrame, target: str, parts: Sequence[str], compression: str, mode: str, sort_cols: Sequence[str]) -> int:
    obs = Observation("lake_write")
    sort = [c for c in sort_cols if c in df.columns]
    out = (df.hint("rebalance", *parts)
           .sortWithinPartitions(*parts, *sort)
           .observe(obs, F.count(F.lit(1)).alias("rows")))
    (out.write.mode(mode)
     .option("compression", compression)
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy(*parts)
     .parquet(target))
    return int(obs.get["rows"])


def _replace_loads(df: DataFrame, root: str, dataset: str, parts, compression, sort_cols, load: str | None) -> int:
    """The partitions present in ``df`` keep its rows only: a new load, then the older ones go."""
    named = load or f"batch-{uuid.uuid4().hex}"
    n = _write(_with_load(df, named), f"{root}/{dataset}", [*parts, LOAD], compression, "overwrite", sort_cols)
    folders = partition_folders(df.sparkSession, root, dataset)
    _drop_other_loads(folders, named)
    return n


def path_exists(spark: SparkSession, path: str) -> bool:
    """One metadata call through the Hadoop file system of ``path``."""
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return bool(p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p))


def _drop_other_loads(folders: DataFrame, load: str) -> None:
    """Of the folders that hold ``load``, drops every other load's folder."""
    loads = load_folders(folders)
    mine = loads.where(F.col(LOAD) == load).select(F.col("parent").alias("kept"))
    drop_folders(loads.where(F.col(LOAD) != load).join(mine, F.col("parent") == F.col("kept"), "left_semi"))


def _clean(keys: DataFrame) -> DataFrame:
    return keys.withColumn("symbol", clean_symbol_key("symbol")) if "symbol" in keys.columns else keys


def delete_partitions(spark: SparkSession, root: str, dataset: str, keys: DataFrame) -> int:
    """K6: drop the (trade_date[, symbol]) partitions in ``keys``, whatever their folders are
    called (K8). The request is joined to the listed folders and dropped by tasks: neither
    is collected. Returns the number of folders dropped."""
    by = [c for c in PARTS_BY_SYMBOL if c in keys.columns]
    asked = _clean(keys.select(*by)).distinct()
    return drop_folders(partition_folders(spark, root, dataset).join(asked, by, "left_semi"))


def overwrite_partitions(spark: SparkSession, df: DataFrame, requested: DataFrame, root: str,
                         dataset: str, **kw) -> int:
    """K6: replace exactly the requested (trade_date, symbol) partitions with ``df``'s rows.

    ``df`` is evaluated once, into the shared scratch folder. Its rows are then written
    with dynamic partition overwrite, and requested partitions without new rows, as
    well as legacy-named folders of requested ones, are dropped by tasks; a failed write
    loses nothing and the whole call can be repeated. Untouched partitions stay."""
    staged_at = scratch_path(spark, "lake-staged")
    _clean(df).write.option("compression", "zstd").parquet(staged_at)
    staged = spark.read.schema(df.schema).parquet(staged_at)
    n = write_partitioned(staged, root, dataset, mode="overwrite", **kw)
    fresh = staged.select(*PARTS_BY_SYMBOL).distinct()
    asked = _clean(requested.select(*PARTS_BY_SYMBOL)).distinct()
    folders = partition_folders(spark, root, dataset).join(asked, PARTS_BY_SYMBOL, "left_semi")
    legacy = F.col("folder").rlike(r"/symbol=\(")
    drop_folders(folders.join(fresh, PARTS_BY_SYMBOL, "left_anti").unionByName(folders.where(legacy)))
    return n


def read_lake(spark: SparkSession, root: str, dataset: str, schema=None, skip_corrupt: bool = False) -> DataFrame:
    """A bad file fails the job unless ``skip_corrupt`` asks to leave it out."""
    r = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower()).option("basePath", f"{root}/{dataset}")
    if schema is not None:
        r = r.schema(schema)
    out = r.parquet(f"{root}/{dataset}")
    return out.drop(LOAD) if path_exists(spark, f"{root}/{dataset}/{_BY_LOAD}") else out


def _prune(df: DataFrame, trade_date=None, symbols=None, utc_range=None) -> DataFrame:
    if trade_date is not None:
        if isinstance(trade_date, (list, tuple)):
            df = df.where(F.col("trade_date").isin([F.lit(d).cast("date") for d in trade_date]))
        else:
            df = df.where(F.col("trade_date") == F.lit(trade_date).cast("date"))
    if symbols is not None:
        df = df.where(F.col("symbol").isin([symbols] if isinstance(symbols, str) else list(symbols)))
    if utc_range is not None:  # on the stored column, so Parquet row groups are skipped
        df = df.where(_between(*utc_range))
    return df


def _between(lo, hi):
    return F.col("ts_event").between(F.lit(str(lo)).cast("timestamp_ntz"), F.lit(str(hi)).cast("timestamp_ntz"))


def utc_bounds(lo, hi, tz: str = EXCHANGE_TZ) -> tuple[datetime, datetime]:
    """The UTC instants (naive) that enclose a local range, both ends inclusive. A wall clock
    time that comes twice counts from its first to its last instant."""
    zone = ZoneInfo(tz)
    ends = []
    for at, fold in ((lo, 0), (hi, 1)):
        at = at if isinstance(at, datetime) else datetime.fromisoformat(str(at))
        ends.append(at.replace(tzinfo=zone, fold=fold).astimezone(timezone.utc).replace(tzinfo=None))
    return min(ends), max(ends)


def local_bounds(lo, hi, tz: str = EXCHANGE_TZ):
    """F10 on a lake: a local range as a predicate on ``trade_date`` (the exchange's date, which
    prunes partitions) and on the stored UTC ``ts_event`` (which prunes row groups)."""
    first, last = (str(x)[:10] for x in (lo, hi))
    return F.col("trade_date").between(F.lit(first).cast("date"), F.lit(last).cast("date")) & _between(*utc_bounds(lo, hi, tz))


def daily_bounds(dates: Sequence, start: str, end: str, tz: str = EXCHANGE_TZ):
    """P13 on a lake: the local window ``start`` to ``end`` of each of ``dates``, as one range of
    instants per date; dates that share a UTC offset share their instants of day."""
    by_offset: dict[tuple, list] = {}
    for day in dates:
        lo, hi = utc_bounds(f"{day} {start}", f"{day} {end}", tz)
        midnight = datetime.fromisoformat(str(day))
        by_offset.setdefault((lo - midnight, hi - midnight), []).append(str(day))
    out = F.lit(False)
    for (lo, hi), days in by_offset.items():
        day = F.col("trade_date").cast("timestamp_ntz")
        at = F.col("ts_event").between(*(F.timestamp_add("MICROSECOND", F.lit(int(x / timedelta(microseconds=1))), day) for x in (lo, hi)))
        span = [datetime.fromisoformat(d) for d in (min(days), max(days))]
        out |= F.col("trade_date").isin([F.lit(d).cast("date") for d in days]) & _between(span[0] + lo, span[1] + hi) & at
    return out


def lake_dates(spark: SparkSession, root: str, dataset: str) -> list[str]:
    """The dates of a dataset, by the names of its date folders."""
    names = (f.base_name for f in children(f"{root}/{dataset}"))
    return sorted(n.split("=", 1)[1] for n in names if n.startswith("trade_date=") and not n.endswith("__"))


def _window(spark, df, root, dataset, trade_date, local_range, daily_window, tz) -> DataFrame:
    if local_range is not None:
        df = df.where(local_bounds(*local_range, tz))
    if daily_window is not None:
        dates = lake_dates(spark, root, dataset) if trade_date is None else trade_date if isinstance(trade_date, (list, tuple)) else [trade_date]
        df = df.where(daily_bounds(dates, *daily_window, tz))
    return df


def load_trades(spark: SparkSession, root: str, trade_date=None, symbols=None, tz: str = EXCHANGE_TZ, schema=None,
                utc_range=None, local_range=None, daily_window=None) -> DataFrame:
    """Trades of one date (or a list, or all), optional symbols; ``ts_event`` becomes
    exchange-local wall time, the UTC instant is kept as ``ts_event_utc`` (P5). ``local_range``: exchange-local
    times, both inclusive; ``daily_window``: local times of day, of every date read. Both
    become predicates on the partitions and the stored instants."""
    df = _prune(read_lake(spark, root, "trades", schema), trade_date, symbols, utc_range)
    df = _window(spark, df, root, "trades", trade_date, local_range, daily_window, tz)
    return df.withColumnRenamed("ts_event", "ts_event_utc").withColumn("ts_event", local_time("ts_event_utc", tz))


def load_nbbo(spark: SparkSession, root: str, trade_date=None, symbols=None, tz: str = EXCHANGE_TZ, schema=None,
              utc_range=None, local_range=None, daily_window=None) -> DataFrame:
    """As ``load_trades`` and always (re)computes ``mid_price`` and ``spread``."""
    df = _prune(read_lake(spark, root, "nbbo", schema), trade_date, symbols, utc_range)
    df = _window(spark, df, root, "nbbo", trade_date, local_range, daily_window, tz)
    return (df.withColumnRenamed("ts_event", "ts_event_utc").withColumn("ts_event", local_time("ts_event_utc", tz))
            .withColumn("mid_price", mid()).withColumn("spread", spread()))


def normalize_trade_date(df: DataFrame, col: str = "trade_date") -> DataFrame:
    """A string ``trade_date`` (older files) becomes a DATE; bad text → NULL."""
    if dict(df.dtypes).get(col) == "string":
        return df.withColumn(col, F.try_to_date(F.col(col), "yyyy-MM-dd"))
    return df
