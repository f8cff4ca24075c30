"""Partition catalog, availability and incremental work planning.

The catalog is an ordinary DataFrame ``(source, data_type, trade_date, symbol, n_rows)``,
built once from the lake's folders and Parquet footers (no data page is read) instead
of listing directories per question. Every operator below is a function of a catalog
and a request; requested universes (symbols × types × dates) are generated with
``explode`` of literal arrays / date sequences, never with cross joins. Trades and
NBBO are kept apart throughout: what is available is asked per data type.
"""

from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickspark.functions.columns import clean_symbol_key
from tickspark.sources.listing import partition_files

DATA_TYPES = ["trades", "quotes", "nbbo"]

# The ETFs the reference always adds to the default universe.
TOP_ETFS = ["SPY", "QQQ", "DIA", "IWM", "JETS", "XLE", "XLK", "XLF", "XLU",
            "XLY", "XLP", "XLI", "XLB", "XLV", "XLRE", "XLC"]


def catalog_from_frames(frames: dict[tuple[str, str], DataFrame]) -> DataFrame:
    """Catalog from tick DataFrames keyed by (source, data_type): one row per (date, symbol)."""
    out = None
    for (source, dtype), df in frames.items():
        c = (df.groupBy("trade_date", "symbol").agg(F.count(F.lit(1)).alias("n_rows"))
             .select(F.lit(source).alias("source"), F.lit(dtype).alias("data_type"), "trade_date", "symbol", "n_rows"))
        out = c if out is None else out.unionByName(c)
    return out


def lake_partitions(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """(trade_date, symbol, n_rows, n_files, n_bytes) of one dataset of a lake.

    Folders are listed and footers read by tasks. A dataset partitioned by date alone has
    its symbols in the files: only that column is counted. Bytes and files are then those
    of the date, and stand with each of its symbols.
    """
    files = partition_files(spark, root, dataset)
    per = [F.count(F.lit(1)).alias("n_files"), F.sum("n_bytes").alias("n_bytes")]
    by_symbol = (files.where(F.col("folder").contains("/symbol=")).groupBy("trade_date", "symbol")
                 .agg(F.sum("n_rows").alias("n_rows"), *per))
    by_date = files.where(~F.col("folder").contains("/symbol="))
    if not by_date.limit(1).count():
        return by_symbol
    read = spark.read.option("basePath", f"{root}/{dataset}").parquet(f"{root}/{dataset}")
    inside = read.groupBy("trade_date", clean_symbol_key("symbol").alias("symbol")).agg(F.count(F.lit(1)).alias("n_rows"))
    return inside.join(by_date.groupBy("trade_date").agg(*per), "trade_date").select(*by_symbol.columns)


def catalog_from_lake(spark: SparkSession, root: str, source: str, types: Sequence[str] = DATA_TYPES) -> DataFrame:
    """The catalog of a lake root ``{type}/trade_date=…/symbol=…``. A missing type
    folder has no partitions; a folder without rows is in the catalog with ``n_rows`` 0."""
    each = [lake_partitions(spark, root, t).select(F.lit(source).alias("source"), F.lit(t).alias("data_type"), "trade_date",
                                                   "symbol", "n_rows") for t in types]
    return reduce(DataFrame.unionByName, each)


def catalog_from_lakes(spark: SparkSession, roots: dict[str, str], types: Sequence[str] = DATA_TYPES) -> DataFrame:
    """The catalog of several sources, each with a lake root of its own."""
    return reduce(DataFrame.unionByName, (catalog_from_lake(spark, root, source, types) for source, root in roots.items()))


def date_range(lo: Column, hi: Column, weekdays_only: bool = False, col: str = "trade_date"):
    """``explode(sequence(lo, hi))`` as a column expression; pair with a filter."""
    return F.explode(F.sequence(lo, hi)).alias(col)


def is_weekday(c: str = "trade_date") -> Column:
    return F.weekday(F.col(c)) < 5


def requested_grid(symbols: DataFrame, dates_lo: Column, dates_hi: Column,
                   types: Sequence[str] = DATA_TYPES, weekdays_only: bool = True) -> DataFrame:
    """Requested symbol × trading day × type, generated per symbol row (no join)."""
    g = (symbols.select("symbol", F.explode(F.sequence(dates_lo, dates_hi)).alias("trade_date"))
         .withColumn("data_type", F.explode(F.array(*[F.lit(t) for t in types]))))
    return g.where(is_weekday()) if weekdays_only else g


def present(catalog: DataFrame, source: str | None = None) -> DataFrame:
    """Keys that have at least one row."""
    c = catalog.where(F.col("n_rows") > 0)
    if source is not None:
        c = c.where(F.col("source") == source)
    return c.select("source", "data_type", "trade_date", "symbol")


def ingestion_status(grid: DataFrame, catalog: DataFrame, source: str) -> DataFrame:
    """Requested (date, symbol, type) → ingested?"""
    p = present(catalog, source).drop("source").withColumn("_hit", F.lit(True))
    return (grid.join(p, ["trade_date", "symbol", "data_type"], "left")
            .select("trade_date", "symbol", "data_type", F.coalesce("_hit", F.lit(False)).alias("ingested")))


def missing(grid: DataFrame, catalog: DataFrame, source: str) -> DataFrame:
    """Requested minus present (anti join)."""
    p = present(catalog, source).drop("source")
    return grid.join(p, ["trade_date", "symbol", "data_type"], "left_anti")


MODES = ("normal", "resume", "overwrite")
FEEDS = ("warehouse", "rest", "csv")


def plan_work(requested: DataFrame, catalog: DataFrame, source: str, mode: str = "normal", feed: str = "warehouse",
              types: Sequence[str] | None = None) -> DataFrame:
    """The requested (trade_date, symbol, data_type) rows that an extract has to fetch.

    A warehouse fetches what is missing in normal and resume mode; REST and CSV feeds fetch
    everything unless they resume; overwriting fetches everything. Nothing missing gives no
    rows. ``types`` keeps only these data types of the request.
    """
    if mode not in MODES or feed not in FEEDS:
        raise ValueError(f"mode is one of {MODES}, feed one of {FEEDS}")
    asked = requested.select("trade_date", clean_symbol_key("symbol").alias("symbol"), "data_type").distinct()
    if types is not None:
        asked = asked.where(F.col("data_type").isin(*types))
    skips = mode == "resume" or (mode == "normal" and feed == "warehouse")
    return missing(asked, catalog, source) if skips else asked


def data_available(requests: DataFrame, catalog: DataFrame) -> DataFrame:
    """Requests (source, trade_date, symbol, data_type) plus ``available``. A NULL symbol
    asks for any symbol of that date; the data type asked for is the one looked at."""
    keys = ["source", "data_type", "trade_date"]
    have = present(catalog).distinct()
    named = requests.where(F.col("symbol").isNotNull()).join(have.withColumn("_hit", F.lit(True)), [*keys, "symbol"], "left")
    anyone = requests.where(F.col("symbol").isNull()).join(have.select(*keys).distinct().withColumn("_hit", F.lit(True)), keys, "left")
    out = [*requests.columns, F.coalesce("_hit", F.lit(False)).alias("available")]
    return named.select(*out).unionByName(anyone.select(*out))


def availability(symbols: DataFrame, dates_lo: Column, dates_hi: Column, sources: Sequence[str], catalog: DataFrame,
                 types: Sequence[str] = ("trades", "nbbo"), weekdays_only: bool = True) -> DataFrame:
    """Symbol × date × source × type → available?, generated per symbol row."""
    grid = requested_grid(symbols, dates_lo, dates_hi, types, weekdays_only)
    return data_available(grid.withColumn("source", F.explode(F.array(*map(F.lit, sources)))), catalog)


def common_sources(matrix: DataFrame) -> DataFrame:
    """Per date, source and type of an ``availability`` matrix: how many of its symbols
    are there, whether all, some or none, and which are missing (bounded by the request)."""
    hit = F.col("available")
    return (matrix.groupBy("trade_date", "source", "data_type")
            .agg(F.count_if(hit).alias("n_present"), F.count_if(~hit).alias("_n"),
                 F.sort_array(F.collect_list(F.when(~hit, F.col("symbol")))).alias("missing_symbols"))
            .select("trade_date", "source", "data_type", "n_present",
                    F.when(F.col("_n") == 0, F.lit("all")).when(F.col("n_present") > 0, F.lit("some")).otherwise(F.lit("none")).alias("status"),
                    "missing_symbols"))


def dates_with_data(dates: DataFrame, catalog: DataFrame, types: Sequence[str] = ("trades", "nbbo")) -> DataFrame:
    """Every requested date, ``kept`` if some symbol has data of ``types``, else ``removed``."""
    has = present(catalog).where(F.col("data_type").isin(*types)).select("trade_date").distinct().withColumn("_hit", F.lit(True))
    return (dates.select("trade_date").distinct().join(has, "trade_date", "left")
            .select("trade_date", F.when(F.col("_hit"), F.lit("kept")).otherwise(F.lit("removed")).alias("status")))


def best_type(catalog: DataFrame, prefer: Sequence[str] = ("trades", "nbbo")) -> DataFrame:
    """Per source and date the first of ``prefer`` that it has: (source, trade_date, data_type)."""
    rank = F.array_position(F.array(*map(F.lit, prefer)), F.col("data_type"))
    have = present(catalog).where(F.col("data_type").isin(*prefer))
    return have.groupBy("source", "trade_date").agg(F.min_by("data_type", rank).alias("data_type"))


def symbols_on_all_dates(catalog: DataFrame, dates: DataFrame, prefer: Sequence[str] = ("trades", "nbbo")) -> DataFrame:
    """Symbols that some source has on every one of ``dates`` (relational division),
    looked up in each source's preferred type of the date."""
    days = dates.select("trade_date").distinct()
    found = (present(catalog).join(best_type(catalog, prefer), ["source", "trade_date", "data_type"], "left_semi")
             .join(days, "trade_date", "left_semi").select("trade_date", "symbol").distinct())
    return (found.groupBy("symbol").agg(F.count(F.lit(1)).alias("_n"))
            .where(F.col("_n") == days.agg(F.count(F.lit(1))).scalar()).select("symbol"))


def coverage_rank(catalog: DataFrame, symbols: DataFrame, prefer: Sequence[str] = ("trades", "nbbo")) -> DataFrame:
    """Sources by how many of ``symbols`` they have (in their preferred types); ``has_all``
    where a source has every one that any source has. One row per source."""
    asked, have = symbols.select("symbol").distinct(), present(catalog)
    found = (have.join(best_type(catalog, prefer), ["source", "trade_date", "data_type"], "left_semi")
             .join(asked, "symbol", "left_semi").groupBy("source").agg(F.count_distinct("symbol").alias("n_symbols")))
    known = asked.join(have.select("symbol").distinct(), "symbol", "left_semi").agg(F.count(F.lit(1))).scalar()
    place = F.row_number().over(Window.orderBy(F.desc("n_symbols"), "source")).cast("long")
    return found.withColumn("has_all", F.col("n_symbols") == known).withColumn("rank", place)


def suggest_alternatives(catalog: DataFrame, source: str, data_type: str, target: Column, max_days_away: int = 30,
                         recent: int = 10) -> DataFrame:
    """What to look at instead of ``source`` on ``target``: its closest date with data of
    the type, its newest dates, and the closest date of every other source (the same date
    where that source has it). (kind, source, suggested_date)."""
    have = present(catalog).where(F.col("data_type") == data_type).select("source", "trade_date").distinct()
    far = F.abs(F.datediff("trade_date", target))
    closest = (have.where(far <= max_days_away).groupBy("source")
               .agg(F.min_by("trade_date", F.struct(far, -F.unix_date("trade_date"))).alias("suggested_date")))
    mine = F.col("source") == source
    newest = have.where(mine).orderBy(F.desc("trade_date")).limit(recent)
    return (closest.select(F.when(mine, F.lit("closest_date")).otherwise(F.lit("alternative_source")).alias("kind"), "source", "suggested_date")
            .unionByName(newest.select(F.lit("available_date").alias("kind"), "source", F.col("trade_date").alias("suggested_date"))))


def closest_dates(available: DataFrame, targets: DataFrame, keys: Sequence[str],
                  max_days_away: int = 30, recent_cap: int | None = None) -> DataFrame:
    """Per key and target date, the available date at the least day distance
    (≤ max_days_away); ties go to the later date.

    A band join written as an equi-join: each available date is exploded to the
    ≤ 2·max_days_away+1 target dates it can serve, so fan-out is bounded.
    ``recent_cap`` keeps only the newest N available dates per key (reference rule).
    """
    keys = list(keys)
    av = available.select(*keys, F.col("trade_date").alias("avail_date")).distinct()
    if recent_cap is not None:
        w = Window.partitionBy(*keys).orderBy(F.desc("avail_date"))
        av = av.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= recent_cap).drop("_r")
    fan = av.withColumn("target_date", F.explode(F.sequence(F.date_sub("avail_date", max_days_away),
                                                            F.date_add("avail_date", max_days_away))))
    j = targets.select(*keys, "target_date").join(fan, [*keys, "target_date"])
    j = j.withColumn("distance", F.abs(F.datediff("avail_date", "target_date")).cast("long"))
    return (j.groupBy(*keys, "target_date")
            .agg(F.min_by("avail_date", F.struct(F.col("distance"), -F.unix_date("avail_date"))).alias("closest_date"),
                 F.min("distance").alias("distance")))


def index_members_asof(names: DataFrame, members: DataFrame, asof: str) -> DataFrame:
    """Tickers whose name record and membership both contain ``asof`` (open end = NULL)."""
    d = F.lit(asof).cast("date")
    m = members.where((F.col("start") <= d) & (F.col("ending").isNull() | (F.col("ending") >= d)))
    n = names.where((F.col("namedt") <= d) & (F.col("nameendt") >= d) & F.col("ticker").isNotNull())
    return n.join(m, "permno").select("ticker").distinct()


def source_availability(catalog: DataFrame, dates: DataFrame | None = None,
                        types: Sequence[str] = ("trades", "nbbo"), preferred: str = "taq") -> DataFrame:
    """C20: per source, does any (requested) date have trades or NBBO; the default source
    is the preferred one when available, else the first available by name."""
    c = present(catalog).where(F.col("data_type").isin(*types))
    if dates is not None:
        c = c.join(dates.select("trade_date").distinct(), "trade_date", "left_semi")
    per = c.groupBy("source").agg(F.count_distinct("trade_date").alias("n_dates"))
    # one row per known source (bounded by the source registry), available or not
    per = catalog.select("source").distinct().join(per, "source", "left").fillna(0, ["n_dates"])
    avail = F.col("n_dates") > 0
    order = Window.orderBy((~avail).cast("int"), (F.col("source") != preferred).cast("int"), "source")
    return (per.withColumn("available", avail)
            .withColumn("is_default", avail & (F.row_number().over(order) == 1)))
