"""Warehouse extracts (S9–S12): daily TAQ tables read through Spark's JDBC source.

``read_daily_table`` partitions the JDBC read by symbol ranges so executors fetch in
parallel; the extract filters are DataFrame predicates, which the JDBC source
pushes into the remote SQL. The filter functions apply to any DataFrame with the
warehouse columns: ``time_m`` as TIME, text or timestamp, or micros of the day in
``time_m_us``. ``resolve_tables`` finds where a day's tables are from a table list.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions.columns import SESSION_CLOSE_US, SESSION_OPEN_US, col
from tickspark.functions.filters import regular_trade, valid_nbbo, valid_quote
from tickspark.functions.times import with_time_micros
from tickspark.operators.symbols import keep_symbols, symbol_ranges

#: Names of the daily tables and the schemas they are looked for in, in order.
TABLES = {"trades": "ctm_{d}", "quotes": "cqm_{d}", "nbbo": "complete_nbbo_{d}"}
SCHEMAS = ("taqm_{y}", "taqmsec")


def read_daily_table(spark: SparkSession, url: str, schema: str, data_type: str, trade_date,
                     symbol_bounds: Sequence[str] = (), props: dict | None = None, symbols: Sequence[str] = (),
                     tasks: int = 16) -> DataFrame:
    """One daily table, read by ``len(symbol_bounds)+1`` parallel range predicates. Without
    bounds, ``symbols`` (say the requested ones) give them; every row is in one range."""
    table = f"{schema}." + TABLES[data_type].format(d=str(trade_date).replace("-", ""))
    return spark.read.jdbc(url, table, predicates=range_predicates(symbol_bounds or symbol_ranges(symbols, tasks)), properties=props or {})


def range_predicates(bounds: Sequence[str]) -> list[str] | None:
    """SQL conditions that cut ``sym_root`` at the bounds; NULL is in the first range."""
    b = ["'" + str(x).replace("'", "''") + "'" for x in bounds]
    if not b:
        return None
    return ([f"sym_root < {b[0]} OR sym_root IS NULL"] + [f"sym_root >= {x} AND sym_root < {y}" for x, y in zip(b, b[1:])]
            + [f"sym_root >= {b[-1]}"])


def daily_tables(requests: DataFrame, schemas: Sequence[str] = SCHEMAS) -> DataFrame:
    """Requests (trade_date, data_type) → candidates (schema, table, rank), in the order to try."""
    d, y = F.date_format("trade_date", "yyyyMMdd"), F.date_format("trade_date", "yyyy")
    name = F.lit(None).cast("string")
    for kind, pattern in TABLES.items():
        name = F.when(F.col("data_type") == kind, F.replace(F.lit(pattern), F.lit("{d}"), d)).otherwise(name)
    tries = F.array(*(F.struct(F.replace(F.lit(s), F.lit("{y}"), y).alias("schema"), F.lit(k).alias("rank")) for k, s in enumerate(schemas)))
    return requests.select("trade_date", "data_type", name.alias("table"), F.explode(tries).alias("_t")).select(
        "trade_date", "data_type", "table", "_t.schema", "_t.rank")


def resolve_tables(requests: DataFrame, listing: DataFrame, schemas: Sequence[str] = SCHEMAS) -> DataFrame:
    """Each request with the first schema that has its table, NULL where none has it.

    ``listing``: (schema, table), e.g. of an information schema; names compare without case."""
    have = listing.select(F.lower("schema").alias("schema"), F.lower("table").alias("table")).distinct()
    found = (daily_tables(requests.select("trade_date", "data_type").distinct(), schemas).join(have, ["schema", "table"])
             .groupBy("trade_date", "data_type").agg(F.min_by("schema", "rank").alias("schema"), F.min_by("table", "rank").alias("table")))
    return requests.join(found, ["trade_date", "data_type"], "left").select(*requests.columns, "schema", "table")


def in_session_us(time_us: str = "time_m_us"):
    """F2 on a micros-of-day column: 09:30:00 ≤ t ≤ 16:00:00 (both inclusive)."""
    return col(time_us).between(F.lit(SESSION_OPEN_US), F.lit(SESSION_CLOSE_US))


def _extract(df: DataFrame, valid, symbols, time_us: str, sym_col: str) -> DataFrame:
    rows = with_time_micros(df)
    return keep_symbols(rows.where(valid & in_session_us(time_us)), symbols, sym_col)


def extract_trades(df: DataFrame, symbols=None, time_us: str = "time_m_us", sym_col: str = "sym_root") -> DataFrame:
    """Regular trades (F1) in session (F2) for the symbols (F8)."""
    return _extract(df, regular_trade(), symbols, time_us, sym_col)


def extract_quotes(df: DataFrame, symbols=None, time_us: str = "time_m_us", sym_col: str = "sym_root") -> DataFrame:
    """Strictly valid quotes (F4) in session (F2) for the symbols (F8)."""
    return _extract(df, valid_quote(), symbols, time_us, sym_col)


def extract_nbbo(df: DataFrame, symbols=None, time_us: str = "time_m_us", sym_col: str = "sym_root") -> DataFrame:
    """Valid NBBO, locked allowed (F5), in session (F2) for the symbols (F8)."""
    return _extract(df, valid_nbbo(), symbols, time_us, sym_col)


def dates_with_all_types(tables: DataFrame, types: Sequence[str] = ("trades", "quotes", "nbbo"), keys: Sequence[str] = ()) -> DataFrame:
    """``tables`` (keys, trade_date, data_type), e.g. resolved ones → dates having every type."""
    t = tables.where(F.col("data_type").isin(*types))
    return (t.groupBy(*keys, "trade_date").agg(F.count_distinct("data_type").alias("_n"))
            .where(F.col("_n") == len(types)).select(*keys, "trade_date"))
