"""Query registry: name → (Spark callable, DuckDB oracle SQL or None).

Queries are whole-table reports over the fixture views; floating columns are
rounded to 6 decimals on both sides so the driver's value hash is stable.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.plans.views_sql import with_views

DIGITS = 6
# Values on exact rounding ties (fixture prices are multiples of 2e-5) would round
# either way depending on the last ulp of the summation order; a tiny common nudge
# applied on both sides moves them off the tie.
NUDGE = 1e-9


@dataclass
class Query:
    name: str
    fn: Callable[[SparkSession, str], DataFrame]
    sql: str | None
    ids: str = ""
    tags: list = field(default_factory=list)


REGISTRY: dict[str, Query] = {}


def round_doubles(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    """Round every DOUBLE/FLOAT column (including inside nothing else)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            cols.append(F.round(F.col(f"`{f.name}`") + F.lit(NUDGE), digits).alias(f.name))
        else:
            cols.append(F.col(f"`{f.name}`"))
    return df.select(*cols)


def oracle(body: str, dbl: list[str] | tuple = (), ctes: dict | None = None) -> str:
    """DuckDB SQL: fixture CTEs + ``ctes`` + ``body``, with ``dbl`` columns rounded."""
    if dbl:
        rep = ", ".join(f"round({c} + {NUDGE}, {DIGITS}) as {c}" for c in dbl)
        body = f"select * replace ({rep}) from (\n{body.strip()}\n) _r"
    return with_views(body, ctes)


def query(name: str, sql: str | None = None, ids: str = "", tags=()):
    """Decorator: register ``fn(spark, sf_dir) -> DataFrame`` under ``name``."""
    def deco(fn):
        def run(spark, sf_dir):
            return round_doubles(fn(spark, sf_dir))
        run.__name__ = fn.__name__
        run.__doc__ = fn.__doc__
        REGISTRY[name] = Query(name, run, sql, ids, list(tags))
        return fn
    return deco
