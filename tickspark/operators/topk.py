"""Top-k reports.

Global top-k is ``orderBy(...).limit(k)`` (TakeOrderedAndProject: each task keeps
k rows, the driver merges k × tasks). Per-group top-k is ``row_number() <= k``
over a partitioned window, which Spark runs as a WindowGroupLimit before the
shuffle. Every ordering carries a unique tie key so results are deterministic.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_k(df: DataFrame, k: int, order: Sequence, key: str, value: Column, board: str) -> DataFrame:
    """Tagged global top-k: ``(board, rank, key, value)``."""
    top = df.orderBy(*order).limit(k)
    return top.select(F.lit(board).alias("board"),
                      F.row_number().over(Window.orderBy(*order)).cast("long").alias("rank"),
                      F.col(key), value.alias("value"))


def top_k_per_group(df: DataFrame, k: int, keys: Sequence[str], order: Sequence,
                    rank_col: str = "rank") -> DataFrame:
    """Rows ranked ``1..k`` within each ``keys`` group."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn(rank_col, F.row_number().over(w).cast("long")).where(F.col(rank_col) <= k)


def leaderboards(boards: dict[str, tuple[DataFrame, str]], key: str, k: int) -> DataFrame:
    """(board, rank, key, value): the ``k`` largest of each board's measure, ties by ``key``.

    ``boards``: name -> (table, measure). Measures of one table are taken from a single
    evaluation of it, and each board keeps ``k`` rows a task before the shuffle."""
    by_table: dict[int, tuple[DataFrame, list]] = {}
    for name, (df, measure) in boards.items():
        by_table.setdefault(id(df), (df, []))[1].append((name, measure))
    long = None
    for df, measures in by_table.values():
        each = F.explode(F.array(*(F.struct(F.lit(n).alias("board"), F.col(m).cast("long").alias("value")) for n, m in measures)))
        part = df.select(F.col(key), each.alias("_b")).select("_b.board", key, "_b.value")
        long = part if long is None else long.unionByName(part)
    return top_k_per_group(long, k, ["board"], [F.desc("value"), key]).select("board", "rank", key, "value")


def largest(trades: DataFrame, k: int, keys: Sequence[str], size: str = "size", order: Sequence = ("ts_event", "tr_seqnum")) -> DataFrame:
    """The ``k`` largest trades of each group; the first ``k`` where there is no size column."""
    first = [F.desc_nulls_last(size)] if size in trades.columns else []
    return top_k_per_group(trades, k, keys, [*first, *order])
