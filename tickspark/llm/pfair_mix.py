"""Operator 10: mixing sources to target weights by Pfair scheduling.

A source's documents, in a hashed order, are cut into blocks of ``block_chars``
characters. Target weights become whole shares a of a period P. Block i of a source
is released at floor(i P / a) and due by ceil((i + 1) P / a); serving in each slot the
released block of the earliest deadline meets every deadline, so at any time t each
source that still has blocks was served between t a / P - 1 and t a / P + 1 times.
The schedule repeats every P slots: only one period is computed, as a table of P rows
whatever the size of the data, and joined: block i is served at slot
(i div a) P + slot of (i mod a). A source that has run out leaves its slots empty;
the order of the rest, and with it their proportion, stays. No document is dropped
or repeated.

Defined cases: a null source is a source of its own; null and empty texts count one
character; repeated rows each have a place; sources without a given weight get the
least one; an empty table gives an empty result. Clashing column names are kept.
"""

from __future__ import annotations

import heapq

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickspark.llm.common import stored

BLOCK_CHARS = 65_536
BUCKET_ROWS = 512
#: The period is the least power of two with this many slots per source.
SLOTS_PER_SOURCE = 32
MAX_SOURCES = 65_536
#: Without given weights: shares of all characters to this power.
TEMPER = 0.5
_NULL_SOURCE = "\u0000null"


def shares(weights: dict[str, float], slots_per_source: int = SLOTS_PER_SOURCE) -> dict[str, int]:
    """Whole shares, each at least one, that sum to the period, by largest remainder."""
    if not weights:
        return {}
    period = 1 << (max(1, slots_per_source * len(weights)) - 1).bit_length()
    total = sum(weights.values()) or 1.0
    exact = {s: max(1.0, w / total * period) for s, w in weights.items()}
    scale = (period - len(exact)) / max(1e-12, sum(x - 1.0 for x in exact.values()))
    exact = {s: 1.0 + (x - 1.0) * scale for s, x in exact.items()}
    out = {s: int(x) for s, x in exact.items()}
    rest = sorted(exact, key=lambda s: (out[s] - exact[s], s))
    for k in range(period - sum(out.values())):
        out[rest[k % len(rest)]] += 1
    return out


def one_period(whole: dict[str, int]) -> list[tuple[str, int, int, int, int]]:
    """(source, block of the period, release, deadline, slot), earliest deadline first."""
    period = sum(whole.values())
    waiting = [(0, -(-period // a), s, 0) for s, a in sorted(whole.items())]
    heapq.heapify(waiting)
    ready: list[tuple[int, str, int, int]] = []
    out = []
    for slot in range(period):
        while waiting and waiting[0][0] <= slot:
            release, due, s, i = heapq.heappop(waiting)
            heapq.heappush(ready, (due, s, i, release))
        due, s, i, release = heapq.heappop(ready)
        out.append((s, i, release, due, slot))
        if i + 1 < whole[s]:
            a = whole[s]
            heapq.heappush(waiting, ((i + 1) * period // a, -(-(i + 2) * period // a), s, i + 1))
    return out


def schedule(docs: DataFrame, weights: dict[str, float] | None = None, id_col: str = "doc_id", text_col: str = "text",
             source_col: str = "source", block_chars: int = BLOCK_CHARS, bucket_rows: int = BUCKET_ROWS,
             slots_per_source: int = SLOTS_PER_SOURCE) -> DataFrame:
    """``docs`` with __source, __start (characters of its source before it), __block,
    __release, __deadline, __slot and __weight (share a of the period)."""
    spark = docs.sparkSession
    size = F.greatest(F.coalesce(F.length(F.col(text_col).cast("string")), F.lit(0)), F.lit(1)).cast("long")
    place = F.xxhash64(F.col(id_col).cast("string"), F.lit("mix"))
    rows = docs.withColumns({"__source": F.coalesce(F.col(source_col).cast("string"), F.lit(_NULL_SOURCE)), "__size": size,
                             "__place": place})
    count, total = rows.agg(F.count("*"), F.coalesce(F.sum("__size"), F.lit(0))).first()
    buckets = max(1, -(-count // bucket_rows))
    rows = rows.withColumn("__bucket", F.pmod("__place", F.lit(buckets)))
    sums = stored(rows.groupBy("__source", "__bucket").agg(F.sum("__size").alias("chars")), "mix-sums")
    by_source = sums.groupBy("__source").agg(F.sum("chars").alias("chars"))
    if by_source.count() > MAX_SOURCES:
        raise ValueError(f"more than {MAX_SOURCES} sources: name coarser ones")
    known = {r["__source"]: float(r["chars"]) for r in by_source.collect()}
    if weights is None:
        target = {s: (c / total) ** TEMPER for s, c in known.items()}
    else:
        named = {_NULL_SOURCE if s is None else s: w for s, w in weights.items()}
        target = {s: named.get(s, 0.0) for s in known}
    whole = shares(target, slots_per_source)
    period = sum(whole.values())
    table = spark.createDataFrame([(s, i, r, d, t, whole[s]) for s, i, r, d, t in one_period(whole)],
                                  "__source string, __nth long, __r long, __d long, __t long, __weight long")
    before = W.partitionBy("__source").orderBy("__bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = sums.select("__source", "__bucket", F.coalesce(F.sum("chars").over(before), F.lit(0)).alias("__before"))
    inside = W.partitionBy("__source", "__bucket").orderBy("__place", F.col(id_col), F.xxhash64(F.col(text_col).cast("string")))
    run = F.sum("__size").over(inside.rowsBetween(W.unboundedPreceding, 0)) - F.col("__size")
    placed = rows.withColumn("__run", run).join(offsets, ["__source", "__bucket"]).withColumn("__start", F.col("__before") + F.col("__run"))
    block = F.floor(F.col("__start") / block_chars)
    # One row per source, at most MAX_SOURCES.
    counts = F.broadcast(spark.createDataFrame(sorted(whole.items()), "__source string, __a long"))
    cut = placed.withColumn("__block", block).join(counts, "__source")
    # The period's table has slots_per_source rows for each of at most MAX_SOURCES sources.
    cut = cut.withColumn("__nth", F.col("__block") % F.col("__a")).join(F.broadcast(table), ["__source", "__nth"])
    turn = F.floor(F.col("__block") / F.col("__weight")) * period
    return cut.select(*docs.columns, F.when(F.col("__source") != _NULL_SOURCE, F.col("__source")).alias("__source"), "__start",
                      "__block", (turn + F.col("__r")).alias("__release"), (turn + F.col("__d")).alias("__deadline"),
                      (turn + F.col("__t")).alias("__slot"), "__weight")


def mix(docs: DataFrame, **args) -> DataFrame:
    """All rows of ``docs``, columns unchanged, range-partitioned and sorted in the
    order of the schedule, so that a file written from it is read in mixed order."""
    names = {c: f"mix{k}" for k, c in enumerate(docs.columns)}  # no name of ours can clash with these
    own = {k: names[args.pop(k, default)] for k, default in (("id_col", "doc_id"), ("text_col", "text"), ("source_col", "source"))}
    placed = schedule(docs.toDF(*names.values()), **own, **args)
    ordered = placed.repartitionByRange("__slot", "__start").sortWithinPartitions("__slot", "__start")
    return ordered.select(*(F.col(n).alias(c) for c, n in names.items()))
