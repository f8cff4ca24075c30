"""Operator 11: prefix trie of conversations by whole-sequence collapse.

1. Turns are placed by number; a conversation may open with turns of another one.
2. Conversations that are equal from start to end collapse into one sequence with a
   weight, a representative (smallest id) and the list of the ids that end there.
3. Only representatives are cut into prefixes. A sequence that is a proper prefix of
   another one is dropped by an anti join: those left end in the trie's leaves.
4. Weighted prefixes are aggregated to nodes. What is summed over a subtree goes up
   through each node's owner (the representative that is its smallest member): along
   the owner's own prefixes by a running sum, then over the owners of a node's prefix.

A prefix is known by its depth and 128 bits: the exclusive or of hashes of (place, turn
digest), so that running and partial sums meet in any order. Conversations of any length
are cut in blocks of ``BLOCK`` turns for windows and joins, ends are collected by ranges
of 256 ids, and a node's end list is hashed as a stream. The join of nodes with their
parents is left to adaptive skew splitting.

Defined cases: a null role or text is empty; turns with equal numbers are ordered by the
MD5 of the role's length, role and text; rows without a conversation id are in no
conversation; repeated rows are turns of their own; other columns are ignored; an empty
table has no nodes, not even a root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tickspark.llm.common import stored
from tickspark.operators.ranking import ranked

BLOCK = 1024
ID_RANGE = 8  # ends are collected by ranges of 2**8 ids
NODE = ["depth", "ka", "kb"]


def _blocks(n: Column) -> Column:
    """0 to the number of the block that holds row n - 1; none if n is 0."""
    return F.explode(F.when(n > 0, F.sequence(F.lit(0).cast("long"), F.floor((n - 1) / BLOCK))).otherwise(F.array().cast("array<bigint>")))


def placed_turns(turns: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """conv_id, pos (0-based), turns (the conversation's number of turns), digest, chars."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in (role_col, text_col))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text).cast("binary"))
    slim = turns.select(F.col(conv_col).cast("long").alias("conv_id"), F.col(turn_col).alias("turn"), digest.alias("digest"),
                        F.char_length(text).cast("long").alias("chars")).where("conv_id is not null")
    at = ranked(slim, ["conv_id"], [F.col("turn").asc_nulls_first(), F.col("digest")], rank="pos", size="turns", name="trie-order")
    return stored(at.select("conv_id", "pos", "turns", "digest", "chars"), "trie-turns")


def opened_by(placed: DataFrame, opener: Column, head: Column, most: int) -> tuple[DataFrame, DataFrame]:
    """Conversations that open with the first ``head`` turns of conversation ``opener`` (both
    of ``conv_id``; head at most ``most``) and go on with their own turns after the first
    ``head``: (conv_id, pos, digest, chars) and (conv_id, length)."""
    convs = placed.where("pos = 0").select("conv_id", "turns", opener.alias("opener"), head.cast("long").alias("cut"))
    sizes = convs.select(F.col("conv_id").alias("opener"), F.col("turns").alias("there"))
    info = stored(convs.join(sizes, "opener", "left").select(
        "conv_id", "opener", "cut", F.least("cut", F.coalesce("there", F.lit(0))).alias("head"), "turns")
        .withColumn("length", F.col("head") + F.greatest(F.col("turns") - F.col("cut"), F.lit(0))), "trie-convs")
    first = placed.where(F.col("pos") < most).select(F.col("conv_id").alias("opener"), "pos", "digest", "chars")
    heads = info.where("head > 0").select("conv_id", "opener", "head").join(first, "opener").where("pos < head")
    block = F.floor(F.col("pos") / BLOCK)
    own = placed.withColumn("block", block).drop("turns").join(
        info.select("conv_id", "cut", "head", _blocks(F.col("turns")).alias("block")), ["conv_id", "block"]).where("pos >= cut")
    rows = heads.select("conv_id", "pos", "digest", "chars").unionByName(
        own.select("conv_id", (F.col("pos") - F.col("cut") + F.col("head")).alias("pos"), "digest", "chars"))
    return rows, info.select("conv_id", "length")


def running(rows: DataFrame, key: str, order: str, totals: dict, descending: bool = False) -> DataFrame:
    """Running aggregates of ``rows`` along ``order`` within ``key``, this row included.

    ``totals``: new column -> (aggregate function, column, merge of two values). Each
    block of BLOCK places is summed alone; one row per block carries what lies before it.
    """
    def along(col):
        return F.col(col).desc() if descending else F.col(col).asc()

    block = rows.withColumn("__block", F.floor(F.col(order) / BLOCK))
    inside = Window.partitionBy(key, "__block").orderBy(along(order)).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy(along("__block")).rowsBetween(Window.unboundedPreceding, -1)
    sums = block.groupBy(key, "__block").agg(*(f(c).alias(f"__t_{n}") for n, (f, c, _) in totals.items()))
    carried = sums.select(key, "__block", *(F.coalesce(f(f"__t_{n}").over(before), F.lit(0)).alias(f"__b_{n}")
                                            for n, (f, _, _) in totals.items()))
    out = block.select("*", *(f(c).over(inside).alias(f"__i_{n}") for n, (f, c, _) in totals.items())).join(carried, [key, "__block"])
    return out.select(*rows.columns, *(merge(F.col(f"__i_{n}"), F.col(f"__b_{n}")).alias(n) for n, (_, _, merge) in totals.items()))


def _turn_keys() -> list[Column]:
    return [F.xxhash64(F.lit(seed), "pos", "digest").alias(n) for seed, n in ((0x51ED, "a"), (0xC0DE, "b"))]


def _xor(x: Column, y: Column) -> Column:
    return x.bitwiseXOR(y)


def _plus(x: Column, y: Column) -> Column:
    return x + y


def collapse(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """(conv_id, depth, ka, kb): the whole sequence of every conversation as one node key."""
    whole = rows.select("conv_id", *_turn_keys()).groupBy("conv_id").agg(F.bit_xor("a").alias("ka"), F.bit_xor("b").alias("kb"))
    return lengths.join(whole, "conv_id", "left").select(
        "conv_id", F.col("length").alias("depth"), *(F.coalesce(k, F.lit(0)).alias(k) for k in ("ka", "kb")))


def _hash_streams(batches):
    """Joined id lists, sorted by node and id range -> SHA-256 of each node's whole list."""
    now, state = None, None
    for batch in batches:
        done = []
        *keys, parts = (batch.column(k).to_pylist() for k in (0, 1, 2, 4))
        for node, part in zip(zip(*keys), parts):
            if node != now:
                if now is not None:
                    done.append((*now, state.hexdigest()))
                now, state = node, hashlib.sha256(part.encode())
            else:
                state.update(b"," + part.encode())
        yield _ends_batch(done)
    if now is not None:
        yield _ends_batch([(*now, state.hexdigest())])


def _ends_batch(rows: list) -> pa.RecordBatch:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(types)], [*NODE, "ends_sha256"])


def end_lists(whole: DataFrame) -> DataFrame:
    """Per sequence the SHA-256 of its ids in numeric order, joined by commas."""
    parts = (whole.groupBy(*NODE, F.shiftright("conv_id", ID_RANGE).alias("ids"))
             .agg(F.concat_ws(",", F.sort_array(F.collect_list("conv_id")).cast("array<string>")).alias("part")))
    return (parts.repartition(*NODE).sortWithinPartitions(*NODE, "ids")
            .mapInArrow(_hash_streams, "depth long, ka long, kb long, ends_sha256 string"))


def trie(rows: DataFrame, lengths: DataFrame) -> DataFrame:
    """The nodes of the trie of conversations given as (conv_id, pos, digest, chars) rows and
    (conv_id, length): conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    rows = stored(rows, "trie-rebuilt")
    whole = stored(collapse(rows, lengths), "trie-whole")
    sequences = stored(whole.groupBy(*NODE).agg(F.count(F.lit(1)).alias("weight"), F.min("conv_id").alias("rep")), "trie-sequences")
    # Prefixes of the representatives only, depth 0 included.
    mine = sequences.select("rep", "weight", F.col("depth").alias("length"), _blocks(F.col("depth")).alias("block"))
    kept = (rows.withColumn("block", F.floor(F.col("pos") / BLOCK)).withColumnRenamed("conv_id", "rep").join(mine, ["rep", "block"])
            .select("rep", (F.col("pos") + 1).alias("depth"), "chars", "weight", "length", *_turn_keys()))
    zero = F.lit(0).cast("long")
    roots = sequences.select("rep", zero.alias("depth"), zero.alias("chars"), "weight", F.col("depth").alias("length"),
                             zero.alias("a"), zero.alias("b"))
    chains = running(kept.unionByName(roots), "rep", "depth", {"ka": (F.bit_xor, "a", _xor), "kb": (F.bit_xor, "b", _xor)})
    chains = stored(chains.withColumn("pa", _xor(F.col("ka"), F.col("a"))).withColumn("pb", _xor(F.col("kb"), F.col("b")))
                    .drop("a", "b"), "trie-chains")
    proper = chains.where("depth < length").select(*NODE).distinct()
    leaves = sequences.join(proper, NODE, "left_anti").select("rep", "depth", zero.alias("saved"), F.lit(1).cast("long").alias("leaf"))
    nodes = stored(chains.groupBy(*NODE).agg(F.sum("weight").alias("n_convs"), F.min("rep").alias("conv_id"), F.max("chars").alias("chars"),
                                             F.max("pa").alias("pa"), F.max("pb").alias("pb")), "trie-nodes")
    own = nodes.select(F.col("conv_id").alias("rep"), "depth", ((F.col("n_convs") - 1) * F.col("chars")).alias("saved"), zero.alias("leaf"))
    own = own.unionByName(leaves).groupBy("rep", "depth").agg(F.sum("saved").alias("saved"), F.sum("leaf").alias("leaf"))
    along = (chains.select("rep", *NODE).join(own, ["rep", "depth"], "left")
             .withColumns({c: F.coalesce(c, zero) for c in ("saved", "leaf")}))
    up = running(along, "rep", "depth", {"all_saved": (F.sum, "saved", _plus), "all_leaves": (F.sum, "leaf", _plus)}, descending=True)
    parts = [nodes.select(*NODE, "conv_id", "n_convs"),
             up.select(*NODE, F.col("all_saved").alias("saved_tokens"), F.col("all_leaves").alias("n_leaves")),
             nodes.where("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("pa").alias("ka"), F.col("pb").alias("kb"),
                                             F.lit(1).cast("long").alias("n_children")),
             end_lists(whole)]
    every = parts[0]
    for part in parts[1:]:
        every = every.unionByName(part, allowMissingColumns=True)
    every = every.groupBy(*NODE).agg(F.max("conv_id").alias("conv_id"), F.max("n_convs").alias("n_convs"), *(
        F.coalesce(F.sum(c), zero).alias(c) for c in ("n_children", "n_leaves", "saved_tokens")),
        F.coalesce(F.max("ends_sha256"), F.sha2(F.lit(""), 256)).alias("ends_sha256"))
    parents = nodes.where("depth > 0").select(*NODE, (F.col("depth") - 1).alias("pd"), "pa", "pb").join(
        nodes.select(F.col("depth").alias("pd"), F.col("ka").alias("pa"), F.col("kb").alias("pb"),
                     F.col("conv_id").alias("parent_conv_id")), ["pd", "pa", "pb"]).select(*NODE, "parent_conv_id")
    return every.join(parents, NODE, "left").select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves",
                                                    "saved_tokens", "ends_sha256")


def conversation_trie(turns: DataFrame, opener: Column, head: Column, most: int, conv_col: str = "conv_id", turn_col: str = "turn",
                      role_col: str = "role", text_col: str = "text") -> DataFrame:
    """The trie of the conversations in ``turns``, each opened by the first ``head`` turns of
    conversation ``opener`` (expressions on ``conv_id``; see ``opened_by``)."""
    rows, lengths = opened_by(placed_turns(turns, conv_col, turn_col, role_col, text_col), opener, head, most)
    return trie(rows, lengths)
