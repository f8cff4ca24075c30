"""Operator 7: near-duplicate classes by Order MinHash and banded alignment.

A text is its sequence of five-word shingles. One sketch takes the few of least hash and
keeps them in text order, so two texts share a sketch only where they agree in content
and in order. ``labelled`` sketches are over occurrence-labelled shingles (the k-th
occurrence of one is another than its first); the others are over the distinct
shingles at their first places, the sequence that is aligned in the end, so that texts
which repeat a passage a different number of times meet as well.

1. Equal word sequences fall together under one representative.
2. Representatives with an equal sketch meet in a bucket, whose first and last members
   in random orders of its own lead it, so a text meets other texts in other buckets
   and pairs grow with the members, never with their square. First each text is
   paired with the leader it meets most often.
3. Then texts meet in finer buckets of two equal neighbouring sketches, where only the
   closer ones of a large group do, and each is paired with the first and last members
   in ORDERS random orders that are of another class yet. A pair that shares fewer than
   ``min_shared`` of all sketches is left out (at similarity 0.8 that happens about once
   in 80,000 pairs). One byte of each sketch travels with the members, so those pairs are
   never made; equal sketches have equal bytes, so none is lost by it, and unequal ones
   that agree in that byte only add a pair to verify.
4. What leaders may have missed is searched exactly: rows that share ``min_shared`` or
   more buckets with other classes meet on their rarest shingles. At similarity 0.8 two
   texts have a shingle in common among the rarest fifth of each, whatever the order of
   rarity (prefix filter), so no pair of two such rows is lost, however large their group.
5. Pairs are verified by alignment: the longest common subsequence of the a and b
   distinct shingles inside a diagonal band, m, gives m / (a + b - m) >= 0.8.
6. Classes are the connected components of verified pairs. ``n_links`` counts the
   verified pairs that were tried: texts of one class are not all aligned with each other.

Defined cases: a null text or one without words is like all such texts: they form one
class of empty texts; a text under five words is one shingle; repeated rows and equal
ids are told apart by a row number; empty tables give empty results.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import among, hashed_words, mix64, numbered, shingles, sliced, stored
from tickspark.operators.ranking import fresh

SHINGLE_WORDS = 5
SIMILARITY = 0.8
SKETCHES, LABELLED, PER_SKETCH, MIN_SHARED = 24, 8, 3, 3
ORDERS = 1
SLOTS = 1 << 20  # counters of how often a shingle occurs, which order shingles by rarity
BAND = 0.25  # of the longer text: how far apart matching positions may lie
_SEEDS = mix64(np.arange(1, 1025, dtype=np.uint64) * np.uint64(0xD1342543DE82EF95))


def sketch(keys: np.ndarray, sketches: int, per_sketch: int) -> np.ndarray:
    """Order-MinHash values of distinct shingle hashes in text order."""
    n = len(keys)
    out = np.empty(sketches, np.uint64)
    step = max(1, (1 << 19) // max(n, 1))
    for lo in range(0, sketches, step):
        seeds = _SEEDS[lo:min(sketches, lo + step)]
        with np.errstate(over="ignore"):
            ranks = (keys[None, :] ^ seeds[:, None]) * np.uint64(0x9FB21C651E98DF25)
            ranks ^= ranks >> np.uint64(32)
        if n > per_sketch:
            at = np.sort(np.argpartition(ranks, per_sketch - 1, axis=1)[:, :per_sketch], axis=1)
        else:
            at = np.broadcast_to(np.arange(n), (len(seeds), n))
        value = np.zeros(len(seeds), np.uint64)
        with np.errstate(over="ignore"):
            for k in range(at.shape[1]):
                value = (value + keys[at[:, k]]) * np.uint64(0x9E3779B97F4A7C15)
                value ^= value >> np.uint64(29)
        out[lo:lo + len(seeds)] = mix64(value + seeds)
    return out


def aligned(a: np.ndarray, b: np.ndarray, band: float = BAND) -> int:
    """Length of the longest common subsequence of two sequences without repeats,
    over matches whose positions differ by at most ``band`` of the longer one."""
    order = np.argsort(b)
    at = np.minimum(np.searchsorted(b[order], a), len(b) - 1)
    hit = b[order][at] == a
    i, j = np.flatnonzero(hit), order[at[hit]]
    j = j[np.abs(i - j) <= max(1.0, band * max(len(a), len(b)))]
    if len(j) < 2 or (np.diff(j) > 0).all():
        return len(j)
    # Longest increasing run of positions in b, kept as the least end per length.
    from bisect import bisect_left
    ends: list[int] = []
    for x in j.tolist():
        k = bisect_left(ends, x)
        if k == len(ends):
            ends.append(x)
        else:
            ends[k] = x
    return len(ends)


def distinct(hashes: np.ndarray) -> np.ndarray:
    """First occurrences, in order."""
    return hashes[np.sort(np.unique(hashes, return_index=True)[1])]


def labelled(hashes: np.ndarray) -> np.ndarray:
    """Every shingle with the number of its occurrence mixed in, in order."""
    order = np.argsort(hashes, kind="stable")
    first = np.append(True, np.diff(hashes[order]) != 0)[:len(hashes)]
    starts = np.flatnonzero(first)
    nth = np.empty(len(hashes), np.uint64)
    nth[order] = np.arange(len(hashes)) - np.repeat(starts, np.diff(np.append(starts, len(hashes))))
    with np.errstate(over="ignore"):
        return mix64(hashes + nth * np.uint64(0xA0761D6478BD642F))


def similarity(words_a: np.ndarray, words_b: np.ndarray, size: int, band: float = BAND) -> float:
    """Ordered similarity of two word sequences over their distinct shingles."""
    a, b = distinct(shingles(words_a, size)), distinct(shingles(words_b, size))
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    if len(a) == len(b) and (a == b).all():
        return 1.0
    m = aligned(a, b, band)
    return m / (len(a) + len(b) - m)


def _sketch_rows(size, sketches, n_labelled, per_sketch):
    def run(batches):
        for batch in sliced(batches):
            keys, high, low, counts = [], [], [], []
            for _, words in hashed_words(batch.column(2)):
                every = shingles(words, size)
                own = distinct(every)
                with np.errstate(over="ignore"):
                    place = mix64(words ^ (np.arange(len(words), dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
                    high.append(int(place.sum(dtype=np.uint64).view(np.int64)))
                    low.append(int(mix64(place * np.uint64(0xC2B2AE3D27D4EB4F)).sum(dtype=np.uint64).view(np.int64)))
                counts.append(len(own))
                keys.append(np.concatenate([sketch(own, sketches, per_sketch), mix64(sketch(labelled(every), n_labelled, per_sketch))])
                            .view(np.int64) if len(own) else np.zeros(0, np.int64))
            offsets = np.concatenate([[0], np.cumsum([len(k) for k in keys])]).astype(np.int32)
            flat = pa.array(np.concatenate(keys) if keys else np.zeros(0, np.int64))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(high, pa.int64()), pa.array(low, pa.int64()),
                 pa.array(counts, pa.int32()), pa.ListArray.from_arrays(pa.array(offsets), flat)],
                ["row", "doc_id", "high", "low", "size", "sketches"])

    return run


def _words(batches):
    """(row, word hashes as 32-bit numbers) of each text."""
    for batch in sliced(batches):
        found = [(w >> np.uint64(32)).astype(np.uint32).tobytes() for _, w in hashed_words(batch.column(1))]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], ["row", "words"])


def _verify(size, band, least):
    def run(batches):
        for batch in sliced(batches):
            keep = np.zeros(batch.num_rows, bool)
            mine, theirs = batch.column(2), batch.column(3)
            for k in range(batch.num_rows):
                a, b = (np.frombuffer(x[k].as_buffer(), np.uint32).astype(np.uint64) for x in (mine, theirs))
                keep[k] = similarity(a, b, size, band) >= least
            mask = pa.array(keep)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(mask), batch.column(1).filter(mask)], ["a", "b"])

    return run


def _tally(size):
    """(slot, n): how many texts have a shingle of that slot."""
    def run(batches):
        total = np.zeros(SLOTS, np.int64)
        for batch in sliced(batches):
            for found in batch.column(1):
                own = distinct(shingles(np.frombuffer(found.as_buffer(), np.uint32).astype(np.uint64), size))
                np.add.at(total, (own % np.uint64(SLOTS)).astype(np.int64), 1)
        slots = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(slots.astype(np.int32)), pa.array(total[slots])], ["slot", "n"])

    return run


def _rarest(size, least, often):
    """(row, key, at, size): the shingles of the prefix that some other text may have,
    with their place in the text's order of rarity."""
    def run(batches):
        for batch in sliced(batches):
            rows, keys, at, sizes = ([np.zeros(0, np.int64)] for _ in range(4))
            for row, found in zip(batch.column(0).to_pylist(), batch.column(1)):
                own = distinct(shingles(np.frombuffer(found.as_buffer(), np.uint32).astype(np.uint64), size))
                n = often[(own % np.uint64(SLOTS)).astype(np.int64)]
                order = np.lexsort((own, n))[:len(own) - math.ceil(least * len(own) - 1e-9) + 1]
                place = np.flatnonzero(n[order] > 1)
                rows.append(np.full(len(place), row))
                keys.append(own[order[place]].view(np.int64))
                at.append(place)
                sizes.append(np.full(len(place), len(own)))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in (rows, keys, at, sizes)], ["row", "key", "at", "size"])

    return run


def _unmet(words: DataFrame, classed: DataFrame, size: int, least: float) -> DataFrame:
    """(a, b): all pairs of different classes among ``words`` whose prefixes meet and
    whose sizes and places allow the similarity."""
    tally = words.mapInArrow(_tally(size), "slot int, n long").groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    often = np.zeros(SLOTS, np.int32)
    often[tally["slot"].to_numpy()] = np.minimum(tally["n"].to_numpy(), (1 << 31) - 1)
    keyed = stored(words.mapInArrow(_rarest(size, least, often), "row long, key long, at long, size long").join(classed, "row"), "omh-rare")
    # Of two classes at a key, one is not its most frequent: those rows meet all others.
    usual = keyed.groupBy("key").agg(F.min("class").alias("lowest"), F.max("class").alias("highest"), F.mode("class").alias("usual"))
    met = stored(keyed.join(usual.where("lowest <> highest").select("key", "usual"), "key"), "omh-met")
    x, y = met.where("class <> usual").alias("x"), met.alias("y")
    c = F.col
    both = c("x.size") + c("y.size")
    return (x.join(y, (c("x.key") == c("y.key")) & (c("x.class") != c("y.class"))
                   & ((c("y.class") == c("y.usual")) | (c("x.row") < c("y.row")))
                   & (F.least("x.size", "y.size") >= least * F.greatest("x.size", "y.size") - 1e-9)
                   & (F.least(c("x.size") - c("x.at"), c("y.size") - c("y.at")) >= least / (1 + least) * both - 1e-9))
            .select(F.least("x.row", "y.row").alias("a"), F.greatest("x.row", "y.row").alias("b")).distinct())


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """(row, class) of every row in (a, b) edges; the class is the least row reached.

    Each round points every row at the least of its neighbours and itself, follows the
    pointers to their ends by doubling, and goes on with the edges between different
    ends only; every round is written to shared storage.
    """
    left = stored(edges.select("a", "b").distinct(), "cc-edges")
    label = None
    for _ in range(rounds):
        both = left.unionByName(left.select(F.col("b").alias("a"), F.col("a").alias("b")))
        ends = _followed(stored(both.groupBy(F.col("a").alias("row")).agg(F.least(F.first("a"), F.min("b")).alias("class")), "cc"), rounds)
        if label is None:
            label = ends
        else:
            onward = ends.select(F.col("row").alias("class"), F.col("class").alias("far"))
            label = stored(label.join(onward, "class", "left").select("row", F.coalesce("far", "class").alias("class")), "cc")
        one, two = (ends.select(F.col("row").alias(x), F.col("class").alias(f"c{x}")) for x in "ab")
        left = stored(left.join(one, "a").join(two, "b").where("ca <> cb")
                      .select(F.least("ca", "cb").alias("a"), F.greatest("ca", "cb").alias("b")).distinct(), "cc-edges")
        if not left.limit(1).count():
            return label
    raise RuntimeError(f"components did not settle in {rounds} rounds")


def _followed(label: DataFrame, rounds: int) -> DataFrame:
    """(row, class) with every class's own class followed to its end."""
    for _ in range(rounds):
        jump = label.select(F.col("row").alias("class"), F.col("class").alias("far"))
        moved = label.where("row <> class").join(jump.where("far <> class"), "class")
        if not moved.limit(1).count():
            return label
        label = stored(label.join(jump, "class").select("row", F.col("far").alias("class")), "cc")
    raise RuntimeError(f"classes did not settle in {rounds} rounds")


def near_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", row_col: str | None = None,
                 size: int = SHINGLE_WORDS, least: float = SIMILARITY, sketches: int = SKETCHES,
                 n_labelled: int = LABELLED, per_sketch: int = PER_SKETCH, min_shared: int = MIN_SHARED, band: float = BAND) -> DataFrame:
    """(row, doc_id, class_row, class_id, n_links) per row of ``docs``. ``class_row`` is
    the row that stands for the class, ``class_id`` its id; ``n_links`` counts the row's verified pairs with other
    texts. ``row_col`` names a unique row number that no reread changes; without it rows are
    numbered by ``numbered``."""
    if row_col is None:
        row_col = fresh(docs.columns, "__row")
        docs = numbered(docs, row_col)
    src = docs.select(F.col(row_col).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    made = stored(src.mapInArrow(_sketch_rows(size, sketches, n_labelled, per_sketch),
                                 "row long, doc_id long, high long, low long, size int, sketches array<long>"), "omh")
    reps = stored(made.groupBy("high", "low").agg(F.min(F.struct("row", "doc_id")).alias("rep"))
                  .select("high", "low", F.col("rep.row").alias("rep"), F.col("rep.doc_id").alias("rep_id")), "omh-reps")
    sketched = stored(made.join(reps.select(F.col("rep").alias("row")), "row", "left_semi").where("size > 0")
                      .select("row", "size", "sketches"), "omh-sketches")
    # Most sketches are one text's own: only shared ones are kept.
    spread = sketched.select("row", F.explode("sketches").alias("bucket"))
    shared = spread.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = stored(spread.join(shared, "bucket", "left_semi"), "omh-members")
    led = stored(members.join(_ends(members, 1), "bucket").select("row", "ends"), "omh-buckets")
    met = (led.select("row", F.explode(F.array_distinct(F.transform("ends", lambda e: e["row"]))).alias("other")).where("row <> other")
           .groupBy("row", "other").agg(F.count("*").alias("n")))
    best = (met.groupBy("row").agg(F.max(F.struct("n", F.xxhash64("row", "other"), "other"))["other"].alias("other"))
            .select(F.least("row", "other").alias("a"), F.greatest("row", "other").alias("b")).distinct())
    first = stored(_verified(src, stored(best, "omh-best"), size, band, least), "omh-links")
    label = components(first)
    fine = F.transform("sketches", lambda s, k: F.xxhash64(s, F.get("sketches", (k + 1) % F.size("sketches"))))
    marks = F.transform("sketches", lambda s: F.shiftright(s, 56).cast("tinyint"))
    # Keys first: what travels with a member is added where a bucket holds two classes.
    close = (sketched.join(led.select("row").distinct(), "row", "left_semi").join(label, "row", "left")
             .select("row", F.coalesce("class", "row").alias("class"), F.explode(fine).alias("bucket")))
    both = close.groupBy("bucket").agg(F.min("class").alias("lowest"), F.max("class").alias("highest")).where("lowest <> highest")
    classed = stored(close.join(both.select("bucket"), "bucket", "left_semi")
                     .join(sketched.select("row", "size", marks.alias("marks")), "row"), "omh-fine")
    mixed = _ends(classed, ORDERS)
    agree = lambda e: F.aggregate(F.zip_with(e["marks"], "marks", lambda x, y: (x == y).cast("int")), F.lit(0), lambda n, x: n + x)
    apart = F.filter("ends", lambda e: (e["class"] != F.col("class")) & (agree(e) >= min_shared)
                     & (F.least(e["size"], "size") >= least * F.greatest(e["size"], "size")))
    pairs = (classed.join(mixed, "bucket").select("row", F.explode(F.array_distinct(F.transform(apart, lambda e: e["row"]))).alias("other"))
             .select(F.least("row", "other").alias("a"), F.greatest("row", "other").alias("b")).distinct())
    rest = stored(pairs, "omh-pairs")
    links = first.unionByName(stored(_verified(src, rest, size, band, least), "omh-links"))
    label = components(links)
    # Exactly: rows that share enough buckets with rows of another class.
    seen = members.join(label, "row", "left").withColumn("class", F.coalesce("class", "row"))
    mixed = seen.groupBy("bucket").agg(F.min("class").alias("lowest"), F.max("class").alias("highest")).where("lowest <> highest")
    left = stored(seen.join(mixed.select("bucket"), "bucket", "left_semi").groupBy("row", "class").agg(F.count("*").alias("n"))
                  .where(F.col("n") >= min_shared).select("row", "class"), "omh-open")
    words = stored(among(src.select("row", "text"), left.select("row"), "row").mapInArrow(_words, "row long, words binary"), "omh-words")
    late = stored(_aligned_pairs(words, stored(_unmet(words, left, size, least), "omh-pairs"), size, band, least), "omh-links")
    links = links.unionByName(late)
    # Only classes are joined further, not rows.
    ends = left.select(F.col("row").alias("a"), F.col("class").alias("ca")), left.select(F.col("row").alias("b"), F.col("class").alias("cb"))
    merged = components(late.join(ends[0], "a").join(ends[1], "b").select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    merged = merged.select(F.col("row").alias("class_row"), F.col("class").alias("into"))
    degree = links.select(F.explode(F.array("a", "b")).alias("rep")).groupBy("rep").agg(F.count("*").alias("n_links"))
    named = (reps.join(label.withColumnRenamed("row", "rep"), "rep", "left").join(degree, "rep", "left")
             .select("high", "low", F.coalesce("class", "rep").alias("class_row"), F.coalesce("n_links", F.lit(0)).alias("n_links")))
    named = named.join(merged, "class_row", "left").withColumn("class_row", F.coalesce("into", "class_row")).drop("into")
    named = named.join(reps.select(F.col("rep").alias("class_row"), F.col("rep_id").alias("class_id")), "class_row")
    return made.select("row", "doc_id", "high", "low").join(named, ["high", "low"]).select(
        "row", "doc_id", "class_row", "class_id", "n_links")


def _ends(members: DataFrame, orders: int) -> DataFrame:
    """Per bucket: n, the least and greatest class, and ``ends``: its first and last
    members in ``orders`` random orders, with what the members carry. A member without
    a class is one of its own."""
    label = F.col("class") if "class" in members.columns else F.col("row")
    carried = ["row", "class", *(c for c in ("size", "marks") if c in members.columns)]
    turns = [F.struct(F.xxhash64("row", "bucket", F.lit(k)).alias("h"), F.col("row"), label.alias("class"), *carried[2:])
             for k in range(orders)]
    return members.groupBy("bucket").agg(
        F.count("*").alias("n"), F.min(label).alias("lowest"), F.max(label).alias("highest"),
        F.array(*(F.struct(*(end(t)[c].alias(c) for c in carried)) for t in turns for end in (F.min, F.max))).alias("ends"))


def _verified(src: DataFrame, pairs: DataFrame, size: int, band: float, least: float) -> DataFrame:
    """The (a, b) pairs whose texts align; only the words of texts in a pair are shuffled."""
    ids = pairs.select("a").union(pairs.select("b"))
    words = among(src.select("row", "text"), ids, "row").mapInArrow(_words, "row long, words binary")
    return _aligned_pairs(stored(words, "omh-words"), pairs, size, band, least)


def _aligned_pairs(words: DataFrame, pairs: DataFrame, size: int, band: float, least: float) -> DataFrame:
    """The (a, b) pairs whose words align."""
    one, two = (words.select(F.col("row").alias(x), F.col("words").alias(f"w{x}")) for x in "ab")
    return pairs.join(one, "a").join(two, "b").select("a", "b", "wa", "wb").mapInArrow(_verify(size, band, least), "a long, b long")


def keep_one(docs: DataFrame, **args) -> DataFrame:
    """The rows of ``docs`` that stand for their class, columns unchanged."""
    row = fresh(docs.columns, "__row")
    keyed = numbered(docs, row)
    chosen = near_classes(keyed, row_col=row, **args).where("row = class_row").select(F.col("row").alias(row))
    return among(keyed, chosen, row).select(*docs.columns)
