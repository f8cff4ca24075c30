"""Operator 4: benchmark decontamination by greedy string tiling.

Texts become word hashes (``common.hashed_words``). Windows of ``seed`` words that a
document shares with an item make a candidate pair; the pair is tiled: the longest
common runs of at least ``seed`` words, found by rolling Karp-Rabin hashes, are
marked one after another without overlap, longest first. An item whose tiles cover
at least ``coverage`` of its words is in the document, in whatever order.

The benchmark is the bounded side. Up to ``broadcast_words`` words of it (eight bytes count
as a word at least, so unspaced texts are bounded too) travel as a broadcast index;
beyond that the same windows are joined by a shuffle.

Defined cases: null and empty texts match nothing; items shorter than ``seed`` words
match as one run of all their words; repeated items and documents each keep their
rows; null ids stay null; an empty benchmark flags nothing. Other columns ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import hashed_words, mix64, numbered, shingles
from tickspark.operators.ranking import fresh

SEED_WORDS = 5
COVERAGE = 0.8
BROADCAST_WORDS = 2_000_000
_BASE = 0x9E3779B97F4A7C15


def _windows(words: np.ndarray, size: int) -> np.ndarray:
    return shingles(words, size) if len(words) >= size else words[:0]


class _Rolling:
    """Karp-Rabin hashes of all windows of any length, from one pass over the words."""

    def __init__(self, words: np.ndarray):
        self.words = words
        with np.errstate(over="ignore"):
            up = np.full(len(words) + 1, np.uint64(_BASE))
            down = np.full(len(words) + 1, np.uint64(pow(_BASE, -1, 1 << 64)))
            up[0] = down[0] = 1
            up, self.down = np.cumprod(up), np.cumprod(down)
            self.sums = np.append(np.uint64(0), np.cumsum(mix64(words + np.uint64(1)) * up[:-1]))

    def at(self, starts: np.ndarray, size: int) -> np.ndarray:
        with np.errstate(over="ignore"):
            return mix64((self.sums[starts + size] - self.sums[starts]) * self.down[starts])


def tile(doc: np.ndarray, item: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling: (document start, item start, length) tiles.

    Each round finds the longest length at which a free run of both texts is equal, by
    halving over rolling hashes of all free runs, and marks the runs of that length in
    order of their place in the item, then in the document, without overlap. A round
    costs n log n in the texts' lengths, also where one word fills both.
    """
    least = min(least, len(item))
    free_d, free_i = np.ones(len(doc), bool), np.ones(len(item), bool)
    rolling_d, rolling_i = _Rolling(doc), _Rolling(item)
    tiles: list[tuple[int, int, int]] = []
    longest = min(len(doc), len(item))
    while least:
        longest = _longest(rolling_d, rolling_i, free_d, free_i, least, longest)
        if not longest:
            return tiles
        starts_d, hash_d, starts_i, hash_i = _shared(rolling_d, rolling_i, free_d, free_i, longest)
        order = np.argsort(hash_d, kind="stable")
        starts_d, hash_d = starts_d[order], hash_d[order]
        # Marked words stay marked: a document start that was passed over is never free again.
        after = np.searchsorted(hash_d, hash_i, "right")
        first: dict[int, int] = {}
        for i, key, lo, hi in zip(starts_i.tolist(), hash_i.tolist(), np.searchsorted(hash_d, hash_i, "left").tolist(), after.tolist()):
            if not (free_i[i] and free_i[i + longest - 1]):  # runs of one length overlap at an end
                continue
            k = first.get(key, lo)
            while k < hi and not (free_d[starts_d[k]] and free_d[starts_d[k] + longest - 1]):
                k += 1
            first[key] = k
            if k < hi:
                d = int(starts_d[k])
                free_d[d:d + longest] = False
                free_i[i:i + longest] = False
                tiles.append((d, i, longest))
        longest -= 1
    return tiles


def _shared(rolling_d: _Rolling, rolling_i: _Rolling, free_d, free_i, size: int):
    """Starts and hashes of the free runs of ``size`` words that the other text has too."""
    starts_d, starts_i = _free_starts(free_d, size), _free_starts(free_i, size)
    hash_d, hash_i = rolling_d.at(starts_d, size), rolling_i.at(starts_i, size)
    in_d, in_i = np.isin(hash_d, hash_i), np.isin(hash_i, hash_d)
    return starts_d[in_d], hash_d[in_d], starts_i[in_i], hash_i[in_i]


def _longest(rolling_d, rolling_i, free_d, free_i, least: int, most: int) -> int:
    """The longest length up to ``most`` of an equal free run; 0 if none has ``least`` words."""
    def some(size):
        return len(_shared(rolling_d, rolling_i, free_d, free_i, size)[0]) > 0

    if most < least or not some(least):
        return 0
    low, step = least, 1
    while low + step <= most and some(low + step):  # most runs are short: grow, then halve
        low, step = low + step, 2 * step
    high = min(most, low + step)
    while low < high:
        middle = (low + high + 1) // 2
        low, high = (middle, high) if some(middle) else (low, middle - 1)
    return low


def _free_starts(free: np.ndarray, size: int) -> np.ndarray:
    if len(free) < size:
        return np.zeros(0, np.int64)
    upto = np.append(0, np.cumsum(free))
    return np.flatnonzero(upto[size:] - upto[:-size] == size)


class Index:
    """Items as word hashes and their window hashes, sorted, with the items of each."""

    def __init__(self, items: list[np.ndarray], seed: int):
        self.items, self.seed = items, seed
        keys = [np.unique(_windows(w, seed)) for w in items]
        owner = np.concatenate([np.full(len(k), n, np.int64) for n, k in enumerate(keys)] or [np.zeros(0, np.int64)])
        flat = np.concatenate(keys or [np.zeros(0, np.uint64)])
        order = np.argsort(flat, kind="stable")
        self.keys, self.owners = flat[order], owner[order]
        self.short: dict[int, list[tuple[int, int]]] = {}
        for n, w in enumerate(items):
            if 0 < len(w) < seed:
                self.short.setdefault(len(w), []).append((int(shingles(w, len(w))[0]), n))

    def candidates(self, words: np.ndarray) -> list[int]:
        got: set[int] = set()
        if len(self.keys):
            own = np.unique(_windows(words, self.seed))
            lo, hi = np.searchsorted(self.keys, own, "left"), np.searchsorted(self.keys, own, "right")
            for a, b in zip(lo[hi > lo].tolist(), hi[hi > lo].tolist()):
                got.update(self.owners[a:b].tolist())
        for size, rows in self.short.items():
            own = set(_windows(words, size).tolist())
            got.update(n for key, n in rows if key in own)
        return sorted(got)


def _tiled(words, item, seed):
    tiles = tile(words, item, seed)
    return sum(n for _, _, n in tiles), len(tiles)


_PAIR = "row long, doc_id long, item_id long, tiled_words long, item_words long, n_tiles long"


def find_pairs(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
               item_col: str = "item_id", item_text_col: str = "text", seed: int = SEED_WORDS,
               broadcast_words: int = BROADCAST_WORDS, row_col: str | None = None) -> DataFrame:
    """(row, doc_id, item_id, tiled_words, item_words, n_tiles) of all pairs that share
    a seed. ``row`` tells repeated documents apart: ``row_col``, if given, else a number of
    the row in its table. See ``find_leaks`` for the verdict."""
    if row_col is None:
        row_col = fresh(docs.columns, "__row")
        docs = numbered(docs, row_col)
    src = docs.select(F.col(row_col).alias("row"), F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    words = F.greatest(F.size(F.split("text", r"\s+")), F.ceil(F.octet_length("text") / 8))
    size = items.agg(F.coalesce(F.sum(words), F.lit(0))).first()[0]
    return _by_broadcast(src, items, seed) if size <= broadcast_words else _by_join(src, items, seed)


def _by_broadcast(src: DataFrame, items: DataFrame, seed: int) -> DataFrame:
    got = items.where("text is not null").toArrow()
    ids = got.column("item_id").to_pylist()
    words = [w for _, w in hashed_words(got.column("text").combine_chunks())] if len(ids) else []
    shared = src.sparkSession.sparkContext.broadcast((ids, words))
    index: list[Index] = []

    def run(batches):
        ids, words = shared.value
        if not index:
            index.append(Index(words, seed))
        for batch in batches:
            rows, doc_ids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            out = []
            for k, own in hashed_words(batch.column(2)):
                for n in index[0].candidates(own):
                    out.append((rows[k], doc_ids[k], ids[n], *_measure(own, words[n], seed)))
            yield _batch(out, [pa.int64()] * 6, ["row", "doc_id", "item_id", "tiled_words", "item_words", "n_tiles"])

    return src.select("row", "doc_id", "text").mapInArrow(run, _PAIR)


def _measure(own, item, seed):
    tiled, n_tiles = _tiled(own, item, seed)
    return tiled, len(item), n_tiles


def _batch(rows, types, names):
    cols = list(zip(*rows)) or [[] for _ in names]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)


def _by_join(src: DataFrame, items: DataFrame, seed: int) -> DataFrame:
    """The same pairs with the window index joined by shuffles: item windows that no
    document has and document windows that no item has never meet a text."""
    def windows(sizes):
        def run(batches):
            for batch in batches:
                rows = batch.column(0).to_pylist()
                for k, own in hashed_words(batch.column(1)):
                    found = [_windows(own, n) for n in sizes] if sizes else [shingles(own, seed)]
                    keys = np.unique(np.concatenate(found)).view(np.int64)
                    yield pa.RecordBatch.from_arrays([pa.array(keys), pa.array([rows[k]] * len(keys), pa.int64())], ["key", "at"])

        return run

    def sizes_below(batches):
        for batch in batches:
            found = {min(seed, len(w)) for _, w in hashed_words(batch.column(0))} - {0}
            yield pa.RecordBatch.from_arrays([pa.array(sorted(found), pa.int32())], ["n"])

    def tile_pairs(batches):
        for batch in batches:
            mine = dict(hashed_words(batch.column("text")))
            theirs = dict(hashed_words(batch.column("item_text")))
            base = [batch.column(n).to_pylist() for n in ("row", "doc_id", "item_id")]
            out = [(base[0][k], base[1][k], base[2][k], *_measure(mine[k], theirs[k], seed)) for k in range(batch.num_rows)]
            yield _batch(out, [pa.int64()] * 6, ["row", "doc_id", "item_id", "tiled_words", "item_words", "n_tiles"])

    numbered = items.withColumn("item", F.monotonically_increasing_id())
    # Items below the seed length match whole: documents show windows of those few lengths too.
    sizes = [r.n for r in items.select("text").mapInArrow(sizes_below, "n int").distinct().collect()] or [seed]
    left = src.select("row", "text").mapInArrow(windows(sizes), "key long, at long").withColumnRenamed("at", "row")
    right = numbered.select("item", "text").mapInArrow(windows(None), "key long, at long").withColumnRenamed("at", "item")
    pairs = left.join(right, "key").select("row", "item").distinct()
    joined = (pairs.join(src, "row").join(numbered.withColumnRenamed("text", "item_text"), "item")
              .select("row", "doc_id", "item_id", "text", "item_text"))
    return joined.mapInArrow(tile_pairs, _PAIR)


def find_leaks(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, **args) -> DataFrame:
    """The pairs whose tiles cover at least ``coverage`` of the item, with the share."""
    share = F.col("tiled_words") / F.col("item_words")
    return find_pairs(docs, benchmark, **args).withColumn("coverage", share).where(F.col("coverage") >= coverage)


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, coverage: float = COVERAGE, **args) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, columns unchanged."""
    row = fresh(docs.columns, "__row")
    keyed = numbered(docs, row)
    leaks = find_leaks(keyed, benchmark, coverage, row_col=row, **args).select(F.col("row").alias(row)).distinct()
    return keyed.join(leaks, row, "left_anti").select(*docs.columns)
