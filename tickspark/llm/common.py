"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tickspark.operators.ranking import fresh
from tickspark.session import scratch_path

#: Folder of the public tokenizer files; every operator takes a path of its own too.
TOKENIZERS = os.environ.get("TICKSPARK_TOKENIZERS", "/opt/tokenizers")

_MULT = 0x9E3779B97F4A7C15
BROADCAST_FILES = 100_000
BROADCAST_BITS = 20_000  # bitmaps of 4 KB
_STEP = 1 << 18  # bytes of text worked on at once


def tokenizer_file(name: str) -> str:
    return os.path.join(TOKENIZERS, name)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written as Parquet to the shared scratch folder and read back.

    Cuts the lineage: a lost executor costs no recomputation of what was written.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(docs: DataFrame, name: str) -> DataFrame:
    """``docs`` plus ``name``: a number of each row that stays the same however often, and by
    however many executors, the table is read.

    Of a plain scan of files it is the file's number by path and the row's place in it;
    anything else is written once with its numbers.
    """
    spark = docs.sparkSession
    try:
        if any(c.lower() == "_metadata" for c in docs.columns):
            raise AnalysisException("a column of the table hides the file's")
        at = docs.select(*docs.columns, F.col("_metadata.file_path").alias("__path"), F.col("_metadata.row_index").alias("__at"))
        files = at.select("__path").distinct()
    except AnalysisException:
        return stored(docs.withColumn(name, F.monotonically_increasing_id()), "numbered")
    order = F.row_number().over(Window.orderBy("__path")).cast("long")  # a row per file
    files = stored(files.withColumn("__file", order).coalesce(1), "files")
    few = files.count() <= BROADCAST_FILES
    return at.join(F.broadcast(files) if few else files, "__path").select(
        *docs.columns, F.shiftleft("__file", 40).bitwiseOR(F.col("__at")).alias(name))


def among(docs: DataFrame, rows: DataFrame, name: str) -> DataFrame:
    """The rows of ``docs`` whose number ``name`` is in the one column of ``rows``.

    The numbers become a bit each and go to all executors, so ``docs`` stays where it is;
    only where they lie so far apart that the bits are many, ``docs`` is shuffled to them.
    """
    one, bucket, bits = (fresh([*docs.columns, name], x) for x in ("__one", "__bucket", "__bits"))
    rows = rows.toDF(one).where(F.col(one).isNotNull())
    marks = stored(rows.groupBy(F.bitmap_bucket_number(one).alias(bucket))
                   .agg(F.bitmap_construct_agg(F.bitmap_bit_position(one)).alias(bits)), "row-bits")
    if marks.count() > BROADCAST_BITS:
        return docs.join(rows.withColumnRenamed(one, name), name, "left_semi")
    at = F.bitmap_bit_position(name)
    byte = F.conv(F.hex(F.substring(bits, F.shiftright(at, 3).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = docs.join(F.broadcast(marks), F.bitmap_bucket_number(name) == F.col(bucket))
    return found.where(F.getbit(byte, F.pmod(at, F.lit(8)).cast("int")) == 1).drop(bucket, bits)


def sliced(batches: Iterable[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """The batches in slices of ``rows``; a worker that waits for its next task keeps no Arrow memory."""
    try:
        for batch in batches:
            for lo in range(0, batch.num_rows, rows):
                yield batch.slice(lo, rows)
    finally:
        pa.default_memory_pool().release_unused()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_bucket(col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; -1 for a null id."""
    return F.coalesce(F.crc32(col.cast("string").cast("binary")) % mod, F.lit(-1))


def mix64(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser, element by element."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


_WORD = np.zeros(256, bool)
_WORD[[*range(48, 58), *range(97, 123), 95, *range(128, 256)]] = True
_POWERS: dict[str, np.ndarray] = {}


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the multiplier and of its inverse modulo 2**64, at least n of each."""
    if len(_POWERS.get("up", ())) < n:
        size = max(n, _STEP)
        with np.errstate(over="ignore"):
            for name, base in (("up", _MULT), ("down", pow(_MULT, -1, 1 << 64))):
                steps = np.full(size, np.uint64(base))
                steps[0] = 1
                _POWERS[name] = np.cumprod(steps)
    return _POWERS["up"], _POWERS["down"]


def hashed_words(texts: pa.Array) -> Iterator[tuple[int, np.ndarray]]:
    """(row, 64-bit hashes of the row's words) for every row of a string array.

    Words are runs of ASCII letters, digits, underscores and non-ASCII bytes of the
    lower-cased text. Null texts have none. Whole texts are hashed, many at a time.
    """
    lower = pc.utf8_lower(pc.fill_null(texts.cast(pa.large_string()), ""))
    offsets = np.frombuffer(lower.buffers()[1], np.int64)[lower.offset:lower.offset + len(lower) + 1]
    data = lower.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(lower):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + _STEP, "right")) - 1)
        start = offsets[row]
        if offsets[end] - start > _STEP:  # one long text
            yield row, np.concatenate([_hash(part, np.array([0, len(part)]))[1] for part in _pieces(data[start:offsets[end]])])
        else:
            bounds = offsets[row:end + 1] - start
            starts, hashes = _hash(data[start:offsets[end]], bounds)
            cuts = np.searchsorted(starts, bounds)
            for k in range(end - row):
                yield row + k, hashes[cuts[k]:cuts[k + 1]]
        row = end


def _pieces(text: np.ndarray) -> Iterator[np.ndarray]:
    """A long text in pieces of about _STEP bytes; words stay whole."""
    low = 0
    while low < len(text):
        high = min(len(text), low + _STEP)
        if high < len(text):
            gaps = np.flatnonzero(~_WORD[text[low:high]])
            if len(gaps):
                high = low + int(gaps[-1]) + 1
            else:  # a word longer than a piece
                while high < len(text) and _WORD[text[high]]:
                    more = np.flatnonzero(~_WORD[text[high:high + _STEP]])
                    high = high + int(more[0]) if len(more) else min(len(text), high + _STEP)
        yield text[low:high]
        low = high


def _hash(part: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    word = _WORD[part]
    opens = word.copy()
    opens[1:] &= ~word[:-1]
    inside = bounds[(bounds > 0) & (bounds < len(part))]
    opens[inside] = word[inside]
    shuts = np.zeros(len(part) + 1, bool)
    shuts[1:][word] = True
    if len(part):
        shuts[1:-1] &= ~word[1:] | opens[1:]
    starts, ends = np.flatnonzero(opens), np.flatnonzero(shuts)
    up, down = _powers(len(part) + 1)
    with np.errstate(over="ignore"):
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * up[:len(part)], out=sums[1:])
        return starts, mix64((sums[ends] - sums[starts]) * down[starts])


def shingles(words: np.ndarray, size: int) -> np.ndarray:
    """Hashes of all ``size``-word windows; of all words together if there are fewer."""
    if len(words) == 0:
        return words
    size = min(size, len(words))
    out = np.zeros(len(words) - size + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(size):
            out = out * np.uint64(_MULT) + words[k:k + len(out)]
    return mix64(out)
