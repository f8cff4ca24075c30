"""Operator 9: token ids in training order as fixed-stride binary shards.

1. Texts are tokenised with a public vocabulary (ids, then one end id) and cut into
   sequences of ``seq_len``; the last one of a text is padded in the file.
   The distinct pieces between white space of 2 MB of texts are looked up once each.
2. Sequences are numbered in table order. A first pass only counts them and keeps, per
   BLOCK rows of a file, where each row begins; that table goes to all executors and the
   texts are tokenised again on their way to the shards, so that token ids lie on disk in
   the shuffle and the shards alone. Numbers do not depend on how tasks split the files.
3. A keyed Feistel network over the next even power of two, with cycle-walking,
   permutes the numbers: every sequence gets one global slot, every slot one sequence.
   With ``window`` the permutation stays inside windows of so many numbers, so an
   order that an earlier step made holds at that scale.
4. Range partitions of whole shards write slots in order. Record ``s`` of a shard
   starts at ``(s - first slot) * stride``; a file appears under its name only when it
   is complete, so a repeated task replaces a shard by the same bytes.

A record is id (int64), part and length (uint32 each), then ``seq_len`` ids (uint16).

Defined cases: a null or empty text is one sequence of the end id; a null id is
written as -2**63 and comes back null; repeated rows are sequences of their own; an
empty table writes no shard. Other columns are ignored.
"""

from __future__ import annotations

import base64
import itertools
import math
import re
import struct
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs as pafs
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickspark.llm.common import mix64, stored, tokenizer_file

SEQ_LEN, SHARD_SLOTS = 512, 32_768
ROUNDS = 6
BLOCK, BROADCAST_BLOCKS = 1024, 50_000  # rows of a block; blocks of at most 4 KB each
_NULL_ID = -(1 << 63)
_HEAD = np.dtype([("doc_id", "<i8"), ("part", "<u4"), ("length", "<u4")])
_PIECE = re.compile(r"\s+(?!\S)| ?\S+|\s+")
_KEPT_PIECES = 300_000
_STEP = 1 << 21  # bytes of text worked on at once
#: What \s of _PIECE finds, as UTF-8.
_SPACES = [chr(c).encode() for c in range(0x3001) if chr(c).isspace()]
_SPACE = np.zeros(256, bool)
_SPACE[[c[0] for c in _SPACES if len(c) == 1]] = True
#: Fixed value: the pre-tokenisation pattern that belongs to the vocabulary file.
PATTERN = r"'(?:[sdmt]|ll|ve|re)| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class Tokens:
    """Ids of a byte-level vocabulary; runs between white space are kept per task."""

    def __init__(self, ranks_file: str):
        import tiktoken

        with open(ranks_file, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.encoding = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        self.end = max(ranks.values()) + 1
        self.bytes = np.zeros(1 << 16, np.int64)
        for token, rank in ranks.items():
            self.bytes[rank] = len(token)
        self.known: dict[str, list[int]] = {}

    def of(self, text: str | None) -> list[int]:
        known, out = self.known, []
        for piece in _PIECE.findall(text or ""):
            ids = known.get(piece)
            if ids is None:
                if len(known) > _KEPT_PIECES:
                    known.clear()
                ids = known[piece] = self.encoding.encode_ordinary(piece)
            out += ids
        out.append(self.end)
        return out

    def many(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts in a row, each with its end, and where each text begins."""
        kind, size, flat = self._kinds(texts)
        n = size[kind]
        ends = np.cumsum(n)
        where = np.repeat(((np.cumsum(size) - size)[kind] - (ends - n)).astype(np.int32), n)
        where += np.arange(len(where), dtype=np.int32)
        return flat[where], np.concatenate([[0], ends[kind == len(size) - 1]])

    def counts(self, texts: pa.Array) -> np.ndarray:
        """How many ids each text has, with its end."""
        kind, size, _ = self._kinds(texts)
        return np.diff(np.cumsum(size[kind])[kind == len(size) - 1], prepend=0)

    def _kinds(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The pieces of all texts as numbers of distinct ones, the ids that each of those
        has, and these ids in a row; a text's end is the last kind, after its own pieces."""
        data, bounds = _bytes_of(texts)
        starts = _piece_starts(data, bounds)
        pieces = pa.LargeStringArray.from_buffers(len(starts), pa.py_buffer(np.append(starts, len(data)).astype(np.int64)), pa.py_buffer(data))
        coded = pieces.dictionary_encode()
        size, flat = self._each(coded.dictionary)
        kind = np.insert(coded.indices.to_numpy(zero_copy_only=False), np.searchsorted(starts, bounds[1:]), len(size))
        return kind, np.append(size, 1), np.append(flat, np.uint16(self.end))

    def _each(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """How many ids each piece has, and all of them in a row.

        Words are encoded together, with the blank before them or a line break between
        them: the vocabulary's pattern starts anew there, and the bytes of the ids tell
        where. Pieces of white space are encoded one by one."""
        data, bounds = _bytes_of(pieces)
        space = _spaces(data)[bounds[1:] - 1]
        blank = ~space & (data[bounds[:-1]] == 32)
        size, parts = np.zeros(len(pieces), np.int64), []
        for own, mark in ((blank, ""), (~space & ~blank, "\n")):
            words = pc.binary_join_element_wise(pa.scalar(mark, pa.large_string()), pieces.filter(pa.array(own)), pa.scalar("", pa.large_string()))
            ids = np.array(self.encoding.encode_ordinary(_bytes_of(words)[0].tobytes().decode()), np.uint16)
            last = np.cumsum(np.diff(bounds)[own] + len(mark))
            n = np.diff(np.searchsorted(np.cumsum(self.bytes[ids]), last) + 1, prepend=0)
            if mark:
                ids, n = np.delete(ids, np.cumsum(n) - n), n - 1
            size[own] = n
            parts.append((own, ids))
        lists = [self.encoding.encode_ordinary(x) for x in pieces.filter(pa.array(space)).to_pylist()]
        size[space] = [len(x) for x in lists]
        parts.append((space, np.fromiter(itertools.chain.from_iterable(lists), np.uint16, int(size[space].sum()))))
        flat = np.empty(int(size.sum()), np.uint16)
        for own, ids in parts:
            flat[np.repeat(own, size)] = ids
        return size, flat

    def text(self, ids) -> str:
        return self.encoding.decode([i for i in ids if i != self.end])


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all texts in a row and where each begins; null texts are empty."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    bounds = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    data = texts.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[bounds[0]:bounds[-1]], bounds - bounds[0]


def _spaces(data: np.ndarray) -> np.ndarray:
    """Which bytes of UTF-8 belong to white space."""
    space = _SPACE[data]
    if (data >= 128).any():
        for wide in _SPACES:
            if len(wide) > 1:
                at = np.flatnonzero(data[:max(0, len(data) - len(wide) + 1)] == wide[0])
                for k in range(1, len(wide)):
                    at = at[data[at + k] == wide[k]]
                for k in range(len(wide)):
                    space[at + k] = True
    return space


def _piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of _PIECE begin in texts that lie one after another."""
    space = _spaces(data)
    opens = np.zeros(len(data) + 1, bool)
    opens[bounds] = True
    start = opens[:-1].copy()  # texts and runs of white space
    start[1:] |= space[1:] & ~space[:-1]
    words = np.flatnonzero(~space[1:] & space[:-1] & ~opens[1:-1]) + 1 if len(data) else np.zeros(0, np.int64)
    last = words - 1  # the white space before a word is its own if it is one blank, else a piece
    blank = data[last] == 32
    for _ in range(3):
        last = last - ((data[last] & 0xC0) == 0x80)
    start[last] = True
    start[words[~blank]] = True
    return np.flatnonzero(start)


def record_type(seq_len: int) -> np.dtype:
    return np.dtype(_HEAD.descr + [("ids", "<u2", (seq_len,))])


def feistel(x: np.ndarray, n: int, key: int) -> np.ndarray:
    """A keyed permutation of 0..n-1: Feistel rounds on the next even power of two,
    walked until the value falls below n."""
    half = max(1, math.ceil(max(1, (n - 1).bit_length()) / 2))
    mask, shift = np.uint64((1 << half) - 1), np.uint64(half)
    keys = mix64(np.arange(1, ROUNDS + 1, dtype=np.uint64) + mix64(np.array([key & (2**64 - 1)], np.uint64)))
    out = x.astype(np.uint64)
    walk = np.arange(len(out))
    while len(walk):
        left, right = out[walk] >> shift, out[walk] & mask
        for k in keys:
            left, right = right, left ^ (mix64(right ^ k) & mask)
        out[walk] = (left << shift) | right
        walk = walk[out[walk] >= np.uint64(n)]
    return out.astype(np.int64)


def slots_of(numbers: np.ndarray, total: int, key: int, window: int | None) -> np.ndarray:
    """Slots of sequence numbers; each window has a key of its own."""
    if not window or window >= total:
        return feistel(numbers, total, key)
    out = np.empty(len(numbers), np.int64)
    at = numbers // window
    order = np.argsort(at, kind="stable")
    for part in np.split(order, np.flatnonzero(np.diff(at[order])) + 1):
        if len(part):
            first = int(at[part[0]]) * window
            size = min(window, total - first)
            own = int(mix64(np.array([(key + 0x9E3779B97F4A7C15 * (first + 1)) & (2**64 - 1)], np.uint64))[0])
            out[part] = first + feistel(numbers[part] - first, size, own)
    return out


def _tokenised(ranks_file: str, work):
    """``work(tokens, batch)`` over batches of 2 MB of text, whose second column it is."""
    kept: list[Tokens] = []

    def run(batches):
        if not kept:
            kept.append(Tokens(ranks_file))
        try:
            for batch in batches:
                ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
                lo = 0
                while lo < batch.num_rows:
                    done = ends[lo - 1] if lo else 0
                    hi = max(lo + 1, int(np.searchsorted(ends, done + _STEP, "right")))
                    yield from work(kept[0], batch.slice(lo, hi - lo))
                    lo = hi
        finally:
            kept.clear()  # a worker that waits for its next task keeps no pieces
            pa.default_memory_pool().release_unused()

    return run


def _counts(seq_len: int):
    """(path, block, first, last, n, starts) for the rows from ``first`` to ``last`` of a
    block: how many sequences they are and how many lie before each."""
    def work(tokens, batch):
        n = -(-tokens.counts(batch.column(1)) // seq_len)
        at, paths = batch.column("at").to_numpy(), batch.column("path").dictionary_encode()
        file = paths.indices.to_numpy()
        cuts = np.flatnonzero((np.diff(at) <= 0) | (np.diff(file) != 0) | (np.diff(at // BLOCK) != 0)) + 1
        for lo, hi in zip([0, *cuts.tolist()], [*cuts.tolist(), len(at)]):
            starts = np.zeros(int(at[hi - 1] - at[lo]) + 1, np.int32)
            own = n[lo:hi]
            starts[at[lo:hi] - at[lo]] = np.cumsum(own) - own
            yield pa.RecordBatch.from_arrays(
                [pa.array([paths.dictionary[int(file[lo])].as_py()], pa.string()), *(pa.array([int(x)], pa.int64()) for x in (at[lo] // BLOCK, at[lo], at[hi - 1], own.sum())),
                 pa.array([starts], pa.list_(pa.int32()))], ["path", "block", "first", "last", "n", "starts"])

    return work


def _sequences(seq_len: int, shard_slots: int, total: int, key: int, window: int | None):
    def work(tokens, batch):
        ids, bounds = tokens.many(batch.column(1))
        n = -(-np.diff(bounds) // seq_len)
        of = np.repeat(np.arange(len(n)), n)
        part = np.arange(len(of)) - (np.cumsum(n) - n)[of]
        begin = bounds[:-1][of] + part * seq_len
        length = np.minimum(bounds[1:][of] - begin, seq_len)
        number = batch.column("number").to_numpy()[of] + part
        slot = slots_of(number, total, key, window)
        raw = pa.BinaryArray.from_buffers(pa.binary(), len(of), [None, pa.py_buffer((2 * np.append(begin, len(ids))).astype(np.int32)), pa.py_buffer(ids)])
        yield pa.RecordBatch.from_arrays(
            [batch.column(0).take(pa.array(of)), pa.array(part.astype(np.int32)), pa.array(length.astype(np.int32)), raw,
             pa.array(number), pa.array(slot), pa.array(slot // shard_slots)],
            ["doc_id", "part", "n_tokens", "ids", "number", "slot", "shard"])

    return work


def _in_table_order(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, text, path, at): at counts up within a path in the order of the table."""
    cols = [F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")]
    try:
        return docs.select(*cols, F.col("_metadata.file_path").alias("path"), F.col("_metadata.row_index").alias("at"))
    except AnalysisException:  # not a plain file scan: the order of its partitions, written as it is read twice
        number = F.monotonically_increasing_id()
        return stored(docs.select(*cols, F.format_string("%012d", F.shiftright(number, 33)).alias("path"),
                                  number.bitwiseAND((1 << 33) - 1).alias("at")), "ordered")


def materialise(docs: DataFrame, out_dir: str, key: int = 20_240_613, seq_len: int = SEQ_LEN, shard_slots: int = SHARD_SLOTS,
                window: int | None = None, id_col: str = "doc_id", text_col: str = "text", ranks_file: str | None = None) -> DataFrame:
    """Writes the shards under ``out_dir`` and returns their table of contents: doc_id,
    part, n_tokens, number, slot, shard and byte offset of every sequence."""
    ranks_file = ranks_file or tokenizer_file("byte_bpe_50k.tiktoken")
    rows = _in_table_order(docs, id_col, text_col)
    counted = rows.select("doc_id", "text", "path", "at").mapInArrow(
        _tokenised(ranks_file, _counts(seq_len)), "path string, block long, first long, last long, n long, starts array<int>")
    blocks = stored(counted, "blocks")
    before = F.sum("n").over(W.orderBy("path", "first").rowsBetween(W.unboundedPreceding, -1))  # a row per block
    bases = stored(blocks.select("path", "first", "n", F.coalesce(before, F.lit(0)).alias("before")).coalesce(1), "bases")
    n_blocks, total = bases.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
    blocks = blocks.drop("n").join(bases.drop("n"), ["path", "first"])
    begins = F.col("before") + F.get("starts", (F.col("at") - F.col("first")).cast("int"))
    numbered = (rows.withColumn("block", F.floor(F.col("at") / BLOCK)).join(F.broadcast(blocks) if n_blocks <= BROADCAST_BLOCKS else blocks, ["path", "block"])
                .where("at between first and last").select("doc_id", "text", begins.alias("number")))
    n_shards = max(1, -(-total // shard_slots))
    placed = numbered.mapInArrow(_tokenised(ranks_file, _sequences(seq_len, shard_slots, total, key, window)),
                                 "doc_id long, part int, n_tokens int, ids binary, number long, slot long, shard long")
    placed = placed.repartitionById(n_shards, F.col("shard").cast("int")).sortWithinPartitions("slot")
    written = placed.mapInArrow(_writer(out_dir, seq_len, shard_slots),
                                "doc_id long, part int, n_tokens int, number long, slot long, shard long, byte_offset long")
    return stored(written, "contents")


def _writer(out_dir: str, seq_len: int, shard_slots: int):
    kind = record_type(seq_len)

    def run(batches):
        fs, root = _open(out_dir)
        shard, stream, temp = None, None, None

        def finish():
            if stream is not None:
                stream.close()
                fs.move(temp, shard_path(root, shard))

        for batch in batches:
            for lo in range(0, batch.num_rows, 4096):
                part = batch.slice(lo, 4096)
                own = part.column("shard").to_numpy()
                records = np.zeros(part.num_rows, kind)
                records["doc_id"] = part.column("doc_id").fill_null(_NULL_ID).to_numpy()
                records["part"], records["length"] = part.column("part").to_numpy(), part.column("n_tokens").to_numpy()
                for k, raw in enumerate(part.column("ids").to_pylist()):
                    ids = np.frombuffer(raw, np.uint16)
                    records["ids"][k, :len(ids)] = ids
                for own_shard in np.unique(own):
                    if own_shard != shard:
                        finish()
                        shard, temp = int(own_shard), f"{root}/.{int(own_shard)}-{uuid.uuid4().hex}"
                        fs.create_dir(root, recursive=True)
                        stream = fs.open_output_stream(temp)
                    stream.write(records[own == own_shard].tobytes())
                offset = (part.column("slot").to_numpy() - own * shard_slots) * kind.itemsize
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("doc_id", "part", "n_tokens", "number", "slot", "shard")), pa.array(offset)],
                    ["doc_id", "part", "n_tokens", "number", "slot", "shard", "byte_offset"])
        finish()

    return run


def _open(out_dir: str):
    """File system and path of a folder given as a URI or a plain path."""
    if "://" in out_dir or out_dir.startswith("file:"):
        return pafs.FileSystem.from_uri(out_dir if "://" in out_dir else "file://" + out_dir.removeprefix("file:"))
    return pafs.LocalFileSystem(), out_dir


def shard_path(root: str, shard: int) -> str:
    return f"{root}/shard-{shard:09d}.bin"


def read_slots(out_dir: str, first: int, count: int, seq_len: int = SEQ_LEN, shard_slots: int = SHARD_SLOTS) -> np.ndarray:
    """Records of ``count`` slots from ``first`` on, by one seek in each shard they span."""
    fs, root = _open(out_dir)
    kind, out = record_type(seq_len), []
    while count > 0:
        shard, skip = divmod(first, shard_slots)
        take = min(count, shard_slots - skip)
        with fs.open_input_file(shard_path(root, shard)) as f:
            f.seek(skip * kind.itemsize)
            got = np.frombuffer(f.read(take * kind.itemsize), kind)
        out.append(got)
        if len(got) < take:
            break
        first, count = first + take, count - take
    return np.concatenate(out) if out else np.zeros(0, kind)


def read_shards(spark: SparkSession, out_dir: str, seq_len: int = SEQ_LEN, shard_slots: int = SHARD_SLOTS) -> DataFrame:
    """Every record of the shards, read back by Spark: doc_id, part, n_tokens, slot, ids."""
    size = record_type(seq_len).itemsize
    files = (spark.read.format("binaryFile").option("pathGlobFilter", "shard-*.bin").load(out_dir)
             .select(F.regexp_extract("path", r"shard-(\d+)\.bin", 1).cast("long").alias("shard"), "content"))

    def run(batches):
        for batch in batches:
            for shard, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                rows = np.frombuffer(raw, record_type(seq_len))
                ids = [None if d == _NULL_ID else d for d in rows["doc_id"].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(rows["part"].astype(np.int32)), pa.array(rows["length"].astype(np.int32)),
                     pa.array(shard * shard_slots + np.arange(len(rows))),
                     pa.array([r["ids"][:r["length"]].tolist() for r in rows], pa.list_(pa.int32()))],
                    ["doc_id", "part", "n_tokens", "slot", "ids"])

    assert size == struct.calcsize("<qII") + 2 * seq_len
    return files.mapInArrow(run, "doc_id long, part int, n_tokens int, slot long, ids array<int>")
