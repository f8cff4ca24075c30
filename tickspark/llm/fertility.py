"""Operator 6: quality rules on tokeniser fertility.

A public vocabulary with byte fallback tokenises every word of a text (pieces never
cross white space, so a word's pieces do not depend on its neighbours and each word
of a few megabytes of texts is tokenised once). Characters per token, the share of byte-fallback tokens and the entropy
of the token ids are measured per text. Per language, over all texts that pass the base rules, the median of each measure and
the quartiles of its distance from the median (times the root of the word count, as
the distance of sound texts shrinks with their length) give a band; texts outside it
are rejected.

Quartiles come from counts per (language, measure, bin), so they take one partial
aggregation and the bins' rows, whatever the size of a language.

Defined cases: a null or empty text has no words and fails the base rules; a null
language is a group of its own; a text whose language has no passing text is only
held to the base rules; repeated rows stay. Other columns are ignored.
"""

from __future__ import annotations

import re
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tickspark.llm.common import stored, tokenizer_file

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEAT_SHARE = 50, 50
#: Band: quartiles widened by FENCE times their distance; within MARGIN of the median
#: a text always passes.
FENCE = 5.0
MARGIN = {"chars_per_token": 0.05, "byte_share": 0.02, "token_entropy": 1.0}
#: Bins per unit of each measure.
BINS = {"chars_per_token": 200, "byte_share": 2000, "token_entropy": 100}
BROADCAST_BANDS = 10_000
_LINE_WORD = re.compile(r"[^\x20\x09-\x0D]")
_STEP = 1 << 23


class Pieces:
    """Token ids of words under a public vocabulary."""

    def __init__(self, model_file: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=model_file)
        self.is_byte = np.array([self.model.is_byte(i) or self.model.is_unknown(i) for i in range(self.model.get_piece_size())])

    def of(self, words: list[bytes]) -> list[np.ndarray]:
        """Token ids of each word."""
        tokens, sizes = self.joined([w.decode() for w in words])
        return np.split(tokens, np.cumsum(sizes)[:-1])

    def joined(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(token ids of all words in order, number of tokens of each word)."""
        got = self.model.encode(words, num_threads=1)
        sizes = np.fromiter(map(len, got), np.int64, len(got))
        return np.fromiter(chain.from_iterable(got), np.int64, int(sizes.sum())), sizes


def repeated_window_words(ids: np.ndarray) -> int:
    """Words inside 3-word windows that occur twice or more, the first included."""
    if len(ids) < 4:
        return 0
    n = int(ids.max()) + 1
    if n < 1 << 20:
        key = (ids[:-2] * n + ids[1:-1]) * n + ids[2:]
    else:
        _, pair = np.unique(ids[:-1] * n + ids[1:], return_inverse=True)
        key = pair[:-1] * n + ids[2:]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    twice = counts[inverse] > 1
    hit = np.zeros(len(ids), bool)
    for k in range(3):
        hit[k:k + len(twice)] |= twice
    return int(hit.sum())


def duplicate_lines(text: str) -> int:
    """Lines with a word that equal an earlier line."""
    lines = text.split("\n")
    if len(lines) == len(set(lines)):
        return 0
    lines = [line for line in lines if _LINE_WORD.search(line)]
    return len(lines) - len(set(lines))


def measure_all(texts: pa.Array, pieces: Pieces) -> list[tuple]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, then the three
    fertility measures (null without words) and the number of tokens, of each text.

    The words of all the texts are told apart once, and each is tokenised once.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    split = pc.ascii_split_whitespace(texts)
    words = split.flatten()
    real = pc.not_equal(words, "")
    bounds = np.concatenate([[0], np.cumsum(np.asarray(real).astype(np.int64))])[
        np.concatenate([[0], np.cumsum(pc.list_value_length(split).to_numpy(zero_copy_only=False))])]
    words = words.filter(real)
    chars = np.concatenate([[0], np.cumsum(pc.utf8_length(words).to_numpy(zero_copy_only=False))])
    coded = words.dictionary_encode()
    ids = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    tokens, sizes = pieces.joined(coded.dictionary.to_pylist())
    first = np.cumsum(sizes) - sizes
    symbols = pc.count_substring_regex(texts, f"[{SYMBOLS}]").to_pylist()
    out = []
    for k, text in enumerate(texts.to_pylist()):
        own = ids[bounds[k]:bounds[k + 1]]
        base = (len(own), int(chars[bounds[k + 1]] - chars[bounds[k]]), symbols[k], duplicate_lines(text), repeated_window_words(own))
        many = sizes[own]
        total = int(many.sum())
        if not total:
            out.append((*base, None, None, None, 0))
            continue
        all_tokens = tokens[np.repeat(first[own] - (np.cumsum(many) - many), many) + np.arange(total)]
        mass = np.bincount(all_tokens)
        mass = mass[mass > 0] / total
        entropy = float(-(mass * np.log2(mass)).sum())
        out.append((*base, base[1] / total, float(pieces.is_byte[all_tokens].sum() / total), entropy, total))
    return out


def measure(text: str | None, pieces: Pieces) -> tuple:
    """The measures of one text."""
    return measure_all(pa.array([text], pa.large_string()), pieces)[0]


_COLUMNS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "chars_per_token", "byte_share",
            "token_entropy", "n_pieces")
_TYPES = [pa.int64()] * 5 + [pa.float64()] * 3 + [pa.int64()]
_SCHEMA = ("doc_id long, lang string, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
           "chars_per_token double, byte_share double, token_entropy double, n_pieces long")


def measure_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang",
                      model_file: str | None = None) -> DataFrame:
    """One row of measures per row of ``docs``."""
    path = model_file or tokenizer_file("piece_bpe_32k.model")
    kept: list[Pieces] = []

    def run(batches):
        if not kept:
            kept.append(Pieces(path))
        for batch in batches:
            # Whole texts, as many at once as have _STEP bytes; a longer one is worked on alone.
            upto = np.cumsum(pc.fill_null(pc.binary_length(batch.column(2)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
            lo = 0
            while lo < batch.num_rows:
                before = upto[lo - 1] if lo else 0
                n = max(1, int(np.searchsorted(upto, before + _STEP, "right")) - lo)
                part = batch.slice(lo, n)
                cols = [pa.array(c, t) for c, t in zip(zip(*measure_all(part.column(2), kept[0])), _TYPES)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), *cols], ["doc_id", "lang", *_COLUMNS])
                lo += n

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(lang_col).cast("string").alias("lang"),
                      F.col(text_col).cast("string").alias("text"))
    return src.mapInArrow(run, _SCHEMA)


def _quantiles(rows: DataFrame, scaled: dict, at: dict[str, float]) -> DataFrame:
    """(lang, <name>_<measure>...) quantiles of the ``scaled`` expressions of all rows."""
    long = rows.select("lang", F.explode(F.array(*(
        F.struct(F.lit(m).alias("m"), F.floor(x * BINS[m]).cast("long").alias("bin")) for m, x in scaled.items()))).alias("x"))
    bins = long.groupBy("lang", "x.m", "x.bin").agg(F.count("*").alias("n"))
    by = W.partitionBy("lang", "m")
    run = bins.withColumn("upto", F.sum("n").over(by.orderBy("bin").rowsBetween(W.unboundedPreceding, 0))).withColumn(
        "all", F.sum("n").over(by))
    return run.groupBy("lang").agg(*(
        (F.min(F.when((F.col("m") == m) & (F.col("upto") >= q * F.col("all")), F.col("bin"))) / float(BINS[m])).alias(f"{name}_{m}")
        for m in scaled for name, q in at.items()))


def _with(rows: DataFrame, per_lang: DataFrame) -> DataFrame:
    """Adds a language's row to its texts; null languages meet too."""
    small = stored(per_lang.withColumnRenamed("lang", "band_lang").coalesce(1), "bands")
    small = F.broadcast(small) if small.count() <= BROADCAST_BANDS else small
    return rows.join(small, rows["lang"].eqNullSafe(small["band_lang"]), "left").drop("band_lang")


def _spread(m: str):
    """Distance from the language's median in units that do not shrink with length."""
    return (F.col(m) - F.col(f"mid_{m}")) * F.sqrt(F.col("n_words"))


def judge_documents(docs: DataFrame, fence: float = FENCE, **args) -> DataFrame:
    """Measures of every row with base_failed and kept."""
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_SHARE * F.col("n_words"))
    measures = stored(measure_documents(docs, **args).withColumn("base_failed", failed), "fertility")

    def passed(rows):
        return rows.where("not base_failed and n_pieces > 0")

    centred = _with(measures, _quantiles(passed(measures), {m: F.col(m) for m in BINS}, {"mid": 0.5}))
    out = _with(centred, _quantiles(passed(centred), {m: _spread(m) for m in BINS}, {"low": 0.25, "high": 0.75}))
    inside = F.lit(True)
    for m in BINS:
        low, high = F.col(f"low_{m}"), F.col(f"high_{m}")
        wide = fence * (high - low)
        near = F.abs(F.col(m) - F.col(f"mid_{m}")) <= MARGIN[m]
        inside = inside & F.coalesce(near | _spread(m).between(low - wide, high + wide), F.lit(True))
    return out.select("doc_id", "lang", *_COLUMNS, "base_failed", (~F.col("base_failed") & inside).alias("kept"))
