"""Operator 1: document scores of a subword lattice language model.

Every distinct word gets the summed probability of all its segmentations under a
public unigram vocabulary (``lattice.py``). The vocabulary file's own scores start
the arc weights; expectation rounds over all distinct training words fit them. The
lattice is the back-off of absolutely discounted training counts:

    p(word) = max(c - d, 0) / N + (d V / N) * lattice(word)

A document's probability is the mean over a grid of concentrations m (and of none)
of drawing its tokens from a Dirichlet(m p) urn, which lets a word recur in a text.

Defined cases: a null or empty text is one end token; a null id counts as training;
repeated rows are scored each on its own; without training tokens only the lattice
speaks; an empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickspark.llm.common import stored, tokenizer_file
from tickspark.llm.lattice import Lattice, load_pieces

EM_ROUNDS = 2
#: A word with at least 1/DICT_SHARE of all tokens goes into the broadcast table, so
#: that has at most DICT_SHARE rows at any corpus size; all others are joined.
DICT_SHARE = 1 << 20
CONCENTRATIONS = (50.0, 200.0, 1000.0, 5000.0)
_FLUSH = 200_000


def tokens(text: bytes | None) -> list[bytes]:
    """Words between ASCII white space with A-Z lowered, then one end (empty) token."""
    out = (text or b"").lower().split()
    out.append(b"")
    return out


def _count(batches):
    """Partial (word, training count, count) rows, flushed before they get many."""
    train, other = Counter(), Counter()

    def flush():
        words = list(train.keys() | other.keys())
        n = [train[w] for w in words]
        out = pa.RecordBatch.from_arrays(
            [pa.array(words, pa.binary()), pa.array(n, pa.int64()),
             pa.array([a + other[w] for a, w in zip(n, words)], pa.int64())], ["word", "c", "n"])
        train.clear()
        other.clear()
        return out

    for batch in batches:
        for text, learn in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            (train if learn else other).update(tokens(text))
            if len(train) + len(other) > _FLUSH:
                yield flush()
    if train or other:
        yield flush()


def _fit_weights(words: DataFrame, lattice: Lattice, rounds: int) -> Lattice:
    """Expectation rounds over all distinct training words; what comes back has one
    row per vocabulary piece at most."""
    def expect(batches):
        total = [np.zeros(len(x)) for x in lattice.names]
        ends = 0.0
        for batch in batches:
            got = batch.column(0).to_pylist()
            a, b, e = lattice.expect(got, np.ones(len(got)))
            total[0] += a
            total[1] += b
            ends += e
        for side, x in enumerate([*total, np.array([ends])]):
            at = np.flatnonzero(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(at), side, np.int32)), pa.array(at.astype(np.int32)), pa.array(x[at])],
                ["side", "piece", "mass"])

    for _ in range(rounds):
        got = (words.where("c > 0").select("word").mapInArrow(expect, "side int, piece int, mass double")
               .groupBy("side", "piece").agg(F.sum("mass").alias("mass")).toArrow())
        side, piece, mass = (got.column(i).to_numpy() for i in range(3))
        if not len(side):
            break
        total = [np.full(len(x), 0.01) for x in lattice.names]
        for s in (0, 1):
            total[s][piece[side == s]] += mass[side == s]
        ends = float(mass[side == 2].sum()) + 0.01
        end = ends / (total[1].sum() + ends)
        lattice.set_weights([total[0] / total[0].sum(), total[1] / total[1].sum() * (1 - end)], end)
    return lattice


def _score(entries, concentrations):
    """mapInArrow function: a sum row per document (word null) and a row for each of
    its words that the broadcast table does not have."""
    logs = [math.log(m) for m in concentrations]
    lgamma, grid = math.lgamma, list(enumerate(concentrations))
    kept: dict = {}

    def table():
        if not kept:
            words, base, known, logp = entries.value
            kept.update(zip(words, zip(base.tolist(), known.tolist(), logp.tolist(), np.exp(logp).tolist())))
            kept[None] = True
        return kept

    def run(batches):
        get = table().get
        for batch in batches:
            rows, doc_ids, texts, held = (batch.column(i).to_pylist() for i in range(4))
            for lo in range(0, len(rows), 1000):
                sums, missed = [], ([], [], [])
                for row, doc_id, text, out in zip(*(x[lo:lo + 1000] for x in (rows, doc_ids, texts, held))):
                    counts = Counter(tokens(text))
                    n_tokens, n_known, base, plain, once = counts.total(), 0, 0.0, 0.0, 0.0
                    urn = [lgamma(m) - lgamma(m + n_tokens) for m in concentrations]
                    seen = 0
                    for word, n in counts.items():
                        e = get(word)
                        if e is None:
                            missed[0].append(row)
                            missed[1].append(word)
                            missed[2].append(n)
                            continue
                        b, known, logp, p = e
                        seen += 1
                        base += n * b
                        plain += n * logp
                        once += logp
                        n_known += n * known
                        if n > 1:
                            for k, m in grid:
                                urn[k] += lgamma(m * p + n) - lgamma(m * p + 1.0)
                    urn = [u + once + seen * x for u, x in zip(urn, logs)]
                    sums.append((row, doc_id, out, n_tokens, n_known, base, plain, urn))
                cols = list(zip(*sums))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.bool_()),
                     pa.nulls(len(sums), pa.binary()), pa.array(cols[3], pa.int64()), pa.array(cols[4], pa.int64()),
                     pa.array(cols[5], pa.float64()), pa.array(cols[6], pa.float64()),
                     pa.array(cols[7], pa.list_(pa.float64()))], names)
                if missed[0]:
                    none = len(missed[0])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(missed[0], pa.int64()), pa.nulls(none, pa.int64()), pa.nulls(none, pa.bool_()),
                         pa.array(missed[1], pa.binary()), pa.array(missed[2], pa.int64()), pa.nulls(none, pa.int64()),
                         pa.nulls(none, pa.float64()), pa.nulls(none, pa.float64()),
                         pa.nulls(none, pa.list_(pa.float64()))], names)

    names = ["row", "doc_id", "held_out", "word", "n", "n_known", "base", "plain", "urn"]
    return run


_SUMS = ("row long, doc_id long, held_out boolean, word binary, n long, n_known long, base double, plain double, "
         "urn array<double>")


def score_documents(docs: DataFrame, held_out: Column, id_col: str = "doc_id", text_col: str = "text",
                    model_file: str | None = None, em_rounds: int = EM_ROUNDS, dict_share: int = DICT_SHARE,
                    concentrations: tuple[float, ...] = CONCENTRATIONS) -> DataFrame:
    """One row per row of ``docs``: id, held_out, n_tokens, n_known, train_tokens,
    base_score (add-half unigram) and score, both log10. Rows where ``held_out`` is
    true do not train. One shuffle of distinct words per task counts the corpus, one
    join brings rare words their scores, one aggregation sums them by document."""
    spark = docs.sparkSession
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                      F.col(text_col).cast("binary").alias("text"), F.coalesce(held_out, F.lit(False)).alias("held_out"))
    words = stored(src.select("text", (~F.col("held_out")).alias("learn"))
                   .mapInArrow(_count, "word binary, c long, n long")
                   .groupBy("word").agg(F.sum("c").alias("c"), F.sum("n").alias("n")), "lm-words")
    n_train, vocab, n1, n2, n_all = words.agg(
        F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0), F.count_if(F.col("c") == 1),
        F.count_if(F.col("c") == 2), F.coalesce(F.sum("n"), F.lit(0))).first()
    lattice = _fit_weights(words, Lattice(*load_pieces(model_file or tokenizer_file("piece_bpe_32k.model"))), em_rounds)

    def weigh(batches):
        for batch in batches:
            logs = lattice.log_prob(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(logs)], ["word", "c", "n", "lattice"])

    discount = min(0.9, max(0.1, n1 / (n1 + 2 * n2) if n1 + n2 else 0.5))
    backoff = discount * vocab / n_train if n_train else 1.0
    c, denominator = F.col("c"), n_train + 0.5 * (vocab + 1)
    spread = math.log(backoff) + F.col("lattice")
    scored = stored(words.mapInArrow(weigh, "word binary, c long, n long, lattice double").select(
        "word", "c", "n", F.log10((c + 0.5) / denominator).alias("b"),
        F.when(c > 0, F.log((c - discount) / max(n_train, 1) + F.exp(spread))).otherwise(spread).alias("logp")), "lm-scores")
    common = F.col("n") * F.lit(dict_share) >= F.lit(n_all)
    top = scored.where(common).select("word", "b", (c > 0).cast("int").alias("known"), "logp").toArrow()
    entries = spark.sparkContext.broadcast(
        (top.column(0).to_pylist(), top.column(1).to_numpy(), top.column(2).to_numpy(), top.column(3).to_numpy()))
    rows = src.select("row", "doc_id", "text", "held_out").mapInArrow(_score(entries, concentrations), _SUMS)
    rare = scored.where(~common).select("word", "c", "b", "logp")
    again = F.sequence(F.lit(1), F.greatest(F.col("n") - 1, F.lit(1)))

    def drawn(m):
        """log of m p (m p + 1) ... (m p + n - 1)."""
        more = F.aggregate(again, F.lit(0.0), lambda a, k: a + F.log(m * F.exp(F.col("logp")) + k))
        return math.log(m) + F.col("logp") + F.when(F.col("n") > 1, more).otherwise(0.0)

    urn = F.array(*(drawn(m) for m in concentrations))
    # A sum row joins under a key of its own that no word can equal (it has a space).
    own = F.concat(F.lit(b" "), F.col("row").cast("string").cast("binary"))
    keyed = rows.withColumn("lone", F.col("word").isNotNull()).withColumn("word", F.coalesce("word", own))
    parts = keyed.join(rare, "word", "left").select(
        "row", "doc_id", "held_out", F.when(~F.col("lone"), F.col("n")).alias("n_tokens"),
        F.when(F.col("lone"), F.when(c > 0, F.col("n")).otherwise(0)).otherwise(F.col("n_known")).alias("n_known"),
        F.when(F.col("lone"), F.col("n") * F.col("b")).otherwise(F.col("base")).alias("base"),
        F.when(F.col("lone"), F.col("n") * F.col("logp")).otherwise(F.col("plain")).alias("plain"),
        F.when(F.col("lone"), urn).otherwise(F.col("urn")).alias("urn"))
    sums = parts.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.coalesce(F.max("held_out"), F.lit(False)).alias("held_out"),
        F.max("n_tokens").alias("n_tokens"), F.sum("n_known").alias("n_known"), F.sum("base").alias("base_score"),
        F.sum("plain").alias("plain"), *(F.sum(F.col("urn")[k]).alias(f"urn{k}") for k in range(len(concentrations))))
    logs = [F.col("plain"), *(F.col(f"urn{k}") for k in range(len(concentrations)))]
    most = F.greatest(*logs) if len(logs) > 1 else logs[0]
    total = sum((F.exp(x - F.col("most")) for x in logs), F.lit(0.0))
    return sums.withColumn("most", most).select(
        F.col("doc_id").alias(id_col), "held_out", "n_tokens", "n_known", F.lit(n_train).cast("long").alias("train_tokens"),
        "base_score", ((F.col("most") + F.log(total / len(logs))) / math.log(10)).alias("score"))
