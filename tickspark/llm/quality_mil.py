"""Operator 13: text quality by attention-based multiple-instance learning.

A document is a bag of passages (pieces of lines of at most ``PASSAGE`` bytes). Every
passage of the whole text is encoded: dense counts of its bytes, words and repetitions,
then a learned layer. Gated attention (tanh times sigmoid) weighs the passages of a bag,
and a logistic layer scores the weighted mean. Only documents have labels; the weights
of the passages are learned from them.

Learning uses a bounded sample: at most ``max_labelled`` labelled rows and
``max_bytes`` of their text, in the order of a hash of the id, trained in one task.
Scoring reads every text in pieces of ``STEP`` bytes with a running softmax: memory does
not grow with the length of a text.

Defined cases: a null or empty text, or one of white space only, is a bag of one empty
passage; rows with null labels or ids teach nothing; an id with several labels counts as
good only if all say so, and with several texts is taught by the smallest; with fewer
than two classes to learn from, every score is the share of good rows (0.5 if there are
none). Repeated rows and other columns are kept; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

from tickspark.llm.common import mix64, stored
from tickspark.operators.ranking import fresh

MAX_LABELLED, MAX_BYTES = 8_000, 48 << 20
THRESHOLD = 0.3
PASSAGE, STEP = 256, 1 << 18  # bytes of a passage; bytes of text worked on at once
HIDDEN, GATE, EPOCHS, BAGS, RATE = 24, 16, 10, 64, 0.01
#: Signs that have a share of their own; the others are counted together.
SIGNS = b".,;:!?#$%&*|<>/\\()[]{}-_=+\"'@^~`"
_CLASS = np.full(256, 4, np.int64)  # 0 upper, 1 lower, 2 digit, 3 white space, 4 control, 5 beyond ASCII, 6.. signs
_CLASS[65:91], _CLASS[97:123], _CLASS[48:58], _CLASS[128:] = 0, 1, 2, 5
_CLASS[[9, 10, 11, 12, 13, 32]] = 3
_CLASS[list(SIGNS)] = 6 + np.arange(len(SIGNS))
N_CLASSES = 6 + len(SIGNS)
N_FEATURES = N_CLASSES + 9


def passages(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, features, hash) of every passage that holds a word, in order.

    ``data``: bytes of consecutive texts, ``bounds``: where each starts, and the end.
    """
    n = len(data)
    kinds = _CLASS[data]
    doc_at = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    # A line opens at a text's start and after a line end; a passage every PASSAGE bytes of it.
    opens = np.zeros(n, bool)
    opens[bounds[:-1][bounds[:-1] < n]] = True
    opens[1:] |= data[:-1] == 10
    starts = np.flatnonzero(opens)
    place = np.arange(n) - np.repeat(starts, np.diff(np.append(starts, n)))
    opens = place % PASSAGE == 0
    part = np.cumsum(opens) - 1
    at = np.flatnonzero(opens)
    doc = doc_at[at]
    size = np.diff(np.append(at, n)).astype(float)
    shares = np.bincount(part * N_CLASSES + kinds, minlength=len(at) * N_CLASSES).reshape(-1, N_CLASSES) / size[:, None]
    # Words are runs of bytes that are not white space; one counts where it starts.
    solid = kinds != 3
    first = solid.copy()
    first[1:] &= ~solid[:-1] | (doc_at[1:] != doc_at[:-1])
    last = solid.copy()
    last[:-1] &= ~solid[1:] | (doc_at[1:] != doc_at[:-1])
    w_at, w_end = np.flatnonzero(first), np.flatnonzero(last) + 1
    words = part[w_at]
    n_words = np.bincount(words, minlength=len(at))
    full = np.maximum(n_words, 1)

    def mean(values):
        return np.bincount(words, weights=values, minlength=len(at)) / full

    hashes = _hashes(data, w_at, w_end)
    length = (w_end - w_at).astype(float)
    average = mean(length)
    same = np.zeros((2, len(words)))
    for k in (1, 2):
        same[k - 1, k:] = (hashes[k:] == hashes[:-k]) & (doc_at[w_at[k:]] == doc_at[w_at[:-k]])
    with np.errstate(over="ignore"):
        once = np.zeros(len(words))
        once[np.unique(mix64(hashes + words.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), return_index=True)[1]] = 1.0
        text = mix64(np.bincount(words, minlength=len(at)).astype(np.uint64))
        if len(words):
            holds, begin = np.unique(words, return_index=True)
            order = np.arange(len(words), dtype=np.uint64) - begin[np.searchsorted(holds, words)].astype(np.uint64)
            text[holds] ^= np.bitwise_xor.reduceat(mix64(hashes + order * np.uint64(0xD6E8FEB86659FD93)), begin)
    more = np.column_stack([
        np.log1p(size), np.log1p(n_words), average, np.sqrt(np.maximum(mean(length ** 2) - average ** 2, 0)), mean(same[0]),
        mean(same[1]), mean(once), mean((kinds[w_end - 1] >= 6).astype(float)), mean((kinds[w_at] == 0).astype(float))])
    keep = n_words > 0
    return doc[keep], np.hstack([shares, more])[keep], text[keep]


def _hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hashes of the byte runs: an exclusive or over (place in the run, byte)."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    size = ends - starts
    inside = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    with np.errstate(over="ignore"):
        each = mix64(data[np.repeat(starts, size) + inside].astype(np.uint64) + np.uint64(256) * inside.astype(np.uint64) + np.uint64(1))
    return np.bitwise_xor.reduceat(each, np.cumsum(size) - size)


def bags(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, row of each passage less the first, features), in pieces of STEP bytes.

    Features end with the share of passages before (1 or 0) that equal this one, over
    the whole text. A text longer than a piece comes in several, cut at white space if
    there is any. An empty text has one passage of zeros.
    """
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset:texts.offset + len(texts) + 1]
    buffer = texts.buffers()[2]
    data = np.frombuffer(buffer, np.uint8) if buffer is not None else np.zeros(0, np.uint8)
    row = 0
    while row < len(texts):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + STEP, "right")) - 1)
        seen: set[int] = set()
        some, low, high = end - row > 1, int(offsets[row]), int(offsets[end])
        found = False
        while low < high or not found:
            cut = high if some else min(high, low + STEP)
            if cut < high:
                space = np.flatnonzero(_CLASS[data[low:cut]] == 3)
                cut = low + int(space[-1]) + 1 if len(space) else cut
            bounds = offsets[row:end + 1] - low if some else np.array([0, cut - low])
            doc, x, text = passages(data[low:cut], bounds)
            again = np.zeros(len(doc))
            if some:
                pair = mix64(text ^ mix64(doc.astype(np.uint64)))
                again[:] = 1.0
                again[np.unique(pair, return_index=True)[1]] = 0.0
            else:
                for k, t in enumerate(text.tolist()):
                    again[k] = t in seen
                    seen.add(t)
            x = np.column_stack([x, again])
            low, found = cut, True
            if some or len(doc):
                lacks = np.setdiff1d(np.arange(end - row), doc) if some else np.zeros(0, int)
                order = np.argsort(np.append(doc, lacks), kind="stable")
                yield row, np.append(doc, lacks)[order], np.vstack([x, np.zeros((len(lacks), x.shape[1]))])[order]
            elif low >= high and not seen:
                yield row, np.zeros(1, int), np.zeros((1, N_FEATURES + 1))
        row = end


class Model:
    """Weights of the encoder, the gated attention and the output, by name."""

    SHAPES = {"W": (N_FEATURES + 1, HIDDEN), "b": (HIDDEN,), "V": (HIDDEN, GATE), "v": (GATE,), "U": (HIDDEN, GATE), "u": (GATE,),
              "w": (GATE,), "o": (HIDDEN,), "c": (1,)}

    def __init__(self, mean: np.ndarray, scale: np.ndarray, weights: dict[str, np.ndarray]):
        self.mean, self.scale, self.weights = mean, scale, weights

    def passages(self, x: np.ndarray) -> tuple:
        """Encoded passages, their attention logits and what the gradient needs."""
        p = self.weights
        h = np.tanh(np.clip((x - self.mean) / self.scale, -8, 8) @ p["W"] + p["b"])
        t = np.tanh(h @ p["V"] + p["v"])
        g = 1 / (1 + np.exp(-(h @ p["U"] + p["u"])))
        return h, (t * g) @ p["w"], t, g

    def scores(self, texts: pa.Array) -> np.ndarray:
        top = np.full(len(texts), -np.inf)
        mass, mixed = np.zeros(len(texts)), np.zeros((len(texts), HIDDEN))
        for row, doc, x in bags(texts):
            h, a, _, _ = self.passages(x)
            rows, begin = np.unique(doc, return_index=True)
            rows = rows + row
            best = np.maximum(top[rows], np.maximum.reduceat(a, begin))
            fade = np.exp(top[rows] - best)
            e = np.exp(a - np.repeat(best, np.diff(np.append(begin, len(doc)))))
            mass[rows] = mass[rows] * fade + np.add.reduceat(e, begin)
            mixed[rows] = mixed[rows] * fade[:, None] + np.add.reduceat(e[:, None] * h, begin)
            top[rows] = best
        z = mixed / np.maximum(mass, 1e-300)[:, None]
        return 1 / (1 + np.exp(-(z @ self.weights["o"] + self.weights["c"][0])))

    def gradient(self, x: np.ndarray, begin: np.ndarray, y: np.ndarray) -> tuple[float, dict[str, np.ndarray]]:
        """Mean log loss of bags (``begin``: first passage of each) and its gradient."""
        p, size = self.weights, np.diff(np.append(begin, len(x)))
        s = np.clip((x - self.mean) / self.scale, -8, 8)
        h, a, t, g = self.passages(x)
        e = np.exp(a - np.repeat(np.maximum.reduceat(a, begin), size))
        alpha = e / np.repeat(np.add.reduceat(e, begin), size)
        z = np.add.reduceat(alpha[:, None] * h, begin)
        score = 1 / (1 + np.exp(-(z @ p["o"] + p["c"][0])))
        loss = -np.mean(np.where(y > 0, np.log(score + 1e-12), np.log(1 - score + 1e-12)))
        d = (score - y) / len(y)
        dz = np.repeat(d[:, None] * p["o"], size, axis=0)
        gain = np.sum(dz * h, axis=1)
        da = alpha * (gain - np.repeat(np.add.reduceat(alpha * gain, begin), size))
        dt, dg = da[:, None] * p["w"] * g * (1 - t ** 2), da[:, None] * p["w"] * t * g * (1 - g)
        dh = (alpha[:, None] * dz + dt @ p["V"].T + dg @ p["U"].T) * (1 - h ** 2)
        return loss, {"W": s.T @ dh, "b": dh.sum(0), "V": h.T @ dt, "v": dt.sum(0), "U": h.T @ dg, "u": dg.sum(0),
                      "w": (t * g).T @ da, "o": z.T @ d, "c": np.array([d.sum()])}


def fit(texts: pa.Array, y: np.ndarray, epochs: int = EPOCHS, seed: int = 11) -> Model:
    """A model trained on whole bags by Adam, in one fixed order."""
    parts = [(row + doc, x) for row, doc, x in bags(texts)]
    doc, x = np.concatenate([d for d, _ in parts]), np.vstack([x for _, x in parts])
    first = np.searchsorted(doc, np.arange(len(y) + 1))
    scale = x.std(0)
    rng = np.random.default_rng(seed)
    weights = {k: rng.normal(0, 1 / np.sqrt(shape[0]), shape) if len(shape) > 1 or k in "wo" else np.zeros(shape)
               for k, shape in Model.SHAPES.items()}
    model = Model(x.mean(0), np.where(scale > 1e-9, scale, 1.0), weights)
    m = {k: np.zeros_like(w) for k, w in weights.items()}
    v = {k: np.zeros_like(w) for k, w in weights.items()}
    step = 0
    for epoch in range(epochs):
        order = rng.permutation(len(y))
        for k in range(0, len(y), BAGS):
            chosen = order[k:k + BAGS]
            size = first[chosen + 1] - first[chosen]
            begin = np.cumsum(size) - size
            rows = np.repeat(first[chosen] - begin, size) + np.arange(size.sum())
            _, grad = model.gradient(x[rows], begin, y[chosen])
            step += 1
            rate = RATE * (1 - epoch / epochs) * np.sqrt(1 - 0.999 ** step) / (1 - 0.9 ** step)
            for name, w in weights.items():
                full = grad[name] + (1e-4 * w if w.ndim > 1 else 0)
                m[name] += 0.1 * (full - m[name])
                v[name] += 0.001 * (full ** 2 - v[name])
                w -= rate * m[name] / (np.sqrt(v[name]) + 1e-8)
    return model


def _train(epochs: int):
    def run(batches):
        got = pa.Table.from_batches(list(batches)).combine_chunks()
        if got.num_rows:
            got = got.sort_by([("spread", "ascending"), ("id", "ascending")])
            model = fit(got["text"].combine_chunks(), got["label"].to_numpy().astype(float), epochs)
            named = {"mean": model.mean, "scale": model.scale} | model.weights
            yield pa.RecordBatch.from_arrays([pa.array(list(named)), pa.array([w.ravel().tolist() for w in named.values()])], ["name", "value"])

    return run


def labelled_sample(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str, text_col: str, label_col: str,
                    max_labelled: int, max_bytes: int) -> DataFrame:
    """(id, spread, text, label): at most ``max_labelled`` ids and ``max_bytes`` of text, in hash order."""
    ids = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
           .where("id is not null and label is not null").withColumnRenamed("id", id_col).where(may_learn).withColumnRenamed(id_col, "id")
           .groupBy("id").agg(F.min(F.when(F.col("label") > 0, 1).otherwise(0)).alias("label"))
           .withColumn("spread", F.xxhash64("id", F.lit(29))))
    chosen = ids.orderBy("spread", "id").limit(max_labelled)
    text = docs.select(F.col(id_col).cast("long").alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = text.where(F.octet_length("text") <= max_bytes).join(F.broadcast(chosen), "id").groupBy("id", "spread", "label").agg(F.min("text").alias("text"))
    # A running sum over at most max_labelled rows.
    so_far = F.sum(F.octet_length("text")).over(Window.orderBy("spread", "id").rowsBetween(Window.unboundedPreceding, 0))
    return rows.withColumn("__bytes", so_far).where(F.col("__bytes") <= max_bytes).select("id", "spread", "text", "label")


def train(sample: DataFrame, epochs: int = EPOCHS) -> Model:
    """The model of a bounded sample, trained in one task; the driver gets its weights."""
    got = sample.coalesce(1).mapInArrow(_train(epochs), "name string, value array<double>").collect()
    named = {r.name: np.array(r.value) for r in got}
    mean, scale = named.pop("mean"), named.pop("scale")
    return Model(mean, scale, {k: named[k].reshape(shape) for k, shape in Model.SHAPES.items()})


def score_quality(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
                  label_col: str = "quality", score_col: str = "quality_score", max_labelled: int = MAX_LABELLED,
                  max_bytes: int = MAX_BYTES, epochs: int = EPOCHS) -> DataFrame:
    """``docs`` with all its columns plus ``score_col`` (0 to 1, underscores added if the name
    is taken). ``may_learn`` is a condition on the id; rows where it is not true teach nothing."""
    may_learn = F.lit(True) if may_learn is None else may_learn
    name = fresh(docs.columns, score_col)
    sample = stored(labelled_sample(docs, labels, may_learn, id_col, text_col, label_col, max_labelled, max_bytes), "mil-sample")
    good, rows = sample.agg(F.count_if(F.col("label") == 1), F.count(F.lit(1))).first()
    if good in (0, rows):
        return docs.withColumn(name, F.lit(float(good) / rows if rows else 0.5))
    model = train(sample, epochs)

    @arrow_udf("double")
    def score(texts: pa.Array) -> pa.Array:
        return pa.array(model.scores(texts))

    return docs.withColumn(name, score(F.col(text_col).cast("string")))
