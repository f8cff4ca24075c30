"""Operator 2: toxicity by gradient-boosted trees with isotonic calibration.

Learning uses a bounded sample of labelled rows (``max_labelled``), cut in three by
a hash of the id: the first half learns a lexicon (words and word beginnings that
are far more frequent in toxic texts), the next part the trees over dense features
(lexicon densities, nearness to second-person words, capitals, punctuation and
obfuscation rates), the last part the calibration. Scoring covers whole texts.

Defined cases: a null or empty text has all-zero rates and gets the model's score
for them; rows with null labels or ids teach nothing; an id with several labels
counts as toxic if any says so; with fewer than two classes to learn from, every
score is the share of toxic rows (0 if there are none). Repeated rows and other
columns are kept as they are; an empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from tickspark.llm.common import stored
from tickspark.operators.ranking import fresh

MAX_LABELLED = 20_000
THRESHOLD = 0.3
#: Lexicon terms: at least so many toxic texts and so many times as frequent in them.
MIN_TEXTS, MIN_RATIO, MAX_TERMS = 4, 6.0, 20_000
NEAR = 6  # words between a lexicon word and a second-person word
#: Second-person words of English, German, French and Spanish.
SECOND_PERSON = frozenset(
    "you your yours yourself du dich dir dein deine deinen ihr euch euer tu te toi ton ta tes vous votre vos "
    "tú ti tus usted ustedes vosotros".split())
#: Characters that stand for letters in obfuscated words.
LOOKALIKES = str.maketrans("013457@$!|€", "oieastasile")
_WORD = re.compile(r"[^\W\d_]+")
_MIXED = re.compile(r"(?<!\S)(?=[^\s]*[^\W\d_])(?=[^\s]*[013457@$!|*€])[^\s]{3,30}(?!\S)")
N_FEATURES = 13


def terms(word: str) -> list[str]:
    """The word and its beginnings of four to six letters (marked by a hyphen)."""
    return [word, *(word[:n] + "-" for n in (4, 5, 6) if len(word) >= n)]


def _near_second_person(words: list[str], hits: list[int]) -> int:
    return sum(any(w in SECOND_PERSON for w in words[max(0, k - NEAR):k + NEAR + 1]) for k in hits)


class Features:
    """Dense features of a text under a lexicon of term -> log ratio."""

    def __init__(self, lexicon: dict[str, float]):
        self.lexicon, self.known = lexicon, {}

    def weight(self, word: str) -> tuple[float, float]:
        """(the word's own log ratio, the largest of its beginnings)."""
        got = self.known.get(word)
        if got is None:
            if len(self.known) > 200_000:
                self.known.clear()
            whole, *stems = terms(word)
            got = self.known[word] = (self.lexicon.get(whole, 0.0), max((self.lexicon.get(s, 0.0) for s in stems), default=0.0))
        return got

    def of(self, text: str | None) -> list[float]:
        text = text or ""
        words = _WORD.findall(text.lower())
        n = max(1, len(words))
        hits: dict[str, tuple[float, float]] = {}
        n_word = n_stem = 0
        s_word = s_stem = 0.0
        for word, k in Counter(words).items():
            w, s = self.weight(word)
            if w or s:
                hits[word] = (w, s)
                n_word += k * (w > 0)
                n_stem += k * (s > 0)
                s_word += k * w
                s_stem += k * s
        at = [k for k, w in enumerate(words) if w in hits] if hits else []
        hidden = mixed = 0
        for odd in _MIXED.findall(text):
            plain = "".join(_WORD.findall(odd.lower().translate(LOOKALIKES)))
            mixed += 1
            hidden += plain not in hits and self.weight(plain)[0] > 0
        chars = max(1, len(text))
        letters = max(1, sum(map(len, words)))
        distinct = sum(w > 0 for w, _ in hits.values()), sum(s > 0 for _, s in hits.values())
        return [n_word / n, n_stem / n, s_word / n, s_stem / n, float(distinct[0]), float(distinct[1]),
                _near_second_person(words, at) / n, sum(map(str.isupper, text)) / letters,
                (text.count("!") + text.count("?")) / chars, sum(map(text.count, ".,;:")) / chars,
                mixed / n, hidden / n, math.log1p(len(words))]


def _features(lexicon: dict[str, float]):
    shared = Features(lexicon)

    @pandas_udf("array<double>")
    def features(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        try:
            for batch in texts:
                yield pd.Series([shared.of(t) for t in batch], dtype=object)
        finally:
            shared.known.clear()  # a worker that waits for its next task keeps no words

    return features


def _term_texts(batches):
    """Partial (term, toxic texts, other texts) counts; each text counts a term once."""
    for batch in batches:
        toxic, other = Counter(), Counter()
        for text, label in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            seen = {t for w in set(_WORD.findall((text or "").lower())) for t in terms(w)}
            (toxic if label else other).update(seen)
        names = list(toxic.keys() | other.keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(names), pa.array([toxic[t] for t in names], pa.int64()),
             pa.array([other[t] for t in names], pa.int64())], ["term", "toxic", "other"])


def learn_lexicon(rows: DataFrame) -> dict[str, float]:
    """term -> log ratio from (text, label) rows; at most MAX_TERMS, strongest first."""
    n1, n0 = rows.agg(F.count_if(F.col("label") == 1), F.count_if(F.col("label") == 0)).first()
    ratio = ((F.col("toxic") + 0.5) / (n1 + 1)) / ((F.col("other") + 0.5) / (n0 + 1))
    got = (rows.select("text", "label").mapInArrow(_term_texts, "term string, toxic long, other long")
           .groupBy("term").agg(F.sum("toxic").alias("toxic"), F.sum("other").alias("other"))
           .where((F.col("toxic") >= MIN_TEXTS) & (ratio >= MIN_RATIO))
           .select("term", F.log(ratio).alias("w"), "toxic").orderBy(F.desc(F.col("w") * F.col("toxic")), "term").limit(MAX_TERMS))
    return {r.term: r.w for r in got.collect()}


def labelled_sample(docs: DataFrame, labels: DataFrame, may_learn: Column, id_col: str, text_col: str, label_col: str,
                    max_labelled: int) -> DataFrame:
    """(text, label, part) of at most ``max_labelled`` labelled ids; part is 0 to 1 by hash."""
    ids = (labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("label"))
           .where(F.col("id").isNotNull() & F.col("label").isNotNull()).withColumnRenamed("id", id_col).where(may_learn)
           .groupBy(id_col).agg(F.max(F.when(F.col("label") > 0, 1).otherwise(0)).alias("label")))
    spread = F.pmod(F.xxhash64(id_col, F.lit(17)), F.lit(1 << 30)) / float(1 << 30)
    share = min(1.0, max_labelled / max(1, ids.count()))
    # The limit is only against hash luck, and in the order of the hash: the same rows in every run.
    chosen = ids.where(spread < share).orderBy(spread, id_col).limit(max_labelled)
    text = docs.select(F.col(id_col).cast("long").alias(id_col), F.col(text_col).cast("string").alias("text"))
    part = F.pmod(F.xxhash64(id_col, F.lit(23)), F.lit(1 << 30)) / float(1 << 30)
    return text.join(F.broadcast(chosen), id_col).groupBy(id_col).agg(
        F.min("text").alias("text"), F.max("label").alias("label")).withColumn("part", part)


def score_toxicity(docs: DataFrame, labels: DataFrame, may_learn: Column | None = None, id_col: str = "doc_id",
                   text_col: str = "text", label_col: str = "toxic", max_labelled: int = MAX_LABELLED,
                   trees: int = 20, depth: int = 3, score_col: str = "tox_score") -> DataFrame:
    """``docs`` with all its columns plus ``score_col`` (0 to 1; underscores are added while the
    name is taken). ``may_learn`` is a condition on the id column; rows where it is not
    true teach nothing."""
    score_col = fresh(docs.columns, score_col)
    may_learn = F.lit(True) if may_learn is None else may_learn
    sample = stored(labelled_sample(docs, labels, may_learn, id_col, text_col, label_col, max_labelled).coalesce(8), "tox-sample")
    lexicon = learn_lexicon(sample.where("part < 0.5"))
    features = _features(lexicon)
    model_rows = stored(sample.where("part >= 0.5").select(
        array_to_vector(features("text")).alias("__tox_x"), F.col("label").cast("double").alias("y"), "part")
        .repartition(4, "part").sortWithinPartitions("part", "y"), "tox-rows")
    # At most max_labelled rows, summed in one order: equal gains fall alike on any cluster.
    tree_rows = model_rows.where("part < 0.85").coalesce(1).sortWithinPartitions("part", "y")
    n1, n0 = tree_rows.agg(F.count_if(F.col("y") == 1), F.count_if(F.col("y") == 0)).first()
    if not n1 or not n0:
        share = sample.agg(F.coalesce(F.avg("label"), F.lit(0.0))).first()[0]
        return docs.withColumn(score_col, F.lit(float(share)))
    gbt = GBTClassifier(featuresCol="__tox_x", labelCol="y", predictionCol="__tox_pred", maxIter=trees, maxDepth=depth,
                        stepSize=0.2, seed=7, minInstancesPerNode=3)
    gbt = gbt.setProbabilityCol("__tox_prob").setRawPredictionCol("__tox_raw").fit(tree_rows)
    p = vector_to_array(F.col("__tox_prob"))[1]
    held = gbt.transform(model_rows.where("part >= 0.85")).select(p.alias("p"), "y")
    smooth = IsotonicRegression(featuresCol="p", labelCol="y", predictionCol="__tox_cal")
    # One toxic and one clean row at the ends keep the curve off plain 0 and 1.
    spark = docs.sparkSession
    iso = smooth.fit(held.unionByName(spark.createDataFrame([(0.0, 0.0), (1.0, 1.0)], "p double, y double")))
    curve = list(zip(iso.boundaries.toArray().tolist(), iso.predictions.toArray().tolist()))
    scored = gbt.transform(docs.withColumn("__tox_x", array_to_vector(features(F.col(text_col).cast("string")))))
    # The calibrated value decides; the trees' own probability orders equal values.
    cal = _interpolate(curve, F.col("__tox_p"))
    return (scored.withColumn("__tox_p", p).withColumn(score_col, 0.999 * cal + 0.001 * F.col("__tox_p"))
            .select(*docs.columns, score_col))


def _interpolate(curve: list[tuple[float, float]], x: Column) -> Column:
    """The isotonic curve as an expression: straight lines between its points."""
    points = F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b")) for a, b in curve))
    low = F.element_at(F.filter(points, lambda q: q["a"] <= x), -1)
    high = F.element_at(F.filter(points, lambda q: q["a"] >= x), 1)
    between = low["b"] + (high["b"] - low["b"]) * (x - low["a"]) / (high["a"] - low["a"])
    return (F.when(low.isNull(), F.lit(curve[0][1])).when(high.isNull(), F.lit(curve[-1][1]))
            .when(high["a"] == low["a"], low["b"]).otherwise(between))


def reject_toxic(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, **args) -> DataFrame:
    """The rows of ``docs`` scored under ``threshold``, columns unchanged."""
    name = fresh(docs.columns, "tox_score")
    return score_toxicity(docs, labels, score_col=name, **args).where(F.col(name) < threshold).select(*docs.columns)
