"""The corpus pipeline: five stages over ``documents``, each calling one operator.

Every stage takes (spark, docs, sf_dir); its result is written as Parquet and read
again as the next one's docs. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tickspark.llm import decontaminate, order_minhash, pfair_mix, token_shards, toxicity
from tickspark.llm.common import stored, table
from tickspark.session import scratch_path

#: Sequences per window of the final permutation: the mixture holds from window to window.
WINDOW = 1 << 16


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents under the toxicity threshold stay."""
    return toxicity.reject_toxic(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class of near copies stays."""
    return order_minhash.keep_one(docs)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item stay."""
    return decontaminate.drop_contaminated(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the source schedule."""
    return pfair_mix.mix(docs)


def write_tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token shards in training order; returns their table of contents."""
    return token_shards.materialise(docs, scratch_path(spark, "corpus-shards"), window=WINDOW)


STAGES = [("toxicity", drop_toxic), ("near duplicates", drop_near_duplicates), ("benchmark", drop_benchmark),
          ("mixing", mix_sources), ("token shards", write_tokens)]

#: SQL cannot express the trained, iterative and binary stages; tests hold each
#: against a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k + 1 < len(STAGES):
            docs = stored(docs, f"stage{k}")
    return docs
