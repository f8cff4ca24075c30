"""ST1: incremental landing → canonical lake, exactly once per file.

A file-source stream with an explicit schema whose micro-batches are loads of the lake
(``sources/lake.py``): each is written by dynamic overwrite of its own load folders, so
a batch that is run again after a failure replaces itself, and batch jobs can append
to, overwrite and read the same dataset. The checkpoint skips files already done (the
reference's skip/resume). ``rebalance`` splits a hot symbol-day over tasks.
``trigger(availableNow=True)`` drains what is there and stops, so the same job
serves as a scheduled batch or a continuous stream.
"""

from __future__ import annotations

import json
from typing import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tickspark.sources import lake


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that a stream keeps in its checkpoint; loads of another checkpoint differ by it."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def ingest_stream(spark: SparkSession, landing: str, schema: T.StructType, root: str, dataset: str,
                  checkpoint: str, transform: Callable[[DataFrame], DataFrame] | None = None,
                  fmt: str = "csv", partition_by_symbol: bool = True, available_now: bool = True,
                  max_files_per_trigger: int | None = None, sort_cols: Sequence[str] = lake.ORDER):
    """Start the landing → ``root/dataset`` stream; returns the ``StreamingQuery``."""
    r = spark.readStream.schema(schema)
    if fmt == "csv":
        r = r.option("header", True).option("mode", "PERMISSIVE")
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    src = r.format(fmt).load(landing)
    df = transform(src) if transform else src

    def write(batch: DataFrame, number: int) -> None:
        load = f"stream-{stream_id(batch.sparkSession, checkpoint)}-{number:012d}"
        lake.write_partitioned(batch, root, dataset, partition_by_symbol, mode="append", sort_cols=sort_cols, load=load)

    w = df.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="10 seconds")
    return w.start()


def run_to_end(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()
