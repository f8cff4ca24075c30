"""Manifests of a lake (K4, A42): per partition its files, rows, time bounds and content.

``manifest`` is one aggregation over the lake. The content hash is a pair of sums of row
hashes over all columns: free of the order of rows and columns and of how rows are cut
into files, and different when any value moves to another row. ``publish`` stores the
manifest beside the dataset and then marks its dates; ``verify`` holds a lake against
what was stored.
"""

from __future__ import annotations

from typing import Sequence

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.sources import lake
from tickspark.sources.listing import open_uri, partition_folders

SCHEMA_VERSION = 2
MARKER = "_SUCCESS"
KEYS = ("trade_date", "symbol")


def content_sums(columns: Sequence[str]) -> list:
    """Two order-free sums of row hashes, each with a seed of its own."""
    row = [F.col(c) for c in sorted(columns)]
    return [F.sum(F.xxhash64(F.lit(seed), *row).cast("decimal(20,0)")).alias(name) for seed, name in ((7, "content_a"), (11, "content_b"))]


def manifest(lake_df: DataFrame, requested: DataFrame | None = None, ts: str = "ts_event", seq: str | None = "tr_seqnum",
             size: str | None = "size", keys: Sequence[str] = KEYS, file_col: str | None = None) -> DataFrame:
    """One row per partition: rows, time bounds, sorted file list and its length, checksums,
    content sums, schema version and, given the ``requested`` symbols, whether asked for.

    The file list is of one partition's files. ``lake_df`` is a plain read of the lake, or
    has the path of each row's file in ``file_col`` (which is no part of the content)."""
    file = F.col(file_col or "_metadata.file_path")
    data = [c for c in lake_df.columns if c != file_col]
    sums = [F.sum(c).cast("long").alias(n) for c, n in ((seq, "seq_checksum"), (size, "size_checksum")) if c is not None]
    per_file = lake_df.groupBy(*keys, file.alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min(ts).alias("lo"), F.max(ts).alias("hi"), *sums, *content_sums(data))
    m = per_file.groupBy(*keys).agg(
        F.sum("n").alias("n_rows"), F.min("lo").alias("min_ts"), F.max("hi").alias("max_ts"),
        F.count(F.lit(1)).cast("int").alias("n_files"), F.sort_array(F.collect_list("file")).alias("files"),
        *(F.sum(c).alias(c) for c in [*(n for c, n in ((seq, "seq_checksum"), (size, "size_checksum")) if c is not None), "content_a", "content_b"]))
    m = m.withColumn("schema_version", F.lit(SCHEMA_VERSION))
    if requested is not None:
        flag = requested.select("symbol").distinct().withColumn("requested", F.lit(True))
        m = (m.join(flag, "symbol", "left")
             .withColumn("requested", F.coalesce("requested", F.lit(False))))
    return m


def manifest_path(root: str, dataset: str) -> str:
    return f"{root}/_manifest/{dataset}"


def publish(spark: SparkSession, root: str, dataset: str, requested: DataFrame | None = None, dates: DataFrame | None = None, **args) -> None:
    """Stores the manifest of ``dataset`` (of ``dates`` only, if given) under ``root/_manifest``,
    replacing those dates' rows, and then writes a marker into every date's folder. A
    date is marked only when its manifest stands; doing it again changes nothing."""
    read = lake.read_lake(spark, root, dataset)
    if dates is not None:
        read = read.withColumn("__file", F.col("_metadata.file_path")).join(dates.select("trade_date").distinct(), "trade_date", "left_semi")
        args = args | {"file_col": "__file"}
    made = manifest(read, requested, **args)
    (made.repartition("trade_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("trade_date").parquet(manifest_path(root, dataset)))
    folders = partition_folders(spark, root, dataset)
    if dates is not None:
        folders = folders.join(dates.select("trade_date").distinct(), "trade_date", "left_semi")
    folders.select(F.regexp_extract("folder", r"^(.*/trade_date=[^/]*)", 1).alias("folder")).distinct().mapInArrow(
        _mark, "marked long").agg(F.sum("marked")).first()


def _mark(batches):
    for batch in batches:
        for folder in batch.column(0).to_pylist():
            fs, path = open_uri(folder)
            fs.open_output_stream(f"{path}/{MARKER}").close()
        yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows], pa.int64())], ["marked"])


def read_manifest(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    return spark.read.parquet(manifest_path(root, dataset))


def marked_dates(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """Dates whose folder holds the marker, i.e. that were published to the end."""
    def look(batches):
        for batch in batches:
            rows = []
            for date, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fs, path = open_uri(folder)
                if fs.get_file_info(f"{path}/{MARKER}").is_file:
                    rows.append(date)
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.date32())], ["trade_date"])

    folders = partition_folders(spark, root, dataset).select(
        "trade_date", F.regexp_extract("folder", r"^(.*/trade_date=[^/]*)", 1).alias("folder")).distinct()
    return folders.mapInArrow(look, "trade_date date")


def verify(spark: SparkSession, root: str, dataset: str, **args) -> DataFrame:
    """Every partition that is stored in the manifest or there now, with ``status``: ``ok``,
    ``changed`` (other rows or values), ``missing`` (gone) or ``unlisted`` (not in the manifest)."""
    told = read_manifest(spark, root, dataset).select(*KEYS, F.struct("n_rows", "content_a", "content_b").alias("told"))
    now = manifest(lake.read_lake(spark, root, dataset), **args).select(
        F.col("trade_date").alias("d"), F.col("symbol").alias("s"), F.struct("n_rows", "content_a", "content_b").alias("now"))
    both = told.join(now, F.col("trade_date").eqNullSafe(F.col("d")) & F.col("symbol").eqNullSafe(F.col("s")), "full_outer")
    status = (F.when(F.col("now").isNull(), F.lit("missing")).when(F.col("told").isNull(), F.lit("unlisted"))
              .when(F.col("now") == F.col("told"), F.lit("ok")).otherwise(F.lit("changed")))
    return both.select(F.coalesce("trade_date", "d").alias("trade_date"), F.coalesce("symbol", "s").alias("symbol"), status.alias("status"))
