"""CSV drops (S6–S8): ``{prefix}_YYYYMMDD.csv`` files with a header row.

``find_drops`` lists a folder and reads every file's header in tasks; ``read_drops``
picks drops by data type (its prefix) and date, reads all files of one header in one
splittable scan of text columns, and brings every header to the canonical columns:
by name, in any order, missing ones NULL. Bad values become NULL through ``try_cast``
(the reference's "errors → null" inference); there is no per-file loop over rows.
"""

from __future__ import annotations

import datetime as _dt
import re
from collections import defaultdict
from functools import reduce

import pyarrow as pa
import pyarrow.fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.times import any_date, with_time_micros
from tickspark.schemas import DERIVED, SCHEMAS, conform
from tickspark.sources.listing import children, open_uri

DATE_IN_NAME = r"_(\d{8})\.csv"
_DROP = re.compile(r"([^/]+)_(\d{8})\.csv(?:/[^/]*)?$")
#: The prefixes that drops of each type are named by.
PREFIXES = {"trades": "taq_trade", "quotes": "taq_quote", "nbbo": "taq_nbbo"}
_HEADER_BYTES = 1 << 16


def _headers(batches):
    for batch in batches:
        out = []
        for file in batch.column(0).to_pylist():
            fs, path = open_uri(file)
            with fs.open_input_stream(path) as stream:
                line = stream.read(_HEADER_BYTES).split(b"\n", 1)[0]
            out.append(line.decode("utf-8-sig", "replace").rstrip("\r"))
        yield pa.RecordBatch.from_arrays([*(batch.column(k) for k in range(3)), pa.array(out, pa.string())],
                                         ["file", "prefix", "file_date", "header"])


def find_drops(spark: SparkSession, root: str) -> DataFrame:
    """(file, prefix, file_date, header) of every drop below ``root``. Names are listed by the
    driver (one per type and date), headers read by tasks."""
    scheme = root.split("://", 1)[0] + "://" if "://" in root else "file:" if root.startswith("file:") else ""
    rows = []
    for f in children(root, recursive=True):
        named = _DROP.search(f.path)
        if f.type == pafs.FileType.File and named:
            rows.append((scheme + f.path, named[1].rsplit("file=", 1)[-1], _dt.datetime.strptime(named[2], "%Y%m%d").date()))
    names = spark.createDataFrame(sorted(rows), "file string, prefix string, file_date date")
    spread = names.repartition(max(1, min(len(rows), 4 * spark.sparkContext.defaultParallelism)))
    return spread.mapInArrow(_headers, "file string, prefix string, file_date date, header string")


def read_drops(spark: SparkSession, root: str, data_type: str, dates=None, prefix: str | None = None,
               schema: T.StructType | None = None, sep: str = ",") -> DataFrame:
    """Drops of one ``data_type`` (by ``prefix``, default PREFIXES) and ``dates`` (None for all, a
    list, or a (first, last) tuple), with the original columns of the type's schema, typed,
    plus ``file_date`` and ``source_file``. Times of any writing become ``*_us`` and
    ``*_nano``; ``date`` falls back to the file's date. No drop gives no rows."""
    schema = schema or SCHEMAS[data_type]
    derived = {f.name for f in DERIVED}
    schema = T.StructType([f for f in schema.fields if f.name not in derived])
    drops = find_drops(spark, root).where(F.col("prefix") == (prefix or PREFIXES[data_type]))
    if isinstance(dates, tuple):
        drops = drops.where(F.col("file_date").between(*(F.lit(d).cast("date") for d in dates)))
    elif dates is not None:
        drops = drops.where(F.col("file_date").isin([F.lit(d).cast("date") for d in dates]))
    by_header = defaultdict(list)
    for r in drops.select("file", "header").collect():
        by_header[r.header].append(r.file)
    parts = [_one_header(spark, sorted(files), header.split(sep), schema, sep) for header, files in sorted(by_header.items())]
    empty = T.StructType([*schema.fields, T.StructField("file_date", T.DateType()), T.StructField("source_file", T.StringType())])
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], empty)


def _one_header(spark: SparkSession, files: list[str], header: list[str], schema: T.StructType, sep: str) -> DataFrame:
    names = [h.strip().strip('"').lower() for h in header]
    text = T.StructType([T.StructField(n if n and n not in names[:k] else f"_{k}", T.StringType()) for k, n in enumerate(names)])
    raw = spark.read.schema(text).option("header", True).option("sep", sep).option("mode", "PERMISSIVE").csv(files)
    file = F.col("_metadata.file_path")
    day = F.to_date(F.regexp_extract(file, DATE_IN_NAME, 1), "yyyyMMdd")
    raw = raw.withColumns({"_file": file, "_day": day})
    own = any_date(F.col("date"), T.StringType()) if "date" in raw.columns else F.lit(None).cast("date")
    numbers = {f"{t}_us": F.col(f"{t}_us").try_cast("long") for t in ("time_m", "part_time", "trf_time") if f"{t}_us" in raw.columns}
    typed_rows = with_time_micros(raw.withColumns({"date": F.coalesce(own, F.col("_day")), **numbers}))
    return conform(typed_rows, schema, keep_extra=False, also=[F.col("_day").alias("file_date"), F.col("_file").alias("source_file")])


def read_csv_drops(spark: SparkSession, path: str, schema: T.StructType,
                   date_pattern: str = DATE_IN_NAME) -> DataFrame:
    """Read all CSV drops under ``path`` (files or directories); the columns of ``schema``
    are taken by header name, in any order, and those a drop lacks are NULL. Adds
    ``file_date`` parsed from the file name and ``source_file``. Drops of one call share
    one header: a file with another one fails the job instead of shifting columns
    (``read_drops`` takes several headers)."""
    df = (spark.read.option("header", True).option("enforceSchema", False).option("mode", "PERMISSIVE")
          .option("recursiveFileLookup", "true").csv(path))
    have = {c.strip().lower(): c for c in df.columns}
    picked = [(F.col(f"`{have[f.name.lower()]}`").try_cast(f.dataType) if f.name.lower() in have
               else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields]
    fp = F.col("_metadata.file_path")
    return df.select(*picked, fp.alias("source_file"),
                     F.to_date(F.regexp_extract(fp, date_pattern, 1), "yyyyMMdd").alias("file_date"))


def write_csv_drops(df: DataFrame, root: str, prefix: str, date_col: str = "trade_date", mode: str = "overwrite") -> None:
    """Land ``df`` as one drop per date: ``root/file={prefix}_YYYYMMDD.csv/part-*.csv``
    (a test/landing helper; a single distributed write)."""
    name = F.concat(F.lit(f"{prefix}_"), F.date_format(F.col(date_col), "yyyyMMdd"), F.lit(".csv"))
    (df.withColumn("file", name).repartition("file")
     .write.mode(mode).option("header", True).partitionBy("file").csv(root))


def typed(df: DataFrame, types: dict[str, str]) -> DataFrame:
    """Cast text columns with ``try_cast`` (bad → NULL), leave the rest."""
    return df.withColumns({c: F.col(c).try_cast(t) for c, t in types.items() if c in df.columns})
