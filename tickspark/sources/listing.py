"""A lake's folders and Parquet footers as distributed tables.

Only the date folders are listed by the driver (one name per day); symbol folders are
listed, footers read and folders dropped by tasks, through ``pyarrow.fs``. Folder names
are taken as found: escapes are undone and legacy names cleaned (K8), so a request for
``AAPL`` also meets a folder that an older writer named ``('AAPL',)``.
"""

from __future__ import annotations

from urllib.parse import unquote

import pyarrow as pa
import pyarrow.fs as pafs
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions.columns import clean_symbol_key

_NULL = "__HIVE_DEFAULT_PARTITION__"
_FOLDERS = "trade_date string, symbol string, folder string"
_FILES = "trade_date date, symbol string, folder string, file string, n_rows long, n_bytes long"


def open_uri(uri: str) -> tuple[pafs.FileSystem, str]:
    """File system and path of a folder given as a URI or a plain path. Only the part
    before the path is read as a URI: escapes in folder names are names, not escapes."""
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + uri.removeprefix("file:").lstrip("/")
    if "://" not in uri:
        return pafs.LocalFileSystem(), uri
    scheme, rest = uri.replace("s3a://", "s3://", 1).split("://", 1)
    host, _, path = rest.partition("/")
    fs, base = pafs.FileSystem.from_uri(f"{scheme}://{host}/")
    return fs, f"{base.rstrip('/')}/{path}"


def children(uri: str, recursive: bool = False) -> list[pafs.FileInfo]:
    """What a folder holds but for hidden names; nothing if there is no such folder."""
    fs, path = open_uri(uri)
    found = fs.get_file_info(pafs.FileSelector(path, allow_not_found=True, recursive=recursive))
    inside = len(path.rstrip("/")) + 1
    return [f for f in found if not any(part[:1] in "_." and not part.startswith(f"{_NULL}") for part in f.path[inside:].split("/"))]


def _value(name: str) -> str | None:
    value = unquote(name.split("=", 1)[1])
    return None if value == _NULL else value


def _symbol_folders(batches):
    for batch in batches:
        rows = []
        for date, folder in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            names = sorted(f.base_name for f in children(folder) if f.type == pafs.FileType.Directory and f.base_name.startswith("symbol="))
            rows += [(date, _value(n), f"{folder}/{n}") for n in names] or [(date, None, folder)]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], ["trade_date", "symbol", "folder"])


def _date_folders(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    target = f"{root}/{dataset}"
    dates = [f.base_name for f in children(target) if f.type == pafs.FileType.Directory and f.base_name.startswith("trade_date=")]
    rows = spark.createDataFrame([(_value(d), f"{target}/{d}") for d in sorted(dates)], "trade_date string, folder string")
    return rows.repartition(max(1, min(len(dates), 4 * spark.sparkContext.defaultParallelism)))


def _cleaned(found: DataFrame) -> DataFrame:
    return found.select(F.to_date("trade_date").alias("trade_date"), clean_symbol_key("symbol").alias("symbol"), *found.columns[2:])


def partition_folders(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """(trade_date, symbol, folder) of every partition folder; a date without symbol
    folders is one row with a NULL symbol. Symbols are cleaned, folders as they are."""
    return _cleaned(_date_folders(spark, root, dataset).mapInArrow(_symbol_folders, _FOLDERS))


def partition_files(spark: SparkSession, root: str, dataset: str) -> DataFrame:
    """``lake_files`` of all ``partition_folders``, listed and read by one Python worker of a task."""
    found = _date_folders(spark, root, dataset).mapInArrow(lambda batches: _footers(_symbol_folders(batches)),
                                                           _FILES.replace("trade_date date", "trade_date string"))
    return _cleaned(found)


def _footers(batches):
    for batch in batches:
        rows = []
        for date, symbol, folder in zip(*(batch.column(k).to_pylist() for k in range(3))):
            fs, _ = open_uri(folder)
            for f in children(folder, recursive=True):
                if f.type == pafs.FileType.File and f.base_name.endswith(".parquet"):
                    with fs.open_input_file(f.path) as source:
                        rows.append((date, symbol, folder, f.path, pq.read_metadata(source).num_rows, f.size))
        kinds = (batch.schema.field(0).type, pa.string(), pa.string(), pa.string(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)],
                                         ["trade_date", "symbol", "folder", "file", "n_rows", "n_bytes"])


def lake_files(folders: DataFrame) -> DataFrame:
    """One row per Parquet file of the ``folders``: rows by its footer, bytes by the listing."""
    return folders.select("trade_date", "symbol", "folder").mapInArrow(_footers, _FILES)


def _loads(batches):
    for batch in batches:
        rows = [(folder, _value(f.base_name), f"{folder}/{f.base_name}") for folder in batch.column(0).to_pylist()
                for f in children(folder) if f.type == pafs.FileType.Directory and f.base_name.startswith("load=")]
        yield pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], pa.string()) for k in range(3)], ["parent", "load", "folder"])


def load_folders(folders: DataFrame) -> DataFrame:
    """(parent, load, folder) of every load below the partition ``folders``."""
    return folders.select("folder").mapInArrow(_loads, "parent string, load string, folder string")


def _drop(batches):
    for batch in batches:
        gone = 0
        for folder in batch.column(0).to_pylist():
            fs, path = open_uri(folder)
            if fs.get_file_info(path).type == pafs.FileType.Directory:
                try:
                    fs.delete_dir(path)
                    gone += 1
                except FileNotFoundError:  # another attempt of this task was faster
                    pass
        yield pa.RecordBatch.from_arrays([pa.array([gone], pa.int64())], ["gone"])


def drop_folders(folders: DataFrame) -> int:
    """Deletes the folders in tasks; returns how many there were. Safe to repeat."""
    paths = folders.select("folder").distinct()
    return int(paths.mapInArrow(_drop, "gone long").agg(F.coalesce(F.sum("gone"), F.lit(0))).first()[0])
