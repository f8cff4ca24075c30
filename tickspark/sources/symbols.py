"""Symbol list sources (S16): comma lists or one-per-line text, read by Spark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def parse_symbol_lines(lines: DataFrame, col: str = "value") -> DataFrame:
    """Split every line on commas, trim, upper-case and drop blanks → ``symbol``."""
    return (lines.select(F.explode(F.split(F.col(col), ",")).alias("_s"))
            .select(F.upper(F.trim("_s")).alias("symbol"))
            .where(F.col("symbol") != ""))


def read_symbol_file(spark, path: str) -> DataFrame:
    """One-per-line or comma-separated symbol file(s) → distinct symbols."""
    return parse_symbol_lines(spark.read.text(path)).distinct()
