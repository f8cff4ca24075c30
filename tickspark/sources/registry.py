"""Multi-source registry (S18, U1, U2): one logical table over several lake roots."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# wider-type order used when two sources disagree on a column type
_RANK = [T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType]


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    if a == b:
        return a
    ra = next((i for i, t in enumerate(_RANK) if isinstance(a, t)), None)
    rb = next((i for i, t in enumerate(_RANK) if isinstance(b, t)), None)
    if ra is not None and rb is not None:
        whole, real = _RANK.index(T.IntegerType), _RANK.index(T.FloatType)
        if min(ra, rb) in (whole, whole + 1) and max(ra, rb) == real:
            return T.DoubleType()  # FLOAT holds 24 bits: INT and LONG values would change
        return a if ra >= rb else b
    if isinstance(a, T.DecimalType) and isinstance(b, T.DecimalType):
        scale = max(a.scale, b.scale)
        return T.DecimalType(min(38, max(a.precision - a.scale, b.precision - b.scale) + scale), scale)
    if isinstance(a, T.DecimalType) or isinstance(b, T.DecimalType):
        return T.DoubleType()
    if isinstance(a, (T.DateType,)) and isinstance(b, (T.TimestampType, T.TimestampNTZType)):
        return b
    if isinstance(b, (T.DateType,)) and isinstance(a, (T.TimestampType, T.TimestampNTZType)):
        return a
    return T.StringType()


def union_sources(frames: dict[str, DataFrame], common_only: bool = True) -> DataFrame:
    """Tag each frame with ``source``; keep the common columns (or all, null-filled)
    and cast each to the widest type among the sources, then ``unionByName``."""
    names = list(frames)
    cols = [c for c in frames[names[0]].columns
            if all(c in frames[n].columns for n in names)] if common_only else \
        list(dict.fromkeys(c for n in names for c in frames[n].columns))
    types = {}
    for c in cols:
        ts = [frames[n].schema[c].dataType for n in names if c in frames[n].columns]
        types[c] = reduce(wider, ts)
    out = []
    for n in names:
        df = frames[n]
        out.append(df.select(F.lit(n).alias("source"),
                             *[(F.col(c) if c in df.columns else F.lit(None)).cast(types[c]).alias(c) for c in cols]))
    return reduce(lambda a, b: a.unionByName(b), out)


def read_sources(spark, roots: dict[str, str], dataset: str, schema=None, skip_corrupt: bool = False) -> DataFrame:
    """Read ``{root}/{dataset}`` of every registered source into one tagged table."""
    frames = {}
    for name, root in roots.items():
        r = spark.read.option("ignoreCorruptFiles", str(skip_corrupt).lower())
        if schema is not None:
            r = r.schema(schema)
        frames[name] = r.parquet(f"{root}/{dataset}")
    return union_sources(frames, common_only=False)
