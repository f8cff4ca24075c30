"""tickspark: market tick analytics as plain PySpark DataFrame operators.

Every public operator takes DataFrames and returns a DataFrame; none runs an
action except the lake/stream writers, which must materialise by nature.
"""

from tickspark.session import get_spark, scratch_path

__all__ = ["get_spark", "scratch_path"]
