"""ST3: suppress re-delivered ticks on a stream.

``dropDuplicatesWithinWatermark`` keeps the first copy of each key and forgets keys
once the watermark has moved past them, so state is bounded by the delay. Sequence
numbers restart each day, so the date is part of the key.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def dedupe_stream(df: DataFrame, keys=("trade_date", "symbol", "tr_seqnum"), ts: str = "ts_event",
                  delay: str = "10 minutes") -> DataFrame:
    ev = df.withColumn("_ev", F.col(ts).cast("timestamp")).withWatermark("_ev", delay)
    return ev.dropDuplicatesWithinWatermark(list(keys)).drop("_ev")
