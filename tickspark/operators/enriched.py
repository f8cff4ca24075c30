"""Trades with the NBBO in force, as a written dataset."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickspark.functions.columns import mid, spread
from tickspark.functions.filters import invalid_quote
from tickspark.operators.asof import asof_join
from tickspark.operators.stats import with_deviation
from tickspark.sources import lake

BY = ("symbol", "trade_date")
DATASET = "enriched_trades"
#: The NBBO fields of a snapshot; those that a table lacks are left out.
SNAPSHOT = ("best_bid", "best_ask", "best_bidsiz", "best_asksiz", "best_bidsizeshares", "best_asksizeshares", "best_bidex", "best_askex",
            "nbbo_qu_cond", "qu_cond", "secstat_ind", "luld_indicator", "luld_bbo_cqs", "luld_bbo_uts", "natbbo_ind", "qu_source")


def enriched_trades(trades: DataFrame, nbbo: DataFrame, ts_ns: str = "ts_event_ns", trade_seq: str = "tr_seqnum", quote_seq: str = "qu_seqnum",
                    invalid: str = "drop", snapshot: Sequence[str] = SNAPSHOT, bucket="1m") -> DataFrame:
    """Every trade with all its columns, the NBBO snapshot at its nanosecond (prices, sizes,
    exchanges, flags), ``mid``, ``spread``, deviations, location, ``has_quote`` and the
    quote's age in nanoseconds.

    ``invalid``: ``drop`` looks past quotes that are crossed or not positive, to the last valid
    one; ``flag`` takes them as they are and says so in ``nbbo_invalid``. NBBO columns
    that trades have too keep the trade's value and come as ``nbbo_<name>`` besides.
    """
    if invalid not in ("drop", "flag"):
        raise ValueError("invalid is drop or flag")
    bad = F.coalesce(invalid_quote(), F.lit(True))
    quotes = nbbo.where(~bad) if invalid == "drop" else nbbo
    taken = {c.lower() for c in trades.columns}
    cols = {c: f"nbbo_{c}" if c.lower() in taken else c for c in snapshot if c in nbbo.columns} | {"_quote_ns": "_quote_ns"}
    right = quotes.withColumn("_quote_ns", F.col(ts_ns)).select(*BY, ts_ns, quote_seq, *cols)
    joined = asof_join(trades, right, by=BY, left_ts=ts_ns, right_cols=cols, left_seq=trade_seq, right_seq=quote_seq, bucket=bucket,
                       ts_unit_per_us=1000)
    bid, ask = cols["best_bid"], cols["best_ask"]
    out = with_deviation(joined.withColumns({"mid": mid(bid, ask), "spread": spread(bid, ask), "has_quote": F.col("_quote_ns").isNotNull(),
                                             "quote_age_ns": F.col(ts_ns) - F.col("_quote_ns")}), bid=bid, ask=ask)
    if invalid == "flag":
        out = out.withColumn("nbbo_invalid", F.col("has_quote") & F.coalesce(invalid_quote(bid, ask), F.lit(True)))
    return out.drop("_quote_ns")


def write_enriched(df: DataFrame, root: str, load: str | None = None, **args) -> int:
    """Writes ``enriched_trades`` under ``root`` by date and symbol; a named load replaces itself."""
    return lake.write_partitioned(df, root, DATASET, mode="append" if load else "overwrite", load=load, **args)


def read_enriched(spark: SparkSession, root: str) -> DataFrame:
    return lake.read_lake(spark, root, DATASET)
