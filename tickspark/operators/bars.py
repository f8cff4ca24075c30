"""Time-bucket aggregates: VWAP, churn, per-minute stats, OHLC bars, NBBO at the
minute close, time-weighted spread, multi-resolution (LOD) tables.
(A1, A2, A11, A12, A40, A41, A44, J8, W5)

All of them are one ``groupBy`` on (keys, bucket) — partial aggregation before the
shuffle, so the shuffle carries at most one row per (key, bucket, map task).
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tickspark.functions.columns import (bucket_micros, epoch_micros, from_epoch_micros, mid,
                                         spread, time_bucket)
from tickspark.functions.filters import nonneg_spread
from tickspark.operators.asof import asof_join, next_time


def _keys(keys):
    return [keys] if isinstance(keys, str) else list(keys)


def vwap(trades: DataFrame, window: str = "1m", keys: Sequence[str] = ("symbol",),
         ts: str = "ts_event", price: str = "price", size: str = "size") -> DataFrame:
    """A1: ``total_price_volume, total_volume, vwap`` per (keys, bucket); zero volume → NULL."""
    return (trades.groupBy(*_keys(keys), time_bucket(ts, window).alias("time_bucket"))
            .agg(F.sum(F.col(price) * F.col(size)).alias("total_price_volume"),
                 F.sum(size).cast("long").alias("total_volume"))
            .withColumn("vwap", F.try_divide("total_price_volume", "total_volume")))


def churn(nbbo: DataFrame, window: str = "1m", keys: Sequence[str] = ("symbol",),
          ts: str = "ts_event") -> DataFrame:
    """A2: number of NBBO updates per (keys, bucket)."""
    return (nbbo.groupBy(*_keys(keys), time_bucket(ts, window).alias("time_bucket"))
            .agg(F.count(F.lit(1)).alias("churn")))


def trades_per_bucket(trades: DataFrame, window: str = "1m", keys: Sequence[str] = (),
                      ts: str = "ts_event", price: str = "price", size: str = "size") -> DataFrame:
    """trade_count, total_volume, avg_price per bucket."""
    return (trades.groupBy(*_keys(keys), time_bucket(ts, window).alias("minute"))
            .agg(F.count(F.lit(1)).alias("trade_count"),
                 F.sum(size).cast("long").alias("total_volume"),
                 F.avg(price).alias("avg_price")))


def nbbo_per_bucket(nbbo: DataFrame, window: str = "1m", keys: Sequence[str] = (),
                    ts: str = "ts_event", bid: str = "best_bid", ask: str = "best_ask") -> DataFrame:
    """Update count, average spread and mid per bucket, valid (F6) quotes only."""
    return (nbbo.where(nonneg_spread(bid, ask))
            .groupBy(*_keys(keys), time_bucket(ts, window).alias("minute"))
            .agg(F.count(F.lit(1)).alias("nbbo_update_count"),
                 F.avg(spread(bid, ask)).alias("avg_spread"),
                 F.avg(mid(bid, ask)).alias("avg_mid")))


def ohlc_bars(trades: DataFrame, window: str = "1m", keys: Sequence[str] = ("symbol",),
              ts: str = "ts_event", seq: str = "tr_seqnum", price: str = "price",
              size: str = "size") -> DataFrame:
    """open/high/low/close/volume/vwap/num_trades; open/close ordered by (ts, seq)."""
    order = F.struct(F.col(ts), F.col(seq))
    return (trades.groupBy(*_keys(keys), time_bucket(ts, window).alias("time_bucket"))
            .agg(F.min_by(price, order).alias("open"),
                 F.max(price).alias("high"),
                 F.min(price).alias("low"),
                 F.max_by(price, order).alias("close"),
                 F.sum(size).cast("long").alias("volume"),
                 F.sum(F.col(price) * F.col(size)).alias("_pv"),
                 F.count(F.lit(1)).alias("num_trades"))
            .withColumn("vwap", F.try_divide("_pv", "volume")).drop("_pv"))


def bucket_close_quotes(grid: DataFrame, nbbo: DataFrame, window: str = "1m",
                        by: Sequence[str] = ("symbol", "trade_date"), ts: str = "ts_event",
                        seq: str = "qu_seqnum", bid: str = "best_bid", ask: str = "best_ask",
                        asof_bucket: str | None = "1m") -> DataFrame:
    """NBBO in force at each bucket's close (last quote at or before the bucket end).

    ``grid`` has ``by`` + ``time_bucket`` (bucket start); quotes never cross ``by``.
    """
    w = bucket_micros(window)
    g = grid.withColumn("_close", from_epoch_micros(epoch_micros("time_bucket") + F.lit(w)))
    q = nbbo.where(nonneg_spread(bid, ask)).select(*by, ts, seq, bid, ask)
    j = asof_join(g, q, by=list(by), left_ts="_close", right_ts=ts,
                  right_cols={bid: "close_bid", ask: "close_ask"}, right_seq=seq, bucket=asof_bucket)
    return (j.withColumn("close_mid", mid("close_bid", "close_ask"))
            .withColumn("close_spread", spread("close_bid", "close_ask")).drop("_close"))


def tw_spread(nbbo: DataFrame, window: str = "1m", by: Sequence[str] = ("symbol", "trade_date"),
              ts: str = "ts_event", seq: str = "qu_seqnum", bid: str = "best_bid",
              ask: str = "best_ask", end_of_day_us: int | None = None) -> DataFrame:
    """Time-weighted spread per (by, bucket).

    Each valid quote is in force until the next valid quote of the same ``by`` group;
    the last one until ``end_of_day_us`` local micros of day (default: session close).

    One shuffle on (by, bucket): inside each bucket a ``lead`` gives the in-bucket
    segments and the bucket aggregate reuses the window's partitioning (no second
    exchange), so a hot symbol is split by time. What crosses bucket edges is fixed
    on a one-row-per-bucket table: the head of a bucket is covered by the previous
    quote bucket's last spread, empty buckets in between are fully covered by it, and
    the day's last quote stops at the close.
    """
    from tickspark.functions.columns import SESSION_CLOSE_US
    eod = SESSION_CLOSE_US if end_of_day_us is None else end_of_day_us
    w = bucket_micros(window)
    by = list(by)
    q = (nbbo.where(nonneg_spread(bid, ask))
         .select(*by, epoch_micros(ts).alias("_t"), F.col(seq).alias("_q"), spread(bid, ask).alias("_s"),
                 epoch_micros(F.to_date(ts).cast("timestamp_ntz")).alias("_day")))
    q = q.withColumn("_b", F.col("_t") - F.pmod("_t", F.lit(w)))
    inb = Window.partitionBy(*by, "_b").orderBy("_t", "_q")
    q = q.withColumn("_nt", F.lead("_t").over(inb))
    seg = F.coalesce(F.col("_nt"), F.col("_b") + F.lit(w)) - F.col("_t")   # last one: to bucket end
    per_b = q.groupBy(*by, "_b").agg(
        F.sum(F.col("_s") * seg).alias("_num"), F.sum(seg).alias("_den"),
        F.min("_t").alias("_first"), F.max("_t").alias("_last"),
        F.max(F.when(F.col("_nt").isNull(), F.col("_s"))).alias("_ls"),   # spread of the bucket's last quote
        F.max("_day").alias("_day"))
    across = Window.partitionBy(*by).orderBy("_b")
    per_b = (per_b.withColumn("_ps", F.lag("_ls").over(across))
             .withColumn("_nb", F.lead("_b").over(across))
             .withColumn("_end", F.greatest(F.col("_day") + F.lit(eod), F.col("_last"))))
    # the day's last quote bucket: its last segment stops at max(close, last quote)
    cut = F.when(F.col("_nb").isNull(),
                 F.least(F.col("_end"), F.col("_b") + F.lit(w)) - (F.col("_b") + F.lit(w))).otherwise(F.lit(0))
    head = F.when(F.col("_ps").isNotNull(), F.col("_first") - F.col("_b")).otherwise(F.lit(0))
    heads = per_b.select(
        *by, "_b",
        (F.col("_num") + F.col("_ls") * cut + F.coalesce(F.col("_ps"), F.lit(0.0)) * head).alias("_num"),
        (F.col("_den") + cut + head).alias("_den"))
    # buckets with no quote of their own, covered by the last quote before them
    stop = F.coalesce(F.col("_nb"), F.col("_end"))
    gaps = (per_b.where(stop > F.col("_b") + F.lit(w))
            .select(*by, "_ls", "_nb", "_end",
                    F.explode(F.sequence(F.col("_b") + F.lit(w),
                                         F.coalesce(F.col("_nb") - F.lit(w),
                                                    F.col("_end") - 1 - F.pmod(F.col("_end") - 1, F.lit(w))),
                                         F.lit(w))).alias("_b"))
            .withColumn("_cov", F.least(stop, F.col("_b") + F.lit(w)) - F.col("_b"))
            .select(*by, "_b", (F.col("_ls") * F.col("_cov")).alias("_num"), F.col("_cov").alias("_den")))
    return (heads.unionByName(gaps).where(F.col("_den") > 0)
            .select(*by, from_epoch_micros("_b").alias("time_bucket"),
                    F.try_divide(F.col("_num"), F.col("_den")).alias("tw_spread"),
                    F.col("_den").alias("covered_us")))


def tw_spread_by_lead(nbbo: DataFrame, window: str = "1m", by: Sequence[str] = ("symbol", "trade_date"),
                      ts: str = "ts_event", seq: str = "qu_seqnum", bid: str = "best_bid",
                      ask: str = "best_ask", end_of_day_us: int | None = None,
                      lead_bucket: str | None = "1m") -> DataFrame:
    """Reference formulation of ``tw_spread`` (kept for equivalence tests): a global
    ``lead`` per group, then each interval exploded over the buckets it covers."""
    from tickspark.functions.columns import SESSION_CLOSE_US, day_start
    eod = SESSION_CLOSE_US if end_of_day_us is None else end_of_day_us
    w = bucket_micros(window)
    q = (nbbo.where(nonneg_spread(bid, ask))
         .select(*by, ts, seq, spread(bid, ask).alias("_spr")))
    q = next_time(q, by, ts, seq, bucket=lead_bucket, out="_next")
    close = F.timestamp_add("MICROSECOND", F.lit(eod), day_start(ts))
    start_us = epoch_micros(ts)
    end_us = epoch_micros(F.coalesce(F.col("_next"), F.greatest(close, F.col(ts))))
    q = (q.withColumn("_s", start_us).withColumn("_e", end_us)
         .where(F.col("_e") > F.col("_s"))
         .withColumn("_bk", F.explode(F.sequence(F.col("_s") - F.pmod(F.col("_s"), F.lit(w)),
                                                 F.col("_e") - 1 - F.pmod(F.col("_e") - 1, F.lit(w)),
                                                 F.lit(w))))
         .withColumn("_dt", F.least(F.col("_e"), F.col("_bk") + F.lit(w)) - F.greatest(F.col("_s"), F.col("_bk"))))
    return (q.groupBy(*by, from_epoch_micros("_bk").alias("time_bucket"))
            .agg(F.try_divide(F.sum(F.col("_spr") * F.col("_dt")), F.sum("_dt")).alias("tw_spread"),
                 F.sum("_dt").alias("covered_us")))


def lod_quotes(nbbo: DataFrame, window: str = "1s", keys: Sequence[str] = ("symbol",),
               ts: str = "ts_event", seq: str = "qu_seqnum",
               cols: Sequence[str] = ("best_bid", "best_ask")) -> DataFrame:
    """Quotes at a fixed resolution — last value per bucket, ordered by (ts, seq)."""
    order = F.struct(F.col(ts), F.col(seq))
    return (nbbo.groupBy(*_keys(keys), time_bucket(ts, window).alias("time_bucket"))
            .agg(*[F.max_by(c, order).alias(c) for c in cols],
                 F.count(F.lit(1)).alias("n_updates")))


def lod_trades(trades: DataFrame, window: str = "1s", keys: Sequence[str] = ("symbol",),
               ts: str = "ts_event", price: str = "price", size: str = "size") -> DataFrame:
    """Trades at a fixed resolution — VWAP, volume, count per bucket."""
    return (trades.groupBy(*_keys(keys), time_bucket(ts, window).alias("time_bucket"))
            .agg(F.try_divide(F.sum(F.col(price) * F.col(size)), F.sum(size)).alias("vwap"),
                 F.sum(size).cast("long").alias("volume"),
                 F.count(F.lit(1)).alias("trade_count")))


def lod_choice(window_seconds) -> "F.Column":
    """A44 design rule: >30 min → 1 s table, 2–30 min → 100 ms table, <2 min → raw."""
    s = F.col(window_seconds) if isinstance(window_seconds, str) else window_seconds
    return F.when(s > 1800, F.lit("1s")).when(s >= 120, F.lit("100ms")).otherwise(F.lit("raw"))


def minute_nbbo_features(nbbo: DataFrame, grid: DataFrame, window: str = "1m",
                         by: Sequence[str] = ("symbol", "trade_date"), ts: str = "ts_event",
                         seq: str = "qu_seqnum", bid: str = "best_bid", ask: str = "best_ask",
                         end_of_day_us: int | None = None, fill: bool = False) -> DataFrame:
    """A41 + J8 + A2 for the buckets of ``grid`` (``by`` + ``time_bucket``) from ONE pass over
    the quotes: NBBO at the bucket close (last valid quote at or before the bucket end),
    number of quote updates in the bucket, and the time-weighted spread of the bucket.

    ``fill``: one row per bucket from the first to the last of a ``by`` group that holds a
    row of ``grid`` or a quote; buckets that ``grid`` lacks have NULL in its other columns.
    The state is carried on the buckets that hold something, and each of them generates
    the empty ones after it: no window runs over the dense grid.

    Quotes are shuffled once by (by, bucket). Inside a bucket, valid quotes are ordered
    first, so ``lead`` gives each valid quote's in-bucket segment, and the bucket's last valid
    quote and its quotes stamped exactly at the bucket start (which close the previous
    bucket) are flagged. Per-bucket results are merged with the grid on a small table,
    where windows carry the last valid quote forward and find the next valid bucket.
    Same results as ``bucket_close_quotes`` + ``churn`` + ``tw_spread`` on the grid.
    """
    from tickspark.functions.columns import SESSION_CLOSE_US
    eod = SESSION_CLOSE_US if end_of_day_us is None else end_of_day_us
    w = bucket_micros(window)
    by = list(by)
    q = nbbo.select(*by, epoch_micros(ts).alias("_t"), F.col(seq).alias("_q"),
                    F.col(bid).alias("_bid"), F.col(ask).alias("_ask"),
                    F.coalesce(nonneg_spread(bid, ask), F.lit(False)).alias("_v"),
                    epoch_micros(F.to_date(ts).cast("timestamp_ntz")).alias("_day"))
    q = q.withColumn("_b", F.col("_t") - F.pmod("_t", F.lit(w)))
    inb = Window.partitionBy(*by, "_b").orderBy(F.desc("_v"), "_t", "_q")
    nv, nt = F.lead("_v").over(inb), F.lead("_t").over(inb)
    q = (q.withColumn("_nt", F.when(F.col("_v") & F.coalesce(nv, F.lit(False)), nt))
         .withColumn("_at0_next", F.coalesce(nv & (nt == F.col("_b")), F.lit(False))))
    v, last_v = F.col("_v"), F.col("_v") & F.col("_nt").isNull()
    at0_last = v & (F.col("_t") == F.col("_b")) & ~F.col("_at0_next")
    spr = F.col("_ask") - F.col("_bid")
    seg = F.coalesce(F.col("_nt"), F.col("_b") + F.lit(w)) - F.col("_t")
    per_b = q.groupBy(*by, "_b").agg(
        F.count(F.lit(1)).alias("_n"), F.count_if(v).alias("_nv"),
        F.sum(F.when(v, spr * seg)).alias("_num"), F.sum(F.when(v, seg)).alias("_den"),
        F.min(F.when(v, F.col("_t"))).alias("_first"), F.max(F.when(v, F.col("_t"))).alias("_last"),
        F.max(F.when(last_v, spr)).alias("_ls"), F.max(F.when(last_v, F.col("_bid"))).alias("_lb"),
        F.max(F.when(last_v, F.col("_ask"))).alias("_la"),
        F.max(F.when(at0_last, F.col("_bid"))).alias("_zb"), F.max(F.when(at0_last, F.col("_ask"))).alias("_za"),
        F.max("_day").alias("_day"))
    g = grid.select(*by, epoch_micros("time_bucket").alias("_b"), *[c for c in grid.columns
                                                                   if c not in by and c != "time_bucket"])
    small = g.withColumn("_g", F.lit(True)).unionByName(per_b, allowMissingColumns=True)
    extra = [c for c in g.columns if c not in by and c != "_b"]
    small = small.groupBy(*by, "_b").agg(
        *[F.max(c).alias(c) for c in extra + ["_g", "_n", "_nv", "_num", "_den", "_first", "_last", "_ls",
                                             "_lb", "_la", "_zb", "_za", "_day"]])
    fwd = Window.partitionBy(*by).orderBy("_b")
    before = fwd.rowsBetween(Window.unboundedPreceding, -1)
    bwd = Window.partitionBy(*by).orderBy(F.desc("_b")).rowsBetween(Window.unboundedPreceding, -1)
    valid_b = F.coalesce(F.col("_nv"), F.lit(0)) > 0
    end = F.greatest(F.col("_day") + F.lit(eod), F.col("_last"))
    small = (small
             .withColumn("_pq", F.last(F.when(valid_b, F.struct(F.col("_lb").alias("b"), F.col("_la").alias("a"),
                                                                 F.col("_ls").alias("s"), end.alias("e"))),
                                       ignorenulls=True).over(before))
             .withColumn("_nb", F.last(F.when(valid_b, F.col("_b")), ignorenulls=True).over(bwd))
             .withColumn("_nx", F.lead(F.struct("_b", "_zb", "_za")).over(fwd)))
    # an empty bucket is covered by the last valid quote at the end of the bucket that generates it
    own = F.struct(F.col("_lb").alias("b"), F.col("_la").alias("a"), F.col("_ls").alias("s"), end.alias("e"))
    small = small.withColumns({"_valid": valid_b, "_end": end, "_own": F.when(valid_b, own).otherwise(F.col("_pq"))})
    if fill:
        after = F.greatest(F.coalesce(F.col("_nx._b") - F.lit(w), F.col("_b")), F.col("_b"))
        small = small.withColumn("_m", F.explode(F.sequence(F.col("_b"), after, F.lit(w))))
        gap = F.col("_m") > F.col("_b")
        small = small.withColumns({"_pq": F.when(gap, F.col("_own")).otherwise(F.col("_pq")), "_valid": F.col("_valid") & ~gap,
                                   "_n": F.when(~gap, F.col("_n")), **{c: F.when(~gap, F.col(c)) for c in extra}})
    else:
        small = small.where(F.col("_g")).withColumn("_m", F.col("_b"))
    valid_b, end, at = F.col("_valid"), F.col("_end"), F.col("_m")
    # NBBO at the close: a quote stamped exactly at the bucket end, else this bucket's last, else carried
    at_end = (F.col("_nx._b") == at + F.lit(w)) & F.col("_nx._zb").isNotNull()
    close_b = F.when(at_end, F.col("_nx._zb")).when(valid_b, F.col("_lb")).otherwise(F.col("_pq.b"))
    close_a = F.when(at_end, F.col("_nx._za")).when(valid_b, F.col("_la")).otherwise(F.col("_pq.a"))
    # time-weighted spread: own segments (+ head covered by the previous quote, − tail after the
    # day's last quote) for buckets with valid quotes; carried spread over the covered part otherwise
    cut = F.when(F.col("_nb").isNull(), F.least(end, at + F.lit(w)) - (at + F.lit(w))).otherwise(F.lit(0))
    head = F.when(F.col("_pq").isNotNull(), F.col("_first") - at).otherwise(F.lit(0))
    num_v = F.col("_num") + F.col("_ls") * cut + F.coalesce(F.col("_pq.s"), F.lit(0.0)) * head
    den_v = F.col("_den") + cut + head
    cov_g = F.least(F.coalesce(F.col("_nb"), F.col("_pq.e")), at + F.lit(w)) - at
    num = F.when(valid_b, num_v).otherwise(F.col("_pq.s") * cov_g)
    den = F.when(valid_b, den_v).otherwise(cov_g)
    return (small.select(*by, from_epoch_micros("_m").alias("time_bucket"), *extra,
                         close_b.alias("close_bid"), close_a.alias("close_ask"),
                         F.coalesce(F.col("_n"), F.lit(0).cast("long")).alias("quote_updates"),
                         F.when(den > 0, F.try_divide(num, den)).alias("tw_spread"))
            .withColumn("close_mid", mid("close_bid", "close_ask"))
            .withColumn("close_spread", spread("close_bid", "close_ask")))
