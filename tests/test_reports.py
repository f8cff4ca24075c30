"""Enriched datasets, source comparisons, boards and largest trades against plain versions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tickspark.operators import compare, enriched
from tickspark.operators.topk import largest, leaderboards
from tickspark.session import scratch_path

DAY = dt.date(2024, 1, 2)
TRADES = "symbol string, trade_date date, ts_event_ns long, tr_seqnum long, price double, qu_source string"
QUOTES = "symbol string, trade_date date, ts_event_ns long, qu_seqnum long, best_bid double, best_ask double, nbbo_qu_cond string, qu_source string"


def test_enriched_trades_drop_or_flag_invalid_quotes(spark):
    trades = spark.createDataFrame([("A", DAY, t, t, 10.0, "T") for t in (5, 100, 250, 999)] + [("B", DAY, 50, 1, 1.0, "T"), (None, DAY, 50, 2, 1.0, "T")], TRADES)
    quotes = spark.createDataFrame([("A", DAY, 100, 1, 9.0, 11.0, "R", "C"), ("A", DAY, 200, 2, 12.0, 11.0, "X", "N"), ("A", DAY, 900, 3, None, 11.0, "Y", "N"),
                                    ("A", dt.date(2024, 1, 1), 1, 1, 1.0, 2.0, "P", "C")], QUOTES)
    dropped = {(r.symbol, r.tr_seqnum): r for r in enriched.enriched_trades(trades, quotes).collect()}
    assert len(dropped) == 6 and not dropped["A", 5].has_quote and not dropped["B", 1].has_quote and not dropped[None, 2].has_quote
    for t in (100, 250, 999):
        r = dropped["A", t]
        assert (r.best_bid, r.mid, r.spread, r.nbbo_qu_cond, r.nbbo_qu_source, r.qu_source, r.quote_age_ns) == (9.0, 10.0, 2.0, "R", "C", "T", t - 100)
    flagged = {(r.symbol, r.tr_seqnum): r for r in enriched.enriched_trades(trades, quotes, invalid="flag").collect()}
    assert [flagged["A", t].nbbo_invalid for t in (5, 100, 250, 999)] == [False, False, True, True]
    assert flagged["A", 250].nbbo_qu_cond == "X" and flagged["A", 999].best_bid is None
    with pytest.raises(ValueError):
        enriched.enriched_trades(trades, quotes, invalid="keep")


def test_enriched_dataset_round_trip(spark):
    root = scratch_path(spark, "r")
    trades = spark.createDataFrame([("A", DAY, t, t, 10.0, "T") for t in range(50)], TRADES)
    quotes = spark.createDataFrame([("A", DAY, 10, 1, 9.0, 11.0, "R", "C")], QUOTES)
    made = enriched.enriched_trades(trades, quotes)
    for _ in range(2):
        assert enriched.write_enriched(made, root, load="day-1") == 50
    assert sorted(enriched.read_enriched(spark, root).select(*made.columns).collect()) == sorted(made.collect())


def test_boards_and_largest(spark):
    rng = random.Random(1)
    rows = [(k, rng.randint(0, 5), rng.randint(0, 9)) for k in range(60)]
    df = spark.createDataFrame(rows, "minute int, a int, b long")
    got = {(r.board, r.rank): (r.minute, r.value) for r in leaderboards({"x": (df, "a"), "y": (df, "b")}, "minute", 4).collect()}
    for board, i in (("x", 1), ("y", 2)):
        want = sorted(rows, key=lambda r: (-r[i], r[0]))[:4]
        assert [got[board, k + 1] for k in range(4)] == [(r[0], r[i]) for r in want]
    ticks = spark.createDataFrame([("A", k, k, rng.choice([None, 5, 7])) for k in range(20)], "symbol string, ts_event int, tr_seqnum int, size int")
    sizes = [r["size"] for r in largest(ticks, 5, ["symbol"]).orderBy("rank").collect()]
    assert sizes == sorted((s for s in (r["size"] for r in ticks.collect()) if s), reverse=True)[:5]
    assert [r.tr_seqnum for r in largest(ticks.drop("size"), 3, ["symbol"]).orderBy("rank").collect()] == [0, 1, 2]


def test_sources_side_by_side(spark):
    t = spark.createDataFrame([("x", "A", DAY, 5, 1.0), ("x", "A", DAY, 6, 3.0), ("y", "A", DAY, 1, 2.0), ("y", "B", DAY, 2, 9.0)],
                              "source string, symbol string, trade_date date, size int, price double")
    q = spark.createDataFrame([("x", "A", DAY, 0.5, 1.5)], "source string, symbol string, trade_date date, best_bid double, best_ask double")
    got = {r.symbol: (r.x_trades, r.y_trades, r.diff_trades, r.diff_volume) for r in compare.source_compare(t, "x", "y").collect()}
    assert got == {"A": (2, 1, 1, 10), "B": (None, 1, -1, -2)}
    assert {r.source: (r.n_trades, r.n_nbbo) for r in compare.summary_by_date_source(t, q).collect()} == {"x": (2, 1), "y": (2, None)}
    asked = spark.createDataFrame([("A",), ("C",), ("A",)], "symbol string")
    assert {r.symbol: (r.n_trades, r.volume, r.n_nbbo) for r in compare.summary_by_symbol(asked, t, q).collect()} == {"A": (3, 12, 1), "C": (None, None, None)}
    assert tuple(compare.price_range(t, q).first()) == pytest.approx((0.5, 9.0, 0.475, 9.45))
    assert compare.price_range(t, q.where("false")).first().min_price == 1.0
