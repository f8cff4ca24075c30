"""Hand-made unit rows for the semantic decisions (FIXTURES §3, SURVEY §4.4)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.columns import canonical_symbol, canonical_ts_ns, price_location, time_bucket
from tickspark.operators import bars, stats
from tickspark.operators.asof import asof_join, next_time
from tickspark.operators.catalog import closest_dates
from tickspark.operators.downsample import adaptive_max_points, downsample

NTZ = T.TimestampNTZType()


def ts(s):
    return dt.datetime.fromisoformat(s)


def test_symbol_rule(spark):
    rows = [("AAPL", None), ("AAPL", ""), ("AAPL", "  "), (" BRK ", " A "), ("X", "B")]
    df = spark.createDataFrame(rows, "r string, s string")
    got = [r[0] for r in df.select(canonical_symbol("r", "s")).collect()]
    assert got == ["AAPL", "AAPL", "AAPL", "BRK.A", "X.B"]


def test_canonical_time_dst_and_encodings(spark):
    rows = [(dt.date(2024, 7, 2), 34200123456, 789), (dt.date(2024, 1, 2), 34200123456, 789),
            (dt.date(2024, 1, 2), 34200123456, None), (dt.date(2024, 1, 2), 34200000000, 123456789)]
    df = spark.createDataFrame(rows, "d date, us long, ns int")
    got = [r[0] for r in df.select(canonical_ts_ns("d", "us", "ns")).collect()]
    summer = int(dt.datetime(2024, 7, 2, 13, 30, tzinfo=dt.timezone.utc).timestamp()) * 10**9 + 123456789
    winter = int(dt.datetime(2024, 1, 2, 14, 30, tzinfo=dt.timezone.utc).timestamp()) * 10**9 + 123456789
    assert got[0] == summer            # EDT: UTC-4
    assert got[1] == winter            # EST: UTC-5
    assert got[2] == winter - 789      # null nano → 0
    assert got[3] == winter            # REST style: whole seconds + sub-second nanos, same instant


def _asof(spark, trades, quotes, bucket):
    t = spark.createDataFrame(trades, "sym string, d date, t timestamp_ntz, seq long, price double")
    q = spark.createDataFrame(quotes, "sym string, d date, t timestamp_ntz, qseq long, bid double, ask double")
    q = q.where((F.col("ask") - F.col("bid") >= 0) | F.col("bid").isNull())  # keep the null-field quote
    j = asof_join(t, q, ["sym", "d"], "t", right_cols=["bid", "ask"], left_seq="seq", right_seq="qseq",
                  bucket=bucket)
    return {r["seq"]: (r["bid"], r["ask"]) for r in j.collect()}


def test_asof_edge_cases(spark):
    d1, d0 = dt.date(2024, 1, 3), dt.date(2024, 1, 2)
    quotes = [("A", d0, ts("2024-01-02 15:59:00"), 1, 1.0, 2.0),          # previous date only
              ("A", d1, ts("2024-01-03 09:30:01"), 2, 10.0, 11.0),
              ("A", d1, ts("2024-01-03 09:30:05"), 3, 12.0, 11.0),        # crossed: removed
              ("A", d1, ts("2024-01-03 09:31:30"), 4, None, 13.0),        # null field inside a quote
              ("A", d1, ts("2024-01-03 09:40:00.000001"), 5, 20.0, 21.0),
              ("A", d1, ts("2024-01-03 09:40:00.000001"), 6, 22.0, 23.0)]  # same stamp, higher seq wins
    trades = [("A", d1, ts("2024-01-03 09:30:00"), 100, 10.5),           # before any quote today
              ("A", d1, ts("2024-01-03 09:30:01"), 101, 10.5),           # equal stamp: quote visible
              ("A", d1, ts("2024-01-03 09:30:06"), 102, 10.5),           # crossed quote ignored
              ("A", d1, ts("2024-01-03 09:35:00"), 103, 10.5),           # null bid is not back-filled
              ("A", d1, ts("2024-01-03 09:40:00.000001"), 104, 10.5),
              ("A", d1, ts("2024-01-03 10:15:00"), 105, 10.5)]           # carried across many buckets
    want = {100: (None, None), 101: (10.0, 11.0), 102: (10.0, 11.0), 103: (None, 13.0),
            104: (22.0, 23.0), 105: (22.0, 23.0)}
    for bucket in (None, "1m", "5m"):
        assert _asof(spark, trades, quotes, bucket) == want, bucket


def test_asof_bucketed_equals_plain_on_hot_symbol(spark):
    # one symbol carries ~60% of rows: the bucketed plan must return the same rows
    base = spark.range(0, 20000).select(
        F.when(F.col("id") % 5 < 3, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 7).cast("string"))).alias("sym"),
        F.lit(dt.date(2024, 1, 2)).alias("d"),
        F.timestamp_add("MILLISECOND", (F.col("id") * 977) % 23_400_000, F.lit(ts("2024-01-02 09:30:00"))).alias("t"),
        F.col("id").alias("seq"), (F.col("id") % 13).cast("double").alias("x"))
    trades = base.where(F.col("seq") % 4 == 0).select("sym", "d", "t", "seq", F.col("x").alias("price"))
    quotes = base.where(F.col("seq") % 4 != 0).select("sym", "d", "t", F.col("seq").alias("qseq"),
                                                      F.col("x").alias("bid"), (F.col("x") + 1).alias("ask"))
    args = dict(by=["sym", "d"], left_ts="t", right_cols=["bid", "ask", "qseq"], left_seq="seq", right_seq="qseq")
    plain = asof_join(trades, quotes, bucket=None, **args)
    for b in ("1m", "37s", "1h"):
        buck = asof_join(trades, quotes, bucket=b, **args)
        assert buck.count() == trades.count()
        assert plain.exceptAll(buck).count() == 0 and buck.exceptAll(plain).count() == 0


def test_next_time_bucketed_equals_lead(spark):
    df = spark.range(0, 5000).select(
        (F.col("id") % 3).cast("string").alias("sym"),
        F.timestamp_add("MILLISECOND", (F.col("id") * 7919) % 3_600_000, F.lit(ts("2024-01-02 09:30:00"))).alias("t"),
        F.col("id").alias("seq"))
    a = next_time(df, ["sym"], "t", "seq", bucket=None)
    b = next_time(df, ["sym"], "t", "seq", bucket="1m")
    assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def test_price_location_null_quote(spark):
    df = spark.createDataFrame([(10.0, None, None), (9.0, 9.5, 10.0), (11.0, 9.5, 10.0), (9.7, 9.5, 10.0)],
                               "p double, b double, a double")
    got = [r[0] for r in df.select(price_location("p", "b", "a")).collect()]
    assert got == ["within_spread", "below_bid", "above_ask", "within_spread"]


def test_vwap_zero_volume_is_null_and_std_single_row(spark):
    df = spark.createDataFrame([("A", ts("2024-01-02 09:30:01"), 10.0, 0), ("B", ts("2024-01-02 09:30:01"), 5.0, 7)],
                               "symbol string, ts_event timestamp_ntz, price double, size int")
    got = {r["symbol"]: r["vwap"] for r in bars.vwap(df, "1m").collect()}
    assert got["A"] is None and got["B"] == 5.0
    s = stats.describe(df, "price", keys=["symbol"]).collect()
    assert all(r["std"] is None for r in s)


def test_time_bucket_local_grid(spark):
    df = spark.createDataFrame([(ts("2024-01-02 09:30:36.999"),)], "t timestamp_ntz")
    r = df.select(time_bucket("t", "37s").alias("a"), time_bucket("t", "1min").alias("b"),
                  time_bucket("t", "100ms").alias("c")).first()
    epoch_s = (ts("2024-01-02 09:30:36") - dt.datetime(1970, 1, 1)).total_seconds()
    assert r["a"] == dt.datetime(1970, 1, 1) + dt.timedelta(seconds=int(epoch_s // 37 * 37))
    assert r["b"] == ts("2024-01-02 09:30:00") and r["c"] == ts("2024-01-02 09:30:36.900")


def test_downsample_rules(spark):
    sch = "symbol string, ts_event timestamp_ntz, qu_seqnum long, best_bid double, cond string"
    few = spark.createDataFrame([("A", ts("2024-01-02 09:30:00"), i, float(i), "x") for i in range(5)], sch)
    assert downsample(few, max_points=10).count() == 5                         # within budget: unchanged
    many = spark.createDataFrame(
        [("A", ts("2024-01-02 09:30:00") + dt.timedelta(seconds=i), i, float(i), f"c{i}") for i in range(100)], sch)
    out = downsample(many, max_points=10).collect()
    # 99 s / 10 points = 9.9 s → 9 s buckets on the local-epoch grid
    assert 11 <= len(out) <= 12
    sub_ms = spark.createDataFrame(
        [("A", ts("2024-01-02 09:30:00") + dt.timedelta(microseconds=i * 10), i, float(i), "x") for i in range(50)], sch)
    assert downsample(sub_ms, max_points=5).count() == 1                      # bucket < 1 ms → 1 ms
    same = spark.createDataFrame([("A", ts("2024-01-02 09:30:00"), i, float(i), "x") for i in range(20)], sch)
    r = downsample(same, max_points=5).collect()
    assert len(r) == 1 and r[0]["best_bid"] == 19.0 and r[0]["qu_seqnum"] == 19   # all at one instant


def test_downsample_last_and_first(spark):
    sch = "symbol string, ts_event timestamp_ntz, qu_seqnum long, best_bid double, cond string"
    rows = [("A", ts("2024-01-02 09:30:00") + dt.timedelta(seconds=i), i, float(i), f"c{i}") for i in range(100)]
    out = downsample(spark.createDataFrame(rows, sch), max_points=10).orderBy("ts_event").collect()
    w = 9  # int(99 / 10)
    for r in out:
        start = (r["ts_event"] - ts("2024-01-02 09:30:00")).total_seconds()
        members = [i for i in range(100)
                   if (ts("2024-01-02 09:30:00") + dt.timedelta(seconds=i) - dt.datetime(1970, 1, 1)).total_seconds() // w
                   == (r["ts_event"] - dt.datetime(1970, 1, 1)).total_seconds() // w]
        assert r["best_bid"] == float(max(members)) and r["cond"] == f"c{min(members)}", start


def test_adaptive_points(spark):
    df = spark.createDataFrame([(10.0, "nbbo"), (60.0, "trades"), (300.0, "nbbo"), (1000.0, "nbbo"), (7200.0, "trades")],
                               "s double, t string")
    got = [r[0] for r in df.select(adaptive_max_points("s", "t")).collect()]
    assert got == [5000, 20000, 15000, 10000, 20000]


def test_closest_date_tie_goes_to_later(spark):
    av = spark.createDataFrame([("x", dt.date(2024, 1, 8)), ("x", dt.date(2024, 1, 12))], "k string, trade_date date")
    tg = spark.createDataFrame([("x", dt.date(2024, 1, 10)), ("x", dt.date(2024, 1, 30))], "k string, target_date date")
    got = {r["target_date"]: r["closest_date"] for r in closest_dates(av, tg, ["k"], 5).collect()}
    assert got == {dt.date(2024, 1, 10): dt.date(2024, 1, 12)}       # 30th: nothing within 5 days


def test_histogram_edges(spark):
    df = spark.createDataFrame([(float(x),) for x in [0, 1, 2, 3, 10]], "x double")
    h = {r["bin"]: r["count"] for r in stats.histogram(df, "x", 5).collect()}
    assert sum(h.values()) == 5 and h[4] == 1 and h[0] == 2               # max lands in the last bin
    eq = spark.createDataFrame([(3.0,)] * 4, "x double")
    assert [(r["bin"], r["count"]) for r in stats.histogram(eq, "x", 10).collect()] == [(0, 4)]


def test_tw_spread_single_shuffle_equals_lead_formulation(spark):
    from pyspark.sql import Window as W
    rows = []
    for day in (2, 3):
        base = dt.datetime(2024, 1, day, 9, 30)
        offs = [0, 0.5, 0.5, 59.999, 60, 61.2, 300, 301, 1800.25, 3599, 23399.9, 23401, 23500]  # after close too
        for i, o in enumerate(offs):
            for sym in ("A", "B"):
                rows.append((sym, dt.date(2024, 1, day), base + dt.timedelta(seconds=o), day * 100 + i,
                             10.0 + i * 0.01, 10.02 + i * 0.013 + (0.5 if sym == "B" else 0)))
    rows.append(("C", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 16, 5), 1, 10.0, 10.1))  # only after close
    df = spark.createDataFrame(rows, "symbol string, trade_date date, ts_event timestamp_ntz, qu_seqnum long, "
                                     "best_bid double, best_ask double")
    for win in ("1m", "37s", "1h"):
        a = bars.tw_spread(df, win).withColumn("tw_spread", F.round("tw_spread", 9))
        b = bars.tw_spread_by_lead(df, win).withColumn("tw_spread", F.round("tw_spread", 9))
        assert a.count() == b.count(), win
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, win


def test_session_bounds_clipped_to_data(spark):
    from tickspark.functions.columns import session_bounds
    df = spark.createDataFrame([(ts("2024-01-02 09:45:10"), ts("2024-01-02 17:00:00")),
                                (ts("2024-01-02 04:00:00"), ts("2024-01-02 12:00:00"))], "lo timestamp_ntz, hi timestamp_ntz")
    s, e = session_bounds("lo", "hi")
    got = [(r[0], r[1]) for r in df.select(s, e).collect()]
    assert got == [(ts("2024-01-02 09:45:10"), ts("2024-01-02 16:00:00")),
                   (ts("2024-01-02 09:30:00"), ts("2024-01-02 12:00:00"))]


def test_default_source_prefers_taq(spark):
    from tickspark.operators.catalog import source_availability
    sch = "source string, data_type string, trade_date date, symbol string, n_rows long"
    d = dt.date(2024, 1, 2)
    c = spark.createDataFrame([("alpaca", "trades", d, "A", 3), ("taq", "nbbo", d, "A", 2), ("csv", "quotes", d, "A", 1)], sch)
    got = {r["source"]: (r["available"], r["is_default"]) for r in source_availability(c).collect()}
    assert got == {"alpaca": (True, False), "taq": (True, True), "csv": (False, False)}
    c2 = c.where(F.col("source") != "taq")
    got2 = {r["source"]: r["is_default"] for r in source_availability(c2).collect()}
    assert got2 == {"alpaca": True, "csv": False}


def test_asof_right_required_drops_groups_without_quotes(spark):
    d1 = dt.date(2024, 1, 3)
    t = spark.createDataFrame([("A", d1, ts("2024-01-03 09:30:00"), 1, 1.0), ("A", d1, ts("2024-01-03 11:00:00"), 2, 1.0),
                               ("B", d1, ts("2024-01-03 09:31:00"), 3, 1.0)],
                              "sym string, d date, t timestamp_ntz, seq long, price double")
    q = spark.createDataFrame([("A", d1, ts("2024-01-03 10:00:00"), 9, 5.0, 6.0),
                               ("B", dt.date(2024, 1, 2), ts("2024-01-02 10:00:00"), 8, 5.0, 6.0)],
                              "sym string, d date, t timestamp_ntz, qseq long, bid double, ask double")
    for b in (None, "1m", "5m"):
        got = {r["seq"]: r["bid"] for r in asof_join(t, q, ["sym", "d"], "t", right_cols=["bid"], left_seq="seq",
                                                      right_seq="qseq", bucket=b, right_required=True).collect()}
        assert got == {1: None, 2: 5.0}, b            # B has quotes only on another date → dropped


def test_asof_right_required_equals_semi_join_on_hot_symbol(spark):
    base = spark.range(0, 12000).select(
        F.when(F.col("id") % 5 < 3, F.lit("HOT")).otherwise(F.concat(F.lit("C"), (F.col("id") % 7).cast("string"))).alias("sym"),
        F.lit(dt.date(2024, 1, 2)).alias("d"),
        F.timestamp_add("MILLISECOND", (F.col("id") * 977) % 23_400_000, F.lit(ts("2024-01-02 09:30:00"))).alias("t"),
        F.col("id").alias("seq"), (F.col("id") % 13).cast("double").alias("x"))
    trades = base.where(F.col("seq") % 4 == 0).select("sym", "d", "t", "seq", F.col("x").alias("price"))
    quotes = (base.where((F.col("seq") % 4 != 0) & (F.col("sym") != "C3"))      # C3 never quoted
              .select("sym", "d", "t", F.col("seq").alias("qseq"), F.col("x").alias("bid")))
    args = dict(by=["sym", "d"], left_ts="t", right_cols=["bid", "qseq"], left_seq="seq", right_seq="qseq")
    want = asof_join(trades, quotes, bucket=None, **args).join(quotes.select("sym", "d").distinct(), ["sym", "d"], "left_semi")
    for b in (None, "1m"):
        got = asof_join(trades, quotes, bucket=b, right_required=True, **args)
        assert got.exceptAll(want).count() == 0 and want.exceptAll(got).count() == 0, b


def test_top_k_puts_null_sizes_last(spark):
    from tickspark.operators.topk import top_k_per_group
    df = spark.createDataFrame([("A", None, 1), ("A", 5, 2), ("A", 9, 3), ("A", 5, 4)],
                               "symbol string, size int, seq long")
    r = top_k_per_group(df, 3, ["symbol"], [F.desc_nulls_last("size"), "seq"]).orderBy("rank").collect()
    assert [(x["seq"], x["rank"]) for x in r] == [(3, 1), (2, 2), (4, 3)]     # ties by seq; NULL not "largest"


def test_downsample_properties(spark):
    from tickspark.functions.columns import epoch_micros
    sch = "symbol string, ts_event timestamp_ntz, qu_seqnum long, best_bid double, cond string"
    rows = [(s, ts("2024-01-02 09:30:00") + dt.timedelta(milliseconds=(i * 7919) % 3_600_000), i, float(i), "x")
            for s in ("A", "B") for i in range(3000)] + [("C", ts("2024-01-02 10:00:00"), 1, 1.0, "y")]
    df = spark.createDataFrame(rows, sch)
    out = downsample(df, max_points=100)
    per = {r["symbol"]: r["count"] for r in out.groupBy("symbol").count().collect()}
    # width = int(span / budget) whole seconds → at most span/width + 1 grid buckets (≈ budget)
    span = (max(r[1] for r in rows if r[0] == "A") - min(r[1] for r in rows if r[0] == "A")).total_seconds()
    bound = int(span // int(span / 100)) + 2
    assert per["C"] == 1 and per["A"] <= bound and per["B"] <= bound
    # every output row is a bucket start that some input row falls into, with that bucket's last bid
    joined = out.join(df.select("symbol", F.col("ts_event").alias("t0"), F.col("best_bid").alias("b0")), "symbol")
    assert out.where(F.col("symbol") == "C").first()["best_bid"] == 1.0
    assert out.agg(F.min(epoch_micros("ts_event"))).first()[0] >= 0 and joined.count() > 0


def test_minute_nbbo_features_equal_composition(spark):
    """One-pass close NBBO + updates + time-weighted spread == as-of + churn + tw_spread."""
    rows = []
    for day in (2, 3):
        base = dt.datetime(2024, 1, day, 9, 30)
        offs = [0, 0.5, 0.5, 59.999, 60, 60, 61.2, 120, 300, 301, 1800.25, 3599, 23399.9, 23401, 23500]
        for i, o in enumerate(offs):
            for sym in ("A", "B"):
                b = 10.0 + i * 0.01 + (0.05 if i % 5 == 3 else 0)        # every fifth quote crossed
                rows.append((sym, dt.date(2024, 1, day), base + dt.timedelta(seconds=o), day * 100 + i,
                             b, 10.02 + i * 0.023 + (0.5 if sym == "B" else 0)))
    rows += [("C", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 16, 5), 1, 10.0, 10.1),
             ("D", dt.date(2024, 1, 2), dt.datetime(2024, 1, 2, 10, 0), 1, 10.5, 10.1)]
    q = spark.createDataFrame(rows, "symbol string, trade_date date, ts_event timestamp_ntz, qu_seqnum long, "
                                    "best_bid double, best_ask double")
    tmins = [(s, dt.date(2024, 1, d), dt.datetime(2024, 1, d, 9, 30) + dt.timedelta(minutes=m))
             for s in "ABCDE" for d in (2, 3) for m in (-5, 0, 1, 2, 3, 7, 29, 30, 59, 60, 389, 390, 395)]
    tr = spark.createDataFrame(tmins, "symbol string, trade_date date, ts_event timestamp_ntz")
    for win in ("1m", "37s", "5m"):
        grid = tr.groupBy("symbol", "trade_date", time_bucket("ts_event", win).alias("time_bucket")) \
                 .agg(F.count(F.lit(1)).alias("num_trades"))
        new = bars.minute_nbbo_features(q, grid, win)
        old = (bars.bucket_close_quotes(grid, q, win)
               .join(bars.churn(q, win).withColumnRenamed("churn", "quote_updates"), ["symbol", "time_bucket"], "left")
               .join(bars.tw_spread(q, win).drop("covered_us"), ["symbol", "trade_date", "time_bucket"], "left")
               .withColumn("quote_updates", F.coalesce("quote_updates", F.lit(0).cast("long"))))
        cols = old.columns

        def r(df):
            return df.select(*[F.round(c, 9).alias(c) if t == "double" else F.col(c)
                               for c, t in df.select(*cols).dtypes])
        a, b = r(new), r(old)
        assert a.count() == b.count(), win
        assert a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0, win


def test_session_edges(spark):
    from tickspark.functions.filters import in_session, in_session_half_open
    df = spark.createDataFrame([(ts("2024-01-02 09:29:59.999999"),), (ts("2024-01-02 09:30:00"),),
                                (ts("2024-01-02 15:59:59.999999"),), (ts("2024-01-02 16:00:00"),),
                                (ts("2024-01-02 16:00:00.000001"),)], "ts_event timestamp_ntz")
    got = [(r[0], r[1]) for r in df.select(in_session(), in_session_half_open()).collect()]
    assert got == [(False, False), (True, True), (True, True), (True, False), (False, False)]


def test_lod_choice_rule(spark):
    df = spark.createDataFrame([(60.0,), (119.0,), (120.0,), (1800.0,), (1801.0,)], "s double")
    got = [r[0] for r in df.select(bars.lod_choice("s")).collect()]
    assert got == ["raw", "raw", "100ms", "100ms", "1s"]
