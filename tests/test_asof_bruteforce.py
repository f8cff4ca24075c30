"""Randomized check of the as-of join against a brute-force Python reference."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickspark.operators.asof import asof_join

BASE = dt.datetime(2024, 1, 2, 9, 30)
DAYS = [dt.date(2024, 1, 2), dt.date(2024, 1, 3)]

# times on a coarse grid of 250 ms steps around several bucket edges, so ties and edges are common
tick = st.tuples(st.sampled_from(["A", "B", "C"]), st.sampled_from(DAYS), st.integers(0, 1200))


def _ts(day, step):
    return dt.datetime.combine(day, BASE.time()) + dt.timedelta(milliseconds=250 * step)


def brute(trades, quotes, right_required):
    out = {}
    for sym, day, t, seq in trades:
        cands = [q for q in quotes if q[0] == sym and q[1] == day and q[2] <= t]
        if right_required and not any(q[0] == sym and q[1] == day for q in quotes):
            continue
        best = max(cands, key=lambda q: (q[2], q[3]), default=None)
        out[seq] = None if best is None else best[3]
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(tick, min_size=1, max_size=40), st.lists(tick, min_size=0, max_size=60), st.booleans())
def test_asof_matches_brute_force(spark, tr, qu, right_required):
    trades = [(s, d, _ts(d, k), 1000 + i) for i, (s, d, k) in enumerate(tr)]
    quotes = [(s, d, _ts(d, k), 5000 + i) for i, (s, d, k) in enumerate(qu)]
    want = brute(trades, quotes, right_required)
    t = spark.createDataFrame(trades, "sym string, d date, t timestamp_ntz, seq long")
    q = spark.createDataFrame(quotes, "sym string, d date, t timestamp_ntz, qseq long")
    for bucket in (None, "1m", "7s"):
        j = asof_join(t, q, ["sym", "d"], "t", right_cols=["qseq"], left_seq="seq", right_seq="qseq",
                      bucket=bucket, right_required=right_required)
        got = {r["seq"]: r["qseq"] for r in j.collect()}
        assert got == want, (bucket, right_required)
