"""Randomized check of the adaptive downsampler against a pure-Python version of its rule."""

import datetime as dt
import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tickspark.operators.downsample import downsample

EPOCH = dt.datetime(1970, 1, 1)
BASE = dt.datetime(2024, 1, 2, 9, 30)


def width_us(n, span_s, max_points):
    if n <= max_points:
        return 0
    b = max(0.001, span_s / max_points)
    if b >= 1:
        return math.floor(b) * 1_000_000
    return 100_000 if b >= 0.1 else 10_000 if b >= 0.01 else 1_000


def brute(rows, max_points):
    out = set()
    for sym in {r[0] for r in rows}:
        g = sorted((r for r in rows if r[0] == sym), key=lambda r: (r[1], r[2]))
        us = [int((r[1] - EPOCH) / dt.timedelta(microseconds=1)) for r in g]
        w = width_us(len(g), (max(us) - min(us)) / 1e6, max_points)
        if w == 0:
            out |= {(sym, r[1], r[2], r[3], r[4]) for r in g}
            continue
        buckets = {}
        for r, u in zip(g, us):
            buckets.setdefault(u - u % w, []).append(r)
        for start, members in buckets.items():
            last, first = members[-1], members[0]
            out.add((sym, EPOCH + dt.timedelta(microseconds=start), last[2], last[3], first[4]))
    return out


row = st.tuples(st.sampled_from(["A", "B"]), st.integers(0, 600_000), st.integers(0, 9))


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row, min_size=1, max_size=80), st.sampled_from([3, 7, 20, 100]))
def test_downsample_matches_brute_force(spark, raw, max_points):
    rows = [(s, BASE + dt.timedelta(milliseconds=ms), i, float(v), f"c{i}") for i, (s, ms, v) in enumerate(raw)]
    df = spark.createDataFrame(rows, "symbol string, ts_event timestamp_ntz, qu_seqnum long, best_bid double, cond string")
    got = {tuple(r) for r in downsample(df, max_points=max_points).collect()}
    assert got == brute(rows, max_points)
