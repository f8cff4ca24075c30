"""Times as they come, drops of several headers, symbol lists on ticks, table resolution, REST rows."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickspark.functions.times import any_date, time_of_day_ns, with_time_micros
from tickspark.operators.symbols import keep_symbols, symbol_ranges
from tickspark.schemas import TRADES
from tickspark.session import scratch_path
from tickspark.sources import csv as csvsrc
from tickspark.sources import rest, warehouse

DAY = dt.date(2024, 1, 2)


def test_times_of_any_writing(spark):
    df = spark.createDataFrame([("9:30:00",), ("09:30:00.5",), (" 15:59:59.123456789 ",), ("24:00:00",), ("noon",), ("9:61:00",), (None,)], "t string")
    got = [r[0] for r in df.select(time_of_day_ns(F.col("t"), T.StringType())).collect()]
    open_ns = 9 * 3600 * 10**9 + 30 * 60 * 10**9
    assert got == [open_ns, open_ns + 5 * 10**8, (15 * 3600 + 59 * 60 + 59) * 10**9 + 123456789, None, None, None, None]
    ntz = spark.createDataFrame([(dt.datetime(1970, 1, 1, 9, 30, 0, 7),)], "t timestamp_ntz")
    assert ntz.select(time_of_day_ns(F.col("t"), T.TimestampNTZType())).first()[0] == open_ns + 7000
    rows = spark.createDataFrame([("09:30:00.123456789", "5"), ("09:30:00", None)], "time_m string, time_m_nano string")
    assert [tuple(r) for r in with_time_micros(rows).select("time_m_us", "time_m_nano").collect()] == [
        (open_ns // 1000 + 123456, 794), (open_ns // 1000, 0)]
    days = spark.createDataFrame([("2024-01-02",), ("20240102",), ("2024-01-02 00:00:00",), ("x",)], "d string")
    assert [r[0] for r in days.select(any_date(F.col("d"), T.StringType())).collect()] == [DAY, DAY, DAY, None]


def drop(root, name, text):
    root = root.removeprefix("file:")
    os.makedirs(root, exist_ok=True)
    with open(os.path.join(root, name), "w", encoding="utf-8") as f:
        f.write(text)


def test_drops_of_several_headers_by_type_date_and_prefix(spark):
    root = scratch_path(spark, "drops")
    drop(root, "taq_trade_20240102.csv", "date,time_m,time_m_nano,sym_root,sym_suffix,price,size\n2024-01-02,09:30:00.000001,7,A,,10.5,100\n"
                                         "2024-01-02,bad,7,A,X,n/a,1\n")
    drop(root, "taq_trade_20240103.csv", "﻿SIZE,sym_root,time_m_us,extra\n200,B,34200000000,z\n")
    drop(root, "taq_trade_20240104.csv", "size,sym_root,time_m_us,extra\n300,C,34200000000,z\n")
    drop(root, "taq_nbbo_20240102.csv", "date,sym_root,best_bid\n2024-01-02,A,1\n")
    drop(root, "old_20240102.csv", "sym_root\nOLD\n")
    drop(root, "notes.txt", "no drop")
    got = {r.sym_root: r for r in csvsrc.read_drops(spark, root, "trades", ("2024-01-02", "2024-01-03")).where("price is not null or size > 1").collect()}
    assert set(got) == {"A", "B"}
    assert (got["A"].time_m_us, got["A"].time_m_nano, float(got["A"].price), got["A"].size) == (34_200_000_001, 7, 10.5, 100)
    assert (got["B"].date, got["B"].file_date, got["B"].size, got["B"].price) == (dt.date(2024, 1, 3), dt.date(2024, 1, 3), 200, None)
    bad = csvsrc.read_drops(spark, root, "trades", ["2024-01-02"]).where("sym_suffix = 'X'").first()
    assert bad.time_m_us is None and bad.price is None and bad.size == 1
    names = [f.name for f in TRADES.fields if f.name not in ("trade_date", "symbol", "ts_event", "ts_event_ns", "extract_run_id", "ingest_ts")]
    assert csvsrc.read_drops(spark, root, "trades").columns == [*names, "file_date", "source_file"]
    assert csvsrc.read_drops(spark, root, "trades").count() == 4
    assert csvsrc.read_drops(spark, root, "trades", prefix="old").count() == 1
    assert csvsrc.read_drops(spark, root, "quotes").collect() == []


def test_symbol_lists_never_shuffle_ticks_on_the_symbol_alone(spark):
    ticks = spark.range(5000).select(F.concat(F.lit("S"), (F.col("id") % 50).cast("string")).alias("symbol"), "id")
    names = [f"S{k}" for k in range(0, 60, 3)]
    asked = spark.createDataFrame([(n,) for n in names] + [(None,), ("S0",)], "s string")
    want = ticks.where(F.col("symbol").isin(names)).count()
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for limits in ({}, {"literals": 5}, {"literals": 5, "broadcast": 5}):
            out = keep_symbols(ticks, asked, **limits)
            plan = out._jdf.queryExecution().executedPlan().toString()
            exchanges = [line for line in plan.splitlines() if "Exchange hashpartitioning(" in line and "_name" not in line]
            assert all("xxhash64" in line or "pmod" in line or "," in line.split("hashpartitioning(")[1].split(", 4)")[0] for line in exchanges), plan
            assert out.count() == want
            if not limits:
                assert "Exchange" not in plan and "Join" not in plan
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert keep_symbols(ticks, "S1").count() == 100 and keep_symbols(ticks, None).count() == 5000 and keep_symbols(ticks, []).count() == 0


def test_ranges_of_a_warehouse_read_hold_every_row_once():
    assert symbol_ranges(["B", "A", "C", "D", "A"], 2) == ["C"] and symbol_ranges([], 4) == []
    assert warehouse.range_predicates([]) is None
    assert warehouse.range_predicates(["B", "O'X"]) == ["sym_root < 'B' OR sym_root IS NULL", "sym_root >= 'B' AND sym_root < 'O''X'",
                                                        "sym_root >= 'O''X'"]


def test_tables_resolve_in_order(spark):
    asked = spark.createDataFrame([(DAY, "trades"), (DAY, "quotes"), (DAY, "nbbo")], "trade_date date, data_type string")
    listing = spark.createDataFrame([("taqmsec", "ctm_20240102"), ("TAQM_2024", "CTM_20240102"), ("taqmsec", "cqm_20240102"), ("x", "complete_nbbo_20240102")],
                                    "schema string, table string")
    got = {r.data_type: (r.schema, r.table) for r in warehouse.resolve_tables(asked, listing).collect()}
    assert got == {"trades": ("taqm_2024", "ctm_20240102"), "quotes": ("taqmsec", "cqm_20240102"), "nbbo": (None, None)}


def test_rest_pages_in_the_canonical_schema(spark):
    path = scratch_path(spark, "rest")
    drop(path, "p.json", '{"symbol": "A.B", "quotes": [{"t": "2024-07-02T13:30:00.123456789Z", "bp": 1.5, "bs": 5000000000}]}\n')
    (row,) = rest.canonical_rest(spark, path, "nbbo", "alpaca_iex").collect()
    assert row.source == "alpaca_iex" and row.best_bidsiz == 5_000_000_000 and row.best_ask == 0.0 and row.nbbo_qu_cond is None
    assert row.ts_event_ns % 10**9 == 123456789 and row.ts_event == dt.datetime(2024, 7, 2, 13, 30, 0, 123456) and row.symbol == "A.B"


@pytest.mark.parametrize("kind", ["text", "timestamp"])
def test_extracts_take_real_times(spark, kind):
    at = dt.datetime(1970, 1, 1, 9, 30)
    times = [at - dt.timedelta(microseconds=1), at, dt.datetime(1970, 1, 1, 16, 0), dt.datetime(1970, 1, 1, 16, 0, 0, 1)]
    rows = spark.createDataFrame([("A", t, "00") for t in times], "sym_root string, time_m timestamp_ntz, tr_corr string")
    if kind == "text":
        rows = rows.withColumn("time_m", F.date_format("time_m", "HH:mm:ss.SSSSSS"))
    got = [r.time_m_us for r in warehouse.extract_trades(rows, ["A"]).collect()]
    assert got == [34_200_000_000, 57_600_000_000]
