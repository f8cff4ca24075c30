"""Catalogs of written lakes, the planner and availability per data type."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tickspark.operators import catalog as cat
from tickspark.session import scratch_path
from tickspark.sources import lake

D1, D2 = dt.date(2024, 1, 2), dt.date(2024, 1, 3)
TICKS = "trade_date date, symbol string, x int"
CAT = "source string, data_type string, trade_date date, symbol string, n_rows long"


def keys(df):
    return sorted((r.trade_date, r.symbol, r.data_type) for r in df.collect())


@pytest.fixture(scope="module")
def root(spark):
    root = scratch_path(spark, "lake")
    ticks = spark.createDataFrame([(D1, "A", 1), (D1, "A", 2), (D1, "B", 3), (D2, "A", 4)], TICKS)
    lake.write_partitioned(ticks, root, "trades", sort_cols=())
    lake.write_partitioned(ticks.withColumn("symbol", F.when(F.col("symbol") == "B", F.lit("('B',)")).otherwise(F.col("symbol"))), root, "nbbo",
                           partition_by_symbol=False, sort_cols=())
    return root


def test_catalog_of_both_layouts(spark, root):
    got = sorted(tuple(r) for r in cat.catalog_from_lake(spark, root, "taq").collect())
    want = [(D1, "A", 2), (D1, "B", 1), (D2, "A", 1)]
    assert got == sorted(("taq", t, *w) for t in ("trades", "nbbo") for w in want)
    both = cat.catalog_from_lakes(spark, {"taq": root, "csv": f"{root}-none"})
    assert both.count() == 6


def test_planner_modes_and_types(spark, root):
    c = cat.catalog_from_lake(spark, root, "taq")
    asked = spark.createDataFrame([(d, s, t) for d in (D1, D2) for s in ("A", "('B',)") for t in ("trades", "quotes")],
                                  "trade_date date, symbol string, data_type string")
    every = sorted((d, s, t) for d in (D1, D2) for s in ("A", "B") for t in ("trades", "quotes"))
    lacks = [k for k in every if k[2] == "quotes" or k == (D2, "B", "trades")]
    for feed in cat.FEEDS:
        assert keys(cat.plan_work(asked, c, "taq", "resume", feed)) == lacks
        assert keys(cat.plan_work(asked, c, "taq", "overwrite", feed)) == every
        assert keys(cat.plan_work(asked, c, "taq", "normal", feed)) == (lacks if feed == "warehouse" else every)
    assert keys(cat.plan_work(asked, c, "taq", types=["trades"])) == [(D2, "B", "trades")]
    assert keys(cat.plan_work(asked.where("symbol = 'A' and data_type = 'trades'"), c, "taq")) == []
    with pytest.raises(ValueError):
        cat.plan_work(asked, c, "taq", "again")


def test_availability_keeps_types_apart(spark):
    c = spark.createDataFrame([("taq", "trades", D1, "A", 5), ("taq", "nbbo", D1, "B", 1), ("csv", "nbbo", D1, "A", 0)], CAT)
    asks = spark.createDataFrame([("taq", D1, "A", "trades"), ("taq", D1, "A", "nbbo"), ("taq", D1, None, "nbbo"), ("csv", D1, "A", "nbbo"),
                                  ("csv", D1, None, "nbbo")], "source string, trade_date date, symbol string, data_type string")
    got = {tuple(r)[:4]: r.available for r in cat.data_available(asks, c).collect()}
    assert got == {("taq", D1, "A", "trades"): True, ("taq", D1, "A", "nbbo"): False, ("taq", D1, None, "nbbo"): True,
                   ("csv", D1, "A", "nbbo"): False, ("csv", D1, None, "nbbo"): False}
    matrix = cat.availability(spark.createDataFrame([("A",), ("B",)], "symbol string"), F.lit(D1), F.lit(D1), ["taq"], c)
    rows = {r.data_type: r for r in cat.common_sources(matrix).collect()}
    assert rows["trades"].status == rows["nbbo"].status == "some"
    assert rows["trades"].missing_symbols == ["B"] and rows["nbbo"].missing_symbols == ["A"]


def test_default_source(spark):
    c = spark.createDataFrame([("taq", "trades", D1, "A", 0), ("csv", "nbbo", D1, "A", 1), ("alpaca", "trades", D2, "A", 1)], CAT)
    got = {r.source: (r.n_dates, r.available, r.is_default) for r in cat.source_availability(c).collect()}
    assert got == {"taq": (0, False, False), "csv": (1, True, False), "alpaca": (1, True, True)}


def test_a_task_lists_and_reads_footers_in_one_worker(spark, root):
    found = cat.lake_partitions(spark, root, "trades")
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    assert sorted((r.trade_date, r.symbol, r.n_rows, r.n_files) for r in found.collect()) == [(D1, "A", 2, 1), (D1, "B", 1, 1), (D2, "A", 1, 1)]
