"""The SQL form of the two reads: equal to the DataFrame form, arguments only bound."""

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from stockout.operators.orders import MINUTE_ORDER_COLUMNS, minute_orders
from stockout.operators.report import REPORT_BASE_COLUMNS, report_base
from stockout.operators.scope import Scope
from stockout.sources import from_testdata
from stockout.sources.statements import MINUTE_ORDERS, REPORT_BASE, read_sql


@pytest.fixture(scope="module")
def src(spark):
    return from_testdata(spark, SMOKE_DIR)


@pytest.mark.parametrize("scope", [Scope(), Scope(days=("19970101",)), Scope(days=("19960101", "19980101"), channels=("C",)),
                                   Scope(channels=("H",)), Scope(days=("20200101",)), Scope(days=())], ids=str)
def test_equals_the_dataframe_form(spark, src, scope):
    if scope.days != ():
        want = sorted(map(str, minute_orders(src, scope).select(*MINUTE_ORDER_COLUMNS).collect()))
        assert sorted(map(str, read_sql(spark, src, MINUTE_ORDERS, scope).select(*MINUTE_ORDER_COLUMNS).collect())) == want
        got = read_sql(spark, src, REPORT_BASE, scope)
        assert got.columns == list(REPORT_BASE_COLUMNS)
        assert sorted(map(str, got.collect())) == sorted(map(str, report_base(src, scope).collect()))
    else:
        with pytest.raises(ValueError):  # no first and last day to read
            read_sql(spark, src, MINUTE_ORDERS, scope)


@pytest.mark.parametrize("text", ["x' OR '1'='1", "19970101') OR true --", "'; DROP TABLE t; --", "{broadcast}", ":days", "\\"])
def test_arguments_are_values_and_no_sql(spark, src, text):
    for scope in (Scope(channels=(text,)), Scope(days=("19970101",), channels=("C", text))):
        got = read_sql(spark, src, MINUTE_ORDERS, scope)
        assert {r["chanl_cd"] for r in got.select("chanl_cd").distinct().collect()} <= {"C"}
        assert got.count() == minute_orders(src, scope).count()


def test_days_reach_the_scan(spark, src):
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = read_sql(spark, src, MINUTE_ORDERS, Scope(days=("19970101",)))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(ord_dt" in plan and "19970102" in plan
    assert "EqualTo(broad_ord_time_dtl_cd,O1)" in plan


def test_own_statements_and_number_days(spark, src):
    counted = read_sql(spark, src, "SELECT count(*) AS n FROM {broadcast} WHERE array_contains(:channels, chanl_cd)", Scope(channels=("C",)))
    assert counted.first()["n"] == src.broadcast.where(F.col("chanl_cd") == "C").count()
    with pytest.raises(ValueError):
        read_sql(spark, src, MINUTE_ORDERS, Scope(numeric_day_window=True))
