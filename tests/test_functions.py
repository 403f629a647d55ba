"""Scalar and small aggregate functions (FIXTURES.md §4, other operators)."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from stockout.functions import (broadcast_time_text, month_days, option_detail, ordered_size_string,
                                size_sort_key, strip_paren, yesterday)
from stockout.operators.impute import _rank_pool


def _size_string(spark, values):
    df = spark.createDataFrame([(1, v) for v in values], "prd_cd long, v string")
    out = (df.distinct().withColumn("k", size_sort_key(F.col("v")))
           .groupBy("prd_cd").agg(ordered_size_string("v", "k").alias("s")))
    return out.first()["s"]


def test_size_string_order(spark):
    assert _size_string(spark, ["M", "S", "95", "SS", "FREE", "100", "XL", None]) == "FREE_SS_95_100_S_M_XL"


def test_size_string_nulls_only(spark):
    assert _size_string(spark, [None]) is None


def test_size_key_long_digit_runs_kept_whole(spark):
    df = spark.createDataFrame([("12345",), ("3XL",), ("XXL",)], "v string")
    keys = [r[0] for r in df.select(size_sort_key(F.col("v"))).collect()]
    assert keys == ["112345", "10003", "60"]


def test_strip_paren(spark):
    df = spark.createDataFrame([("M(95)",), ("M",), ("(95)",), (None,)], "v string")
    assert [r[0] for r in df.select(strip_paren(F.col("v"))).collect()] == ["M", "M", None, None]


def test_option_detail_widths(spark):
    df = spark.createDataFrame([("a,b,c,d",), ("a,b,c,d,e",), ("a,b,c",), ("a,b",)], "v string")
    size2, size3 = option_detail(F.col("v"))
    got = [(r[0], r[1]) for r in df.select(size2, size3).collect()]
    assert got == [("c", "d"), ("c", "d e"), ("c", None), (None, None)]


def test_broadcast_time_text(spark):
    df = spark.createDataFrame([(dt.datetime(2016, 8, 8, 21, 40),)],
                               T.StructType([T.StructField("ts", T.TimestampNTZType())]))
    assert df.select(broadcast_time_text(F.col("ts"))).first()[0] == "08/08 (월) 21시"


def test_rank_pool(spark):
    df = spark.createDataFrame([(n,) for n in (1, 2, 3, 5, 10)], "n long")
    got = {r["n"]: list(r["p"]) for r in df.select("n", _rank_pool(F.col("n")).alias("p")).collect()}
    assert got == {1: [0, 1], 2: [1], 3: [1, 2], 5: [2, 3, 4], 10: [3, 4, 6, 7, 9]}


def test_month_days_and_yesterday(spark):
    days = [r[0] for r in month_days(spark, 2016, 2).orderBy("broad_dt").collect()]
    assert days[0] == "20160201" and days[-1] == "20160229" and len(days) == 29
    df = spark.createDataFrame([(dt.date(2016, 3, 1),)], "d date")
    assert df.select(yesterday(F.col("d"))).first()[0] == "20160229"
