"""Deliberate decisions on the reference's quirks."""

from dataclasses import replace

from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from stockout.functions import day_after
from stockout.operators.orders import minute_orders
from stockout.operators.report import broadcast_sequence, order_base, order_option_totals, report_base
from stockout.sources import from_testdata


def test_repeated_listing_does_not_multiply(spark):
    src = from_testdata(spark, SMOKE_DIR)
    doubled = replace(src, broadcast_product=src.broadcast_product.unionByName(src.broadcast_product))
    cols = ["pgm_id", "attr_prd_cd", "tot_ord_qty", "tot_ord_amt", "pord_03_tot_ord_qty", "suply_apnt_qty"]
    assert sorted(report_base(doubled).select(cols).collect()) == sorted(report_base(src).select(cols).collect())
    keys = ["pgm_id", "attr_prd_cd", "ord_dt", "ord_time", "tot_ord_qty"]
    assert sorted(minute_orders(doubled).select(keys).collect()) == sorted(minute_orders(src).select(keys).collect())


def test_listing_under_both_channels_counts_lines_once(spark):
    """A product listed under both channels of a broadcast takes each channel's lines once."""
    src = from_testdata(spark, SMOKE_DIR)
    other = src.broadcast_product.withColumn("chanl_cd", F.when(F.col("chanl_cd") == "C", "H").otherwise("C"))
    both = replace(src, broadcast_product=src.broadcast_product.unionByName(other))
    lines = (src.order_fact.where("broad_ord_time_dtl_cd = 'O1' and tot_ord_cust_no > 0")
             .join(src.broadcast.select("pgm_id", "broad_dt"), "pgm_id").where("ord_dt = broad_dt"))
    truth = {r["pgm_id"]: r["n"] for r in lines.groupBy("pgm_id").agg(F.sum("tot_ord_qty").alias("n")).collect()}
    totals = order_option_totals(order_base(both, broadcast_sequence(both)))
    got = {r["pgm_id"]: r["n"] for r in totals.groupBy("pgm_id").agg(F.sum("tot_ord_qty").alias("n")).collect()}
    assert got == truth


def test_day_window_month_end(spark):
    df = spark.createDataFrame([("20160831",), ("20161231",), ("20160808",)], "d string")
    got = df.select(day_after(F.col("d")).alias("cal"), day_after(F.col("d"), numeric=True).alias("num")).collect()
    assert [(r["cal"], r["num"]) for r in got] == [("20160901", "20160832"), ("20170101", "20161232"),
                                                   ("20160809", "20160809")]
