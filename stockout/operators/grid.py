"""The option x minute grid of each broadcast x product ("group").

Kept long: one row per (group, option, minute) instead of a wide matrix. The minute axis of
a group is the set of minutes in which any of its options sold; options are those ordered
plus those the report lists, the latter at 0 where they never sold.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockout.functions import parse_minute
from stockout.stage import bucket_count

GROUP = ["pgm_id", "prd_cd"]
OPTION = GROUP + ["attr_prd_cd"]
GRID_COLUMNS = ("pgm_id", "prd_cd", "attr_prd_cd", "ord_ts", "qty", "supply", "is_live", "broad_dt")


def _orders(minutes: DataFrame) -> DataFrame:
    """Minute orders with their minute as a timestamp.

    Pass ``minutes`` hash-partitioned (or bucketed) by the group, as ``DailyRun`` does: every
    later distinct, join, union and window here is keyed by the group plus more columns, so
    Spark keeps that partitioning through the grid, the sold-out rule and the snapshots."""
    return minutes.select(*GROUP, "attr_prd_cd",
                          parse_minute(F.col("ord_dt"), F.col("ord_time")).alias("ord_ts"),
                          F.col("tot_ord_qty").alias("qty"), "is_live", "broad_dt")


def option_frame(minutes: DataFrame, options: DataFrame) -> DataFrame:
    """Options of every group with on-air orders: those ordered plus those the report lists,
    with supply, the number of report rows listing the option (``n_listed``, 0 for an
    ordered option the report lacks) and the group gate.

    The gate compares the group's report rows with its grid options; they differ when an
    ordered option is missing from the report (or the report repeats one), and then the
    whole group is left out of the report, as the reference does.
    """
    orders = _orders(minutes)
    # channel and day are fixed per broadcast: grouping keys (keeps a hash aggregation)
    groups = orders.select(*GROUP, "is_live", "broad_dt").distinct()
    # same hash partitioning as the bucketed minute stage, so the two sides stay co-partitioned
    listed = (options.repartition(bucket_count(options.sparkSession), *GROUP)
              .join(groups.select(*GROUP), GROUP, "left_semi")
              .groupBy(*OPTION).agg(F.count("*").alias("n_listed"), F.max("supply").alias("supply")))
    by_group = Window.partitionBy(*GROUP)
    return (orders.select(*OPTION).unionByName(listed.select(*OPTION)).distinct()
            .join(listed, OPTION, "left")
            .join(groups, GROUP)
            .withColumn("n_listed", F.coalesce(F.col("n_listed"), F.lit(0)))
            .withColumns({"n_report_rows": F.sum("n_listed").over(by_group),
                          "n_grid_options": F.count("*").over(by_group)})
            .withColumn("passes", F.col("n_report_rows") == F.col("n_grid_options")))


def group_gate(frame: DataFrame) -> DataFrame:
    """Per group with on-air orders: report rows, grid options and whether they agree."""
    return frame.select(*GROUP, "n_report_rows", "n_grid_options", "passes").distinct()


def order_grid(minutes: DataFrame, frame: DataFrame) -> DataFrame:
    """Dense grid ``GRID_COLUMNS + (passes,)``: every option of a group at every minute of
    the group's axis, units 0 where the option did not sell.

    ``minutes``: output of ``minute_orders``; ``frame``: ``option_frame``. Minutes come from
    the broadcast day and the next, so a group spans at most 2 x 1440 minutes and the grid
    grows linearly with the options, never with the order lines. The option x minute
    expansion is an equi-join on the group key.
    """
    orders = _orders(minutes)
    axis = orders.select(*GROUP, "ord_ts").distinct()
    cells = (frame.select(*OPTION, "supply", "is_live", "broad_dt", "passes")
             .join(axis, GROUP)
             .join(orders.select(*OPTION, "ord_ts", "qty"), OPTION + ["ord_ts"], "left")
             .withColumn("qty", F.coalesce(F.col("qty"), F.lit(0)).cast("bigint")))
    return cells.select(*GRID_COLUMNS, "passes")
