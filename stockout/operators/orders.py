"""Minute orders: on-air quantity per broadcast x option x order minute."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockout.functions import day_after
from stockout.operators.report import ON_AIR
from stockout.operators.scope import ALL, LIVE_CHANNEL, Scope
from stockout.sources import Sources

# Fixed value: broadcasts selling fewer units than this are "low order" (optional filter).
LOW_ORDER_THRESHOLD = 5


def broadcast_products(src: Sources, scope: Scope = ALL) -> DataFrame:
    """Broadcast x product of the run with the broadcast's channel and day. A product listed
    twice for a broadcast counts once (a repeated listing must not multiply the units)."""
    run = scope.broadcasts(src.broadcast).select("pgm_id", "chanl_cd", "broad_dt")
    return (run.join(src.broadcast_product.select("pgm_id", "prd_cd").distinct(), "pgm_id")
            .join(src.product.select("prd_cd"), "prd_cd", "left_semi"))


def minute_orders(src: Sources, scope: Scope = ALL, lines: DataFrame | None = None) -> DataFrame:
    """On-air units of real customers per (broadcast, channel, option, order day, order
    minute) over the broadcast day and the day after. Not keyed on the order's channel.

    Filters on the order lines reach the parquet scan. The lines are summed to minutes before
    they meet the broadcasts, with a partial sum on the map side, so a hot option is one row
    per minute and task when it is shuffled, and lines themselves never are. ``lines``: the run's
    ``line_minutes`` if already written, which is read instead.
    """
    if lines is not None:
        orders = lines.where(F.col("broad_ord_time_dtl_cd") == ON_AIR)
    else:
        orders = (src.order_fact
                  .where((F.col("broad_ord_time_dtl_cd") == ON_AIR) & (F.col("tot_ord_cust_no") > 0))
                  .select("pgm_id", "prd_cd", "attr_prd_cd", "ord_dt", "ord_time", "tot_ord_qty"))
        bounds = scope.order_day_bounds()
        if bounds is not None:
            orders = orders.where(F.col("ord_dt").between(*bounds))
    orders = (orders.groupBy("pgm_id", "prd_cd", "attr_prd_cd", "ord_dt", "ord_time")
              .agg(F.sum("tot_ord_qty").alias("tot_ord_qty")))
    window = broadcast_products(src, scope).withColumn(
        "last_ord_dt", day_after(F.col("broad_dt"), scope.numeric_day_window))
    return (orders.join(window, ["pgm_id", "prd_cd"])
            .where((F.col("ord_dt") >= F.col("broad_dt")) & (F.col("ord_dt") <= F.col("last_ord_dt")))
            # broad_dt is fixed per broadcast: a grouping key, not a max(string), so the
            # aggregation stays a hash aggregation (a string buffer forces a sort-based one).
            .groupBy("pgm_id", "chanl_cd", "attr_prd_cd", "ord_dt", "ord_time", "broad_dt")
            .agg(F.max("prd_cd").alias("prd_cd"),
                 F.sum("tot_ord_qty").alias("tot_ord_qty"))
            .withColumn("is_live", F.col("chanl_cd") == LIVE_CHANNEL))


MINUTE_ORDER_COLUMNS = ("pgm_id", "prd_cd", "chanl_cd", "attr_prd_cd", "ord_dt", "ord_time", "tot_ord_qty")


def low_order_filter(minutes: DataFrame, threshold: int = LOW_ORDER_THRESHOLD) -> DataFrame:
    """Keep the minute orders of broadcasts whose total on-air units reach ``threshold``
    (optional; the daily job does not apply it). Partial sums per broadcast, then a
    semi-join, so no broadcast's rows are gathered in one place."""
    kept = (minutes.groupBy("pgm_id").agg(F.sum("tot_ord_qty").alias("pgm_qty"))
            .where(F.col("pgm_qty") >= threshold).select("pgm_id"))
    return minutes.join(kept, "pgm_id", "left_semi")
