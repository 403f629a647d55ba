"""Sold-out detection on the grid and censoring of the cells from the sold-out minute on.

Per option, minutes in order, ``cum`` = running units, ``total`` = all units, ``s`` = supply:

1. ``total >= s`` (either channel): among minutes with ``cum <= s``, the first minute at
   which ``cum`` reaches its largest value; if no minute has ``cum <= s``, the first minute
   at which ``cum`` is smallest.
2. otherwise, live broadcasts only, ``total > ceil(0.9 s)``: over the minutes whose ``cum``
   is at least that buffer, the first one whose own and next two increments (increments
   between consecutive buffer minutes, the first buffer minute has none) add up to 0.
3. otherwise no sell-out.

The sold-out minute itself and every later minute are censored. Options without supply
(none listed, or 0) pass through untouched.

All windows are partitioned by the option (a superset of the group key the grid is
already hash-partitioned on), so no shuffle is added, only local sorts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockout.operators.grid import GROUP, OPTION

# Fixed values of the rule: buffer share of supply and the flat-run length in minutes.
BUFFER_SHARE = 0.9
BUFFER_RUN = 3


def censor(grid: DataFrame) -> DataFrame:
    """Add ``sold_out_ts`` (per option, null when none) and ``is_censored`` to the grid."""
    by_option = Window.partitionBy(*OPTION)
    running = by_option.orderBy("ord_ts").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    supply = F.col("supply")
    buffer = F.ceil(supply.cast("double") * F.lit(BUFFER_SHARE))

    step1 = grid.withColumns({
        "cum": F.sum("qty").over(running),
        "total": F.sum("qty").over(by_option),
        "buffer": buffer,
    })
    step2 = step1.withColumns({
        "best": F.max(F.when(F.col("cum") <= supply, F.col("cum"))).over(by_option),
        "lowest": F.min("cum").over(by_option),
        "in_buffer": F.col("cum") >= F.col("buffer"),
    })
    # Increments between consecutive in-buffer minutes telescope: the sum of the increments
    # at rows k, k+1, k+2 of the buffer minutes is cum[k+2] - cum[k-1].
    in_buffer = Window.partitionBy(*OPTION, "in_buffer").orderBy("ord_ts")
    step3 = step2.withColumns({
        "before": F.lag("cum", 1).over(in_buffer),
        "after": F.lead("cum", BUFFER_RUN - 1).over(in_buffer),
    })
    flat = (F.col("in_buffer") & F.col("before").isNotNull() & F.col("after").isNotNull()
            & (F.col("after") == F.col("before")))
    target = F.coalesce(F.col("best"), F.col("lowest"))
    step4 = step3.withColumns({
        "hard_ts": F.min(F.when(F.col("cum") == target, F.col("ord_ts"))).over(by_option),
        "flat_ts": F.min(F.when(flat, F.col("ord_ts"))).over(by_option),
    })
    has_supply = supply.isNotNull() & (supply != 0)
    sold_out_ts = (F.when(~has_supply, F.lit(None))
                   .when(F.col("total") >= supply, F.col("hard_ts"))
                   .when(F.col("is_live") & (F.col("total") > F.col("buffer")), F.col("flat_ts")))
    return (step4.withColumn("sold_out_ts", sold_out_ts.cast("timestamp_ntz"))
            .withColumn("is_censored", F.coalesce(F.col("ord_ts") >= F.col("sold_out_ts"), F.lit(False)))
            .drop("cum", "total", "buffer", "best", "lowest", "in_buffer", "before", "after",
                  "hard_ts", "flat_ts"))


def soldout_time(censored: DataFrame) -> DataFrame:
    """Per option: units sold, first censored minute and the 0/1 sold-out flag."""
    return (censored.groupBy(*OPTION)
            .agg(F.sum("qty").alias("total_qty"),
                 F.min(F.when(F.col("is_censored"), F.col("ord_ts"))).alias("sold_out_dtm"))
            .withColumn("sold_out_flag", F.col("sold_out_dtm").isNotNull().cast("int")))


def observed_demand(censored: DataFrame) -> DataFrame:
    """Per option: units over the uncensored cells only (what remains without imputation)."""
    return (censored.groupBy(*OPTION)
            .agg(F.sum(F.when(~F.col("is_censored"), F.col("qty"))).alias("observed_qty"),
                 F.count(F.when(F.col("is_censored"), 1)).alias("n_censored")))


__all__ = ["censor", "soldout_time", "observed_demand", "GROUP", "OPTION"]
