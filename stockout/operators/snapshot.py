"""Snapshots: every option's running units at each sold-out event of its group.

The running total counts censored cells as 0, so an option freezes just before its own
sold-out minute. A group's events are its options' distinct sold-out minutes, where an
option that never sold out stands for the group's last minute; events are numbered from 1
in time. Built from windows over the grid (no join): a cell is an event cell when any
option of its group has its event at that cell's minute.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockout.operators.grid import GROUP, OPTION


def soldout_snapshot(censored: DataFrame) -> DataFrame:
    """``(pgm_id, prd_cd, soldout_seq, attr_prd_cd, value, broad_dt)``: one row per event x
    option of the group."""
    running = Window.partitionBy(*OPTION).orderBy("ord_ts").rowsBetween(Window.unboundedPreceding,
                                                                         Window.currentRow)
    with_cum = censored.withColumns({
        "value": F.sum(F.when(F.col("is_censored"), F.lit(0)).otherwise(F.col("qty"))).over(running),
        "last_ts": F.max("ord_ts").over(Window.partitionBy(*GROUP)),
    })
    event_ts = F.coalesce(F.col("sold_out_ts"), F.col("last_ts"))
    at_minute = Window.partitionBy(*GROUP, "ord_ts")
    events = (with_cum
              .withColumn("is_event", F.max(event_ts == F.col("ord_ts")).over(at_minute))
              .where(F.col("is_event")))
    seq = F.dense_rank().over(Window.partitionBy(*GROUP).orderBy("ord_ts")).cast("int")
    return events.select(*GROUP, seq.alias("soldout_seq"), "attr_prd_cd",
                         F.col("value").cast("bigint").alias("value"), "broad_dt")


def first_soldout_value(snapshot: DataFrame) -> DataFrame:
    """Per option: its running units at the group's first event (the report's VALUE)."""
    return snapshot.where(F.col("soldout_seq") == 1).select(*GROUP, "attr_prd_cd", "value")
