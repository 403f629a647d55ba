"""Day and minute arithmetic on the warehouse's 'YYYYMMDD' / 'HHMI' strings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def parse_minute(ord_dt: Column, ord_time: Column) -> Column:
    """'YYYYMMDD' + 'HHMI' -> wall-clock minute (TIMESTAMP_NTZ, no zone attached)."""
    return F.to_timestamp_ntz(F.concat(ord_dt, ord_time), F.lit("yyyyMMddHHmm"))


def day_after(broad_dt: Column, numeric: bool = False) -> Column:
    """The last order day counted for a broadcast day, as 'YYYYMMDD'.

    By default a real calendar day. ``numeric=True`` reproduces the warehouse query, which
    adds 1 to the day as a number (so 20160831 -> 20160832 and the next month's first day
    falls outside the window)."""
    if numeric:
        return (broad_dt.cast("bigint") + 1).cast("string")
    return F.date_format(F.date_add(F.to_date(broad_dt, "yyyyMMdd"), 1), "yyyyMMdd")


def month_days(spark: SparkSession, year: int, month: int) -> DataFrame:
    """All days of a month as 'YYYYMMDD' strings, one row each (backfill driver input)."""
    first = F.make_date(F.lit(year), F.lit(month), F.lit(1))
    return (spark.range(1)
            .select(F.explode(F.sequence(first, F.last_day(first))).alias("d"))
            .select(F.date_format("d", "yyyyMMdd").alias("broad_dt")))


def yesterday(today: Column | None = None) -> Column:
    """The day before ``today`` (default: the current date) as 'YYYYMMDD'."""
    base = F.current_date() if today is None else today
    return F.date_format(F.date_sub(base, 1), "yyyyMMdd")


def month_days_of(broadcast: DataFrame) -> DataFrame:
    """Every day of every month in which a broadcast aired: ``(broad_month, broad_dt)``.
    One row per month is expanded in place (explode of a date sequence), no join."""
    first = F.to_date(F.concat(F.col("broad_month"), F.lit("01")), "yyyyMMdd")
    return (broadcast.select(F.substring("broad_dt", 1, 6).alias("broad_month")).distinct()
            .select("broad_month", F.explode(F.sequence(first, F.last_day(first))).alias("d"))
            .select("broad_month", F.date_format("d", "yyyyMMdd").alias("broad_dt")))
