"""Small builders for hand-made grids."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import types as T

GRID_SCHEMA = T.StructType([
    T.StructField("pgm_id", T.LongType()), T.StructField("prd_cd", T.LongType()),
    T.StructField("attr_prd_cd", T.LongType()), T.StructField("ord_ts", T.TimestampNTZType()),
    T.StructField("qty", T.LongType()), T.StructField("supply", T.LongType()),
    T.StructField("is_live", T.BooleanType()), T.StructField("broad_dt", T.StringType()),
    T.StructField("passes", T.BooleanType()),
])

T0 = dt.datetime(2016, 8, 8, 21, 40)


def minute(i: int) -> dt.datetime:
    """m1 -> T0, m2 -> T0 + 1 minute, ..."""
    return T0 + dt.timedelta(minutes=i - 1)


def grid_rows(options: dict[int, tuple[int | None, list[int]]], live: bool = True, pgm: int = 1, prd: int = 1):
    """options: attr -> (supply, qty by minute)."""
    rows = []
    for attr, (supply, qtys) in options.items():
        for i, q in enumerate(qtys, start=1):
            rows.append((pgm, prd, attr, minute(i), q, supply, live, "20160808", True))
    return rows


def make_grid(spark, options, live=True, pgm=1, prd=1):
    return spark.createDataFrame(grid_rows(options, live, pgm, prd), GRID_SCHEMA)
