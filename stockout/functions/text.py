"""Presentation text: option detail columns and the broadcast time label."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Weekday labels, Sunday first (Spark's dayofweek 1..7 order).
WEEKDAY_LABELS = ("일", "월", "화", "수", "목", "금", "토")


def option_detail(whole_text: Column) -> tuple[Column, Column]:
    """Split the comma-joined option text: SIZE2 = third part, SIZE3 = parts four to the end
    joined by a space. Missing parts give NULL (per row, whatever the width)."""
    parts = F.split(whole_text, ",")
    size2 = F.get(parts, 2)
    rest = F.slice(parts, 4, F.greatest(F.size(parts) - 3, F.lit(1)))
    size3 = F.when(F.size(parts) >= 4, F.nullif(F.array_join(rest, " "), F.lit("")))
    return size2, size3


def broadcast_time_text(ts: Column) -> Column:
    """``MM/dd (요일) HH시`` for the broadcast start, with the weekday taken from a fixed
    table rather than from the JVM locale."""
    weekday = F.element_at(F.array(*[F.lit(w) for w in WEEKDAY_LABELS]), F.dayofweek(ts))
    return F.concat(F.date_format(ts, "MM/dd"), F.lit(" ("), weekday, F.lit(") "),
                    F.date_format(ts, "HH"), F.lit("시"))
