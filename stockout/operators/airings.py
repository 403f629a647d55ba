"""Numbering of airings from kept state instead of the whole history.

A broadcast is a product's n-th airing on a channel: the rank of its start among all distinct starts.
Ranking a day from the sources reads all history; here each loaded day leaves two small tables:

* ``starts``: its distinct (product, channel, start) and the day itself;
* ``head``: per (product, channel), as of the newest loaded day: airings so far, the last start,
  and the product's first day.

A day that lies behind all loaded ones, and whose starts do, is numbered by the head alone: airings
so far plus its own rank; nothing older is read. Loading a day again, or one in between, is a repair:
the starts of the products concerned are read, their head is counted anew, and the days
whose numbers have changed by it are named, so that their reports can be loaded again.

All state is parquet under one root, a folder per load, named by a manifest as the results are, so
a load that breaks leaves the state as it was.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockout.sources import Sources
from stockout.stage import read_note, write_note

SERIES = ["prd_cd", "chanl_cd"]
_STARTS = "prd_cd long, chanl_cd string, broad_str_dtm timestamp_ntz, broad_dt string"
_HEAD = "prd_cd long, chanl_cd string, n_airings long, last_start timestamp_ntz, first_dt string"


@dataclass(frozen=True)
class Airings:
    """What a load found: the day's rows with ``broad_seq`` and ``first_dt``; days loaded earlier whose
    numbers it changed; whether older starts had to be read."""

    numbered: DataFrame
    renumbered: tuple[str, ...]
    read_history: bool


def day_starts(src: Sources, day: str) -> DataFrame:
    """Broadcast x product x listed channel of a day with its start."""
    listed = src.broadcast_product.select("pgm_id", "prd_cd", "chanl_cd").distinct()
    aired = src.broadcast.where(F.col("broad_dt") == day).select("pgm_id", "broad_str_dtm", "broad_dt")
    return aired.join(listed, "pgm_id").select("pgm_id", *SERIES, "broad_str_dtm", "broad_dt")


class AiringState:
    """The state under ``root``, a folder that driver and executors share. One load at a time."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")

    def _state(self) -> dict:
        text = read_note(self.spark, f"{self.root}/state.json")
        return json.loads(text) if text else {"days": {}, "head": None}

    def days(self) -> list[str]:
        return sorted(self._state()["days"])

    def _starts(self, state: dict, but: str | None = None, only: str | None = None) -> DataFrame:
        paths = [f"{self.root}/starts/{load}" for day, load in sorted(state["days"].items())
                 if day != but and only in (None, day)]
        if not paths:
            return self.spark.createDataFrame([], _STARTS)
        return self.spark.read.schema(_STARTS).parquet(*paths)

    def _head(self, state: dict) -> DataFrame:
        if state["head"] is None:
            return self.spark.createDataFrame([], _HEAD)
        return self.spark.read.schema(_HEAD).parquet(f"{self.root}/head/{state['head']}")

    def load(self, src: Sources, day: str) -> Airings:
        """Number the airings of ``day`` and make it a part of the state, in place of what the state had
        of it."""
        state, load = self._state(), uuid.uuid4().hex
        rows = day_starts(src, day)
        own = f"{self.root}/starts/{load}"
        rows.select(*SERIES, "broad_str_dtm", "broad_dt").distinct().write.parquet(own)
        starts, head = self.spark.read.schema(_STARTS).parquet(own), self._head(state)
        behind = day > max(state["days"], default="") and starts.join(head, SERIES).where(
            F.col("broad_str_dtm") <= F.col("last_start")).isEmpty()
        if behind:
            numbered = self._numbered(rows, starts, head.select(*SERIES, F.col("n_airings").alias("n_before")), None)
            new_head = self._folded(head, starts)
        else:
            old = self._starts(state, only=day)
            touched = starts.select(*SERIES).unionByName(old.select(*SERIES)).distinct()
            others = self._starts(state, but=day).join(touched, SERIES, "left_semi")
            numbered = self._numbered(rows, starts, None, others)
            new_head = head.join(touched, SERIES, "left_anti").unionByName(self._counted(others.unionByName(starts)))
        new_head.write.parquet(f"{self.root}/head/{load}")
        new_head = self.spark.read.schema(_HEAD).parquet(f"{self.root}/head/{load}")
        first = new_head.groupBy("prd_cd").agg(F.min("first_dt").alias("first_dt"))
        renumbered = () if behind else self._renumbered(state, day, starts, old, others, head, first)
        write_note(self.spark, f"{self.root}/state.json", json.dumps({"days": {**state["days"], day: load}, "head": load}))
        return Airings(numbered.join(first, "prd_cd", "left"), renumbered, not behind)

    def number(self, src: Sources, day: str) -> DataFrame:
        """A loaded day's rows with the numbers that the state gives them now."""
        state = self._state()
        starts = self._starts(state, only=day)
        others = self._starts(state, but=day).join(starts.select(*SERIES).distinct(), SERIES, "left_semi")
        first = self._head(state).groupBy("prd_cd").agg(F.min("first_dt").alias("first_dt"))
        return self._numbered(day_starts(src, day), starts, None, others).join(first, "prd_cd", "left")

    def _numbered(self, rows: DataFrame, starts: DataFrame, before: DataFrame | None, others: DataFrame | None) -> DataFrame:
        own = starts.select(*SERIES, "broad_str_dtm", F.lit(True).alias("asked"))
        if others is not None:
            own = own.unionByName(others.select(*SERIES, "broad_str_dtm", F.lit(False).alias("asked")))
        rank = F.dense_rank().over(Window.partitionBy(*SERIES).orderBy("broad_str_dtm"))
        ranked = own.withColumn("place", rank).where("asked").select(*SERIES, "broad_str_dtm", "place").distinct()
        if before is not None:
            ranked = (ranked.join(before, SERIES, "left")
                      .withColumn("place", F.col("place") + F.coalesce("n_before", F.lit(0))).drop("n_before"))
        return rows.join(ranked.withColumn("broad_seq", F.col("place").cast("int")).drop("place"), [*SERIES, "broad_str_dtm"])

    @staticmethod
    def _counted(starts: DataFrame) -> DataFrame:
        """The head of the series in ``starts``."""
        return starts.groupBy(*SERIES).agg(F.count_distinct("broad_str_dtm").alias("n_airings"),
                                           F.max("broad_str_dtm").alias("last_start"), F.min("broad_dt").alias("first_dt"))

    def _folded(self, head: DataFrame, starts: DataFrame) -> DataFrame:
        """The head with the starts of a day that lies behind it."""
        day = self._counted(starts).select(*SERIES, *[F.col(c).alias(f"own_{c}") for c in ("n_airings", "last_start", "first_dt")])
        return head.join(day, SERIES, "full").select(
            *SERIES, (F.coalesce("n_airings", F.lit(0)) + F.coalesce("own_n_airings", F.lit(0))).alias("n_airings"),
            F.greatest("last_start", "own_last_start").alias("last_start"), F.least("first_dt", "own_first_dt").alias("first_dt"))

    def _renumbered(self, state: dict, day: str, starts: DataFrame, old: DataFrame, others: DataFrame, head: DataFrame,
                    first: DataFrame) -> tuple[str, ...]:
        """Other loaded days with a start behind one that came or went, or with a product whose first day
        is another now."""
        point = [*SERIES, "broad_str_dtm"]
        elsewhere = others.select(*point).distinct()  # a start that another day has too neither came nor went
        new, gone = (a.select(*point).join(b.select(*point), point, "left_anti").join(elsewhere, point, "left_anti")
                     .withColumns({"broad_dt": F.lit(None).cast("string"), "step": F.lit(s)}) for a, b, s in ((starts, old, 1), (old, starts, -1)))
        marked = others.withColumn("step", F.lit(0)).unionByName(new).unionByName(gone)
        shift = F.sum("step").over(Window.partitionBy(*SERIES).orderBy("broad_str_dtm").rangeBetween(
            Window.unboundedPreceding, Window.currentRow))
        moved = marked.withColumn("shift", shift).where((F.col("shift") != 0) & F.col("broad_dt").isNotNull()).select("broad_dt")
        before = head.groupBy("prd_cd").agg(F.min("first_dt").alias("was"))
        other_first = before.join(first, "prd_cd").where(F.col("was") != F.col("first_dt")).select("prd_cd")
        moved = moved.unionByName(self._starts(state, but=day).join(other_first, "prd_cd", "left_semi").select("broad_dt"))
        return tuple(sorted(r["broad_dt"] for r in moved.distinct().collect()))  # few strings: days
