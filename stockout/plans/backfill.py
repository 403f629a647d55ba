"""Backfills that compute only what changed, and pick up where a broken run stopped.

Every day's fingerprint is a digest of what its report is computed from: the order lines of the day
and the next, the broadcasts of the day and all before it (they number the airings) with their
products, the day's supply and exposure rows, the product catalogue, and the settings. The store keeps
the fingerprint with each loaded day; a day whose fingerprint is the stored one is not computed.

The days left are one run. Its stages are written under a tag that follows from their
fingerprints, and are dropped when the load is committed: if the run breaks, the next one with
the same sources reads the stages that were finished.
"""

from __future__ import annotations

import hashlib
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockout.functions import day_after
from stockout.operators.impute import ImputeSettings
from stockout.operators.scope import Scope
from stockout.plans.daily import DailyRun
from stockout.sinks import ResultStore
from stockout.sources import Sources
from stockout.stage import drop_run


@dataclass(frozen=True)
class Backfill:
    """What a backfill did: days computed, days left as they were, and the version it made (None: none)."""

    computed: tuple[str, ...]
    kept: tuple[str, ...]
    version: int | None


def _digest(rows: DataFrame, by: list[str]) -> DataFrame:
    """Rows and the sum of their hashes (in whatever order they come) by ``by``."""
    own = sorted(c for c in rows.columns if c not in by)
    hashed = F.xxhash64(*[F.coalesce(F.col(c).cast("string"), F.lit("\\0")) for c in own]).cast("decimal(38,0)")
    return (rows.groupBy(*by).agg(F.count("*").alias("n"), F.sum(hashed).alias("h"))
            .select(*by, "n", "h"))


def source_fingerprints(src: Sources, days: tuple[str, ...] | None = None, settings: ImputeSettings | None = None,
                        numeric_day_window: bool = False) -> dict[str, str]:
    """Fingerprint by broadcast day, for the days that have broadcasts (``days``: of these)."""
    scope = Scope(days=days, numeric_day_window=numeric_day_window)
    run = scope.broadcasts(src.broadcast)
    lines = src.order_fact
    if (bounds := scope.order_day_bounds()) is not None:
        lines = lines.where(F.col("ord_dt").between(*bounds))
    of_run = run.select("pgm_id", "broad_dt")
    dates = run.select("broad_dt").distinct()
    # A line counts for its own day and for the day before it.
    window = dates.select("broad_dt", F.explode(F.array("broad_dt", day_after(F.col("broad_dt"), numeric_day_window))).alias("ord_dt"))
    ordered = (window.join(_digest(lines, ["ord_dt"]), "ord_dt", "left")
               .groupBy("broad_dt").agg(F.sum("n").alias("n_lines"), F.sum("h").alias("h_lines"),
                                        F.sum(F.when(F.col("ord_dt") == F.col("broad_dt"), F.col("h"))).alias("h_own")))
    listed = src.broadcast.join(src.broadcast_product.withColumnRenamed("chanl_cd", "listed_chanl_cd"), "pgm_id", "left")
    upto = Window.orderBy("broad_dt").rowsBetween(Window.unboundedPreceding, Window.currentRow)  # one row a day
    aired = _digest(listed, ["broad_dt"]).select("broad_dt", F.sum("n").over(upto).alias("n_aired"), F.sum("h").over(upto).alias("h_aired"))
    out = ordered.join(aired, "broad_dt")
    plans = src.supply_plan.join(src.supply_appointment.withColumnRenamed("prd_cd", "for_prd_cd"), "suply_plan_mng_no", "left")
    for name, rows in (("plans", plans), ("minutes", src.target_minutes)):
        own = _digest(rows.join(of_run, "pgm_id"), ["broad_dt"]).select("broad_dt", F.col("n").alias(f"n_{name}"), F.col("h").alias(f"h_{name}"))
        out = out.join(own, "broad_dt", "left")
    catalogue = "|".join(str(tuple(_digest(t, []).first())) for t in (src.product, src.attr_product, src.item))
    fixed = hashlib.sha256(f"{catalogue}|{asdict(settings or ImputeSettings())}|{numeric_day_window}".encode()).hexdigest()
    columns = [c for c in out.columns if c != "broad_dt"]
    joined = F.concat_ws("|", F.lit(fixed), *[F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns])
    return {r["broad_dt"]: r["f"] for r in out.select("broad_dt", F.sha2(joined, 256).alias("f")).collect()}  # one row a day


def backfill(src: Sources, store: ResultStore, days: tuple[str, ...] | None = None, settings: ImputeSettings | None = None,
             numeric_day_window: bool = False) -> Backfill:
    """Bring ``days`` (None: every day with broadcasts) of the store up to date. Days that have no
    broadcasts any more lose their rows."""
    settings = settings or ImputeSettings(method="sgd")
    now = source_fingerprints(src, days, settings, numeric_day_window)
    stored = store.manifest().fingerprints
    asked = set(days) if days is not None else set(now) | set(stored)
    todo = sorted(d for d in asked if now.get(d) != stored.get(d))
    kept = tuple(sorted(asked - set(todo)))
    if not todo:
        return Backfill((), kept, None)
    # Changed and vanished days alike belong to the tag.
    tag = hashlib.sha256("|".join(f"{d}:{now.get(d)}" for d in todo).encode()).hexdigest()[:32]
    run = DailyRun(src, Scope(days=tuple(todo), numeric_day_window=numeric_day_window), materialize=True,
                   impute_settings=settings, resume_tag=tag)
    version = store.load(run.report(with_estimate=True, display_names=False), run.snapshot.drop("prd_cd"), tuple(todo),
                         audit=run.audit, fingerprints={d: now[d] for d in todo if d in now}).version
    drop_run(src.broadcast.sparkSession, tag)
    return Backfill(tuple(todo), kept, version)
