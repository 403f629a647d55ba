"""Registered queries: one per operator group of the survey's catalogue.

Each entry takes ``(spark, sf_dir)``, derives the nine source tables from the test tables
in ``sf_dir`` and runs over all broadcast days and both channels (no sampling, no subsets).
"""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout import schemas
from stockout.functions import month_days_of
from stockout.operators import orders as order_ops
from stockout.operators import report as report_ops
from stockout.operators import snapshot as snapshot_ops
from stockout.operators import soldout as soldout_ops
from stockout.operators.airings import AiringState
from stockout.operators.grid import GRID_COLUMNS, GROUP
from stockout.operators.impute import ImputeSettings, held_out_error
from stockout.operators.present import to_display_names
from stockout.operators.scope import LIVE_CHANNEL, Scope
from stockout.plans.backfill import backfill
from stockout.plans.daily import DailyRun
from stockout.sinks import (ALL_DAYS, ResultStore, load_days, load_report, load_snapshot, output_root,
                            write_snapshot)
from stockout.sinks.store import REPORT, SNAPSHOT
from stockout.sources import from_testdata
from stockout.sources.statements import MINUTE_ORDERS, REPORT_BASE, read_sql
from stockout.stage import write_stage

_DECIMAL_COLUMNS = ("net_ord_amt", "sup_shr_net_ord_dc_amt", "net_ord_naccm_sale_amt", "tot_ord_amt",
                    "sup_shr_tot_ord_dc_amt", "cmm_cpn_dc_amt", "naccm_sale_subtr_apply_rt",
                    "tot_ord_naccm_sale_amt", "chg_rt")


def _run(spark: SparkSession, sf_dir: str, materialize: bool = False, grid: bool = False,
         report: bool = False, method: str = "ridge") -> DailyRun:
    """A run over every day and channel of the test data. ``materialize`` writes the shared
    stages once (for the queries that read several of them); ``grid`` / ``report`` write the
    independent base stages those queries need side by side first."""
    run = DailyRun(from_testdata(spark, sf_dir), materialize=materialize, impute_settings=ImputeSettings(method=method))
    return run.prepare(grid=grid, report=report) if (grid or report) else run


def minute_orders(spark, sf_dir):
    return _run(spark, sf_dir).minutes.select(*order_ops.MINUTE_ORDER_COLUMNS)


def low_order_filter(spark, sf_dir):
    return order_ops.low_order_filter(_run(spark, sf_dir).minutes).select(*order_ops.MINUTE_ORDER_COLUMNS)


def broadcast_sequence(spark, sf_dir):
    return _run(spark, sf_dir).pgm.drop("is_live")


def product_attributes(spark, sf_dir):
    return _run(spark, sf_dir).products.withColumn("fst_prd_sale_prc", F.col("fst_prd_sale_prc").cast("double"))


def product_attr_info(spark, sf_dir):
    return report_ops.product_attr_info(_run(spark, sf_dir).products)


def exposure_minutes(spark, sf_dir):
    run = _run(spark, sf_dir)
    return (report_ops.exposure_minutes(run.src, run.pgm)
            .withColumns({"weiht_minutes": F.round(F.col("weiht_mi") / 60).cast("bigint"),
                          "expos_minutes": F.round(F.col("expos_mi") / 60).cast("bigint")}))


def supply_by_attr(spark, sf_dir):
    run = _run(spark, sf_dir)
    return report_ops.supply_by_attr(run.src, run.pgm)


def order_base(spark, sf_dir):
    base = _run(spark, sf_dir).order_base
    return base.select("pgm_id", "prd_cd", "attr_prd_cd", "tot_ord_qty", "net_ord_amt", "sup_shr_net_ord_dc_amt",
                       "net_ord_qty", "net_ord_naccm_sale_amt", "tot_ord_amt", "sup_shr_tot_ord_dc_amt",
                       "cmm_cpn_dc_amt", "naccm_sale_subtr_apply_rt", "tot_ord_naccm_sale_amt", "chg_rt",
                       "broad_rlrslt_gbn_cd", "ord_dt", "ord_time", "broad_ord_time_dtl_cd"
                       ).withColumns({c: F.col(c).cast("double") for c in _DECIMAL_COLUMNS})


def order_revenue(spark, sf_dir):
    rev = report_ops.order_revenue(_run(spark, sf_dir).order_totals)
    return rev.withColumns({c: F.col(c).cast("double")
                            for c in ("chg_rt", "tot_ord_amt", "net_ord_amt", "expct_sal_amt")})


def preorder_since_3am(spark, sf_dir):
    qty = report_ops.option_quantities(_run(spark, sf_dir).order_totals)
    return qty.select("pgm_id", "attr_prd_cd", F.col("ord_prd_cd").alias("prd_cd"), "pord_03_tot_ord_qty")


def onair_qty(spark, sf_dir):
    qty = report_ops.option_quantities(_run(spark, sf_dir).order_totals)
    return qty.where(F.col("n_onair_lines") > 0).select("pgm_id", "attr_prd_cd", "tot_ord_qty")


def first_broadcast(spark, sf_dir):
    run = _run(spark, sf_dir)
    return report_ops.first_broadcast(run.src, run.products)


def report_base(spark, sf_dir):
    return _run(spark, sf_dir, report=True).report_base.orderBy("pgm_id", "attr_prd_cd")


def order_grid(spark, sf_dir):
    return _run(spark, sf_dir, grid=True).grid.select(*GRID_COLUMNS)


def soldout_censored_grid(spark, sf_dir):
    return _run(spark, sf_dir, grid=True).censored.select(*GRID_COLUMNS, "is_censored", "sold_out_ts")


def soldout_time(spark, sf_dir):
    return _run(spark, sf_dir, grid=True).soldout_time


def soldout_snapshot(spark, sf_dir):
    return _run(spark, sf_dir, materialize=True, grid=True).snapshot


def first_soldout_value(spark, sf_dir):
    return snapshot_ops.first_soldout_value(_run(spark, sf_dir, materialize=True, grid=True).snapshot)


def train_set_profile(spark, sf_dir):
    return _run(spark, sf_dir, grid=True).train_profile


def demand_imputed(spark, sf_dir):
    return _run(spark, sf_dir, materialize=True, grid=True).imputed


def estimated_demand(spark, sf_dir):
    return _run(spark, sf_dir, materialize=True, grid=True).estimated


def observed_demand(spark, sf_dir):
    return soldout_ops.observed_demand(_run(spark, sf_dir, grid=True).censored)


def group_gate(spark, sf_dir):
    return _run(spark, sf_dir, grid=True).gate


def report_presentation(spark, sf_dir):
    return _run(spark, sf_dir, materialize=True, grid=True, report=True).report(with_estimate=False)


def final_report(spark, sf_dir):
    """The report as the daily job writes it, its estimates by stochastic gradient steps."""
    return _run(spark, sf_dir, materialize=True, grid=True, report=True, method="sgd").report(with_estimate=True)


def month_days(spark, sf_dir):
    return month_days_of(from_testdata(spark, sf_dir).broadcast)


def demand_sgd(spark, sf_dir):
    """The grid with units imputed by unbiased factors, fitted by stochastic gradient steps."""
    return _run(spark, sf_dir, materialize=True, grid=True, method="sgd").imputed


def demand_rank_one(spark, sf_dir):
    """The grid with units imputed by mean, biases and one factor in exact arithmetic."""
    return _run(spark, sf_dir, materialize=True, grid=True, method="rank_one").imputed


def estimated_demand_rank_one(spark, sf_dir):
    return _run(spark, sf_dir, materialize=True, grid=True, method="rank_one").estimated


def final_report_rank_one(spark, sf_dir):
    """The final report, its estimates by exact arithmetic."""
    return _run(spark, sf_dir, materialize=True, grid=True, report=True, method="rank_one").report(with_estimate=True)


def imputation_error(spark, sf_dir):
    """Per trainable group, the error of each method on observed cells held out."""
    return held_out_error(_run(spark, sf_dir, materialize=True, grid=True).censored)


def demand_sgd_contract(spark, sf_dir):
    return imputation_contract(spark, sf_dir, "sgd")


def imputation_contract(spark, sf_dir, method="ridge"):
    """What must hold of the imputed cells of every group, counted: observed cells kept, censored
    cells filled or left empty as the gates say, no value outside [0, largest observed] or not
    whole."""
    run = _run(spark, sf_dir, materialize=True, grid=True, method=method)
    cells = run.imputed.join(run.train_profile.select(*GROUP, "max_observed"), GROUP)
    censored, value = F.col("is_censored"), F.col("qty_imputed")
    outside = (value < 0) | (value > F.col("max_observed")) | (value != F.bround(value, 0))
    count = lambda condition: F.count(F.when(condition, 1))
    return cells.groupBy(*GROUP).agg(
        F.count("*").alias("n_cells"), count(~censored & (value == F.col("qty"))).alias("n_kept"),
        count(censored & value.isNotNull()).alias("n_filled"), count(censored & value.isNull()).alias("n_empty"),
        count(censored & outside).alias("n_outside"))


def final_report_without_estimate(spark, sf_dir):
    """Every column of the final report but the estimate."""
    run = _run(spark, sf_dir, materialize=True, grid=True, report=True)
    return run.report(with_estimate=True).drop(schemas.REPORT_COLUMN_NAMES["estim_qty"])


def soldout_time_one_day(spark, sf_dir):
    """A run bound to one day and one channel."""
    run = DailyRun(from_testdata(spark, sf_dir), Scope(days=("19960101",), channels=(LIVE_CHANNEL,)))
    return run.prepare(grid=True).soldout_time


def report_load_roundtrip(spark, sf_dir):
    """Load both tables for all days, reload one day, read the report back under its display names."""
    run = _run(spark, sf_dir, materialize=True, grid=True, report=True)
    report = write_stage(run.report(with_estimate=False, display_names=False), "roundtrip_report")
    snapshot = write_stage(run.snapshot.drop("prd_cd"), "roundtrip_snapshot")
    root = f"{output_root(spark)}/roundtrip-{uuid.uuid4().hex}"
    paths = (f"{root}/soldout_report", f"{root}/soldout_snapshot")
    load_days(report, snapshot, *paths, ALL_DAYS)
    day = F.col("broad_dt") == "19960101"
    load_days(report.where(day), snapshot.where(day), *paths, ("19960101",))
    back = load_report(spark, paths[0])
    return to_display_names(back.select(*[F.col(c).cast(report.schema[c].dataType) for c in report.columns]))


def daily_load_roundtrip(spark, sf_dir):
    """Write every day's snapshot, rewrite the same days again (idempotent reload), read back."""
    run = _run(spark, sf_dir, materialize=True, grid=True)
    snap = write_stage(run.snapshot.drop("prd_cd"), "roundtrip_snapshot")
    path = f"{output_root(spark)}/roundtrip-{uuid.uuid4().hex}/soldout_snapshot"
    write_snapshot(snap, path)
    write_snapshot(snap, path)
    return load_snapshot(spark, path)


def _loaded_store(spark, sf_dir, store=ResultStore):
    """Both tables of all days, written once, and a store that holds them as its first version."""
    run = _run(spark, sf_dir, materialize=True, grid=True, report=True)
    report = write_stage(run.report(with_estimate=False, display_names=False), "roundtrip_report")
    snapshot = write_stage(run.snapshot.drop("prd_cd"), "roundtrip_snapshot")
    store = store(spark, f"{output_root(spark)}/store-{uuid.uuid4().hex}")
    store.load(report, snapshot, ALL_DAYS)
    return report, snapshot, store


class _BreaksOnce(ResultStore):
    """Fails at the second table's write when told to."""

    broken = False

    def _write(self, rows, table, load, found):
        if self.broken and table == SNAPSHOT:
            raise OSError("injected")
        return super()._write(rows, table, load, found)


def versioned_load_roundtrip(spark, sf_dir):
    """Load all days; fail in the middle of reloading the first one; reload it; read the first version
    again. Per step, table and day: rows and units."""
    report, snapshot, store = _loaded_store(spark, sf_dir, _BreaksOnce)
    first = min(store.manifest().tables[REPORT])
    day = F.col("broad_dt") == first
    some = report.where(day & (F.col("attr_prd_cd") % 2 == 0))
    more = lambda n: snapshot.where(day).withColumn("value", F.col("value") + n)
    seen = []

    def look(step, version=None):
        for name, rows, units in ((REPORT, store.report(version), "tot_ord_qty"), (SNAPSHOT, store.snapshot(version), "value")):
            seen.append(rows.groupBy("broad_dt").agg(F.count("*").alias("n_rows"), F.sum(units).cast("long").alias("units"))
                        .select(F.lit(step).alias("step"), F.lit(name).alias("tbl"), "broad_dt", "n_rows", "units"))

    look("loaded")
    store.broken = True
    try:
        store.load(some, more(100), (first,))
    except OSError:
        look("failed")
    store.broken = False
    store.load(some, more(1), (first,))
    look("reloaded")
    look("first version", 1)
    out = seen[0]
    for frame in seen[1:]:
        out = out.unionByName(frame)
    return out


def target_key_check(spark, sf_dir):
    """Keys of a batch (the first day's rows under a new day, and as many new keys) that stored days
    hold already, found through the days' key filters."""
    report, _, store = _loaded_store(spark, sf_dir)
    first = min(store.manifest().tables[REPORT])
    batch = report.where(F.col("broad_dt") == first).withColumn("broad_dt", F.lit("99991231"))
    new = batch.withColumn("attr_prd_cd", -F.col("attr_prd_cd") - 1)
    return store.clashing_keys(batch.unionByName(new)).select("pgm_id", "attr_prd_cd", "broad_dt")


def backfill_changes(spark, sf_dir):
    """Load the first two days; again; again after every on-air line of the second has one unit more.
    Per step and day: whether it was computed, and its units in the store."""
    src = from_testdata(spark, sf_dir)
    store = ResultStore(spark, f"{output_root(spark)}/store-{uuid.uuid4().hex}")
    days = tuple(r["broad_dt"] for r in src.broadcast.select("broad_dt").distinct().orderBy("broad_dt").limit(2).collect())
    more = F.col("tot_ord_qty") + F.when((F.substring("ord_dt", 1, 4) == days[-1][:4]) & (F.col("broad_ord_time_dtl_cd") == "O1"), 1).otherwise(0)
    changed = replace(src, order_fact=src.order_fact.withColumn("tot_ord_qty", more))
    out = None
    for step, sources in (("first", src), ("again", src), ("changed", changed)):
        done = backfill(sources, store, days, ImputeSettings(method="rank_one"))
        rows = (store.report(store.manifest().version).groupBy("broad_dt").agg(F.sum("tot_ord_qty").cast("long").alias("units"))
                .select(F.lit(step).alias("step"), "broad_dt", F.col("broad_dt").isin(*done.computed, "").alias("computed"), "units"))
        out = rows if out is None else out.unionByName(rows)
    return out


def load_audit(spark, sf_dir):
    """What became of every group, as the store keeps it."""
    run = _run(spark, sf_dir, materialize=True, grid=True, report=True)
    store = ResultStore(spark, f"{output_root(spark)}/store-{uuid.uuid4().hex}")
    store.load(run.report(with_estimate=False, display_names=False), run.snapshot.drop("prd_cd"), ALL_DAYS, audit=run.audit)
    return store.audit()


def load_metrics(spark, sf_dir):
    """Rows and nulls of both tables, counted while they were written."""
    store = _loaded_store(spark, sf_dir)[2]
    rows = [(t, k, v) for t, found in store.manifest().metrics.items() for k, v in found.items()]
    return spark.createDataFrame(rows, "tbl string, metric string, value long").where(
        F.col("metric").isin("rows", "null_sold_out_dtm", "null_chg_rt", "null_size_str", "null_value"))


def minute_orders_sql(spark, sf_dir):
    """Minute orders by SQL text with bound arguments."""
    return read_sql(spark, from_testdata(spark, sf_dir), MINUTE_ORDERS)


def report_base_sql(spark, sf_dir):
    """The report base by SQL text with bound arguments."""
    return read_sql(spark, from_testdata(spark, sf_dir), REPORT_BASE)


def airing_state(spark, sf_dir):
    """Airings numbered from kept state: the second day is loaded before the first, then the others, then
    the second again; days that a load renumbers are read anew."""
    src = from_testdata(spark, sf_dir)
    state = AiringState(spark, f"{output_root(spark)}/airings-{uuid.uuid4().hex}")
    days = [r["broad_dt"] for r in src.broadcast.select("broad_dt").distinct().orderBy("broad_dt").collect()]
    found = {}
    for day in [*days[1:2], *days[:1], *days[2:], *days[1:2]]:
        done = state.load(src, day)
        found[day] = done.numbered
        for other in done.renumbered:
            found[other] = state.number(src, other)
    out = None
    for rows in found.values():
        out = rows if out is None else out.unionByName(rows)
    return out.select("pgm_id", "prd_cd", "chanl_cd", "broad_seq", "first_dt")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: fn for name, fn in [
        ("minute_orders", minute_orders), ("low_order_filter", low_order_filter),
        ("broadcast_sequence", broadcast_sequence), ("product_attributes", product_attributes),
        ("product_attr_info", product_attr_info), ("exposure_minutes", exposure_minutes),
        ("supply_by_attr", supply_by_attr), ("order_base", order_base), ("order_revenue", order_revenue),
        ("preorder_since_3am", preorder_since_3am), ("onair_qty", onair_qty),
        ("first_broadcast", first_broadcast), ("report_base", report_base), ("order_grid", order_grid),
        ("soldout_censored_grid", soldout_censored_grid), ("soldout_time", soldout_time),
        ("soldout_snapshot", soldout_snapshot), ("first_soldout_value", first_soldout_value),
        ("train_set_profile", train_set_profile), ("demand_imputed", demand_imputed),
        ("estimated_demand", estimated_demand), ("observed_demand", observed_demand),
        ("group_gate", group_gate), ("report_presentation", report_presentation),
        ("final_report", final_report), ("month_days", month_days),
        ("daily_load_roundtrip", daily_load_roundtrip), ("imputation_contract", imputation_contract),
        ("final_report_without_estimate", final_report_without_estimate),
        ("soldout_time_one_day", soldout_time_one_day), ("report_load_roundtrip", report_load_roundtrip),
        ("demand_sgd", demand_sgd), ("demand_sgd_contract", demand_sgd_contract),
        ("demand_rank_one", demand_rank_one), ("estimated_demand_rank_one", estimated_demand_rank_one),
        ("final_report_rank_one", final_report_rank_one), ("imputation_error", imputation_error),
        ("versioned_load_roundtrip", versioned_load_roundtrip), ("target_key_check", target_key_check),
        ("backfill_changes", backfill_changes), ("load_audit", load_audit), ("load_metrics", load_metrics),
        ("minute_orders_sql", minute_orders_sql), ("report_base_sql", report_base_sql),
        ("airing_state", airing_state),
    ]
}
