"""Plan properties the design relies on at scale (checked on the physical plan)."""

from helpers import make_grid
from conftest import SMOKE_DIR
from stockout.operators.grid import GROUP
from stockout.operators.orders import minute_orders
from stockout.operators.report import in_broadcast_days, line_minutes, option_totals
from stockout.operators.scope import Scope
from stockout.operators.snapshot import soldout_snapshot
from stockout.operators.soldout import censor
from stockout.sources import from_testdata


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _exchanges(df) -> int:
    return _plan(df).count("Exchange hashpartitioning")


def test_windows_reuse_the_group_partitioning(spark):
    grid = make_grid(spark, {1: (10, [4, 6, 0, 3]), 2: (100, [1, 1, 1, 1])}).repartition(*GROUP)
    base = _exchanges(grid)
    assert _exchanges(censor(grid)) == base
    assert _exchanges(soldout_snapshot(censor(grid))) == base


def test_day_run_prunes_fact_partitions_and_pushes_filters(spark):
    src = from_testdata(spark, SMOKE_DIR)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = _plan(minute_orders(src, Scope(days=("19980101",))))
    assert "PartitionFilters: [isnotnull(ord_dt" in plan and "19980102" in plan
    assert "EqualTo(broad_ord_time_dtl_cd,O1)" in plan and "GreaterThan(tot_ord_cust_no,0)" in plan


def test_fact_aggregation_is_hash_based(spark):
    src = from_testdata(spark, SMOKE_DIR)
    plan = _plan(minute_orders(src))
    assert "HashAggregate" in plan and "SortAggregate" not in plan


def test_one_scan_of_the_order_lines_feeds_grid_and_report(spark):
    """The lines are read once, summed before any shuffle, and both users of the sum read it as it lies."""
    from stockout.plans.daily import DailyRun

    src = from_testdata(spark, SMOKE_DIR)
    spark.conf.set("spark.sql.maxMetadataStringLength", "10000")
    summed = _plan(line_minutes(src))
    assert summed.count("FileScan") == 1 and summed.index("HashAggregate(keys=[pgm_id") < summed.index("Exchange")
    run = DailyRun(src, materialize=True).prepare(grid=True, report=True)
    for user in (minute_orders(run.src, run.scope, run.lines), option_totals(in_broadcast_days(run.lines, run.pgm))):
        plan = _plan(user)
        assert "order_fact" not in plan and "Bucketed: true" in plan
    # the summed lines are the larger side of the join and are not dealt out again
    joined = in_broadcast_days(run.lines, run.pgm)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert _exchanges(option_totals(joined)) == 1  # the broadcasts
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_censored_stage_serves_its_readers_without_a_shuffle(spark):
    from stockout.operators.impute import impute_demand, train_set_profile
    from stockout.plans.daily import DailyRun

    run = DailyRun(from_testdata(spark, SMOKE_DIR), materialize=True)
    for user in (impute_demand(run.censored), train_set_profile(run.censored), soldout_snapshot(run.censored)):
        assert _exchanges(user) == 0
