"""End-to-end daily job on the smallest test data: load, reload, another day."""

import tempfile

from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from stockout.operators.impute import ImputeSettings
from stockout.plans.jobs import month_day_list, run_days
from stockout.sinks import load_report, load_snapshot
from stockout.sources import from_testdata

FAST = ImputeSettings(max_iter=4)


def test_daily_load_and_reload(spark):
    src = from_testdata(spark, SMOKE_DIR)
    root = tempfile.mkdtemp(prefix="stockout-job-")
    paths = {"report_path": f"{root}/report", "snapshot_path": f"{root}/snapshot", "settings": FAST}
    tables = {t.name for t in spark.catalog.listTables()}
    run_days(src, ["19960101"], **paths)
    assert {t.name for t in spark.catalog.listTables()} == tables  # its stages are gone
    first = load_report(spark, paths["report_path"]).count()
    snap = load_snapshot(spark, paths["snapshot_path"]).count()
    assert first > 0 and snap > 0
    run_days(src, ["19960101"], **paths)  # rerun the same day: replaced, not appended
    assert load_report(spark, paths["report_path"]).count() == first
    run_days(src, ["19970101"], **paths)  # another day: the first stays
    report = load_report(spark, paths["report_path"])
    assert report.where(F.col("broad_dt") == "19960101").count() == first
    assert report.where(F.col("broad_dt") == "19970101").count() > 0
    assert report.where(F.col("estim_qty").isNull()).count() == 0


def test_command_line_into_a_store(spark, capsys):
    from stockout.plans.jobs import main
    from stockout.sinks import ResultStore
    from stockout.sources.tables import write_parquet_root

    root = tempfile.mkdtemp(prefix="stockout-job-")
    write_parquet_root(from_testdata(spark, SMOKE_DIR), f"{root}/sources")
    args = ["--sources", f"{root}/sources", "--store", f"{root}/store", "--imputation", "rank_one"]
    main([*args, "--month", "1996-01"])
    assert "computed: 19960101" in capsys.readouterr().out
    main([*args, "--day", "19960101", "--day", "19970101"])
    assert "computed: 19970101 unchanged: 19960101 version: 2" in capsys.readouterr().out
    store = ResultStore(spark, f"{root}/store")
    assert {r["broad_dt"] for r in store.report().select("broad_dt").distinct().collect()} == {"19960101", "19970101"}
    assert store.report().where(F.col("estim_qty").isNull()).count() == 0


def test_day_scope_matches_all_days_slice(spark):
    """A one-day run gives the same sold-out minutes as that day's slice of the all-days run."""
    from stockout.operators.scope import Scope
    from stockout.plans.daily import DailyRun

    src = from_testdata(spark, SMOKE_DIR)
    one = DailyRun(src, Scope(days=("19980101",))).soldout_time
    all_days = DailyRun(src).soldout_time.where(F.col("pgm_id") == 1998)
    assert sorted(one.collect()) == sorted(all_days.collect())


def test_month_day_list():
    days = month_day_list(2016, 2)
    assert days[0] == "20160201" and days[-1] == "20160229" and len(days) == 29


def test_channel_scope_matches_all_channels_slice(spark):
    """A live-channel run equals the live broadcasts' slice of the both-channel run."""
    from stockout.operators.scope import Scope
    from stockout.plans.daily import DailyRun

    src = from_testdata(spark, SMOKE_DIR)
    live = DailyRun(src, Scope(channels=("C",))).soldout_time
    both = DailyRun(src).soldout_time.where(F.col("pgm_id") % 2 == 0)  # even years are live
    got = sorted(live.collect())
    assert got and got == sorted(both.collect())
