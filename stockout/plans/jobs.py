"""The daily job and its backfill: compute a set of days and load both result tables.

``run_days`` replaces exactly the days it was asked for in the report and the snapshot tables,
those that come out empty included; both channels of a day are in the same write. A month
backfill is one run over the month's days, not one run per day.

    python -m stockout.plans.jobs --sources /lake/warehouse --output /lake/results --day 20160808
    python -m stockout.plans.jobs --sources /lake/warehouse --output /lake/results --month 2016-08
    python -m stockout.plans.jobs --sources /lake/warehouse --store /lake/store --month 2016-08

With ``--store`` the tables lie behind one manifest (``sinks.store``), and only days whose sources have
changed since they were loaded are computed (``plans.backfill``).
"""

from __future__ import annotations

import argparse
import calendar
import datetime as dt

from pyspark.sql import SparkSession

from stockout.operators.impute import METHODS, ImputeSettings
from stockout.operators.scope import Scope
from stockout.plans.backfill import backfill
from stockout.plans.daily import DailyRun
from stockout.session import SESSION_CONF, ensure_checkpoint_dir, ship_package
from stockout.sinks import ALL_DAYS, ResultStore, load_days
from stockout.sources import Sources, read_parquet_root
from stockout.stage import drop_run


def run_days(src: Sources, days: list[str] | tuple[str, ...] | None = None, *,
             report_path: str | None = None, snapshot_path: str | None = None,
             settings: ImputeSettings | None = None, numeric_day_window: bool = False) -> tuple[str, str]:
    """Compute ``days`` ('YYYYMMDD'; None = every day in the sources) and load them. Estimates are by
    stochastic gradient steps unless ``settings`` say otherwise."""
    settings = settings or ImputeSettings(method="sgd")
    scope = Scope(days=tuple(days) if days else None, numeric_day_window=numeric_day_window)
    run = DailyRun(src, scope, materialize=True, impute_settings=settings)
    try:
        report = run.report(with_estimate=True, display_names=False)
        return load_days(report, run.snapshot.drop("prd_cd"), report_path, snapshot_path,
                         tuple(days) if days else ALL_DAYS)
    finally:
        drop_run(src.broadcast.sparkSession, run.run_tag)


def month_day_list(year: int, month: int) -> list[str]:
    """The days of a month as 'YYYYMMDD' (at most 31 strings: run parameters, not data)."""
    last = calendar.monthrange(year, month)[1]
    return [dt.date(year, month, d).strftime("%Y%m%d") for d in range(1, last + 1)]


def run_month(src: Sources, year: int, month: int, **kwargs) -> tuple[str, str]:
    return run_days(src, month_day_list(year, month), **kwargs)


def run_yesterday(src: Sources, today: dt.date | None = None, **kwargs) -> tuple[str, str]:
    day = (today or dt.date.today()) - dt.timedelta(days=1)
    return run_days(src, [day.strftime("%Y%m%d")], **kwargs)


def _asked(args: argparse.Namespace) -> tuple[str, ...] | None:
    """The days that the arguments name; None for all."""
    if args.month:
        return tuple(month_day_list(*(int(x) for x in args.month.split("-"))))
    if args.yesterday:
        return ((dt.date.today() - dt.timedelta(days=1)).strftime("%Y%m%d"),)
    return tuple(args.day) if args.day else None


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter)
    parser.add_argument("--sources", required=True, help="folder with the nine source tables as parquet")
    where = parser.add_mutually_exclusive_group(required=True)
    where.add_argument("--output", help="shared folder of the two result tables, by day")
    where.add_argument("--store", help="shared folder of a result store")
    parser.add_argument("--stage-dir", help="shared folder of stages, unless spark.checkpoint.dir names one")
    parser.add_argument("--imputation", choices=METHODS, default="sgd", help="how demand is estimated")
    when = parser.add_mutually_exclusive_group(required=True)
    when.add_argument("--day", action="append", help="broadcast day YYYYMMDD (repeatable)")
    when.add_argument("--month", help="YYYY-MM: every day of the month")
    when.add_argument("--yesterday", action="store_true")
    when.add_argument("--all", action="store_true", help="every day in the sources; replaces both tables")
    args = parser.parse_args(argv)
    builder = SparkSession.builder.appName("stockout-daily")
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    if args.stage_dir and not spark.conf.get("spark.checkpoint.dir", None):
        spark.sparkContext.setCheckpointDir(args.stage_dir)
    ensure_checkpoint_dir(spark)
    ship_package(spark)
    src = read_parquet_root(spark, args.sources)
    if args.store:
        done = backfill(src, ResultStore(spark, args.store), _asked(args), ImputeSettings(method=args.imputation))
        print("computed:", *done.computed, "unchanged:", *done.kept, "version:", done.version)
        return
    output = args.output.rstrip("/")
    paths = {"report_path": f"{output}/soldout_report", "snapshot_path": f"{output}/soldout_snapshot",
             "settings": ImputeSettings(method=args.imputation)}
    if args.month:
        year, month = (int(x) for x in args.month.split("-"))
        out = run_month(src, year, month, **paths)
    elif args.yesterday:
        out = run_yesterday(src, **paths)
    else:
        out = run_days(src, args.day, **paths)
    print("report:", out[0], "snapshot:", out[1])


if __name__ == "__main__":
    main()
