"""Backfills: only changed days are computed, broken runs go on from their finished stages."""

import os
import tempfile
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from conftest import SMOKE_DIR
from stockout.operators.impute import ImputeSettings
from stockout.plans.backfill import backfill, source_fingerprints
from stockout.session import ensure_checkpoint_dir
from stockout.sinks import ResultStore
from stockout.sources import from_testdata
from stockout.stage import write_stage

FAST = ImputeSettings(method="rank_one")
DAYS = ("19960101", "19970101", "19980101")


@pytest.fixture(scope="module")
def src(spark):
    return from_testdata(spark, SMOKE_DIR)


def changed(src, **tables):
    return replace(src, **tables)


def test_fingerprints_name_the_days_that_depend_on_a_change(src):
    base = source_fingerprints(src, DAYS, FAST)
    assert set(base) == set(DAYS) and base == source_fingerprints(src, DAYS[::-1], FAST)
    assert source_fingerprints(replace(src, order_fact=src.order_fact.repartition(7)), DAYS, FAST) == base

    def differ(**tables):
        now = source_fingerprints(replace(src, **tables), DAYS, FAST)
        return {d for d in DAYS if now.get(d) != base[d]}

    units = lambda day: F.col("tot_ord_qty") + F.when(F.col("ord_dt") == day, 1).otherwise(0)
    assert differ(order_fact=src.order_fact.withColumn("tot_ord_qty", units("19970101"))) == {"19970101"}
    assert differ(order_fact=src.order_fact.withColumn("ord_dt", F.when(F.col("ord_dt") == "19970103", "19970102").otherwise(F.col("ord_dt")))) \
        == {"19970101"}  # lines of the day after
    gone = src.broadcast.where("broad_dt <> '19970101'")
    assert differ(broadcast=gone) == {"19970101", "19980101"}  # later airings are numbered anew
    assert differ(product=src.product.withColumn("prd_nm", F.upper("prd_nm"))) == set(DAYS)
    assert differ(supply_plan=src.supply_plan.where("pgm_id <> 1996")) == {"19960101"}
    assert differ(target_minutes=src.target_minutes.where("pgm_id <> 1998")) == {"19980101"}
    other = source_fingerprints(src, DAYS, ImputeSettings(method="sgd"))
    assert all(other[d] != base[d] for d in DAYS)


def test_a_broken_backfill_goes_on_from_its_stages(spark, src, monkeypatch):
    store = ResultStore(spark, tempfile.mkdtemp(prefix="stockout-store-"))
    stages = os.path.join(ensure_checkpoint_dir(spark).removeprefix("file:"), "stages")
    before = set(os.listdir(stages)) if os.path.isdir(stages) else set()

    def kept():
        [folder] = [d for d in set(os.listdir(stages)) - before if os.path.exists(os.path.join(stages, d, "censored"))]
        return {n: os.stat(os.path.join(stages, folder, n)).st_ino for n in os.listdir(os.path.join(stages, folder))}

    real = ResultStore._commit
    with monkeypatch.context() as m:
        m.setattr(ResultStore, "_commit", lambda *a, **k: (_ for _ in ()).throw(OSError("injected")))
        with pytest.raises(OSError):
            backfill(src, store, DAYS[:2], FAST)
    first = kept()
    assert {"lines" not in first, "imputed" in first, "minutes" in first} == {True} and store.versions() == []
    for table in spark.catalog.listTables():  # as after a restart: the catalog has forgotten the stages
        if "_kept" in table.name:
            spark.sql(f"DROP TABLE {table.name}")
    with monkeypatch.context() as m:
        m.setattr(ResultStore, "_commit", lambda *a, **k: (_ for _ in ()).throw(OSError("injected")))
        with pytest.raises(OSError):
            backfill(src, store, DAYS[:2], FAST)
    assert kept() == first  # read, not written again
    assert ResultStore._commit is real
    done = backfill(src, store, DAYS[:2], FAST)
    assert done.computed == DAYS[:2] and done.version == 1
    clean = ResultStore(spark, tempfile.mkdtemp(prefix="stockout-store-"))
    backfill(src, clean, DAYS[:2], FAST)
    key = ["pgm_id", "prd_cd", "attr_prd_cd"]
    assert store.report().orderBy(key).collect() == clean.report().orderBy(key).collect()
    assert not [d for d in set(os.listdir(stages)) - before if os.path.exists(os.path.join(stages, d, "censored"))]

    # Nothing changed: nothing to do. One day gone: it loses its rows, a later one is numbered anew.
    assert backfill(src, store, DAYS[:2], FAST).computed == ()
    without = replace(src, broadcast=src.broadcast.where("broad_dt <> '19960101'"))
    assert backfill(without, store, DAYS[:2], FAST).computed == DAYS[:2]
    assert {r["broad_dt"] for r in store.report().select("broad_dt").distinct().collect()} == {"19970101"}
    assert store.audit().where("outcome = 'kept'").count() > 0 and set(store.manifest().fingerprints) == {"19970101"}
    assert store.manifest().metrics["soldout_report"]["rows"] == store.report().count()


def test_audit_names_every_group_that_is_left_out(spark, src):
    from stockout.operators.scope import Scope
    from stockout.plans.daily import DailyRun

    day = Scope(days=("19970101",))
    lines = src.order_fact
    first = lines.where("ord_dt = '19970101' and broad_ord_time_dtl_cd = 'O1' and tot_ord_cust_no > 0").orderBy("prd_cd").first()
    silent = lines.where("ord_dt = '19970101'").orderBy(F.col("prd_cd").desc()).first()["prd_cd"]
    stray = lines.where((F.col("prd_cd") == first["prd_cd"]) & (F.col("ord_dt") == "19970101")).withColumn("attr_prd_cd", F.lit(-1).cast("long"))
    altered = lines.where(F.col("prd_cd") != silent).unionByName(stray)
    rows = {r["prd_cd"]: r for r in DailyRun(replace(src, order_fact=altered), day, materialize=True).audit.collect()}
    assert rows[first["prd_cd"]]["outcome"] == "options differ"
    assert rows[first["prd_cd"]]["n_grid_options"] == rows[first["prd_cd"]]["n_report_rows"] + 1
    assert rows[silent]["outcome"] == "no order on air" and rows[silent]["n_grid_options"] == 0
    assert sum(r["outcome"] == "kept" for r in rows.values()) == len(rows) - 2
    assert {r["broad_dt"] for r in rows.values()} == {"19970101"}


def test_stages_of_a_tag_are_read_again(spark):
    tag = "t" + os.urandom(8).hex()
    one = write_stage(spark.range(5), "numbers", run_tag=tag, resume=True)
    again = write_stage(spark.range(9), "numbers", run_tag=tag, resume=True)
    assert one.count() == again.count() == 5
    assert write_stage(spark.range(9), "numbers", run_tag=tag).count() == 9
