"""Day reload: writing a day twice leaves one copy; writing another day leaves the first alone."""

import tempfile

import pytest
from pyspark.sql import functions as F

from stockout.sinks import check_keys, load_snapshot, write_snapshot
from stockout.sinks.tables import KeyViolation

SNAP = "pgm_id long, soldout_seq int, attr_prd_cd long, value long, broad_dt string"


def test_reload_is_idempotent(spark):
    path = tempfile.mkdtemp(prefix="stockout-sink-") + "/snap"
    day1 = spark.createDataFrame([(1, 1, 11, 4, "20160808"), (1, 1, 12, 2, "20160808")], SNAP)
    day2 = spark.createDataFrame([(2, 1, 21, 7, "20160809")], SNAP)
    write_snapshot(day1, path)
    write_snapshot(day1, path)
    assert load_snapshot(spark, path).count() == 2
    write_snapshot(day2, path)
    back = load_snapshot(spark, path)
    assert back.count() == 3
    assert back.where(F.col("broad_dt") == "20160808").count() == 2
    changed = day1.withColumn("value", F.col("value") + 1)
    write_snapshot(changed, path)
    assert sorted(r["value"] for r in load_snapshot(spark, path).where("broad_dt = '20160808'").collect()) == [3, 5]
    assert load_snapshot(spark, path).where("broad_dt = '20160809'").count() == 1


def test_key_check(spark):
    dup = spark.createDataFrame([(1, 1, 11, 4, "20160808"), (1, 1, 11, 5, "20160808")], SNAP)
    with pytest.raises(KeyViolation):
        check_keys(dup, ("pgm_id", "attr_prd_cd", "soldout_seq", "broad_dt"))


def test_trial_table_replace_and_drop(spark):
    from stockout.sinks import drop_table, replace_table

    df = spark.createDataFrame([(1, "a"), (2, "b")], "pgm_id long, v string")
    replace_table(df, "stockout_trial_report")
    replace_table(df.limit(1), "stockout_trial_report")  # replaced as a whole
    assert spark.table("stockout_trial_report").count() == 1
    drop_table(spark, "stockout_trial_report")
    assert not spark.catalog.tableExists("stockout_trial_report")


def test_display_names_round_trip(spark):
    from stockout import schemas
    from stockout.operators.present import from_display_names, to_display_names

    cols = list(schemas.REPORT_COLUMN_NAMES)
    df = spark.createDataFrame([tuple(range(len(cols)))], ", ".join(f"{c} int" for c in cols))
    shown = to_display_names(df)
    assert len(set(shown.columns)) == 39 and "방송코드" in shown.columns
    assert from_display_names(shown).columns == cols


def test_snapshot_value_must_not_be_null(spark):
    bad = spark.createDataFrame([(1, 1, 11, None, "20160808")], SNAP)
    with pytest.raises(KeyViolation):
        write_snapshot(bad, tempfile.mkdtemp(prefix="stockout-sink-") + "/snap")


def test_reload_drops_days_that_come_out_empty(spark):
    from stockout import schemas
    from stockout.sinks import ALL_DAYS, load_days, load_report

    root = tempfile.mkdtemp(prefix="stockout-sink-")
    snap = spark.createDataFrame([(1, 1, 11, 4, "20160808"), (2, 1, 21, 7, "20160809")], SNAP)
    key = ", ".join(f"{c} {'string' if c == 'broad_dt' else 'long'}" for c in (*schemas.REPORT_KEY, "broad_dt"))
    width = len(schemas.REPORT_KEY)
    report = spark.createDataFrame([(*[1] * width, "20160808"), (*[2] * width, "20160809")], key)
    paths = (f"{root}/report", f"{root}/snap")
    both = ("20160808", "20160809")

    def days():
        return [sorted({r["broad_dt"] for r in load(spark, p).collect()})
                for load, p in ((load_report, paths[0]), (load_snapshot, paths[1]))]

    load_days(report, snap, *paths, both)
    assert days() == [list(both)] * 2
    load_days(report.limit(0), snap.limit(0), *paths, ("20160808",))  # the day was cancelled
    assert days() == [["20160809"]] * 2
    with pytest.raises(ValueError):
        load_days(report, snap, *paths, ("20160809",))  # rows of a day that was not asked for
    bad = snap.withColumn("value", F.lit(None).cast("long"))
    with pytest.raises(KeyViolation):  # nothing is loaded if either table is bad
        load_days(report, bad, *paths, both)
    assert days() == [["20160809"]] * 2
    load_days(report.limit(1), snap.limit(1), *paths, ALL_DAYS)
    assert days() == [["20160808"]] * 2
