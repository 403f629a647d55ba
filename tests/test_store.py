"""The store: loads are whole or not there, keys are unique over all days, days are not read in vain."""

import tempfile

import pytest
from pyspark.sql import functions as F

from stockout import schemas
from stockout.sinks import ALL_DAYS, CommitConflict, ResultStore
from stockout.sinks.keys import StoredDay, day_filters, days_that_may_hold, filter_bits, overlapping_days
from stockout.sinks.store import REPORT, SNAPSHOT
from stockout.sinks.tables import KeyViolation

REPORT_ROWS = "pgm_id long, attr_prd_cd long, tot_ord_qty long, broad_dt string"
SNAP_ROWS = "pgm_id long, soldout_seq int, attr_prd_cd long, value long, broad_dt string"


def tables(spark, rows):
    """rows: (pgm, attr, units, day)."""
    return (spark.createDataFrame(rows, REPORT_ROWS),
            spark.createDataFrame([(p, 1, a, u, d) for p, a, u, d in rows], SNAP_ROWS))


@pytest.fixture
def store(spark):
    store = ResultStore(spark, tempfile.mkdtemp(prefix="stockout-store-") + "/store")
    store.load(*tables(spark, [(1, 11, 5, "20160808"), (1, 12, 6, "20160808"), (2, 21, 7, "20160809")]), ALL_DAYS)
    return store


def content(store, version=None):
    return (sorted(tuple(r) for r in store.report(version).select("pgm_id", "attr_prd_cd", "tot_ord_qty", "broad_dt").collect()),
            sorted((r["pgm_id"], r["attr_prd_cd"], r["value"], r["broad_dt"]) for r in store.snapshot(version).collect()))


def test_reload_replaces_the_day_in_both_tables(spark, store):
    before = content(store)
    new = [(1, 13, 9, "20160808")]
    store.load(*tables(spark, new), ("20160808",))
    assert content(store) == tuple([*new, (2, 21, 7, "20160809")] for _ in range(2))
    assert content(store, 1) == before and store.versions() == [1, 2]
    assert store.report().schema == tables(spark, new)[0].schema
    store.load(*(t.limit(0) for t in tables(spark, new)), ("20160809", "20160810"))  # cancelled days
    assert content(store) == (new, new)
    store.load(*tables(spark, before[0]), ALL_DAYS)
    assert content(store) == before
    store.load(*(t.limit(0) for t in tables(spark, new)), ALL_DAYS)
    assert content(store) == ([], []) and content(store, 2) != ([], [])


@pytest.mark.parametrize("step", ["_write", "_commit", "_publish"])
@pytest.mark.parametrize("call", [1, 2])
def test_a_load_that_fails_changes_nothing(spark, store, monkeypatch, step, call):
    if call == 2 and step != "_write":
        pytest.skip("called once")
    before, calls = content(store), []
    real = getattr(ResultStore, step)

    def breaks(self, *args):
        calls.append(step)
        if len(calls) == call:
            raise OSError("injected")
        return real(self, *args)

    with monkeypatch.context() as m:
        m.setattr(ResultStore, step, breaks)
        with pytest.raises(OSError):
            store.load(*tables(spark, [(1, 11, 99, "20160808")]), ("20160808",))
    assert content(store) == before and store.versions() == [1]
    gone = store.remove_unnamed(older_than_hours=-1)
    assert (len(gone) > 0) == (step != "_write" or call == 2)
    assert content(store) == before
    store.load(*tables(spark, [(1, 11, 99, "20160808")]), ("20160808",))
    assert content(store)[0] == [(1, 11, 99, "20160808"), (2, 21, 7, "20160809")]


def test_rows_of_other_days_and_bad_rows_are_refused(spark, store):
    before = content(store)
    report, snap = tables(spark, [(3, 31, 1, "20160811")])
    with pytest.raises(ValueError):
        store.load(report, snap, ("20160812",))
    with pytest.raises(KeyViolation):
        store.load(report, snap.withColumn("value", F.lit(None).cast("long")), ("20160811",))
    with pytest.raises(KeyViolation):
        store.load(report.unionByName(report), snap, ("20160811",))
    assert content(store) == before


def test_a_key_under_two_days_is_refused(spark, store):
    before = content(store)
    with pytest.raises(KeyViolation, match="1, 12"):
        store.load(*tables(spark, [(1, 12, 1, "20160810"), (1, 19, 1, "20160810")]), ("20160810",))
    assert store.days_read == ("20160808",)
    with pytest.raises(KeyViolation):  # within the load itself
        store.load(*tables(spark, [(9, 1, 1, "20160810"), (9, 1, 1, "20160811")]), ("20160810", "20160811"))
    assert content(store) == before
    store.load(*tables(spark, [(1, 12, 1, "20160809")]), ("20160808", "20160809"))  # moved, not doubled
    assert content(store)[0] == [(1, 12, 1, "20160809")]


def test_days_without_the_keys_are_not_read(spark, store):
    days = [f"2017{m:02d}{d:02d}" for m in (1, 2) for d in range(1, 16)]
    rows = [(k, 100 * (i + 1) + k, 1, day) for i, day in enumerate(days) for k in range(1000, 1040)]
    store.load(*tables(spark, rows), tuple(days))
    # The same broadcasts in the same range, other options: ranges overlap, filters do not.
    store.load(*tables(spark, [(k, 77 * 10 ** 6 + k, 1, "20180101") for k in range(1000, 1040)]), ("20180101",))
    assert len(store.days_read) <= 1  # of 30; chance alone
    with pytest.raises(KeyViolation):
        store.load(*tables(spark, [(1003, 100 * 8 + 1003, 1, "20180102")]), ("20180102",))
    assert days[7] in store.days_read and len(store.days_read) <= 2
    store.load(*tables(spark, [(5, 5, 1, "20180103")]), ("20180103",))  # out of every range
    assert store.days_read == ()


def test_filters_miss_no_key(spark):
    rows = spark.range(5000).select((F.col("id") % 50).alias("pgm_id"), F.col("id").alias("attr_prd_cd"),
                                    F.when(F.col("id") % 3 == 0, "a").otherwise("b").alias("broad_dt"))
    bits = {"a": filter_bits(1700), "b": filter_bits(3400)}
    key = schemas.REPORT_KEY
    filters = day_filters(rows, key, bits).cache()
    stored = {d: StoredDay(0, 49, n) for d, n in bits.items()}
    for k in (0, 1, 4999):
        assert rows.where(F.col("attr_prd_cd") == k).first()["broad_dt"] in days_that_may_hold(
            rows.where(F.col("attr_prd_cd") == k), key, filters, stored)
    other = rows.select("pgm_id", (F.col("attr_prd_cd") + 10 ** 9).alias("attr_prd_cd")).limit(40)
    assert len(days_that_may_hold(other, key, filters, stored)) <= 1
    assert days_that_may_hold(rows.limit(0), key, filters, stored) == [] == days_that_may_hold(rows, key, filters, {})
    assert overlapping_days({"a": StoredDay(1, 5, 64), "b": StoredDay(7, 9, 64)}, 5, 6) == ["a"]
    assert filter_bits(0) == 1024 and filter_bits(65) == 2048


def test_two_loads_at_once(spark, store, monkeypatch):
    """Another load publishes between this one's base and its own publishing."""
    def between(rows, days):
        real = ResultStore._check_whole_table
        other = ResultStore(spark, store.root)

        def check(self, *args):
            real(self, *args)
            m.setattr(ResultStore, "_check_whole_table", real)
            other.load(*tables(spark, rows), days)

        m.setattr(ResultStore, "_check_whole_table", check)

    with monkeypatch.context() as m:
        between([(3, 31, 1, "20160811")], ("20160811",))
        store.load(*tables(spark, [(4, 41, 1, "20160812")]), ("20160812",))
    assert {"20160811", "20160812"} <= {r[3] for r in content(store)[0]} and store.versions() == [1, 2, 3]
    with monkeypatch.context() as m:
        between([(4, 42, 1, "20160812")], ("20160812",))
        with pytest.raises(CommitConflict):
            store.load(*tables(spark, [(4, 43, 1, "20160812")]), ("20160812",))
    with monkeypatch.context() as m:  # the same key under another day
        between([(5, 51, 1, "20160813")], ("20160813",))
        with pytest.raises(KeyViolation):
            store.load(*tables(spark, [(5, 51, 1, "20160814")]), ("20160814",))
    assert not store._publish(store.manifest())  # a version is never replaced


def test_reading_before_any_load(spark):
    empty = ResultStore(spark, tempfile.mkdtemp(prefix="stockout-store-"))
    assert empty.versions() == [] and empty.manifest().version == 0
    with pytest.raises(ValueError):
        empty.report()
    with pytest.raises(ValueError):
        empty.manifest(3)
    assert REPORT != SNAPSHOT


def test_a_day_is_read_alone(spark, store):
    plan = store.report().where(F.col("broad_dt") == "20160809")
    assert [r["pgm_id"] for r in plan.collect()] == [2] and len(plan.inputFiles()) <= 3
