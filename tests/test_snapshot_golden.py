"""Snapshot cases (FIXTURES.md §4)."""

from helpers import make_grid
from stockout.operators.snapshot import first_soldout_value, soldout_snapshot
from stockout.operators.soldout import censor


def _rows(df):
    return sorted((r["attr_prd_cd"], r["soldout_seq"], r["value"]) for r in df.collect())


def test_two_events(spark):
    grid = make_grid(spark, {1: (10, [4, 6, 0, 3]), 2: (100, [1, 1, 1, 1])})
    snap = soldout_snapshot(censor(grid))
    # A sells out at m2 (seq 1); B never does, so it stands for the last minute m4 (seq 2).
    # A freezes before its own sold-out minute: 4 at both events.
    assert _rows(snap) == [(1, 1, 4), (1, 2, 4), (2, 1, 2), (2, 2, 4)]
    first = {r["attr_prd_cd"]: r["value"] for r in first_soldout_value(snap).collect()}
    assert first == {1: 4, 2: 2}


def test_no_sell_out_gives_one_event_at_last_minute(spark):
    grid = make_grid(spark, {1: (100, [1, 2, 3]), 2: (0, [0, 0, 5])})
    assert _rows(soldout_snapshot(censor(grid))) == [(1, 1, 6), (2, 1, 5)]


def test_shared_event_minute(spark):
    # both options sell out at m2: one event only
    grid = make_grid(spark, {1: (10, [5, 5, 1]), 2: (4, [2, 2, 2])})
    assert _rows(soldout_snapshot(censor(grid))) == [(1, 1, 5), (2, 1, 2)]
