"""Hand-computed sold-out cases (FIXTURES.md §4)."""

import pytest

from helpers import make_grid, minute
from stockout.operators.soldout import censor, soldout_time

CASES = [
    # name, supply, qty by minute, live, expected sold-out minute index (None = none)
    ("hard, exact", 10, [4, 6, 0, 3], True, 2),
    ("hard, jump over", 10, [4, 0, 9], True, 1),
    ("hard, first order too big", 5, [7, 0, 1], True, 1),
    ("hard on data channel", 10, [4, 6, 1], False, 2),
    ("buffer, live", 20, [10, 9, 0, 0, 0, 0], True, 3),
    ("buffer, data channel", 20, [10, 9, 0, 0, 0, 0], False, None),
    ("buffer, too short", 20, [10, 9, 0, 0], True, None),
    ("buffer, equal to limit", 20, [10, 8, 0, 0, 0, 0], True, None),
    ("buffer, later sale", 40, [37, 0, 0, 1, 0, 0, 0], True, 5),
    ("zero supply", 0, [5, 5, 5], True, None),
    ("below buffer", 20, [5, 5, 0, 0, 0], True, None),
    ("no supply listed", None, [5, 5, 5], True, None),
]


@pytest.mark.parametrize("name,supply,qtys,live,expected", CASES, ids=[c[0] for c in CASES])
def test_sold_out_minute(spark, name, supply, qtys, live, expected):
    grid = make_grid(spark, {7: (supply, qtys)}, live=live)
    out = censor(grid).orderBy("ord_ts").collect()
    want_ts = None if expected is None else minute(expected)
    assert {r["sold_out_ts"] for r in out} == {want_ts}
    for i, r in enumerate(out, start=1):
        assert r["is_censored"] == (expected is not None and i >= expected)
        assert r["qty"] == qtys[i - 1]  # the raw units stay; censoring is a flag


def test_soldout_time_flag(spark):
    grid = make_grid(spark, {1: (10, [4, 6, 0, 3]), 2: (100, [1, 1, 1, 1])})
    rows = {r["attr_prd_cd"]: r for r in soldout_time(censor(grid)).collect()}
    assert rows[1]["sold_out_dtm"] == minute(2) and rows[1]["sold_out_flag"] == 1
    assert rows[2]["sold_out_dtm"] is None and rows[2]["sold_out_flag"] == 0
    assert rows[1]["total_qty"] == 13
