"""Group gate and never-ordered options (FIXTURES.md §4)."""

from pyspark.sql import functions as F

from stockout.operators.grid import group_gate, option_frame, order_grid

MINUTES = "pgm_id long, prd_cd long, chanl_cd string, attr_prd_cd long, ord_dt string, ord_time string, tot_ord_qty long, broad_dt string, is_live boolean"
OPTIONS = "pgm_id long, prd_cd long, attr_prd_cd long, broad_dt string, is_live boolean, supply long"


def _minutes(spark, attrs):
    rows = [(1, 1, "C", a, "20160808", "2140", 1, "20160808", True) for a in attrs]
    rows += [(1, 1, "C", attrs[0], "20160808", "2141", 2, "20160808", True)]
    return spark.createDataFrame(rows, MINUTES)


def _options(spark, attrs):
    return spark.createDataFrame([(1, 1, a, "20160808", True, 10) for a in attrs], OPTIONS)


def test_group_dropped_when_report_lacks_an_ordered_option(spark):
    frame = option_frame(_minutes(spark, [1, 2, 3]), _options(spark, [1, 2]))
    gate = group_gate(frame).first()
    assert (gate["n_report_rows"], gate["n_grid_options"], gate["passes"]) == (2, 3, False)


def test_never_ordered_option_is_a_zero_row(spark):
    minutes = _minutes(spark, [1])
    frame = option_frame(minutes, _options(spark, [1, 2]))
    assert group_gate(frame).first()["passes"]
    grid = order_grid(minutes, frame)
    zero = grid.where(F.col("attr_prd_cd") == 2).collect()
    assert len(zero) == 2 and all(r["qty"] == 0 for r in zero)
    assert sorted(r["qty"] for r in grid.where(F.col("attr_prd_cd") == 1).collect()) == [1, 2]
