"""Registered queries against their DuckDB statements on the smallest test data."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

from __spark_entry__ import entry, oracle_sql, queries  # noqa: E402
from check_oracle import VIEWS, normalise  # noqa: E402
from conftest import SMOKE_DIR  # noqa: E402

CHECKED = ["minute_orders", "broadcast_sequence", "product_attr_info", "supply_by_attr", "order_revenue",
           "preorder_since_3am", "report_base", "soldout_censored_grid", "soldout_snapshot", "train_set_profile",
           "group_gate", "report_presentation", "month_days", "demand_rank_one", "final_report_rank_one",
           "demand_sgd_contract"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for v in VIEWS:
        con.execute(f"CREATE VIEW {v} AS SELECT * FROM read_parquet('{SMOKE_DIR}/{v}.parquet')")
    return con


def test_every_query_but_the_model_ones_has_an_oracle():
    from stockout.plans.catalogue import QUERIES

    assert set(QUERIES) <= set(queries())
    assert set(QUERIES) - set(oracle_sql()) == {"demand_imputed", "estimated_demand", "final_report", "demand_sgd",
                                                "imputation_error"}


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_oracle(spark, duck, name):
    got = queries()[name](spark, SMOKE_DIR).toPandas()
    want = duck.execute(oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want) and len(got) > 0
    assert normalise(got).equals(normalise(want))


def test_entry(spark):
    df = entry(spark)
    assert df.columns == ["pgm_id", "prd_cd", "attr_prd_cd", "total_qty", "sold_out_dtm", "sold_out_flag"]
    assert df.count() > 0
