"""Imputation invariants: observed cells intact, predictions bounded, gates honoured, repeatable."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from helpers import make_grid
from stockout.operators.impute import (
    ImputeSettings, estimated_demand, factorize, impute_demand, impute_group, train_set_profile)
from stockout.operators.soldout import censor

SETTINGS = ImputeSettings(max_iter=5)


@pytest.fixture(scope="module")
def grid(spark):
    # group 1: trainable (sell-outs, enough observed cells, an all-zero option)
    g1 = make_grid(spark, {1: (10, [3, 4, 2, 5, 1, 0]), 2: (30, [2, 3, 2, 3, 2, 3]),
                           3: (8, [9, 0, 1, 0, 0, 0]), 4: (0, [0, 0, 0, 0, 0, 0])}, pgm=1)
    # group 2: a censored cell but only 4 observed cells -> left as it is
    g2 = make_grid(spark, {1: (5, [2, 2, 3]), 2: (0, [1, 1, 0])}, pgm=2)
    # group 3: nothing censored
    g3 = make_grid(spark, {1: (100, [1, 2, 3]), 2: (100, [0, 1, 0])}, pgm=3)
    return censor(g1.unionByName(g2).unionByName(g3)).cache()


def test_profile_gates(spark, grid):
    prof = {r["pgm_id"]: r for r in train_set_profile(grid).collect()}
    assert prof[1]["trainable"] and prof[1]["n_zero_options"] == 1
    assert not prof[2]["trainable"] and prof[2]["n_observed"] == 4
    assert not prof[3]["trainable"] and prof[3]["n_censored"] == 0


def test_invariants(spark, grid):
    imputed = impute_demand(grid, SETTINGS).cache()
    rows = imputed.collect()
    max_obs = {r["pgm_id"]: r["m"] for r in grid.where(~F.col("is_censored")).groupBy("pgm_id")
               .agg(F.max("qty").alias("m")).collect()}
    for r in rows:
        if not r["is_censored"]:
            assert r["qty_imputed"] == r["qty"]
        elif r["pgm_id"] == 1:
            assert r["qty_imputed"] is not None and 0 <= r["qty_imputed"] <= max_obs[1]
            assert r["qty_imputed"] == round(r["qty_imputed"])
        else:
            assert r["qty_imputed"] is None  # untrainable group: censored cells stay empty
    zero = [r for r in rows if r["pgm_id"] == 1 and r["attr_prd_cd"] == 4]
    assert zero and all(r["qty_imputed"] == 0 for r in zero)
    est = {(r["pgm_id"], r["attr_prd_cd"]): r for r in estimated_demand(imputed).collect()}
    # group 2 keeps its observed sum; estimates never fall below what was observed
    assert est[(2, 1)]["estim_qty"] == est[(2, 1)]["observed_qty"]
    assert all(r["estim_qty"] >= (r["observed_qty"] or 0) for r in est.values())
    again = {(r["pgm_id"], r["attr_prd_cd"], r["ord_ts"]): r["qty_imputed"]
             for r in impute_demand(grid, SETTINGS).collect()}
    assert again == {(r["pgm_id"], r["attr_prd_cd"], r["ord_ts"]): r["qty_imputed"] for r in rows}


def as_dict(imputed):
    return {(r["pgm_id"], r["prd_cd"], r["attr_prd_cd"], r["ord_ts"]): r["qty_imputed"] for r in imputed.collect()}


def test_result_depends_on_the_group_alone(spark, grid):
    """Alone or with other groups, in other partitions, in another order: the same estimates."""
    whole = as_dict(impute_demand(grid, SETTINGS))
    alone = as_dict(impute_demand(grid.where("pgm_id = 1"), SETTINGS))
    assert alone == {k: v for k, v in whole.items() if k[0] == 1}
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        for n in ("1", "7"):
            spark.conf.set("spark.sql.shuffle.partitions", n)
            shuffled = grid.orderBy(F.xxhash64("attr_prd_cd", "ord_ts", F.lit(int(n)))).repartition(3)
            assert as_dict(impute_demand(shuffled, SETTINGS)) == whole
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)


def test_planted_low_rank_beats_the_means():
    """Hidden cells of a planted low-rank group are predicted better than by its means."""
    rng = np.random.default_rng(8)
    options, minutes = 12, 60
    truth = np.outer(rng.uniform(1, 10, options), rng.uniform(0.2, 3, minutes))
    truth += np.outer(rng.uniform(0, 4, options), rng.uniform(0, 3, minutes))
    hidden = rng.random(truth.shape) < 0.2
    frame = pd.DataFrame([(1, 2, o, m, round(truth[o, m]), bool(hidden[o, m])) for o in range(options)
                          for m in range(minutes)],
                         columns=["pgm_id", "prd_cd", "attr_prd_cd", "ord_ts", "qty", "is_censored"])
    got = impute_group(frame, ImputeSettings()).reshape(truth.shape)
    error = np.abs(got - truth)[hidden].mean()
    mean = truth[~hidden].mean()
    by_option = np.array([truth[o][~hidden[o]].mean() for o in range(options)])[:, None] + 0 * truth
    assert error < 0.5 * np.abs(mean - truth)[hidden].mean()
    assert error < 0.5 * np.abs(by_option - truth)[hidden].mean()


def test_cells_without_ratings_get_the_biases():
    ratings, mask = np.array([[1.0, 3.0, 0.0], [0.0, 0.0, 0.0]]), np.array([[1.0, 1.0, 0.0], [0.0, 0.0, 0.0]])
    got = factorize(ratings, mask, 1, 0.1, 5, np.full((3, 1), 0.1))
    assert np.isfinite(got).all() and got[1, 2] == pytest.approx(2.0)
