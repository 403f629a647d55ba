"""Exact rank-one imputation against plain whole-number arithmetic; its plan; all methods together."""

import random

import pytest
from pyspark.sql import functions as F

from helpers import make_grid
from stockout.operators.grid import GROUP
from stockout.operators.impute import METHODS, ImputeSettings, estimated_demand, held_out_error, impute_demand
from stockout.operators.rank_one import UNIT, RankOneSettings, half_even, impute_rank_one, rounded_quotient
from stockout.operators.soldout import censor
from stockout.stage import write_stage


def quotient(a, b):
    return 0 if b == 0 else (1 if a >= 0 else -1) * ((2 * abs(a) + b) // (2 * b))


def plain(cells, s):
    """cells: {(option, minute): (qty, censored)} of one group -> {cell: units or None}."""
    busy = {o for (o, _), (q, c) in cells.items() if c or q}
    train = {k: q for k, (q, c) in cells.items() if k[0] in busy and not c}
    gaps = any(c for (o, _), (_, c) in cells.items() if o in busy)
    out = {k: float(q) if not c else None for k, (q, c) in cells.items()}
    if not gaps or len(train) < s.min_observed:
        return out
    mean = quotient(sum(train.values()) * UNIT, len(train))
    bias = ({}, {})
    for _ in range(s.bias_rounds):
        for side in (0, 1):
            got = {}
            for k, q in train.items():
                got.setdefault(k[side], []).append(q * UNIT - mean - bias[1 - side].get(k[1 - side], 0))
            bias[side].update({x: quotient(sum(v), len(v) + s.shrink) for x, v in got.items()})
    rest = {k: q * UNIT - mean - bias[0][k[0]] - bias[1][k[1]] for k, q in train.items()}
    factor = ({}, dict(bias[1]))
    for _ in range(s.factor_rounds):
        for side in (0, 1):
            got = {}
            for k, e in rest.items():
                f = factor[1 - side].get(k[1 - side], 0)
                a, b, n = got.get(k[side], (0, 0, 0))
                got[k[side]] = a + e * f, b + f * f, n + 1
            factor[side].update({x: quotient(a * UNIT, b + n * s.ridge * UNIT) for x, (a, b, n) in got.items()})
    top = max(train.values()) * UNIT
    for (o, m), (_, c) in cells.items():
        if c:
            v = mean + bias[0].get(o, 0) + bias[1].get(m, 0) + quotient(factor[0].get(o, 0) * factor[1].get(m, 0), UNIT)
            v = max(0, min(v, top))
            units, left = divmod(v, UNIT)
            out[o, m] = float(units + (left > UNIT // 2 or (left == UNIT // 2 and units % 2 == 1)))
    return out


@pytest.fixture(scope="module")
def grid(spark):
    rng = random.Random(3)
    groups = [make_grid(spark, {o: (rng.choice([0, 9, 30, 200]), [rng.choice([0, 0, 1, 2, 5, 9]) for _ in range(12)]) for o in range(5)}, pgm=k)
              for k in range(1, 7)]
    groups.append(make_grid(spark, {1: (3, [2, 2]), 2: (0, [1, 1])}, pgm=8))          # too few cells
    groups.append(make_grid(spark, {1: (6, [1, 1, 1, 1, 1, 1, 4, 0]), 2: (5, [1, 1, 1, 1, 1, 0, 3, 1])}, pgm=9))  # nobody observed late
    whole = groups[0]
    for g in groups[1:]:
        whole = whole.unionByName(g)
    return censor(whole).cache()


def test_equals_plain_arithmetic(spark, grid):
    s = RankOneSettings()
    got = impute_rank_one(grid, s).collect()
    groups = {}
    for r in got:
        groups.setdefault(r["pgm_id"], {})[r["attr_prd_cd"], r["ord_ts"]] = (r["qty"], r["is_censored"])
    want = {(g, *k): v for g, cells in groups.items() for k, v in plain(cells, s).items()}
    have = {(r["pgm_id"], r["attr_prd_cd"], r["ord_ts"]): r["qty_imputed"] for r in got}
    assert have == want and any(v for (g, o, t), v in want.items() if groups[g][o, t][1])


def test_rounding(spark):
    pairs = [(5, 2), (-5, 2), (7, 3), (-7, 3), (0, 5), (4, 0), (10 ** 30, 10 ** 15), (-1, 2), (1, 3)]
    rows = spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "a string, b string").select(
        F.col("a").cast("decimal(38,0)").alias("a"), F.col("b").cast("decimal(38,0)").alias("b"))
    got = {(int(r["a"]), int(r["b"])): int(r["q"]) for r in rows.withColumn("q", rounded_quotient(F.col("a"), F.col("b"))).collect()}
    assert got == {(a, b): quotient(a, b) for a, b in pairs}
    halves = spark.range(8).select((F.col("id") * 500_000).cast("decimal(38,0)").alias("v"))
    assert [r[0] for r in halves.select(half_even(F.col("v"))).collect()] == [0, 0, 1, 2, 2, 2, 3, 4]


def test_no_exchange_over_a_bucketed_grid(spark, grid):
    stage = write_stage(grid, "rank_one_test", bucket_by=GROUP)
    plan = impute_rank_one(stage)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and plan.count("Window ") >= 10
    loose = impute_rank_one(write_stage(grid, "rank_one_loose"))._jdf.queryExecution().executedPlan().toString()
    assert loose.count("Exchange hashpartitioning(pgm_id") == 1


@pytest.mark.parametrize("method", METHODS)
def test_contract_of_every_method(spark, grid, method):
    rows = impute_demand(grid, ImputeSettings(method=method, max_iter=4)).collect()
    top = {r["pgm_id"]: r["m"] for r in grid.where("not is_censored").groupBy("pgm_id").agg(F.max("qty").alias("m")).collect()}
    assert len(rows) == grid.count()
    for r in rows:
        if not r["is_censored"]:
            assert r["qty_imputed"] == r["qty"]
        elif r["pgm_id"] == 8:
            assert r["qty_imputed"] is None
        else:
            assert 0 <= r["qty_imputed"] <= top[r["pgm_id"]] and r["qty_imputed"] == int(r["qty_imputed"])
    est = estimated_demand(impute_demand(grid, ImputeSettings(method=method, max_iter=4))).collect()
    assert all(r["estim_qty"] >= (r["observed_qty"] or 0) for r in est)


def test_held_out_error_beside_each_other(spark, grid):
    rows = held_out_error(grid).collect()
    assert {r["pgm_id"] for r in rows} <= set(range(1, 10)) and len(rows) >= 4
    for r in rows:
        assert r["n_held"] > 0 and (r["mae_ridge"] is None) == (r["mae_sgd"] is None) == (r["mae_rank_one"] is None)
