"""The window formulation of the sold-out rule against a plain loop over random grids."""

import math
import random

from helpers import GRID_SCHEMA, minute
from stockout.operators.soldout import censor


def brute_force(supply, qtys, live):
    """Straight reading of the rule, one option at a time."""
    if supply is None or supply == 0:
        return None
    cum, run = [], 0
    for q in qtys:
        run += q
        cum.append(run)
    total = cum[-1]
    if total >= supply:
        under = [(c, i) for i, c in enumerate(cum) if c <= supply]
        if under:
            best = max(c for c, _ in under)
            return next(i for c, i in under if c == best)
        low = min(cum)
        return cum.index(low)
    buffer = math.ceil(supply * 0.9)
    if live and total > buffer:
        idx = [i for i, c in enumerate(cum) if c >= buffer]
        diffs = [(idx[k], cum[idx[k]] - cum[idx[k - 1]]) for k in range(1, len(idx))]
        for k in range(len(diffs) - 2):
            if diffs[k][1] + diffs[k + 1][1] + diffs[k + 2][1] == 0:
                return diffs[k][0]
    return None


def test_random_grids_match_loop(spark):
    rng = random.Random(7)
    rows, expected = [], {}
    for g in range(120):
        live = rng.random() < 0.6
        n_min = rng.randint(1, 12)
        for attr in range(rng.randint(1, 4)):
            supply = rng.choice([None, 0, rng.randint(1, 30), rng.randint(1, 30)])
            qtys = [rng.choice([0, 0, 0, 1, 1, 2, 3, 5, 8]) for _ in range(n_min)]
            if rng.random() < 0.1:
                qtys[rng.randrange(n_min)] = -1  # a negative minute (cancellations) must not break the rule
            for i, q in enumerate(qtys, start=1):
                rows.append((g, 1, attr, minute(i), q, supply, live, "20160808", True))
            k = brute_force(supply, qtys, live)
            expected[(g, attr)] = None if k is None else minute(k + 1)
    out = censor(spark.createDataFrame(rows, GRID_SCHEMA))
    got = {(r["pgm_id"], r["attr_prd_cd"]): r["sold_out_ts"]
           for r in out.select("pgm_id", "attr_prd_cd", "sold_out_ts").distinct().collect()}
    assert got == expected
    assert sum(v is not None for v in expected.values()) > 30
