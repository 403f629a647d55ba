"""Stochastic gradient factorization against a plain loop over cells."""

import itertools

import numpy as np
import pandas as pd
import pytest

from stockout.operators import sgd
from stockout.operators.impute import N_FOLDS, ImputeSettings, impute_group, rank_candidates


def plain_fit(ratings, train, rate, epochs, p, q):
    """One cell after the other, in the order of the diagonals."""
    p, q = p.copy(), q.copy()
    n, m = ratings.shape
    order = ([(i, (i + t) % m) for t in range(m) for i in range(n)] if n <= m
             else [((j + t) % n, j) for t in range(n) for j in range(m)])
    for _ in range(epochs):
        for i, j in order:
            if train[i, j]:
                error = ratings[i, j] - sum(p[i, k] * q[j, k] for k in range(p.shape[1]))
                for k in range(p.shape[1]):
                    a, b = p[i, k], q[j, k]
                    p[i, k] += rate * error * b
                    q[j, k] += rate * error * a
    return p, q


@pytest.mark.parametrize("shape", [(3, 7), (7, 3), (4, 4), (1, 5), (5, 1)])
def test_every_cell_is_on_one_diagonal(shape):
    seen = [c for rows, columns in sgd.diagonals(shape) for c in zip(rows.tolist(), columns.tolist())]
    assert sorted(seen) == list(itertools.product(range(shape[0]), range(shape[1])))
    for rows, columns in sgd.diagonals(shape):
        assert len(set(rows.tolist())) == len(rows) and len(set(columns.tolist())) == len(columns)


@pytest.mark.parametrize("shape", [(3, 8), (6, 4)])
def test_fits_equal_the_plain_loop(shape):
    rng = np.random.default_rng(1)
    ratings = rng.poisson(4, shape).astype(float)
    train = rng.random((2, *shape)) < 0.7
    p, q = rng.normal(scale=0.1, size=(shape[0], 2)), rng.normal(scale=0.1, size=(shape[1], 2))
    states = {e: (a.copy(), b.copy()) for e, a, b in
              sgd.sgd_fits(ratings, train.astype(float), np.array([0.02, 0.01]), np.stack([p, p]), np.stack([q, q]), (2, 5))}
    for e, (a, b) in states.items():
        for f, rate in enumerate((0.02, 0.01)):
            want = plain_fit(ratings, train[f], rate, e, p, q)
            assert np.allclose(a[f], want[0], atol=1e-13) and np.allclose(b[f], want[1], atol=1e-13)


def plain_search(ratings, train, fold, ranks, top, starts, s):
    """Every setting fitted by itself."""
    row, column = train
    qty = ratings[row, column]

    def predict(mask, rate, rank, epochs):
        p, q = plain_fit(ratings, mask, rate, epochs, starts[0][:, :rank], starts[1][:, :rank])
        got = p @ q.T
        got[~mask.any(axis=1)] = ratings[mask].mean()
        got[:, ~mask.any(axis=0)] = ratings[mask].mean()
        return np.clip(got, 0, top)

    def mask(cells):
        out = np.zeros(ratings.shape, dtype=bool)
        out[row[cells], column[cells]] = True
        return out

    errors = []
    for setting in itertools.product(s.rates, ranks, s.epochs):
        mae = [np.abs(predict(mask(fold != f), *setting)[row[fold == f], column[fold == f]] - qty[fold == f]).mean()
               for f in range(N_FOLDS)]
        errors.append((sum(mae), setting))
    best = min(errors, key=lambda e: e[0])[1]
    return best, predict(mask(fold >= 0), *best)


@pytest.mark.parametrize("held", [1 << 22, 1])
def test_search_equals_fitting_each_setting(monkeypatch, held):
    monkeypatch.setattr(sgd, "_HELD", held)
    rng = np.random.default_rng(4)
    shape = (4, 9)
    ratings = np.zeros(shape)
    row, column = np.nonzero(rng.random(shape) < 0.8)
    keep = column != 3  # a minute nobody is observed in
    row, column = row[keep], column[keep]
    ratings[row, column] = rng.poisson(5, len(row))
    fold = rng.permutation(len(row)) % N_FOLDS
    ranks = rank_candidates(4)
    starts = tuple(rng.normal(scale=0.3, size=(n, max(ranks))) for n in shape)
    s = sgd.SgdSettings(rates=(0.05, 0.01), epochs=(3, 6))
    got = sgd.search(ratings, (row, column), fold, N_FOLDS, ranks, ratings.max(), starts, s)
    want = plain_search(ratings, (row, column), fold, ranks, ratings.max(), starts, s)
    assert got[0] == want[0] and np.allclose(got[1], want[1], atol=1e-12)
    assert np.allclose(got[1][:, 3], ratings[row, column].mean())


def frame_of(ratings, hidden):
    return pd.DataFrame([(1, 2, o, m, ratings[o, m], bool(hidden[o, m])) for o, m in itertools.product(*map(range, ratings.shape))],
                        columns=["pgm_id", "prd_cd", "attr_prd_cd", "ord_ts", "qty", "is_censored"])


def test_more_steps_learn_a_planted_matrix():
    """Hidden cells of a planted matrix come out nearer than its mean, by every form."""
    rng = np.random.default_rng(8)
    truth = np.round(np.outer(rng.uniform(1, 5, 8), rng.uniform(0.5, 4, 40)))
    hidden = rng.random(truth.shape) < 0.2
    frame = frame_of(truth, hidden)
    error = {}
    for name, settings in {"long": ImputeSettings(method="sgd", sgd=sgd.SgdSettings(rates=(0.02,), epochs=(200,), start_scale=0.5)),
                           "fixed": ImputeSettings(method="sgd"), "ridge": ImputeSettings()}.items():
        got = impute_group(frame, settings).reshape(truth.shape)
        assert (got[~hidden] == truth[~hidden]).all()
        assert (got >= 0).all() and (got <= truth[~hidden].max()).all() and (got == np.rint(got)).all()
        error[name] = np.abs(got - truth)[hidden].mean()
    mean = np.abs(truth[~hidden].mean() - truth)[hidden].mean()
    assert max(error.values()) < 0.5 * mean


def test_same_result_in_any_row_order():
    rng = np.random.default_rng(2)
    ratings = rng.poisson(3, (4, 12)).astype(float)
    frame = frame_of(ratings, rng.random(ratings.shape) < 0.2)
    want = impute_group(frame, ImputeSettings(method="sgd"))
    order = rng.permutation(len(frame))
    assert (impute_group(frame.iloc[order].reset_index(drop=True), ImputeSettings(method="sgd")) == want[order]).all()


def test_unknown_method_is_refused():
    with pytest.raises(ValueError):
        ImputeSettings(method="als")
