"""Whitening: secular roots and spectra against dense eigenproblems, results against a plain computation."""

import numpy as np
import pytest

from stockout.llm import whitening as W
from stockout.llm.common import read_table

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("seed", range(6))
def test_secular_roots(seed):
    rng = np.random.default_rng(seed)
    k = int(rng.integers(1, 40))
    d = np.cumsum(10.0 ** rng.uniform(-6, 3, k))
    z = rng.normal(size=k) * 10.0 ** rng.uniform(-3, 0, k)
    rho = 10.0 ** rng.uniform(-3, 3)
    roots, apart = W.secular_roots(d, z, rho)
    assert np.allclose(roots, np.linalg.eigvalsh(np.diag(d) + rho * np.outer(z, z)), rtol=1e-12, atol=1e-12 * d[-1])
    assert (apart[np.arange(k), np.arange(k)] < 0).all()  # each beyond its own pole, before the next
    assert all(apart[j + 1, j] > 0 for j in range(k - 1))


@pytest.mark.parametrize("dim, n", [(1, 4), (3, 2), (8, 300), (24, 60)])
def test_updates_and_merges_equal_the_scatter(dim, n):
    rng = np.random.default_rng(dim)
    x = np.floor(30 * rng.normal(size=(n, dim)) * np.linspace(0.1, 1, dim))
    x[:, -1] = x[:, 0]  # a direction without variance
    x = np.concatenate([x, x[: n // 2]])
    whole, halves = W.Spectrum(dim), (W.Spectrum(dim), W.Spectrum(dim))
    for k, v in enumerate(x):
        whole.add(v)
        halves[k % 2].add(v)
    halves[0].merge(halves[1])
    halves[0].merge(W.Spectrum(dim))
    c = x - x.mean(axis=0)
    scatter = c.T @ c
    for s in (whole, halves[0]):
        assert s.n == len(x) and np.allclose(s.mean, x.mean(axis=0))
        assert np.abs(s.vectors.T @ s.vectors - np.eye(dim)).max() < 1e-11
        assert np.abs(s.vectors @ np.diag(s.values) @ s.vectors.T - scatter).max() <= 1e-11 * max(scatter.max(), 1)


def test_weights_are_repeats():
    a, b = W.Spectrum(4), W.Spectrum(4)
    for v, w in ((np.arange(4.0), 3), (np.ones(4), 1), (np.array([5.0, 0, 1, 2]), 2)):
        a.add(v, w)
        for _ in range(w):
            b.add(v)
    assert np.allclose(a.values, b.values) and np.allclose(a.mean, b.mean)


def plain(rows):
    """The same by whole matrices: {vec_id: [...]} in the order of rows."""
    kept = [(i, v) for i, v in rows if v is not None and len(v) and all(c is not None and np.isfinite(c) for c in v)]
    x = [[int(np.floor(64 * float(c))) + 1_000_000 for c in v] for _, v in kept]
    n, sums = len(x), [sum(col) for col in zip(*x)]
    exact = [[n * c - s for c, s in zip(row, sums)] for row in x]
    centred = np.array(exact, dtype=float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    values, vectors = values[::-1][:32], vectors[:, ::-1][:, :32]
    return [i for i, _ in kept], [sum(c * c for c in row) for row in exact], centred, values, vectors


def _by_row(table):
    return table.sort_values(["vec_id", "component"], kind="stable")


def _check(got, rows):
    ids, deviation, centred, values, vectors = plain(rows)
    shown = len(values)
    assert len(got) == len(ids) * shown
    got = _by_row(got)
    order = np.argsort(ids, kind="stable")
    assert got["vec_id"].tolist() == np.repeat(np.array(ids)[order], shown).tolist()
    assert got["n"].unique().tolist() == [len(ids)]
    assert got["deviation"].tolist() == np.repeat(np.array(deviation)[order], shown).tolist()
    whitened = got["whitened"].to_numpy().reshape(len(ids), shown)
    want = (centred @ vectors / np.sqrt(values))[order]
    sign = np.sign((whitened * want).sum(axis=0))
    assert np.abs(whitened - want * sign).max() < 1e-7
    total = np.trace(centred.T @ centred / len(ids))
    assert np.allclose(got["explained"].to_numpy()[:shown], values / total, rtol=1e-9)
    cov = whitened.T @ whitened / len(ids)
    assert np.abs(cov - np.eye(shown)).max() < 1e-9 and got["identity_error"].max() < 1e-9


def test_query_equals_plain_computation(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in read_table(spark, SF, "embeddings").collect()]
    _check(W.whitening_query(spark, SF).toPandas(), rows)


@pytest.mark.parametrize("parts", [1, 40])
def test_result_does_not_hang_on_partitions(spark, parts):
    rng = np.random.default_rng(3)
    rows = [(int(k), [float(v) for v in rng.normal(size=6) * [9, 5, 3, 2, 1, 0.5]]) for k in range(70)]
    rows += [(100 + k, rows[0][1]) for k in range(40)]  # one hot vector
    rows += [(900, None), (901, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (902, [float("nan")] + [0.0] * 5), (903, [float("inf")] + [0.0] * 5), (904, [])]
    table = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<double>, part string").repartition(parts)
    _check(W.whiten(table, W.fit_whitening(table)).toPandas(), rows)


def test_defined_results(spark):
    schema = "vec_id long, embedding array<float>"
    run = lambda rows: (lambda t: W.whiten(t, W.fit_whitening(t)).collect())(spark.createDataFrame(rows, schema))
    assert run([]) == [] and run([(1, None), (2, [])]) == []
    alone = run([(1, [0.5, 2.0])])
    assert [(r["component"], r["n"], r["deviation"], r["whitened"], r["explained"], r["identity_error"]) for r in alone] == \
        [(1, 1, 0, None, None, None), (2, 1, 0, None, None, None)]
    flat = run([(k, [float(k), 1.0, float(k)]) for k in range(5)] + [(None, [2.0, 1.0, 2.0])])  # one direction of three
    assert sorted({r["component"] for r in flat if r["whitened"] is None}) == [2, 3]
    assert sum(r["vec_id"] is None for r in flat) == 3 and max(r["identity_error"] for r in flat) < 1e-12
    mixed = run([(1, [1.0]), (2, [3.0]), (3, [0.0, 1.0]), (4, [1.0, 0.0])])
    assert {(r["vec_id"], r["n"]) for r in mixed} == {(k, 2) for k in (1, 2, 3, 4)} and len(mixed) == 6


def test_large_entries(spark):
    rows = [(1, [2.0**60, 0.0]), (2, [2.0**45, 1.0]), (3, [-(2.0**45), 2.0]), (4, [0.0, 3.0])]
    table = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    out = W.whiten(table, W.fit_whitening(table)).collect()
    assert {r["vec_id"] for r in out} == {2, 3, 4}  # the first is beyond a long
    assert all(r["deviation"] is None for r in out if r["vec_id"] != 4)
    assert W.Whitening(3, (3, 6), np.eye(2), np.ones(2)).centred(np.array([[2, 2]]))[1] == [9]
