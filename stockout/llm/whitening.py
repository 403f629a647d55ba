"""Whitening of embeddings by incremental eigendecomposition.

Each entry c counts as the whole number x = floor(64 * c) + 1000000. Fitting:

1. Every partition keeps the eigendecomposition of its scatter matrix, its mean and exact sums.
   A vector changes the scatter by one rank-one term along its difference to the mean so far
   (equal vectors of a batch by one weighted term). A term is worked in by deflating what it does
   not touch, solving the secular equation for the others' new eigenvalues and rebuilding their
   eigenvectors from the roots.
2. Spectra are combined over a tree of ``FAN_IN``: each eigenpair of one is a rank-one term of the
   other, and so is the difference of their means.
3. Rayleigh-Ritz: one more pass sums the covariance in the combined basis, with (n * x - S) / n as
   the centred value, so that rounding of the updates does not stay; its d x d
   eigenproblem gives the components.

What a task holds is d x d numbers and a batch; what the driver holds is d x d numbers. Transforming
is a pass over the rows with the components, of the same bounded size, sent along.

Defined results: vectors that are null, or hold a null or non-finite entry or one whose x is no
long, are dropped. Vectors of several lengths are fitted and transformed by length, each as a table
of its own; empty vectors have no components and so no rows. Components with a variance of at most
``NO_VARIANCE`` of the largest have whitened null (the vectors do not reach that direction);
explained is null where there is no variance at all. A deviation that no long can hold is null.
Repeated rows and ids count as often as they stand there. Extra columns are never read. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout.llm.common import read_table

SCALE, OFFSET = 64, 1_000_000
MAX_COMPONENTS = 32
#: States that one task combines.
FAN_IN = 32
NO_VARIANCE = 1e-12
_EPS = np.finfo(float).eps
_LONG = 2**63


def secular_roots(d: np.ndarray, z: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Roots of 1 + rho * sum(z**2 / (d - m)) for strictly ascending ``d`` and nonzero ``z``: the new
    values, and the differences d[i] - m[j] to full relative precision.

    The j-th root lies between d[j] and the next pole. Each is sought as a distance from the nearer
    of the two, all at once, by interpolating the poles to either side and halving the
    interval where that leaves it."""
    k = len(d)
    weight = rho * z * z
    top = weight.sum()
    gap = np.append(np.diff(d), top)
    middle = d + gap / 2
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        right = 1 + (weight[:, None] / (d[:, None] - middle[None])).sum(axis=0) < 0
        right[-1] = False
        origin = np.where(right, np.append(d[1:], 0), d)
        delta = d[:, None] - origin[None]
        low = np.where(right, -gap / 2, 0.0)
        high = np.where(right, 0.0, gap / 2)
        high[-1] = top * (1 + 4 * _EPS)
        tau = (low + high) / 2
        left_pole = np.arange(k)[:, None] <= np.arange(k)[None]
        a0 = delta[np.arange(k), np.arange(k)]
        b0 = np.append(delta[np.arange(1, k), np.arange(k - 1)], np.inf)
        for _ in range(200):
            term = weight[:, None] / (delta - tau)
            f = 1 + term.sum(axis=0)
            bound = 8 * k * _EPS * (1 + np.abs(term).sum(axis=0))
            low, high = np.where(f < 0, tau, low), np.where(f > 0, tau, high)
            done = (np.abs(f) <= bound) | (high - low <= 2 * _EPS * np.maximum(np.abs(low), np.abs(high)))
            if done.all():
                break
            slope = term / (delta - tau)
            below, above = (slope * left_pole).sum(axis=0), (slope * ~left_pole).sum(axis=0)
            a, b = a0 - tau, b0 - tau
            c = f - a * below - np.where(np.isinf(b), 0, b * above)
            p = (a + b) * f - a * b * (below + above)
            q = a * b * f
            root = np.sqrt(np.maximum(p * p - 4 * q * c, 0))
            step = np.where(p <= 0, (p - root) / (2 * c), 2 * q / (p + root))
            step[-1] = a[-1] + a[-1] * a[-1] * below[-1] / (f[-1] - a[-1] * below[-1])
            new = tau + step
            inside = (new > low) & (new < high)
            tau = np.where(done, tau, np.where(inside, new, (low + high) / 2))
    return origin + tau, delta - tau


class Spectrum:
    """Mean and eigendecomposition of the scatter of ``n`` vectors: ``vectors`` are columns,
    ``values`` ascend."""

    def __init__(self, dim: int):
        self.n = 0
        self.mean = np.zeros(dim)
        self.values = np.zeros(dim)
        self.vectors = np.eye(dim)

    def add(self, vector: np.ndarray, weight: int = 1) -> None:
        """``weight`` vectors equal to ``vector``."""
        total = self.n + weight
        change = vector - self.mean
        if self.n:
            self.rank_one(change, self.n * weight / total)
        self.mean = self.mean + change * (weight / total)
        self.n = total

    def merge(self, other: Spectrum) -> None:
        """The vectors of ``other`` as well."""
        if not other.n:
            return
        total = self.n + other.n
        change = other.mean - self.mean
        if self.n:
            self.rank_one(change, self.n * other.n / total)
        least = _EPS * max(float(other.values[-1]), float(self.values[-1])) if len(other.values) else 0.0
        for k in np.flatnonzero(other.values > least):
            self.rank_one(other.vectors[:, k], float(other.values[k]))
        self.mean = self.mean + change * (other.n / total)
        self.n = total

    def rank_one(self, vector: np.ndarray, rho: float) -> None:
        """Add rho * vector * vector^T to the scatter."""
        z = self.vectors.T @ vector
        size = float(np.sqrt((z * z).sum()))
        if not size or not rho:
            return
        z = z / size
        rho = rho * size * size
        tolerance = 8 * _EPS * max(float(np.abs(self.values).max()), rho)
        z[rho * np.abs(z) <= tolerance] = 0
        self._deflate_close(z, tolerance)
        moved = np.flatnonzero(z)
        if not len(moved):
            return
        d, zm = self.values[moved], z[moved]
        roots, apart = secular_roots(d, zm, rho)
        # The vector for which these roots are exact keeps the eigenvectors orthogonal.
        between = d[None] - d[:, None]
        np.fill_diagonal(between, 1.0)
        exact = np.sqrt(np.abs((-apart / between).prod(axis=1) / rho)) * np.sign(zm)
        turn = exact[:, None] / apart
        turn /= np.sqrt((turn * turn).sum(axis=0))
        self.values[moved] = roots
        self.vectors[:, moved] = self.vectors[:, moved] @ turn
        order = np.argsort(self.values, kind="stable")
        self.values, self.vectors = self.values[order], self.vectors[:, order]

    def _deflate_close(self, z: np.ndarray, tolerance: float) -> None:
        """Turn pairs of (nearly) equal values so that only one of each is touched."""
        moved = np.flatnonzero(z)
        a, b = z[moved[:-1]], z[moved[1:]]
        if not (np.diff(self.values[moved]) * np.abs(a * b) <= tolerance * (a * a + b * b)).any():
            return
        at = moved[0]
        for nxt in moved[1:]:
            size = np.hypot(z[at], z[nxt])
            c, s = z[nxt] / size, -z[at] / size
            if abs((self.values[nxt] - self.values[at]) * c * s) <= tolerance:
                z[nxt], z[at] = size, 0.0
                u, v = self.vectors[:, at].copy(), self.vectors[:, nxt].copy()
                self.vectors[:, at], self.vectors[:, nxt] = c * u + s * v, c * v - s * u
                low, high = self.values[at], self.values[nxt]
                self.values[at], self.values[nxt] = low * c * c + high * s * s, low * s * s + high * c * c
            at = nxt


@dataclass(frozen=True)
class Whitening:
    """The fit of vectors of one length: count, exact sums of x, all components as columns by falling
    variance, their variances, and the largest deviation of the whitened covariance from the identity."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray
    variances: np.ndarray
    identity_error: float | None = None

    @property
    def usable(self) -> np.ndarray:
        """Which of the reported components have variance."""
        kept = self.variances[:MAX_COMPONENTS]
        return kept > NO_VARIANCE * max(float(self.variances[0]), 0.0) if len(kept) else np.zeros(0, dtype=bool)

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, list[int | None]]:
        """x - S / n, and the exact sum over dimensions of (n * x - S)**2 (None beyond a long)."""
        sums = np.array(self.sums, dtype=object)
        reach = max(max(abs(s) for s in self.sums), self.n * int(np.abs(x).max()))
        if reach < 2**61:
            whole = x * np.int64(self.n) - sums.astype(np.int64)
            if (int(np.abs(whole).max()) ** 2) * x.shape[1] < _LONG:
                return whole / self.n, (whole * whole).sum(axis=1).tolist()
        else:
            whole = x.astype(object) * self.n - sums
        exact = [sum(int(v) * int(v) for v in row) for row in whole]
        return (whole / self.n).astype(float), [v if v < _LONG else None for v in exact]

    def whiten(self, centred: np.ndarray) -> np.ndarray:
        """Whitened values of the usable components."""
        use = np.flatnonzero(self.usable)
        return (centred @ self.components[:, use]) / np.sqrt(self.variances[use])


def whole_vectors(embedding: pd.Series) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Per length: places in the batch and x of the vectors that remain."""
    places: dict[int, list[int]] = {}
    rows: dict[int, list[np.ndarray]] = {}
    for k, values in enumerate(embedding):
        if values is None or not len(values):
            continue
        places.setdefault(len(values), []).append(k)
        rows.setdefault(len(values), []).append(values)
    out = {}
    for dim, vectors in rows.items():
        c = np.array([np.asarray(v, dtype=np.float64) for v in vectors])
        with np.errstate(over="ignore", invalid="ignore"):
            floor = np.floor(c * SCALE)
            good = (np.abs(floor) < 2.0**62).all(axis=1)
        if good.any():
            out[dim] = np.array(places[dim])[good], floor[good].astype(np.int64) + OFFSET
    return out


def _exact_sums(x: np.ndarray) -> list[int]:
    if int(np.abs(x).max()) * len(x) < 2**62:
        return [int(v) for v in x.sum(axis=0)]
    return [int(v) for v in x.astype(object).sum(axis=0)]


_STATE = "dim int, part long, n long, sums array<string>, mean binary, vals binary, vecs binary"


def _pack(dim: int, part: int, s: Spectrum, sums: list[int]) -> pd.DataFrame:
    return pd.DataFrame([(dim, part, s.n, [str(v) for v in sums], s.mean.tobytes(), s.values.tobytes(), s.vectors.tobytes())],
                        columns=["dim", "part", "n", "sums", "mean", "vals", "vecs"])


def _unpack(row) -> tuple[Spectrum, list[int]]:
    s = Spectrum(row.dim)
    s.n = row.n
    s.mean = np.frombuffer(row.mean).copy()
    s.values = np.frombuffer(row.vals).copy()
    s.vectors = np.frombuffer(row.vecs).reshape(row.dim, row.dim).copy()
    return s, [int(v) for v in row.sums]


def _partition_states(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    held: dict[int, tuple[Spectrum, list[int]]] = {}
    part = 0
    for batch in batches:
        if not len(batch):
            continue
        part = int(batch["part"].iloc[0])
        for dim, (_, x) in whole_vectors(batch["embedding"]).items():
            spectrum, sums = held.setdefault(dim, (Spectrum(dim), [0] * dim))
            held[dim] = spectrum, [a + b for a, b in zip(sums, _exact_sums(x), strict=True)]
            distinct, times = np.unique(x, axis=0, return_counts=True)
            for vector, weight in zip((distinct - OFFSET).astype(float), times.tolist(), strict=True):
                spectrum.add(vector, weight)
    for dim, (spectrum, sums) in held.items():
        yield _pack(dim, part, spectrum, sums)


def _merge_states(frame: pd.DataFrame) -> pd.DataFrame:
    rows = list(frame.sort_values("part").itertuples(index=False))
    spectrum, sums = _unpack(rows[0])
    for row in rows[1:]:
        other, more = _unpack(row)
        spectrum.merge(other)
        sums = [a + b for a, b in zip(sums, more, strict=True)]
    return _pack(rows[0].dim, rows[0].part // FAN_IN, spectrum, sums)


def _add_matrices(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame.sort_values("part")
    total = np.frombuffer(frame["total"].iloc[0]).copy()
    for raw in frame["total"].iloc[1:]:
        total += np.frombuffer(raw)
    return pd.DataFrame({"dim": frame["dim"].iloc[:1], "part": frame["part"].iloc[:1] // FAN_IN, "total": [total.tobytes()]})


def _over_tree(states: DataFrame, combine: Callable[[pd.DataFrame], pd.DataFrame], schema: str) -> DataFrame:
    """One state per length, from one per partition and length."""
    left = states.rdd.getNumPartitions()
    while True:
        states = states.groupBy("dim", F.floor(F.col("part") / FAN_IN)).applyInPandas(combine, schema)
        if left <= FAN_IN:
            return states
        left = -(-left // FAN_IN)


def _numbered(vectors: DataFrame) -> DataFrame:
    return vectors.select("embedding", F.spark_partition_id().cast("long").alias("part"))


def _summed(vectors: DataFrame, fits: dict[int, Whitening], values: Callable[[Whitening, np.ndarray], np.ndarray]) -> dict[int, np.ndarray]:
    """Per length, the sum over its vectors of (1, v)^T (1, v), v being ``values`` of the centred vector."""
    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[int, np.ndarray] = {}
        part = 0
        for batch in batches:
            if not len(batch):
                continue
            part = int(batch["part"].iloc[0])
            for dim, (_, x) in whole_vectors(batch["embedding"]).items():
                if dim not in fits:
                    continue
                v = values(fits[dim], fits[dim].centred(x)[0])
                v = np.concatenate([np.ones((len(v), 1)), v], axis=1)
                held[dim] = held.get(dim, 0) + v.T @ v
        for dim, total in held.items():
            yield pd.DataFrame({"dim": [dim], "part": [part], "total": [np.ascontiguousarray(total).tobytes()]})

    schema = "dim int, part long, total binary"
    found = _over_tree(_numbered(vectors).mapInPandas(sums, schema), _add_matrices, schema)
    out = {}
    for row in found.collect():  # one matrix per length
        total = np.frombuffer(row["total"])
        side = int(round(np.sqrt(len(total))))
        out[row["dim"]] = total.reshape(side, side)
    return out


def _covariance(total: np.ndarray) -> np.ndarray:
    n = total[0, 0]
    mean = total[0, 1:] / n
    return total[1:, 1:] / n - np.outer(mean, mean)


def incremental_spectra(vectors: DataFrame) -> dict[int, tuple[Spectrum, list[int]]]:
    """Per length, the combined spectrum of all partitions and the exact sums of x."""
    states = _numbered(vectors).mapInPandas(_partition_states, _STATE)
    return {row["dim"]: _unpack(row) for row in _over_tree(states, _merge_states, _STATE).collect()}


def fit_whitening(vectors: DataFrame) -> dict[int, Whitening]:
    """The fit over all ``vectors`` (column embedding), by length."""
    fits = {dim: Whitening(s.n, tuple(sums), np.linalg.qr(s.vectors[:, ::-1])[0], s.values[::-1] / s.n)
            for dim, (s, sums) in incremental_spectra(vectors).items()}
    if not fits:
        return {}
    projected = _summed(vectors, fits, lambda fit, centred: centred @ fit.components)
    for dim, total in projected.items():
        values, turn = np.linalg.eigh(_covariance(total))
        components = fits[dim].components @ turn[:, ::-1]
        largest = components[np.abs(components).argmax(axis=0), np.arange(dim)]
        fits[dim] = Whitening(fits[dim].n, fits[dim].sums, components * np.where(largest < 0, -1.0, 1.0), values[::-1])
    checked = _summed(vectors, fits, lambda fit, centred: fit.whiten(centred))
    out = {}
    for dim, fit in fits.items():
        got = _covariance(checked[dim])
        error = float(np.abs(got - np.eye(len(got))).max()) if len(got) else None
        out[dim] = Whitening(fit.n, fit.sums, fit.components, fit.variances, error)
    return out


def whiten(vectors: DataFrame, fits: dict[int, Whitening]) -> DataFrame:
    """Rows (vec_id, component, n, deviation, whitened, explained, identity_error) for every vector
    that remains and each of its components, up to 32."""
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for dim, (places, x) in whole_vectors(batch["embedding"]).items():
                if dim not in fits:
                    continue
                fit = fits[dim]
                centred, deviation = fit.centred(x)
                shown = len(fit.usable)
                values = np.full((len(x), shown), np.nan)
                values[:, fit.usable] = fit.whiten(centred)
                trace = float(fit.variances.sum())
                explained = np.maximum(fit.variances[:shown], 0) / trace if trace > 0 else np.full(shown, np.nan)
                frame = pd.DataFrame({
                    "component": np.tile(np.arange(1, shown + 1, dtype=np.int32), len(x)), "n": fit.n,
                    "whitened": values.ravel(), "explained": np.tile(explained, len(x)),
                    "identity_error": np.nan if fit.identity_error is None else fit.identity_error})
                frame.insert(0, "vec_id", batch["vec_id"].iloc[np.repeat(places, shown)].to_numpy())
                frame.insert(3, "deviation", pd.array(np.repeat(np.array(deviation, dtype=object), shown), dtype="Int64"))
                yield frame

    id_type = vectors.schema["vec_id"].dataType.simpleString()
    out = vectors.select("vec_id", "embedding").mapInPandas(
        rows, f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double")
    return out.withColumns({c: F.nanvl(F.col(c), F.lit(None).cast("double")) for c in ("whitened", "explained", "identity_error")})


def whitening_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All embeddings, whitened by the fit over all of them."""
    vectors = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return whiten(vectors, fit_whitening(vectors))
