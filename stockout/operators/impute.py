"""Demand imputation: fill the censored cells of each group by matrix factorization.

Per group (broadcast x product): options are users, minutes are items, observed units are
ratings. Gates, in order: options whose every cell is 0 are left out of training and come
back as 0; a group without a censored cell, or with fewer than 5 observed cells, is left as
it is (censored cells stay empty); otherwise the rank is chosen per group by 5-fold
cross-validated mean absolute error over a grid, the model is refitted on all observed
cells, and censored cells get the prediction clipped to [0, the group's largest observed
value] and rounded half to even.

A group is bounded (its options x at most 2,880 minutes), so each group is solved whole by a
vectorised function after one shuffle by group. The model is mean + option bias + minute bias +
factors, fitted by alternating ridge regressions (``method="ridge"``), or factors alone, fitted by
stochastic gradient steps (``method="sgd"``, module ``sgd``); ``method="rank_one"`` is exact
arithmetic on relations (module ``rank_one``). Start and folds are drawn from the group's own
key over its sorted cells, so a group's result depends on its data alone: not on
partitions, the order of rows, the size of the cluster or what else is in the run.
"""

from __future__ import annotations

from dataclasses import dataclass, field

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockout.operators.grid import GROUP, OPTION
from stockout.operators.rank_one import RankOneSettings, impute_rank_one
from stockout.operators.sgd import SgdSettings, search

# Fixed values of the imputation: seed, fold count, minimum observed cells, number of rank
# candidates per group.
SEED = 23094
N_FOLDS = 5
MIN_OBSERVED = 5
N_RANK_CANDIDATES = 5

METHODS = ("ridge", "sgd", "rank_one")


@dataclass(frozen=True)
class ImputeSettings:
    """``method``: ridge, sgd or rank_one. ``reg_params``: ridge weights tried; ``max_iter``:
    alternations of one fit; ``sgd``, ``rank_one``: those of the other methods."""

    reg_params: tuple[float, ...] = (0.1, 0.01)
    max_iter: int = 10
    method: str = "ridge"
    sgd: SgdSettings = field(default_factory=SgdSettings)
    rank_one: RankOneSettings = field(default_factory=RankOneSettings)

    def __post_init__(self):
        if self.method not in METHODS:
            raise ValueError(f"method {self.method!r} is none of {METHODS}")


def _rank_pool(n: F.Column) -> F.Column:
    """Distinct floors of 5 evenly spaced points from n//5 + 1 to n - 1, ascending.
    The spacing is (stop - start) / 4, exact in binary floating point."""
    start = F.floor(n / N_RANK_CANDIDATES) + 1
    stop = n - 1
    points = F.transform(F.sequence(F.lit(0), F.lit(N_RANK_CANDIDATES - 1)),
                         lambda i: F.floor(start + i * (stop - start) / (N_RANK_CANDIDATES - 1)).cast("int"))
    return F.array_sort(F.array_distinct(points))


def train_set_profile(censored: DataFrame) -> DataFrame:
    """Per group: sizes of the training set and the gates and rank candidates derived from it;
    aggregated to options first, then to groups."""
    observed = ~F.col("is_censored")
    options = (censored.groupBy(*OPTION)
               .agg(F.count(F.when(observed, 1)).alias("observed"), F.count(F.when(~observed, 1)).alias("censored"),
                    F.max(F.when(observed, F.col("qty"))).alias("largest"),
                    (F.max(F.when(~observed | (F.col("qty") != 0), 1).otherwise(0)) == 0).alias("zero")))
    used = ~F.col("zero")
    trainable = (F.col("n_censored") >= 1) & (F.col("n_observed") >= MIN_OBSERVED)
    return (options.groupBy(*GROUP)
            .agg(F.count("*").alias("n_options"), F.count(F.when(F.col("zero"), 1)).alias("n_zero_options"),
                 F.count(F.when(used & (F.col("observed") > 0), 1)).alias("n_train_options"),
                 F.coalesce(F.sum(F.when(used, F.col("observed"))), F.lit(0)).alias("n_observed"),
                 F.coalesce(F.sum(F.when(used, F.col("censored"))), F.lit(0)).alias("n_censored"),
                 F.max(F.when(used, F.col("largest"))).alias("max_observed"))
            .withColumn("trainable", trainable)
            .withColumn("rank_pool", F.when(trainable, F.array_join(_rank_pool(F.col("n_train_options")), ","))))


def rank_candidates(n: int) -> list[int]:
    """The same candidates as :func:`_rank_pool`, each at least 1."""
    start, stop = n // N_RANK_CANDIDATES + 1, n - 1
    points = (start + i * (stop - start) / (N_RANK_CANDIDATES - 1) for i in range(N_RANK_CANDIDATES))
    return sorted({max(1, int(np.floor(x))) for x in points})


def _ridge_rows(ratings: np.ndarray, mask: np.ndarray, factors: np.ndarray, reg: float) -> np.ndarray:
    """Each row's factors given the columns' (ridge weight times its number of ratings)."""
    count = mask.sum(axis=1)
    gram = np.einsum("uc,ck,cl->ukl", mask, factors, factors)
    gram += (reg * np.maximum(count, 1))[:, None, None] * np.eye(factors.shape[1])
    return np.linalg.solve(gram, ((ratings * mask) @ factors)[:, :, None])[:, :, 0]


def factorize(ratings: np.ndarray, mask: np.ndarray, rank: int, reg: float, iterations: int,
              start: np.ndarray) -> np.ndarray:
    """Predictions for every cell of an option x minute matrix from its cells in ``mask``;
    ``start``: first minute factors. Options or minutes without a rating get no bias or factors."""
    mean = (ratings * mask).sum() / max(mask.sum(), 1)
    by_row, by_column = np.zeros(len(ratings)), np.zeros(ratings.shape[1])
    rows, columns = mask.sum(axis=1), mask.sum(axis=0)
    for _ in range(iterations):
        rest = (ratings - mean - by_column[None]) * mask
        by_row = rest.sum(axis=1) / np.maximum(rows * (1 + reg), 1)
        rest = (ratings - mean - by_row[:, None]) * mask
        by_column = rest.sum(axis=0) / np.maximum(columns * (1 + reg), 1)
    base = mean + by_row[:, None] + by_column[None]
    rest = (ratings - base) * mask
    q = start[:, :rank]
    p = np.zeros((len(ratings), rank))
    for _ in range(iterations):
        p = _ridge_rows(rest, mask, q, reg)
        q = _ridge_rows(rest.T, mask.T, p, reg)
    p[rows == 0] = 0
    q[columns == 0] = 0
    return base + p @ q.T


def impute_group(frame: pd.DataFrame, settings: ImputeSettings) -> np.ndarray:
    """Imputed units of one group's cells, in the frame's order; nan where a cell stays empty."""
    qty = frame["qty"].to_numpy(dtype=float)
    censored = frame["is_censored"].to_numpy(dtype=bool)
    out = np.where(censored, np.nan, qty)
    options, row = np.unique(frame["attr_prd_cd"].to_numpy(), return_inverse=True)
    _, column = np.unique(frame["ord_ts"].to_numpy(), return_inverse=True)
    busy = np.zeros(len(options), dtype=bool)
    np.logical_or.at(busy, row, censored | (qty != 0))
    out[~busy[row]] = 0.0
    train = np.flatnonzero(~censored & busy[row])
    if not (censored & busy[row]).any() or len(train) < MIN_OBSERVED:
        return out
    train = train[np.lexsort((column[train], row[train]))]
    key = [SEED, *(int(frame[c].iloc[0]) % 2**32 for c in GROUP)]
    rng = np.random.default_rng(key)
    fold = np.empty(len(train), dtype=int)
    fold[rng.permutation(len(train))] = np.arange(len(train)) % N_FOLDS
    ranks = rank_candidates(len(np.unique(row[train])))
    shape = (len(options), int(column.max()) + 1)
    ratings = np.zeros(shape)
    ratings[row[train], column[train]] = qty[train]
    solve = _solve_sgd if settings.method == "sgd" else _solve_ridge
    fill = np.flatnonzero(censored & busy[row])
    out[fill] = np.rint(solve(ratings, (row[train], column[train]), fold, ranks, rng, settings)[row[fill], column[fill]])
    return out


def _solve_sgd(ratings: np.ndarray, train: tuple[np.ndarray, np.ndarray], fold: np.ndarray, ranks: list[int],
               rng: np.random.Generator, settings: ImputeSettings) -> np.ndarray:
    starts = tuple(rng.normal(scale=settings.sgd.start_scale, size=(n, max(ranks))) for n in ratings.shape)
    return search(ratings, train, fold, N_FOLDS, ranks, ratings[train].max(), starts, settings.sgd)[1]


def _solve_ridge(ratings: np.ndarray, train: tuple[np.ndarray, np.ndarray], fold: np.ndarray, ranks: list[int],
                 rng: np.random.Generator, settings: ImputeSettings) -> np.ndarray:
    row, column = train
    start = rng.normal(scale=0.1, size=(ratings.shape[1], max(ranks)))
    qty = ratings[train]

    def predict(cells: np.ndarray, rank: int, reg: float) -> np.ndarray:
        mask = np.zeros(ratings.shape)
        mask[row[cells], column[cells]] = 1
        return np.clip(factorize(ratings, mask, rank, reg, settings.max_iter, start), 0, qty.max())

    errors = []
    for rank in ranks:
        for k, reg in enumerate(settings.reg_params):
            mae = []
            for f in range(N_FOLDS):
                held = np.flatnonzero(fold == f)
                got = predict(np.flatnonzero(fold != f), rank, reg)
                mae.append(np.abs(got[row[held], column[held]] - qty[held]).mean())
            errors.append((float(np.mean(mae)), k, rank))
    _, k, rank = min(errors)
    return predict(np.arange(len(fold)), rank, settings.reg_params[k])


def impute_demand(censored: DataFrame, settings: ImputeSettings | None = None) -> DataFrame:
    """The grid with ``qty_imputed``: observed units, predictions in censored cells of
    trainable groups, null in censored cells of untrainable groups, 0 for all-zero options."""
    settings = settings or ImputeSettings()
    if settings.method == "rank_one":
        return impute_rank_one(censored, settings.rank_one)
    cells = censored.select(*OPTION, "ord_ts", "qty", "is_censored", "broad_dt")

    def solve(frame: pd.DataFrame) -> pd.DataFrame:
        imputed = pd.Series(impute_group(frame, settings), index=frame.index)
        return frame.assign(qty_imputed=imputed.astype(object).where(imputed.notna(), None))

    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in cells.schema.fields)
    return cells.groupBy(*GROUP).applyInPandas(solve, f"{schema}, qty_imputed double")


def held_out_error(censored: DataFrame, methods: tuple[str, ...] = METHODS) -> DataFrame:
    """Per trainable group: observed cells held out (a fifth, by a hash of the cell) and the mean
    absolute error with which each method predicts them when they are treated as censored, beside the
    error of the group's mean. Groups in which that leaves too few cells to train have null errors."""
    hidden = F.pmod(F.xxhash64(F.lit(SEED), *OPTION, "ord_ts"), F.lit(N_FOLDS)) == 0
    busy = F.max(F.when(F.col("is_censored") | (F.col("qty") != 0), 1).otherwise(0)).over(Window.partitionBy(*OPTION)) == 1
    trial = (censored.withColumn("hidden", hidden & ~F.col("is_censored") & busy)
             .withColumn("was_censored", F.col("is_censored")).withColumn("is_censored", F.col("is_censored") | F.col("hidden")))
    group = Window.partitionBy(*GROUP)
    mean = F.avg(F.when(~F.col("is_censored") & busy, F.col("qty"))).over(group)
    truth = trial.withColumn("mean", mean).where("hidden").select(*OPTION, "ord_ts", F.col("qty").alias("truth"), "mean")
    out = truth
    for method in methods:
        got = impute_demand(trial, ImputeSettings(method=method)).where("is_censored")
        out = out.join(got.select(*OPTION, "ord_ts", F.col("qty_imputed").alias(method)), [*OPTION, "ord_ts"])
    error = lambda c: F.avg(F.abs(F.col(c) - F.col("truth"))).alias(f"mae_{c}")
    return out.groupBy(*GROUP).agg(F.count("*").alias("n_held"), *[error(c) for c in (*methods, "mean")])


def estimated_demand(imputed: DataFrame) -> DataFrame:
    """Per option: the sum of its imputed row (empty cells count as nothing)."""
    return (imputed.groupBy(*OPTION)
            .agg(F.coalesce(F.sum("qty_imputed"), F.lit(0.0)).cast("bigint").alias("estim_qty"),
                 F.sum(F.when(~F.col("is_censored"), F.col("qty"))).alias("observed_qty")))
