"""Quality classifier: a regularised quadratic discriminant over document statistics.

Every whole text is turned into a short vector of transformed statistics (logarithms of
counts, square roots of ratios) by an Arrow-batched function. The fit needs only the class sums
and cross products of those vectors, so it is one aggregation whose result has one row per
class. The driver shrinks each class covariance towards the pooled one and its diagonal,
factors it once (Cholesky), and the scores are differences of Mahalanobis log densities
computed from the cached factors.

Defined results: a null text counts as empty and is scored like any other; labels of one
document that disagree are ignored, repeated ones count once; null labels are ignored; rows
with a null id are scored but never learned from; without labelled rows of both classes every
score is 0.5. Extra columns of the documents are carried through by :func:`score_documents`
under their own names and never read.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout.llm.common import fold, free_name, read_table
from stockout.stage import write_stage

THRESHOLD = 0.3
HELD_OUT_FOLDS = 5


@dataclass(frozen=True)
class QdaSettings:
    """``to_pooled``: weight of the pooled covariance in a class covariance; ``to_diagonal``:
    weight of its diagonal; ``ridge``: variance added to every statistic.

    Gaussian tails make the log-density difference overconfident, so a slope and an intercept
    (a logistic fit of the label on that difference) turn it into the score. They are fitted
    on ``calibration_rows`` distinct labelled vectors at most, those of the smallest hash."""

    to_pooled: float = 0.1
    to_diagonal: float = 0.1
    ridge: float = 1e-4
    calibration_rows: int = 20_000


@dataclass(frozen=True)
class QdaModel:
    """Class means, inverse Cholesky factors, log determinants and log priors (class 0, 1)."""

    means: tuple[np.ndarray, np.ndarray]
    whiten: tuple[np.ndarray, np.ndarray]
    log_det: tuple[float, float]
    log_prior: tuple[float, float]
    slope: float = 1.0
    intercept: float = 0.0

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        side = []
        for c in (0, 1):
            # Statistic by statistic, so that a vector scores the same to the last bit wherever it stands.
            z, distance = np.zeros((len(x), len(self.whiten[c]))), np.zeros(len(x))
            for j in range(x.shape[1]):
                z += (x[:, j] - self.means[c][j])[:, None] * self.whiten[c][:, j]
            for j in range(z.shape[1]):
                distance += z[:, j] * z[:, j]
            side.append(self.log_prior[c] - 0.5 * (self.log_det[c] + distance))
        return side[1] - side[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        return _sigmoid(self.slope * self.log_odds(x) + self.intercept)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -500, 500)))


def calibrate(odds: np.ndarray, label: np.ndarray, times: np.ndarray | None = None) -> tuple[float, float]:
    """Slope (never negative) and intercept of a logistic fit of 0/1 ``label`` on ``odds``,
    each standing for ``times`` rows, by Newton steps. Both classes weigh the same; a small
    penalty keeps separable classes finite."""
    times = np.ones(len(odds)) if times is None else times
    scale = max(float((np.abs(odds) * times).sum() / times.sum()), 1e-9)
    x = np.column_stack([odds / scale, np.ones(len(odds))])
    weight = times * np.where(label == 1, 0.5 / max(times[label == 1].sum(), 1), 0.5 / max(times[label == 0].sum(), 1))
    penalty = 1e-4
    w = np.array([1.0, 0.0])

    def loss(w: np.ndarray) -> float:
        z = (x @ w) * np.where(label == 1, 1, -1)
        return float((weight * np.logaddexp(0, -z)).sum() + 0.5 * penalty * (w @ w))

    for _ in range(100):
        p = _sigmoid(x @ w)
        gradient = x.T @ (weight * (p - label)) + penalty * w
        hessian = (x * (weight * p * (1 - p))[:, None]).T @ x + penalty * np.eye(2)
        step, size = np.linalg.solve(hessian, gradient), 1.0
        while size > 1e-6 and loss(w - size * step) > loss(w):
            size /= 2
        w = w - size * step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]) / scale, 1e-9), float(w[1])


_BYTES = np.arange(256)
_SYMBOLS = np.isin(_BYTES, [b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,!?|"])
_DIGITS = np.isin(_BYTES, list(b"0123456789"))
_UPPER = np.isin(_BYTES, list(range(65, 91)))


def statistics(text: str | None) -> list[float]:
    """Transformed statistics of one whole text. Classes of characters are those of ASCII;
    any other character counts as a letter."""
    text = text or ""
    counts = np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), dtype=np.uint8), minlength=256)
    words = text.split()
    lines = [x for x in text.split("\n") if x]
    n_chars, n_words, n_lines = max(len(text), 1), max(len(words), 1), max(len(lines), 1)
    symbols, digits, upper = (float(counts[mask].sum()) for mask in (_SYMBOLS, _DIGITS, _UPPER))
    pipes, shouts, commas = (float(counts[ord(c)]) for c in "|!,")
    stops = float(counts[ord(".")] + counts[ord("?")])
    short = sum(1 for w in words if len(w) <= 3)
    return [
        math.log1p(len(words)),
        math.log1p(max(len(text) - symbols - pipes - digits, 0.0) / n_words),
        math.sqrt(symbols / n_chars), math.sqrt(pipes / n_chars),
        math.sqrt(digits / n_chars), math.sqrt(upper / n_chars),
        math.sqrt(stops / n_words), math.sqrt(shouts / n_words), math.sqrt(commas / n_words),
        math.sqrt(short / n_words),
        # Distinct words against the length, on a logarithmic scale as vocabulary grows with it.
        math.log1p(len(set(words))) / math.log1p(n_words),
        math.sqrt(len(set(lines)) / n_lines),
        math.log1p(len(words) / n_lines),
    ]


N_STATISTICS = len(statistics(""))


def features(documents: DataFrame, name: str) -> DataFrame:
    """``documents`` with one more column ``name``: the array of transformed statistics."""
    def vector(texts: pd.Series) -> pd.Series:
        return pd.Series([statistics(t) for t in texts], dtype=object)

    return documents.withColumn(name, F.pandas_udf(vector, "array<double>")(F.col("text")))


def clean_labels(labels: DataFrame, column: str = "quality") -> DataFrame:
    """One row (doc_id, label) per document with one undisputed 0/1 label."""
    return (labels.where(F.col("doc_id").isNotNull() & F.col(column).isin(0, 1))
            .groupBy("doc_id").agg(F.min(column).alias("label"), F.max(column).alias("top"))
            .where(F.col("label") == F.col("top")).select("doc_id", "label"))


def fit(vectors: DataFrame, settings: QdaSettings | None = None) -> QdaModel | None:
    """Fit on rows (x array<double>, label 0/1): one aggregation to sums and cross products
    per class, then a few small matrices on the driver and the calibration of the score.
    None unless both classes occur."""
    settings = settings or QdaSettings()
    d = N_STATISTICS
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    x = lambda i: F.col("x")[i]
    rows = {r["label"]: r for r in vectors.groupBy("label").agg(
        F.count("*").alias("n"),
        F.array(*[F.sum(x(i)) for i in range(d)]).alias("sums"),
        F.array(*[F.sum(x(i) * x(j)) for i, j in pairs]).alias("cross")).collect()}
    if set(rows) != {0, 1}:
        return None
    counts, means, covs = {}, {}, {}
    for c in (0, 1):
        counts[c] = rows[c]["n"]
        means[c] = np.array(rows[c]["sums"]) / counts[c]
        cross = np.zeros((d, d))
        for (i, j), v in zip(pairs, rows[c]["cross"], strict=True):
            cross[i, j] = cross[j, i] = v / counts[c]
        covs[c] = cross - np.outer(means[c], means[c])
    total = counts[0] + counts[1]
    pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / total
    whiten, log_det, prior = [], [], []
    for c in (0, 1):
        cov = (1 - settings.to_pooled) * covs[c] + settings.to_pooled * pooled
        cov = (1 - settings.to_diagonal) * cov + settings.to_diagonal * np.diag(np.diag(cov))
        cov = cov + settings.ridge * np.eye(d)
        factor = np.linalg.cholesky(cov)
        whiten.append(np.linalg.inv(factor))
        log_det.append(2.0 * float(np.log(np.diag(factor)).sum()))
        prior.append(float(np.log((counts[c] + 1.0) / (total + 2.0))))
    model = QdaModel((means[0], means[1]), tuple(whiten), tuple(log_det), tuple(prior))
    # Equal vectors are one row that counts as often as it occurs, so copies are no way round the bound.
    distinct = vectors.groupBy("x", "label").agg(F.count("*").alias("times"))
    sample = distinct.orderBy(F.xxhash64("x"), "label").limit(settings.calibration_rows).toPandas()
    if sample["label"].nunique() < 2:
        return model
    slope, intercept = calibrate(model.log_odds(np.stack(sample["x"].to_numpy())), sample["label"].to_numpy(),
                                 sample["times"].to_numpy(dtype=float))
    return replace(model, slope=slope, intercept=intercept)


def fit_documents(documents: DataFrame, labels: DataFrame, settings: QdaSettings | None = None) -> QdaModel | None:
    """Fit on the labelled documents outside the held-out fold. Only ids and vectors meet
    the labels, never texts."""
    vectors = features(documents.select("doc_id", "text"), "x").select("doc_id", "x")
    train = (vectors.where(fold("doc_id", HELD_OUT_FOLDS) != 0)
             .join(clean_labels(labels), "doc_id").select("x", "label"))
    return fit(write_stage(train, "quality_vectors"), settings)


def scorer(model: QdaModel | None):
    """Column function from a vector to its score."""
    if model is None:
        return lambda vector: F.lit(0.5)

    @F.pandas_udf("double")
    def score(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype=float)
        return pd.Series(model.score(np.stack(vectors.to_numpy())))

    return score


def score_documents(documents: DataFrame, model: QdaModel | None, name: str = "score") -> DataFrame:
    """``documents`` with their score in a new column ``name``."""
    scratch = free_name(f"{name}_vector", documents.columns)
    return features(documents, scratch).withColumn(name, scorer(model)(F.col(scratch))).drop(scratch)


def quality_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its quality score and decision."""
    documents = read_table(spark, sf_dir, "documents")
    model = fit_documents(documents, read_table(spark, sf_dir, "labels"))
    scored = score_documents(documents.select("doc_id", "text"), model)
    return scored.select("doc_id", (fold("doc_id", HELD_OUT_FOLDS) == 0).alias("held_out"), "score",
                         (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
