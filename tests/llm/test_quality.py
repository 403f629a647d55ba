"""Quality classifier: figures on the held-out fold, fit against a dense computation, odd rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from stockout.llm import quality as Q

SF = "/root/testdata/sf0.01"


def test_held_out_accuracy_and_columns(spark):
    out = Q.quality_query(spark, "/root/testdata/sf0.1")
    assert out.columns[:4] == ["doc_id", "held_out", "score", "predicted"]
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
    rows = out.join(labels, "doc_id").where("held_out").collect()
    clean = [r["predicted"] for r in rows if r["quality"] == 1]
    junk = [r["predicted"] for r in rows if r["quality"] == 0]
    assert len(junk) > 50 and np.mean(clean) > 0.98 and np.mean(junk) < 0.05


def test_every_document_is_scored_and_split_by_crc(spark):
    import zlib

    rows = Q.quality_query(spark, SF).collect()
    assert len(rows) == spark.read.parquet(f"{SF}/documents.parquet").count()
    for r in rows:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
        assert 0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3)


def test_fit_matches_a_dense_computation(spark):
    rng = np.random.default_rng(3)
    d = Q.N_STATISTICS
    x = {c: rng.normal(c, 1 + c, (300, d)) for c in (0, 1)}
    data = [(row.tolist(), c) for c in (0, 1) for row in x[c]]
    s = Q.QdaSettings()
    model = Q.fit(spark.createDataFrame(data, "x array<double>, label int"), s)
    cov = {c: np.cov(x[c].T, bias=True) for c in (0, 1)}
    pooled = (cov[0] + cov[1]) / 2
    odds = {}
    probe = rng.normal(0.5, 2, (20, d))
    for c in (0, 1):
        m = (1 - s.to_pooled) * cov[c] + s.to_pooled * pooled
        m = (1 - s.to_diagonal) * m + s.to_diagonal * np.diag(np.diag(m)) + s.ridge * np.eye(d)
        diff = probe - x[c].mean(0)
        odds[c] = -0.5 * (np.linalg.slogdet(m)[1] + np.einsum("ij,jk,ik->i", diff, np.linalg.inv(m), diff))
    assert np.allclose(model.log_odds(probe), odds[1] - odds[0], rtol=1e-6)


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (1, 1), (2, None)]])
def test_one_class_or_disputed_labels(spark, labels):
    docs = spark.createDataFrame([(1, "a b"), (2, None), (None, "x " * 20_000)], "doc_id long, text string")
    model = Q.fit_documents(docs, spark.createDataFrame(labels, "doc_id long, quality int"))
    assert model is None
    assert [r["score"] for r in Q.score_documents(docs, model).collect()] == [0.5] * 3


def test_odd_rows_and_clashing_columns(spark):
    model = Q.fit_documents(spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet"))
    docs = spark.createDataFrame([(1, "a", "k"), (1, "a", "k"), (None, None, None), (3, "", "x"),
                                  (4, "é\n" * 100_000, "y")], "doc_id long, text string, x string")
    out = Q.score_documents(docs, model).collect()
    assert len(out) == 5 and all(0 <= r["score"] <= 1 for r in out)
    by_text = {r["text"]: r["score"] for r in out}
    assert by_text[None] == by_text[""]
    assert Q.score_documents(docs.limit(0), model).collect() == []


def test_labels_and_sources_are_not_inputs(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    model = Q.fit_documents(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    renamed = docs.withColumns({"lang": F.lit("zz"), "source": F.lit("q"), "doc_id": F.col("doc_id") + 7})
    score = lambda d: sorted(r["score"] for r in Q.score_documents(d, model).collect())
    assert score(docs) == score(renamed)


def test_calibration_rows_are_bounded_whatever_the_copies(spark, monkeypatch):
    seen = []
    real = Q.calibrate
    monkeypatch.setattr(Q, "calibrate", lambda odds, label, times: seen.append((len(odds), times.sum())) or real(odds, label, times))
    rows = [([float(k % 3 == j) + (k % 40) / 40 for j in range(Q.N_STATISTICS)], k % 2) for k in range(400)]
    vectors = spark.createDataFrame(rows, "x array<double>, label int")
    Q.fit(vectors, Q.QdaSettings(calibration_rows=30))
    Q.fit(vectors)
    assert seen[0][0] == 30 and seen[1][1] == 400 and seen[1][0] == 120
    odds = np.array([-2.0, -1, 1, 2, 0.5])
    label = np.array([0, 0, 1, 1, 0])
    assert np.allclose(real(odds, label, np.array([1.0, 2, 1, 3, 1])),
                       real(np.repeat(odds, [1, 2, 1, 3, 1]), np.repeat(label, [1, 2, 1, 3, 1])))
