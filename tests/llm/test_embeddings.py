"""Cross-polytope near duplicates against all pairs."""

import duckdb
import numpy as np
import pytest

from stockout.llm import embeddings as E


def test_hadamard_is_orthonormal():
    h = E.hadamard(np.eye(16))
    assert np.allclose(h @ h.T, np.eye(16)) and np.allclose(np.abs(h), 0.25)


def brute(rows, threshold=0.93):
    n = len(rows)
    units = [E.unit_vector(e) if i is not None and lab is not None else None for i, e, lab in rows]
    links = [[] for _ in range(n)]
    for a in range(n):
        for b in range(a):
            if (units[a] is not None and units[b] is not None and rows[a][2] == rows[b][2]
                    and len(units[a]) == len(units[b]) and units[a] @ units[b] >= threshold):
                links[a].append(b)
                links[b].append(a)
    out = []
    for a in range(n):
        seen, todo = {a}, [a]
        while todo:
            for b in links[todo.pop()]:
                if b not in seen:
                    seen.add(b)
                    todo.append(b)
        ids = [rows[k][0] for k in seen]
        comp = None if rows[a][0] is None else min(ids)
        out.append((rows[a][0], len(links[a]), comp, comp is None or rows[a][0] == comp))
    return out


def cluster(rng, centre, n, noise):
    return [centre + rng.normal(size=len(centre)) * noise for _ in range(n)]


@pytest.mark.parametrize("block", [1024, 16])
def test_links_and_components_match_all_pairs(spark, block):
    rng = np.random.default_rng(5)
    rows = []
    for label in (0, 1, None):
        for _ in range(40):
            rows.append((len(rows), rng.normal(size=20).tolist(), label))
        for n, noise in ((30, 0.05), (25, 0.2), (10, 0.3)):
            for v in cluster(rng, rng.normal(size=20), n, noise):
                rows.append((len(rows), v.tolist(), label))
    same = rows[0][1]
    rows += [(1000, same, 0), (1001, same, 0), (1002, same, 1), (1002, same, 1), (None, same, 0), (1003, None, 0),
             (1004, [0.0] * 20, 0), (1005, [None] + same[1:], 0), (1006, [float("nan")] + same[1:], 0),
             (1007, same[:10], 0), (1008, [], 0), (1009, [v * 1e300 for v in same], 0),
             (1010, [float("inf")] + same[1:], 0), (1011, [5.0], 0), (1012, [2.0], 0)]
    df = spark.createDataFrame([(*r, 1) for r in rows], "vec_id long, embedding array<double>, label int, rep int")
    got = E.near_duplicates(df, E.CrossPolytopeSettings(block=block, n_tables=8, n_probes=12)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_recall_on_the_test_table_with_planted_links(spark):
    rows = [(r["vec_id"], list(r["embedding"]), r["label"]) for r in
            spark.read.parquet("/root/testdata/sf0.01/embeddings.parquet").collect()]
    rng = np.random.default_rng(1)
    for k in range(150):  # partners at about the threshold
        v = np.array(rows[k][1])
        w = rng.normal(size=len(v))
        w -= (w @ v) * v / (v @ v)
        cos = 0.931 + 0.03 * rng.random()
        w = cos * v / np.linalg.norm(v) + np.sqrt(1 - cos ** 2) * w / np.linalg.norm(w)
        rows.append((10_000 + k, w.astype(np.float32).tolist(), rows[k][2]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int")
    got = {r["vec_id"]: r["n_links"] for r in E.near_duplicates(df).collect()}
    rows = [(r["vec_id"], r["embedding"], r["label"]) for r in df.collect()]
    expected = {r[0]: r[1] for r in brute(rows)}
    assert sum(expected.values()) >= 300
    assert all(got[k] <= expected[k] for k in expected) and sum(got.values()) >= 0.98 * sum(expected.values())


def test_ids_may_repeat_over_labels_and_vectors(spark):
    rng = np.random.default_rng(9)
    rows = [(5, [0.5, 1.0, 0.0, 0.0], "x"), (5, [0.0, 1.0, 0.0, 0.0], "y"), (7, [0.01, 1.0, 0.0, 0.0], "x"),
            (8, [1.0, 0.0, 0.0, 0.0], "x"), (8, [1.0, 0.1, 0.0, 0.0], "x"), (8, [1.0, 0.0, 0.0, 0.0], "x")]
    centres = [rng.normal(size=4) for _ in range(4)]
    for k in range(120):
        v = centres[k % 4] + rng.normal(size=4) * 0.15
        rows.append((int(rng.integers(9, 40)), v.tolist(), "xyz"[int(rng.integers(3))]))
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label string")
    got = E.near_duplicates(df, E.CrossPolytopeSettings(block=16, n_tables=12, n_probes=16)).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows), key=str)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute("CREATE VIEW embeddings AS SELECT * FROM read_parquet('/root/testdata/sf0.001/embeddings.parquet')")
    want = con.execute(E.EMBEDDINGS_SQL).fetchall()
    assert sorted(map(tuple, E.embeddings_query(spark, "/root/testdata/sf0.001").collect())) == sorted(want)


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert E.near_duplicates(df).collect() == []
