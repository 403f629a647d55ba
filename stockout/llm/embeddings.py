"""Near duplicates among embeddings by cross-polytope hashing.

Vectors of one label are compared by cosine. Each is scaled to unit length, padded to a power of
two and rotated by three rounds of random signs and fast Hadamard transforms; the coordinate
largest in size, with its sign, names the nearest vertex of the cross-polytope. ``n_hashes``
vertices of independent rotations make the key of one of ``n_tables`` tables. Every vector is
indexed under its own key and probes the ``n_probes`` most likely keys (multiprobe), ranked by how
much smaller the probed coordinates are. Pairs that meet are verified by their exact cosine in
double precision.

Identical vectors are collapsed first. A bucket is verified block against block as matrix
products, so a bucket of any size is spread over many tasks, and a task returns only link counts
per vector and a spanning forest of the links it verified, never the pairs. A pair that meets in
several tables is counted where it meets first, which both vectors' keys tell.

Defined results: vectors that are null, zero, or hold a null or non-finite component, and
vectors with a null label or id, link with nothing (component_id is their own id); neither do
vectors of unequal length. Every row counts as a vector of its own, so repeated rows link each
other. Extra columns are never read.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout.llm.common import read_table
from stockout.llm.components import connected_components
from stockout.stage import write_stage


@dataclass(frozen=True)
class CrossPolytopeSettings:
    """With these tables, hashes and probes a pair at cosine 0.93 in 64 dimensions meets with
    probability 0.999, closer ones more often. ``block``: vectors of a bucket in one block."""

    threshold: float = 0.93
    n_tables: int = 4
    n_hashes: int = 2
    n_probes: int = 8
    block: int = 1024
    seed: int = 4099


def hadamard(x: np.ndarray) -> np.ndarray:
    """Orthonormal fast Walsh-Hadamard transform of each row; the row length is a power of two."""
    n, h = x.shape[1], 1
    while h < n:
        y = x.reshape(len(x), n // (2 * h), 2, h)
        x = np.stack([y[:, :, 0] + y[:, :, 1], y[:, :, 0] - y[:, :, 1]], axis=2).reshape(len(x), n)
        h *= 2
    return x / np.sqrt(n)


def probe_keys(unit: np.ndarray, s: CrossPolytopeSettings) -> np.ndarray:
    """Keys (vectors, tables, probes) of unit vectors of one length; the first probe is the
    vector's own key. Two vectors of unequal length never get the same key by intent only, so
    their length is a part of the bucket."""
    n, d = unit.shape
    size = 1 << max(d - 1, 1).bit_length()
    x = np.zeros((n, size))
    x[:, :d] = unit
    rng = np.random.default_rng([s.seed, size])
    keep = min(s.n_probes, 2 * size)
    ranks = np.array([c for c in itertools.product(range(keep), repeat=s.n_hashes) if np.prod(np.add(c, 1)) <= s.n_probes])
    out = np.zeros((n, s.n_tables, min(s.n_probes, len(ranks))), dtype=np.int64)
    for t in range(s.n_tables):
        loss = np.zeros((n, len(ranks)))
        key = np.zeros((n, len(ranks)), dtype=np.int64)
        for h in range(s.n_hashes):
            y = x
            for signs in rng.choice([-1.0, 1.0], size=(3, size)):
                y = hadamard(y * signs)
            vertices = np.concatenate([y, -y], axis=1)
            order = np.argsort(-vertices, axis=1, kind="stable")[:, :keep]
            value = np.take_along_axis(vertices, order, axis=1)
            loss += ((value[:, :1] - value) ** 2)[:, ranks[:, h]]
            key = key * (2 * size) + order[:, ranks[:, h]]
        best = np.argsort(loss, axis=1, kind="stable")[:, :out.shape[2]]
        out[:, t] = np.take_along_axis(key, best, axis=1)
    return out


def unit_vector(values) -> np.ndarray | None:
    """The vector at unit length in double precision; None if it cannot be compared."""
    if values is None:
        return None
    x = np.array([np.nan if v is None else v for v in values], dtype=np.float64)
    if not len(x) or not np.isfinite(x).all():
        return None
    x = x / max(np.abs(x).max(), np.finfo(float).tiny)  # squares of very large or small values stay finite
    norm = np.sqrt((x * x).sum())
    return x / norm if norm > 0 else None


def _units(vectors: DataFrame) -> DataFrame:
    """vec_id, label, dim, two digest numbers and the unit vector's bytes; null where a vector
    links with nothing."""
    def units(embedding: pd.Series) -> pd.DataFrame:
        rows = []
        for values in embedding:
            x = unit_vector(values)
            if x is None:
                rows.append((None, None, None, None))
                continue
            raw = x.tobytes()
            digest = xxhash.xxh3_128_digest(raw)
            rows.append((len(x), int.from_bytes(digest[:8], "little", signed=True),
                         int.from_bytes(digest[8:], "little", signed=True), raw))
        frame = pd.DataFrame(rows, columns=["dim", "d1", "d2", "unit"])
        return frame.astype({"dim": "Int64", "d1": "Int64", "d2": "Int64"})

    unit = F.pandas_udf(units, "dim long, d1 long, d2 long, unit binary")
    usable = F.when(F.col("vec_id").isNotNull() & F.col("label").isNotNull(), F.col("embedding"))
    return (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "label", unit(usable).alias("u"))
            .select("vec_id", "label", "u.*"))


def _keys(s: CrossPolytopeSettings):
    def keys(units: pd.Series) -> pd.Series:
        out = [b""] * len(units)
        by_size: dict[int, list[int]] = {}
        for k, raw in enumerate(units):
            by_size.setdefault(len(raw), []).append(k)
        for places in by_size.values():
            x = np.stack([np.frombuffer(units.iloc[k], dtype=np.float64) for k in places])
            for k, row in zip(places, probe_keys(x, s), strict=True):
                out[k] = row.astype("<i8").tobytes()
        return pd.Series(out)

    return F.pandas_udf(keys, "binary")


def _explode_keys(s: CrossPolytopeSettings):
    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            parts = []
            for rep, label, dim, raw in zip(batch["rep"], batch["label"], batch["dim"], batch["probes"], strict=True):
                keys = np.frombuffer(raw, dtype="<i8").reshape(s.n_tables, -1)
                n = keys.shape[1]
                parts.append(pd.DataFrame({
                    "rep": rep, "label": label, "dim": dim, "t": np.repeat(np.arange(s.n_tables, dtype=np.int32), n),
                    "bucket": keys.ravel(), "own": np.tile(np.arange(n) == 0, s.n_tables)}))
            if parts:
                yield pd.concat(parts)

    return rows


def _forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges from each node to the smallest node of its component, given links a-b."""
    nodes, index = np.unique(np.concatenate([a, b]), return_inverse=True)
    ia, ib = index[:len(a)], index[len(a):]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[ia], label[ib])
        new = label.copy()
        np.minimum.at(new, ia, low)
        np.minimum.at(new, ib, low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    other = label != np.arange(len(nodes))
    return nodes[other], nodes[label[other]]


def verify_block(t: int, ids: np.ndarray, counts: np.ndarray, units: np.ndarray, probes: np.ndarray,
                 index: np.ndarray, probing: np.ndarray, threshold: float) -> list[tuple[int, int | None, int]]:
    """Links between the indexed and the probing rows of one block pair of table ``t``, as rows
    (vector, None, links it gains) and (vector, other vector, 0) of a spanning forest. Links
    that an earlier table, or the other direction of this one, counts are left out."""
    q, i = np.nonzero(units[probing] @ units[index].T >= threshold)
    q, i = probing[q], index[i]
    keep = ids[q] != ids[i]
    q, i = q[keep], i[keep]
    own = probes[:, :, 0]
    for earlier in range(t):
        meets = ((probes[q, earlier] == own[i, earlier, None]).any(1)
                 | (probes[i, earlier] == own[q, earlier, None]).any(1))
        q, i = q[~meets], i[~meets]
    both = (probes[i, t] == own[q, t, None]).any(1)
    keep = ~both | (ids[q] < ids[i])
    q, i = q[keep], i[keep]
    if not len(q):
        return []
    gained = np.bincount(q, counts[i], len(ids)) + np.bincount(i, counts[q], len(ids))
    rows = [(int(ids[k]), None, int(gained[k])) for k in np.flatnonzero(gained)]
    return rows + [(int(a), int(b), 0) for a, b in zip(*_forest(ids[q], ids[i]), strict=True)]


_BLOCK_KEY = ["label", "dim", "t", "bucket", "bi", "bq"]


def _verify(s: CrossPolytopeSettings):
    def flush(frame: pd.DataFrame) -> list[tuple[int, int | None, int]]:
        codes = frame.groupby(_BLOCK_KEY, sort=False, dropna=False).ngroup().to_numpy()
        bounds = np.flatnonzero(np.diff(codes)) + 1
        ids, counts = frame["rep"].to_numpy(), frame["m"].to_numpy()
        indexed = frame["indexed"].to_numpy()
        tables, raw_units, raw_probes = frame["t"].to_numpy(), frame["unit"].tolist(), frame["probes"].tolist()
        out = []
        for a, b in zip([0, *bounds], [*bounds, len(frame)], strict=True):
            index, probing = np.flatnonzero(indexed[a:b]), np.flatnonzero(~indexed[a:b])
            if not len(index) or not len(probing):
                continue
            units = np.stack([np.frombuffer(x, dtype=np.float64) for x in raw_units[a:b]])
            probes = np.stack([np.frombuffer(x, dtype="<i8") for x in raw_probes[a:b]]).reshape(b - a, s.n_tables, -1)
            out += verify_block(int(tables[a]), ids[a:b], counts[a:b], units, probes, index, probing, s.threshold)
        return out

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by block pair; the last one of a batch may go on in the next."""
        rest = None
        for batch in batches:
            frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
            last = frame[_BLOCK_KEY].iloc[-1]
            open_from = len(frame) - int((frame[_BLOCK_KEY] == last).all(axis=1)[::-1].cummin().sum())
            rest = frame.iloc[open_from:]
            if open_from:
                yield pd.DataFrame(flush(frame.iloc[:open_from]), columns=["a", "b", "links"]).astype({"b": "Int64"})
        if rest is not None:
            yield pd.DataFrame(flush(rest), columns=["a", "b", "links"]).astype({"b": "Int64"})

    return verify


def near_duplicates(vectors: DataFrame, settings: CrossPolytopeSettings | None = None) -> DataFrame:
    """One row (vec_id, n_links, component_id, kept) per row of ``vectors`` (vec_id, embedding,
    label)."""
    s = settings or CrossPolytopeSettings()
    bucket = ["label", "dim", "t", "bucket"]
    units = write_stage(_units(vectors), "units")
    classes = ["label", "dim", "d1", "d2"]
    reps = (units.where(F.col("dim").isNotNull()).groupBy(*classes)
            .agg(F.min("vec_id").alias("low"), F.count("*").alias("m"), F.first("unit").alias("unit")))
    # An id may stand on rows of several classes, so classes go by a number; the table fixes it.
    reps = write_stage(reps.withColumn("rep", F.monotonically_increasing_id()).withColumn("probes", _keys(s)(F.col("unit"))),
                       "unit_classes")
    label_type = vectors.schema["label"].dataType.simpleString()
    places = reps.select("rep", "label", "dim", "probes").mapInPandas(
        _explode_keys(s), f"rep long, label {label_type}, dim long, t int, bucket long, own boolean")
    places = write_stage(places, "bucket_places")
    # Buckets in which somebody is indexed and somebody else probes, in blocks.
    sizes = (places.groupBy(*bucket).agg(F.count("*").alias("n"), F.sum(F.col("own").cast("int")).alias("n_own"))
             .where((F.col("n") > 1) & (F.col("n_own") > 0))
             .select(*bucket, F.ceil(F.col("n_own") / s.block).alias("nbi"), F.ceil(F.col("n") / s.block).alias("nbq")))
    met = places.join(sizes, bucket)
    mine = lambda n: F.pmod(F.xxhash64("rep"), n)
    upto = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), n - 1))
    indexed = (met.where("own").withColumn("bi", mine(F.col("nbi"))).withColumn("bq", upto(F.col("nbq")))
               .withColumn("indexed", F.lit(True)))
    probing = (met.withColumn("bq", mine(F.col("nbq"))).withColumn("bi", upto(F.col("nbi")))
               .withColumn("indexed", F.lit(False)))
    rows = (indexed.unionByName(probing).select("rep", *_BLOCK_KEY, "indexed")
            .join(reps.select("rep", "m", "unit", "probes"), "rep"))
    found = write_stage(rows.repartition(*_BLOCK_KEY).sortWithinPartitions(*_BLOCK_KEY)
                        .mapInPandas(_verify(s), "a long, b long, links long"), "embedding_links")
    links = found.where("b is null").groupBy(F.col("a").alias("rep")).agg(F.sum("links").alias("links"))
    comps = connected_components(found.where("b is not null").select("a", "b")).withColumnRenamed("node", "rep")
    lowest = comps.join(reps.select("rep", "low"), "rep").groupBy("component").agg(F.min("low").alias("component_id"))
    linked = (reps.select(*classes, "rep", "low", "m").join(links, "rep", "left")
              .join(comps, "rep", "left").join(lowest, "component", "left")
              .select(*classes, (F.coalesce("links", F.lit(0)) + F.col("m") - 1).alias("n_links"),
                      F.coalesce("component_id", "low").alias("component_id")))
    component = F.coalesce("component_id", "vec_id")
    return (units.drop("unit").join(linked, classes, "left")
            .select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                    F.coalesce(F.col("vec_id") == component, F.lit(True)).alias("kept")))


#: All pairs of one label, and their closure.
EMBEDDINGS_SQL = """
WITH RECURSIVE cast_rows AS (
    SELECT row_number() OVER () AS r, vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
),
usable AS MATERIALIZED (
    SELECT r, vec_id, label, e, sqrt(list_sum(list_transform(e, lambda x: x * x))) AS norm
    FROM cast_rows
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0
      AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0
),
linked AS MATERIALIZED (
    SELECT a.r, b.r AS other
    FROM usable a JOIN usable b ON a.label = b.label AND len(a.e) = len(b.e) AND a.r <> b.r
    WHERE list_dot_product(a.e, b.e) / (a.norm * b.norm) >= 0.93
),
reach(r, other) AS (
    SELECT r, r FROM usable
    UNION
    SELECT reach.r, linked.other FROM reach JOIN linked ON linked.r = reach.other
),
lowest AS (SELECT reach.r, min(u.vec_id) AS component_id FROM reach JOIN usable u ON u.r = reach.other GROUP BY reach.r),
degree AS (SELECT r, count(*) AS n FROM linked GROUP BY r)
SELECT c.vec_id, coalesce(d.n, 0) AS n_links, coalesce(l.component_id, c.vec_id) AS component_id,
       coalesce(c.vec_id = coalesce(l.component_id, c.vec_id), true) AS kept
FROM cast_rows c LEFT JOIN lowest l USING (r) LEFT JOIN degree d USING (r)
"""


def embeddings_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector with its links, its component and whether it stays."""
    return near_duplicates(read_table(spark, sf_dir, "embeddings"))
