"""Benchmark decontamination by greedy string tiling.

Both sides are lower-cased word sequences. A seed is a run of ``min_match`` words; its hash rolls
over the whole text (Karp-Rabin). Documents and benchmark items are joined on shared seeds; per
pair, greedy string tiling then marks, again and again, the longest matches whose words are all
unmarked, until none of ``min_match`` words is left. A match of any length is a run of seeds on
one diagonal, so the tiles come from the joined seed positions alone and no text is shuffled.
The share of an item's words under tiles is its coverage; reordered or interrupted passages keep
theirs. Pairs of at least ``threshold`` coverage are reported.

Items shorter than ``min_match`` words are matched whole: seeds of their length are rolled too.

The documents' seeds are looked up in the benchmark's while they are made, when the benchmark
has at most ``max_local_seeds`` seeds (a checked size). A larger benchmark is joined by a
shuffle on the seed instead, with the same result. A passage that a third of the documents hold
costs rows in proportion to its occurrences: seeds are grouped per (document, item) pair only.

Defined results: a null or empty text matches nothing, nor does an item without words; several
rows with one id are compared each for itself, the pair's largest coverage counts; a null
document id is an id like any other, null item ids likewise. Extra columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout.llm.common import WordHashes, content, free_name, read_table, rolling
from stockout.stage import write_stage

_WORD = re.compile(r"\w+")


@dataclass(frozen=True)
class TilingSettings:
    min_match: int = 5
    threshold: float = 0.5
    max_local_seeds: int = 2_000_000


def words_of(text: str | None) -> list[str]:
    return _WORD.findall(text.lower()) if text else []


_SEED = "h long, item_id long, item_at int, k int, n_words int"


def item_seeds(benchmark: DataFrame, settings: TilingSettings) -> DataFrame:
    """All seeds of all items: hash, item, position, length in words, words of the item."""
    def seeds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hash_words = WordHashes()
        for batch in batches:
            parts = []
            for item, text in zip(batch["item_id"], batch["text"], strict=True):
                words = words_of(text)
                if not words:
                    continue
                k = min(settings.min_match, len(words))
                h = rolling(hash_words(words), k)
                parts.append(pd.DataFrame({"h": h, "item_id": pd.array([None if pd.isna(item) else int(item)] * len(h),
                                                                       dtype="Int64"),
                                           "item_at": np.arange(len(h), dtype=np.int32),
                                           "k": np.int32(k), "n_words": np.int32(len(words))}))
            if parts:
                yield pd.concat(parts)

    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").distinct()
    return items.mapInPandas(seeds, _SEED)


def document_seeds(documents: DataFrame, lengths: list[int], known: np.ndarray | None) -> DataFrame:
    """Rows (doc_id, copy, h, at): the documents' seeds of each length; only those among
    ``known`` (sorted) where it is given. ``copy`` tells apart texts of one id."""
    def seeds(texts: pd.Series) -> pd.Series:
        hash_words = WordHashes()
        out = []
        for text in texts:
            words = words_of(text)
            found = []
            if words:
                hashes = hash_words(words)
                for k in lengths:
                    h = rolling(hashes, k)
                    at = np.arange(len(h))
                    if known is not None:
                        place = np.minimum(np.searchsorted(known, h), len(known) - 1)
                        hit = known[place] == h
                        h, at = h[hit], at[hit]
                    found += [{"h": int(a), "at": int(b)} for a, b in zip(h, at, strict=True)]
            out.append(found)
        return pd.Series(out)

    seed = F.pandas_udf(seeds, "array<struct<h:long,at:int>>")
    return (documents.select("doc_id", F.xxhash64(content()).alias("copy"), seed(F.col("text")).alias("seeds"))
            .where(F.size("seeds") > 0)
            .select("doc_id", "copy", F.explode("seeds").alias("s"))
            .select("doc_id", "copy", F.col("s.h").alias("h"), F.col("s.at").alias("at")))


def tile(matches: list[tuple[int, int]], k: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling over seed matches (document position, item position), each ``k``
    words long: tiles (document position, item position, words). Longest first, then by
    document and item position."""
    free = sorted(set(matches), key=lambda m: (m[0] - m[1], m[0]))
    marked_doc: set[int] = set()
    marked_item: set[int] = set()
    tiles = []
    while True:
        free = [m for m in free if not any(m[0] + j in marked_doc or m[1] + j in marked_item for j in range(k))]
        if not free:
            return tiles
        runs = []  # maximal matches: runs of seeds one word apart on a diagonal
        start, length = free[0], k
        for a, b in zip(free, free[1:], strict=False):
            if b == (a[0] + 1, a[1] + 1):
                length += 1
            else:
                runs.append((length, *start))
                start, length = b, k
        runs.append((length, *start))
        longest = max(r[0] for r in runs)
        for n, d, i in sorted(r for r in runs if r[0] == longest):
            if all(d + j not in marked_doc and i + j not in marked_item for j in range(n)):
                tiles.append((d, i, n))
                marked_doc.update(range(d, d + n))
                marked_item.update(range(i, i + n))


def _tiled() -> Column:
    def tiled(matches: pd.Series, k: pd.Series) -> pd.DataFrame:
        rows = [tile([(m["at"], m["item_at"]) for m in pairs], int(n)) for pairs, n in zip(matches, k, strict=True)]
        return pd.DataFrame({"n_tiles": [len(r) for r in rows], "covered": [sum(t[2] for t in r) for r in rows]})

    return F.pandas_udf(tiled, "n_tiles int, covered int")(F.col("matches"), F.col("k"))


def contaminated(documents: DataFrame, benchmark: DataFrame, settings: TilingSettings | None = None) -> DataFrame:
    """Rows (doc_id, copy, item_id, coverage, n_tiles, covered, n_words), one per pair whose
    coverage reaches the threshold."""
    settings = settings or TilingSettings()
    seeds = write_stage(item_seeds(benchmark, settings), "benchmark_seeds")
    stats = seeds.agg(F.count("*").alias("n"), F.collect_set("k").alias("lengths")).collect()[0]
    lengths = sorted(stats["lengths"])  # at most min_match different ones
    known = None
    if stats["n"] <= settings.max_local_seeds:
        known = np.sort(np.array([r["h"] for r in seeds.select("h").distinct().collect()], dtype=np.int64))
        if not len(known):
            lengths = []
    mine = document_seeds(documents, lengths, known)
    pairs = (mine.join(seeds, "h").groupBy("doc_id", "copy", "item_id", "k", "n_words")
             .agg(F.collect_set(F.struct("at", "item_at")).alias("matches")))
    # Too few seeds for the threshold even if none of them overlap.
    pairs = pairs.where(F.size("matches") * F.col("k") >= settings.threshold * F.col("n_words"))
    return (pairs.withColumn("t", _tiled())
            .withColumn("coverage", F.col("t.covered") / F.col("n_words"))
            .where(F.col("coverage") >= settings.threshold)
            .select("doc_id", "copy", "item_id", "coverage", "t.n_tiles", "t.covered", "n_words"))


def clean(documents: DataFrame, benchmark: DataFrame, settings: TilingSettings | None = None) -> DataFrame:
    """The documents that hold no benchmark item, unchanged."""
    bad_id, bad_copy = (free_name(n, documents.columns) for n in ("_bad_id", "_bad_copy"))
    bad = (contaminated(documents.select("doc_id", "text"), benchmark, settings)
           .select(F.col("doc_id").alias(bad_id), F.col("copy").alias(bad_copy)).distinct())
    return documents.join(bad, F.col("doc_id").eqNullSafe(F.col(bad_id))
                          & (F.xxhash64(content()) == F.col(bad_copy)), "left_anti")


def decontaminate_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every pair of a document and a benchmark item that it holds."""
    found = contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))
    return (found.groupBy("doc_id", "item_id", "n_words")
            .agg(F.max_by(F.struct("coverage", "n_tiles", "covered"),
                          F.struct(F.col("coverage"), -F.col("n_tiles"))).alias("best"))
            .select("doc_id", "item_id", "best.coverage", "best.n_tiles", "best.covered",
                    F.col("n_words").alias("item_words")))
