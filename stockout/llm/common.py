"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def free_name(name: str, taken: list[str]) -> str:
    """``name``, with underscores added until no column is called so (upper case or not)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def fold(row_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``. A null id counts as remainder 0, the held-out
    part, so nothing is learned from it."""
    column = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.coalesce(F.crc32(column.cast("string")) % n, F.lit(0))


def content(column: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(column), F.lit(""))


_BASE = np.uint64(0x9E3779B97F4A7C15)  # odd multiplier of the rolling hash


class WordHashes:
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, bound: int = 100_000):
        self.known: dict[str, int] = {}
        self.bound = bound

    def __call__(self, words: list[str]) -> np.ndarray:
        known = self.known
        if len(known) > self.bound:
            known.clear()
        for w in set(words):
            if w not in known:
                known[w] = xxhash.xxh3_64_intdigest(w.encode("utf-8", "surrogatepass"))
        return np.fromiter(map(known.__getitem__, words), dtype=np.uint64, count=len(words))


def rolling(hashes: np.ndarray, k: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``k`` words: sum of hash * base ** (k - 1 - j), modulo
    2 ** 64, as signed numbers; runs of different lengths never share a hash but by chance."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    out = np.full(n, np.uint64(k))
    for j in range(k):
        out = out * _BASE + hashes[j:j + n]
    out ^= out >> np.uint64(31)
    return out.view(np.int64)


def by_group(batches: Iterator[pd.DataFrame], keys: list[str]) -> Iterator[pd.DataFrame]:
    """The groups of batches that come sorted by ``keys``; a group may span batches."""
    rest = None
    for batch in batches:
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(frame):
            continue
        values = frame[keys].to_numpy()
        starts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1).tolist()]
        for a, b in zip(starts, starts[1:], strict=False):
            yield frame.iloc[a:b]
        rest = frame.iloc[starts[-1]:]
    if rest is not None and len(rest):
        yield rest
