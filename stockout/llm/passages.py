"""Exact repeated passages: every run of more than 50 words that another document holds too.

A document's words are hashed, and runs of words by a rolling hash. Runs of ``min_words`` words
(windows) that occur in several documents are what is asked for; one row per window of every
document would be one per word, so anchors find the places first: of the shorter runs (grams) in
each window the one of the smallest hash is taken (winnowing). The choice depends on the window's
words only, so two documents that share a window share an anchor, whatever stands around it.
Only the windows over shared anchors are then compared; shared windows of a document that overlap
or touch are merged to a passage. So every run of ``min_words`` words that another document
repeats lies in a reported passage, and each word of a passage lies in such a run.

Anchors and windows are counted with map-side partial aggregation that keeps the smallest and
largest document, so a passage that a third of all documents share is a few rows per task, and no
pairs of documents are made.

Defined results: words are what blanks and control white space separate and are compared as
written, the white space between them is not; null and empty texts hold no passages; rows with a
null id are never compared; rows of one id are one document, equal ones are reported once and
others each by itself. Positions are code points, end exclusive. Extra columns are never read.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import zstandard
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockout.llm.chunked import unpack
from stockout.llm.common import WordHashes, content, read_table, rolling
from stockout.stage import write_stage

_WORD = re.compile("[^ \t\n\x0b\x0c\r]+")
_HALF = 31  # a window's row and place, and its start and length, are the halves of one number each: a string is shorter


@dataclass(frozen=True)
class PassageSettings:
    """``min_words`` of a passage; ``gram``: words of an anchor, at most ``min_words``."""

    min_words: int = 51
    gram: int = 26


def anchors(hashes: np.ndarray, s: PassageSettings) -> np.ndarray:
    """Distinct hashes of the anchors of a document's word hashes."""
    grams = rolling(hashes, s.gram)
    width = s.min_words - s.gram + 1
    if len(grams) < width:
        return np.zeros(0, dtype=np.int64)
    return np.unique(np.lib.stride_tricks.sliding_window_view(grams, width).min(axis=1))


def anchored(hashes: np.ndarray, shared: np.ndarray, s: PassageSettings) -> np.ndarray:
    """Starts of the windows that hold a shared anchor."""
    n = len(hashes) - s.min_words + 1
    if n <= 0:
        return np.zeros(0, dtype=np.int64)
    at = np.flatnonzero(np.isin(rolling(hashes, s.gram), shared))
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, np.clip(at - (s.min_words - s.gram), 0, n), 1)
    np.add.at(change, np.clip(at + 1, 0, n), -1)
    return np.flatnonzero(np.cumsum(change)[:n] > 0)


def repeated_passages(documents: DataFrame, settings: PassageSettings | None = None) -> DataFrame:
    """One row per passage: doc_id, start, end, n_words, first_doc_id (the smallest document with
    its first window) and is_copy (an earlier document holds each of its windows)."""
    s = settings or PassageSettings()
    if not 0 < s.gram <= s.min_words:
        raise ValueError("an anchor has at least one word and at most those of a passage")
    known = (documents.select(F.col("doc_id").cast("long").alias("doc_id"), content().alias("text"))
             .where("doc_id is not null"))

    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hash_words = WordHashes()
        for batch in batches:
            found = [anchors(hash_words(_WORD.findall(t)), s) for t in batch["text"]]
            yield pd.DataFrame({"doc_id": np.repeat(batch["doc_id"].to_numpy(), [len(a) for a in found]),
                                "h": np.concatenate([np.zeros(0, dtype=np.int64), *found])})

    def several(rows: DataFrame) -> DataFrame:
        return (rows.groupBy("h").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"))
                .where("first_doc_id < last").drop("last"))

    found = write_stage(known.mapInPandas(find, "doc_id long, h long"), "anchors", compression="zstd")
    places = found.join(several(found).select("h"), "h").groupBy("doc_id").agg(F.collect_set("h").alias("shared"))

    def pack(texts: pd.Series) -> pd.Series:
        packer = zstandard.ZstdCompressor(level=1)
        return pd.Series([packer.compress(t.encode("utf-8", "surrogatepass")) for t in texts])

    texts = known.select("doc_id", F.xxhash64("text").alias("text_hash"),
                         F.pandas_udf(pack, "binary")("text").alias("packed"))
    rows = (texts.join(places, "doc_id").dropDuplicates(["doc_id", "text_hash"])
            .withColumn("row", F.row_number().over(Window.partitionBy("doc_id").orderBy("text_hash")))
            .select("doc_id", "row", "packed", "shared"))

    def open_(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        hash_words, reader = WordHashes(), zstandard.ZstdDecompressor()
        for batch in batches:
            for doc, row, packed, shared in zip(batch["doc_id"], batch["row"], batch["packed"], batch["shared"], strict=True):
                text = unpack(packed, reader)
                spans = np.array([m.span() for m in _WORD.finditer(text)], dtype=np.int64).reshape(-1, 2)
                hashes = hash_words([text[a:z] for a, z in spans.tolist()])
                windows = rolling(hashes, s.min_words)
                at = anchored(hashes, np.asarray(shared, dtype=np.int64), s)
                for k in range(0, len(at), 200_000):
                    part = at[k:k + 200_000]
                    start = spans[part, 0]
                    yield pd.DataFrame({"h": windows[part], "doc_id": doc, "at": (int(row) << _HALF) + part,
                                        "span": (start << _HALF) + spans[part + s.min_words - 1, 1] - start})

    # Every word may have a row here, so rows are few numbers, and those that follow each other pack well.
    windows = write_stage(rows.mapInPandas(open_, "h long, doc_id long, at long, span long"), "windows", compression="zstd")
    hits = windows.join(several(windows), "h")
    start = F.shiftright("span", _HALF)
    in_order = Window.partitionBy("doc_id").orderBy("at")
    begins = F.coalesce(F.col("at") - F.lag("at").over(in_order) > s.min_words, F.lit(True)).cast("int")
    runs = hits.withColumn("begins", begins).withColumn("run", F.sum("begins").over(in_order))
    return (runs.groupBy("doc_id", "run")
            .agg(F.min(start).alias("start"), F.max(start + F.col("span").bitwiseAND((1 << _HALF) - 1)).alias("end"),
                 (F.max("at") - F.min("at") + s.min_words).alias("n_words"),
                 F.min_by("first_doc_id", "at").alias("first_doc_id"),
                 F.min((F.col("first_doc_id") < F.col("doc_id")).cast("int")).alias("is_copy"))
            .select("doc_id", "start", "end", "n_words", "first_doc_id", (F.col("is_copy") == 1).alias("is_copy")))


def passages_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of more than 50 words of a document that other documents repeat."""
    return repeated_passages(read_table(spark, sf_dir, "documents"))
