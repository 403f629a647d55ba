"""Substring deduplication by content-defined chunking with a gear rolling hash.

Each whole text is cut where the gear hash of the preceding bytes has zero low bits, so cuts
depend on the nearby content only and an insertion shifts none of the later ones. Chunks are
told apart by a 128-bit digest. A digest that occurs in several documents is a duplicate;
neighbouring duplicate chunks of a document are merged to a passage, and passages of at least
``min_words`` words are reported, with the first document that holds each.

The gear hash is computed for all positions at once (log2 of the window doublings over byte
arrays). Digests are counted with map-side partial aggregation, which keeps only the smallest
and largest document per digest, so a passage that a third of all documents share is a few rows
per task; only the occurrences of duplicate digests are shuffled further, and no list of a
digest's documents is ever made.

Defined results: null and empty texts have no chunks; rows with a null id are never compared; an
id that occurs on several rows is one document whose rows' chunks do not duplicate each other.
Positions are code points, end exclusive. Extra columns are never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockout.llm.common import read_table
from stockout.stage import write_stage


@dataclass(frozen=True)
class ChunkSettings:
    """Bytes of a chunk: at least ``min_bytes``, then on average ``2 ** mask_bits`` more, at most
    ``max_bytes``. A repeated passage of more than 50 words loses the chunks that reach over its
    ends, so ``min_words`` is half of that."""

    min_bytes: int = 24
    mask_bits: int = 4
    max_bytes: int = 128
    window: int = 32
    min_words: int = 25
    seed: int = 20_117


def gear_table(seed: int) -> np.ndarray:
    """256 fixed pseudo-random 32-bit values."""
    return np.random.default_rng(seed).integers(0, 2**32, 256, dtype=np.uint32)


def gear_hash(data: np.ndarray, table: np.ndarray, window: int) -> np.ndarray:
    """h[i] = sum over j < window of table[data[i - j]] << j, modulo 2 ** 32."""
    h = table[data]
    reach = 1
    while reach < window:
        shifted = np.zeros_like(h)
        shifted[reach:] = h[:-reach] << np.uint32(reach)
        h = h + shifted
        reach *= 2
    return h


def cut_points(data: np.ndarray, settings: ChunkSettings, table: np.ndarray) -> list[int]:
    """Ends of the chunks of one text's bytes, the last one its length. A cut never falls inside
    a character."""
    n = len(data)
    if n == 0:
        return []
    h = gear_hash(data, table, settings.window)
    # The top bits depend on the whole window, the low ones on a few bytes only.
    wanted = (h >> np.uint32(32 - settings.mask_bits)) == 0
    inside = np.zeros(n + 1, dtype=bool)
    inside[:n] = (data & 0xC0) == 0x80
    candidates = (np.flatnonzero(wanted) + 1).tolist()
    candidates = [c for c in candidates if not inside[c]]
    cuts, start, k = [], 0, 0
    while start < n:
        while k < len(candidates) and candidates[k] < start + settings.min_bytes:
            k += 1
        end = min(candidates[k] if k < len(candidates) else n, start + settings.max_bytes, n)
        while inside[end]:
            end += 1
        cuts.append(end)
        start = end
    return cuts


def chunk_text(text: str, settings: ChunkSettings, table: np.ndarray) -> list[tuple[int, int, int, int, int]]:
    """Chunks of one text: digest (two signed longs), start and end in code points, words that
    begin in it."""
    raw = text.encode("utf-8", "surrogatepass")
    data = np.frombuffer(raw, dtype=np.uint8)
    cuts = cut_points(data, settings, table)
    if not cuts:
        return []
    characters = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
    space = np.isin(data, np.frombuffer(b" \t\n\x0b\x0c\r", dtype=np.uint8))
    begins = ~space & np.concatenate([[True], space[:-1]])
    words = np.concatenate([[0], np.cumsum(begins)])
    ends = np.array(cuts)
    starts = np.concatenate([[0], ends[:-1]])
    out = []
    for s, e, c0, c1, w in zip(starts.tolist(), cuts, characters[starts].tolist(), characters[ends].tolist(),
                               (words[ends] - words[starts]).tolist(), strict=True):
        digest = xxhash.xxh3_128_digest(raw[s:e])
        out.append((int.from_bytes(digest[:8], "little", signed=True),
                    int.from_bytes(digest[8:], "little", signed=True), c0, c1, w))
    return out


_CHUNK = "doc_id long, d1 long, d2 long, place long"
_LENGTH, _WORDS = 2**10, 2**10  # a chunk has fewer code points and words than these


def chunks(documents: DataFrame, settings: ChunkSettings | None = None) -> DataFrame:
    """One row per chunk of every document with an id: its digest, and start, length and words
    packed to one number, as these rows are what is shuffled."""
    settings = settings or ChunkSettings()
    if not 0 < settings.min_bytes <= settings.max_bytes <= 1000:
        raise ValueError("chunks hold 1 to 1000 bytes")

    def frame(rows: list[tuple[int, int, int, int]]) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=["doc_id", "d1", "d2", "place"])

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        table = gear_table(settings.seed)
        for batch in batches:
            rows: list[tuple[int, int, int, int]] = []
            for doc, text in zip(batch["doc_id"].tolist(), batch["text"], strict=True):
                for d1, d2, start, end, words in chunk_text(text, settings, table) if text else ():
                    rows.append((int(doc), d1, d2, (start * _LENGTH + end - start) * _WORDS + words))
                if len(rows) >= 50_000:  # a batch of long texts is passed on in parts
                    yield frame(rows)
                    rows = []
            if rows:
                yield frame(rows)

    known = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").where("doc_id is not null")
    return known.mapInPandas(cut, _CHUNK)


def repeated_passages(documents: DataFrame, settings: ChunkSettings | None = None) -> DataFrame:
    """One row per passage of a document that other documents hold too: doc_id, start, end,
    n_words, first_doc_id (the smallest document with its first chunk) and is_copy (an earlier
    document holds all of its chunks)."""
    settings = settings or ChunkSettings()
    # Chunking is the costly part and both sides of the join need it: write it once.
    found = write_stage(chunks(documents, settings), "chunks")
    shared = (found.groupBy("d1", "d2").agg(F.min("doc_id").alias("first_doc_id"), F.max("doc_id").alias("last"))
              .where(F.col("first_doc_id") < F.col("last")).drop("last"))
    start = F.floor(F.col("place") / (_LENGTH * _WORDS))
    hits = (found.join(shared, ["d1", "d2"])
            .select("doc_id", start.alias("start"), (F.col("place") % _WORDS).alias("words"), "first_doc_id",
                    (start + F.floor(F.col("place") / _WORDS) % _LENGTH).alias("end")))
    # Neighbouring duplicate chunks touch: a passage begins where the chunk before ends earlier.
    in_order = Window.partitionBy("doc_id").orderBy("start", "end")
    begins = F.coalesce(F.lag("end").over(in_order) != F.col("start"), F.lit(True)).cast("int")
    runs = hits.withColumn("begins", begins).withColumn("run", F.sum("begins").over(in_order))
    return (runs.groupBy("doc_id", "run")
            .agg(F.min("start").alias("start"), F.max("end").alias("end"), F.sum("words").alias("n_words"),
                 F.min_by("first_doc_id", "start").alias("first_doc_id"),
                 F.min((F.col("first_doc_id") < F.col("doc_id")).cast("int")).alias("is_copy"))
            .where(F.col("n_words") >= settings.min_words)
            .select("doc_id", "start", "end", "n_words", "first_doc_id", (F.col("is_copy") == 1).alias("is_copy")))


def chunks_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every passage of a document that other documents repeat."""
    return repeated_passages(read_table(spark, sf_dir, "documents"))
