"""Give documents the values of their words without exploding them to one row per word.

The vocabulary of a corpus grows with it, so it can be neither broadcast nor held in one place;
one row per occurrence would be many times the corpus. Instead documents are dealt to chunks of
bounded size by a hash of id and text, their texts compressed. Each chunk lists its distinct
words, the words of all chunks are grouped and get their values once, and go back to the chunks
that hold them, where the documents are waiting. Both users of the dealt documents read the same
exchange.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockout.llm.common import content

#: Bytes of text per chunk. A chunk's documents, words and values are held by one task.
CHUNK_BYTES = 16 << 20
#: Distinct words that a task holds before it passes them on.
HELD_WORDS = 250_000


def deal(documents: DataFrame, columns: list[str], chunk_bytes: int = CHUNK_BYTES) -> tuple[DataFrame, int]:
    """Rows (chunk, ``columns``, packed), partitioned by chunk, and the number of chunks, which
    follows the bytes of all texts."""
    total = documents.select(F.sum(F.octet_length("text")).alias("n")).collect()[0]["n"] or 0
    n = max(1, -(-total // chunk_bytes))

    def pack(texts: pd.Series) -> pd.Series:
        packer = zstandard.ZstdCompressor(level=1)
        return pd.Series([packer.compress(t.encode("utf-8", "surrogatepass")) for t in texts])

    chunk = F.pmod(F.xxhash64("doc_id", "text"), F.lit(n)).cast("int")
    packed = F.pandas_udf(pack, "binary")(content()).alias("packed")
    return documents.select(chunk.alias("chunk"), *columns, packed).repartition("chunk"), n


def unpack(packed: bytes, reader: zstandard.ZstdDecompressor) -> str:
    return reader.decompress(packed).decode("utf-8", "surrogatepass")


def chunk_words(dealt: DataFrame, count_words: Callable[[pd.Series, str], dict[str, int]]) -> DataFrame:
    """Rows (chunk, word, n): per chunk, the summed counts that ``count_words`` gives for each of
    its documents (the row without its text, and the text). A word may have several rows."""
    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        reader = zstandard.ZstdDecompressor()
        held: dict[int, dict[str, int]] = {}
        size = 0

        def frames() -> Iterator[pd.DataFrame]:
            for chunk, counts in held.items():
                words = list(counts)
                for a in range(0, len(words), 100_000):
                    part = words[a:a + 100_000]
                    yield pd.DataFrame({"chunk": chunk, "word": part, "n": [counts[w] for w in part]})

        for batch in batches:
            for row in batch.itertuples(index=False):
                mine = held.setdefault(row.chunk, {})
                before = len(mine)
                for w, n in count_words(row, unpack(row.packed, reader)).items():
                    mine[w] = mine.get(w, 0) + n
                size += len(mine) - before
            if size > HELD_WORDS:
                yield from frames()
                held, size = {}, 0
        yield from frames()

    return dealt.mapInPandas(words, "chunk int, word string, n long")
