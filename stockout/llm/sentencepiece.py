"""SentencePiece encoding and decoding on a relational lattice.

Texts are split to segments at places that no piece of the table spans (before a run of blanks,
between letters and other characters; checked when the table is loaded). The distinct segments
of the corpus are encoded as tables: substrings of bounded length are exploded, equi-joined to
the piece table, and the joined edges grouped by segment; a fold by Spark's higher-order
functions then picks the segmentation. Documents get their segments' ids back chunk by chunk
(:mod:`stockout.llm.chunked`).

Two folds read the same lattice. ``viterbi`` takes the path of the largest sum of scores, as a
unigram model does. ``merges`` joins neighbouring symbols, best score first, leftmost of equals,
as a byte-pair model does; for such a model the best path is not what its library encodes, so
the registered query, whose vocabulary is one, folds merges. Boundaries are the bits of one
number, so a segment in the fold has at most 61 characters; longer ones (no blank, no change
between letters and others) are merged by a heap in a Python function over the same pieces.

Characters without a piece become the pieces of their UTF-8 bytes. Decoding joins pieces and
bytes and turns the blank mark to blanks, less the one put first.

Defined results: a null or empty text has no ids and decodes to the empty text; a text that
holds the blank mark itself decodes to blanks (``round_trip`` false); repeated rows each get a
row; a null id is kept. Extra columns are never read.
"""

from __future__ import annotations

import heapq
import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from stockout.llm.chunked import deal, unpack
from stockout.llm.common import read_table

MARK = "▁"  # stands for a blank
PARTS_PER_CHUNK = 8
FOLD_EDGES = 100_000  # edges that are folded together
MAX_FOLD = 61  # bits 0 to 61 of a signed 64-bit number


@dataclass(frozen=True)
class PieceTable:
    """Pieces by id with their scores (None where an id is no ordinary piece), and the ids of
    the 256 byte pieces."""

    pieces: tuple[str | None, ...]
    scores: tuple[float, ...]
    byte_ids: tuple[int, ...]

    def __post_init__(self) -> None:
        pattern = self.segmenter()
        for p in self.pieces:
            if p and pattern.findall(p) != [p]:
                raise ValueError(f"piece {p!r} spans a segment boundary")

    def segmenter(self) -> re.Pattern:
        """Finds segments of a marked text: blanks, then letters or other characters. Numbers
        that the expression's letter class holds (raised digits, fractions) are none."""
        numbers = {c for p in self.pieces for c in p or "" if not c.isalpha() and re.match(r"[^\W\d_]", c)}
        letter = f"[^\\W\\d_{MARK}{''.join(sorted(numbers))}]"
        return re.compile(f"{MARK}*(?:{letter}+|(?:(?!{letter})[^{MARK}])+)|{MARK}+")

    @property
    def longest(self) -> int:
        return max((len(p) for p in self.pieces if p), default=1)

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [(p, s, i) for i, (p, s) in enumerate(zip(self.pieces, self.scores, strict=True)) if p]
        return spark.createDataFrame(rows, "piece string, score double, id int")


def load_pieces(model_file: str) -> PieceTable:
    """The piece table of a SentencePiece model file with byte pieces."""
    from sentencepiece import SentencePieceProcessor

    sp = SentencePieceProcessor(model_file=model_file)
    every = range(sp.get_piece_size())
    special = [sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i) for i in every]
    return PieceTable(tuple(None if special[i] else sp.id_to_piece(i) for i in every),
                      tuple(sp.get_score(i) for i in every),
                      tuple(sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)))


def default_model() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


def segments(text: str, pattern: re.Pattern) -> list[str]:
    """Segments of a text, blanks marked and one put first."""
    return pattern.findall(MARK + text.replace(" ", MARK)) if text else []


# --- the lattice, as tables ------------------------------------------------------------

def _substrings(words: DataFrame, longest: int, most: int | None) -> DataFrame:
    """``words`` with start, len and piece: every substring of at most ``longest`` characters; of a
    word of more than ``most`` characters only one row of length 0."""
    n = F.length("word")
    fits = n <= most if most else F.lit(True)
    nothing = F.array(F.lit(0))
    starts = F.when(fits, F.sequence(F.lit(0), n - 1)).otherwise(nothing)
    lengths = F.when(fits, F.sequence(F.lit(1), F.least(F.lit(longest), n - F.col("start")))).otherwise(nothing)
    return (words.select("*", F.explode(starts).alias("start")).select("*", F.explode(lengths).alias("len"))
            .withColumn("piece", F.substring(F.col("word"), F.col("start") + 1, F.col("len"))))


def _byte_ids(table: PieceTable, text: Column) -> Column:
    ids = F.array(*[F.lit(i) for i in table.byte_ids])
    raw = F.encode(text, "UTF-8")
    return F.transform(F.sequence(F.lit(0), F.octet_length(raw) - 1), lambda i: F.element_at(
        ids, F.conv(F.substring(F.hex(raw), i * 2 + 1, F.lit(2)), 16, 10).cast("int") + 1))


def lattice(words: DataFrame, table: PieceTable) -> DataFrame:
    """Rows (word, edges): for every substring of a word that is a piece, an edge (rank, start,
    len, ids); rank is the negative score. Characters without a piece have an edge of their
    bytes' ids, with a null rank."""
    # The vocabulary is a fixed file of some ten thousand rows, whatever the corpus.
    pieces = F.broadcast(table.frame(words.sparkSession))
    met = (_substrings(words, table.longest, None).join(pieces, "piece", "left")
           .where((F.col("len") == 1) | F.col("id").isNotNull()))
    ids = F.when(F.col("id").isNotNull(), F.array("id")).otherwise(_byte_ids(table, F.col("piece")))
    edge = F.struct((-F.col("score")).alias("rank"), "start", "len", ids.alias("ids"))
    return met.groupBy("word").agg(F.array_sort(F.collect_list(edge)).alias("edges"))


# An edge of a word of at most MAX_FOLD characters as one number: the place of its score among
# all scores, best first; its start; its length; its id. Numbers sort by score, then start.
_ID_BITS, _LEN_BITS, _START_BITS = 20, 6, 6
_NO_PIECE = (1 << _ID_BITS) - 1


def packed_edges(words: DataFrame, table: PieceTable) -> DataFrame:
    """Edges as in :func:`lattice`, each one number in a row of its own: (n, edge, word, other columns of
    ``words``). ``n`` numbers the words, and a partition's rows are sorted by it. The edge of a word's
    first character alone carries the word and its other columns. A word of more than ``MAX_FOLD``
    characters and a null have one edge, of length 0."""
    others = [c for c in words.columns if c != "word"]
    order = sorted({-s for p, s in zip(table.pieces, table.scores, strict=True) if p})
    if len(table.pieces) >= _NO_PIECE:
        raise ValueError("too many pieces")
    place = {x: k for k, x in enumerate(order)}
    rows = [(p, (place[-s] << (_START_BITS + _LEN_BITS + _ID_BITS)) + i)
            for i, (p, s) in enumerate(zip(table.pieces, table.scores, strict=True)) if p]
    # The vocabulary is a fixed file of some ten thousand rows, whatever the corpus.
    pieces = F.broadcast(words.sparkSession.createDataFrame(rows, "piece string, value long"))
    met = (_substrings(words.withColumn("n", F.monotonically_increasing_id()), table.longest, MAX_FOLD)
           .join(pieces, "piece", "left").where((F.col("len") <= 1) | F.col("value").isNotNull()))
    edge = (F.coalesce(F.col("value"), F.lit(_NO_PIECE)) + F.shiftleft(F.col("start").cast("long"), _LEN_BITS + _ID_BITS)
            + F.shiftleft(F.col("len").cast("long"), _ID_BITS))
    first = (F.col("start") == 0) & (F.col("len") <= 1)
    return (met.select("n", edge.alias("edge"), *[F.when(first, F.col(c)).alias(c) for c in ["word", *others]])
            .sortWithinPartitions("n"))


def fold_merges(word: np.ndarray, edge: np.ndarray, n_words: int) -> np.ndarray:
    """Places of the edges that are the words' symbols in the end, word by word from left to right.
    ``edge`` are packed edges and ``word`` the number of each one's word. Neighbours are merged best score
    first, leftmost of equals; every word makes its next merge in the same step. The set bits of a word's
    mask are the boundaries between its symbols."""
    bit = lambda n: np.int64(1) << n
    start = (edge >> (_ID_BITS + _LEN_BITS)) & ((1 << _START_BITS) - 1)
    size = (edge >> _ID_BITS) & ((1 << _LEN_BITS) - 1)
    ends = bit(start) + bit(start + size)
    inner = bit(start + size) - bit(start + 1)
    mask = np.zeros(n_words, dtype=np.int64)
    np.bitwise_or.at(mask, word, ends)
    joins = np.flatnonzero(size > 1)
    joins = joins[np.lexsort((edge[joins], word[joins]))]
    while len(joins):
        now = mask[word[joins]]
        inside = np.bitwise_count(now & inner[joins])
        # Boundaries only go: what spans none any more, or has lost an end, never joins again.
        open_ = ((now & ends[joins]) == ends[joins]) & (inside > 0)
        joins, inside = joins[open_], inside[open_]
        ready = joins[inside == 1]
        if not len(ready):
            break
        best = ready[np.flatnonzero(np.diff(word[ready], prepend=-1))]
        mask[word[best]] &= ~inner[best]
        moved = np.zeros(n_words, dtype=bool)
        moved[word[best]] = True
        joins = joins[moved[word[joins]]]
    now = mask[word]
    symbols = np.flatnonzero((size > 0) & ((now & ends) == ends) & ((now & inner) == 0))
    return symbols[np.lexsort((start[symbols], word[symbols]))]


def _ids_of(rows: pa.Table, table: PieceTable, ranks: dict[str, tuple[float, int]], longest: int) -> pa.Table:
    """Whole words' rows of :func:`packed_edges`: one row per word, with its other columns and its ids."""
    n, edge = rows["n"].to_numpy(), rows["edge"].to_numpy()
    word = np.cumsum(np.diff(n, prepend=n[:1]) != 0)
    first = (edge >> _ID_BITS) & ((1 << (_LEN_BITS + _START_BITS)) - 1) <= 1
    out = rows.filter(pa.array(first)).drop_columns(["n", "edge"])
    symbols = fold_merges(word, edge, out.num_rows)
    owner, ids = word[symbols], edge[symbols] & _NO_PIECE
    text = out["word"]
    place = (edge[symbols] >> (_ID_BITS + _LEN_BITS)) & ((1 << _START_BITS) - 1)
    more: list[tuple[int, int, list[int]]] = []  # word, place in it, ids
    unknown = ids == _NO_PIECE
    for w, at in zip(owner[unknown].tolist(), place[unknown].tolist(), strict=True):
        more.append((w, at, [table.byte_ids[b] for b in text[w].as_py()[at].encode("utf-8", "surrogatepass")]))
    for w in word[(edge >> _ID_BITS) & ((1 << _LEN_BITS) - 1) == 0].tolist():
        if text[w].is_valid:
            more.append((w, 0, merge_long(text[w].as_py(), ranks, table.byte_ids, longest)))
    if more:
        at = np.concatenate([place[~unknown], *[np.full(len(x), k) for _, k, x in more]])
        owner = np.concatenate([owner[~unknown], *[np.full(len(x), w) for w, _, x in more]])
        ids = np.concatenate([ids[~unknown], *[np.array(x) for _, _, x in more]])
        order = np.lexsort((at, owner))
        owner, ids = owner[order], ids[order]
    ends = np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=out.num_rows))])
    return out.append_column("ids", pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(ids, pa.int32())))


def _merged(batches: Iterator[pa.RecordBatch], table: PieceTable) -> Iterator[pa.Table]:
    """The words' rows, with ids, of a partition of :func:`packed_edges`."""
    ranks = {p: (-s, i) for i, (p, s) in enumerate(zip(table.pieces, table.scores, strict=True)) if p}
    longest = table.longest
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(len(b) for b in held) < FOLD_EDGES:
            continue
        rows = pa.Table.from_batches(held).combine_chunks()
        n = rows["n"].to_numpy()
        cut = int(np.searchsorted(n, n[-1]))  # the last word may go on
        if cut:
            yield _ids_of(rows.slice(0, cut), table, ranks, longest)
        held = rows.slice(cut).to_batches()
    if held:
        yield _ids_of(pa.Table.from_batches(held).combine_chunks(), table, ranks, longest)


def fold_viterbi(edges: Column, n: Column, unknown_rank: float = 1e6) -> Column:
    """Ids of the path of a word with the smallest sum of ranks (largest of scores); of equal
    paths the one whose ids sort first. A character without a piece costs ``unknown_rank``."""
    empty = F.expr("array(named_struct('cost', cast(0 as double), 'ids', cast(array() as array<int>)))")

    def step(paths: Column, end: Column) -> Column:
        arriving = F.transform(F.filter(edges, lambda e: e["start"] + e["len"] == end), lambda e: F.struct(
            (paths[e["start"]]["cost"] + F.coalesce(e["rank"], F.lit(unknown_rank))).alias("cost"),
            F.concat(paths[e["start"]]["ids"], e["ids"]).alias("ids")))
        return F.concat(paths, F.slice(F.array_sort(arriving), 1, 1))

    return F.aggregate(F.slice(F.sequence(F.lit(0), n), F.lit(2), n), empty, step,
                       lambda paths: F.element_at(paths, -1)["ids"])


def merge_long(word: str, ranks: dict[str, tuple[float, int]], byte_ids: tuple[int, ...], longest: int) -> list[int]:
    """The same merges by a heap, for words too long for the fold."""
    n = len(word)
    left, right, alive = list(range(-1, n - 1)), list(range(1, n + 1)), [True] * n
    symbol = list(word)
    heap: list[tuple[float, int, int]] = []

    def propose(a: int) -> None:
        b = right[a]
        if a >= 0 and b < n:
            both = symbol[a] + symbol[b]
            if len(both) <= longest and both in ranks:
                heapq.heappush(heap, (ranks[both][0], a, len(both)))

    for a in range(n):
        propose(a)
    while heap:
        _, a, size = heapq.heappop(heap)
        if not alive[a] or right[a] >= n or len(symbol[a]) + len(symbol[right[a]]) != size:
            continue
        b = right[a]
        symbol[a] += symbol[b]
        alive[b] = False
        right[a] = right[b]
        if right[b] < n:
            left[right[b]] = a
        propose(a)
        if left[a] >= 0:
            propose(left[a])
    out: list[int] = []
    a = 0
    while a < n:
        if symbol[a] in ranks:
            out.append(ranks[symbol[a]][1])
        else:
            out += [byte_ids[b] for b in symbol[a].encode("utf-8", "surrogatepass")]
        a = right[a]
    return out


def encode_words(words: DataFrame, table: PieceTable, fold: str = "merges") -> DataFrame:
    """Distinct ``words`` (word, any other columns) with their ids."""
    others = [c for c in words.columns if c != "word"]
    if fold == "viterbi":
        found = lattice(words.select("word"), table)
        return words.join(found, "word").select("word", *others, fold_viterbi(F.col("edges"), F.length("word")).alias("ids"))

    def fold_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for words in _merged(batches, table):
            yield from words.select(["word", *others, "ids"]).to_batches()

    schema = words.select("word", *others).schema.add("ids", ArrayType(IntegerType()))
    return packed_edges(words, table).mapInArrow(fold_rows, schema)


# --- documents -------------------------------------------------------------------------

def decode_ids(ids: np.ndarray, parts: list[bytes]) -> str:
    """Text of ids, given every id's bytes."""
    text = b"".join(map(parts.__getitem__, ids.tolist())).decode("utf-8", "surrogatepass")
    return text.replace(MARK, " ")[1:]


def id_bytes(table: PieceTable) -> list[bytes]:
    parts = [(p or "").encode("utf-8") for p in table.pieces]
    for b, i in enumerate(table.byte_ids):
        parts[i] = bytes([b])
    return parts


def encode_chunk(docs: pa.Table, words: pa.Table, parts: list[bytes], pattern: re.Pattern) -> pa.Table:
    """Documents (doc_id, packed) of a chunk with the ids of its ``words`` (word, ids). The words' ids
    stay one array, as a chunk has some hundred thousand words and a task holds them all."""
    reader = zstandard.ZstdDecompressor()
    number = {w: k for k, w in enumerate(words["word"].to_pandas())}
    flat = pc.list_flatten(words["ids"]).to_numpy()
    size = pc.list_value_length(words["ids"]).to_numpy().astype(np.int64)
    first = np.cumsum(size) - size
    out, same = [np.zeros(0, dtype=np.int32)], []
    for packed in docs["packed"]:
        text = unpack(packed.as_py(), reader)
        found = segments(text, pattern)
        word = np.fromiter(map(number.__getitem__, found), np.int64, len(found))
        n = size[word]
        out.append(flat[np.repeat(first[word] - (np.cumsum(n) - n), n) + np.arange(n.sum())])
        same.append(decode_ids(out[-1], parts) == text)
    lengths = [len(x) for x in out]
    ids = pa.ListArray.from_arrays(pa.array(np.cumsum(lengths), pa.int32()), pa.array(np.concatenate(out), pa.int32()))
    return pa.table({"doc_id": docs["doc_id"], "ids": ids, "n_tokens": pa.array(lengths[1:], pa.int32()),
                     "round_trip": pa.array(same, pa.bool_())})


# Words and their ids travel in packets, one per chunk and part of the vocabulary: lists compress to a
# fraction of what a row per word takes.

def pack_words(words: list[bytes]) -> bytes:
    lengths = np.fromiter(map(len, words), "<u4", len(words))
    return zstandard.ZstdCompressor(level=3).compress(np.uint32(len(words)).tobytes() + lengths.tobytes() + b"".join(words))


def unpack_words(raw: bytes) -> pa.Array:
    data = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(data, "<u4", n, 4))]).astype("<i4")
    return pa.Array.from_buffers(pa.string(), n, [None, pa.py_buffer(ends), pa.py_buffer(data[4 + 4 * n:])])


def pack_ids(sizes: np.ndarray, ids: np.ndarray) -> bytes:
    planes = [np.uint32(len(sizes)), sizes.astype("<u4"), (ids & 0xFFFF).astype("<u2"), (ids >> 16).astype("<u2")]
    return zstandard.ZstdCompressor(level=3).compress(b"".join(x.tobytes() for x in planes))


def unpack_ids(raw: bytes) -> pa.Array:
    data = zstandard.ZstdDecompressor().decompress(raw)
    n = int(np.frombuffer(data, "<u4", 1)[0])
    ends = np.concatenate([[0], np.cumsum(np.frombuffer(data, "<u4", n, 4))])
    low, high = np.frombuffer(data, "<u2", offset=4 + 4 * n).astype(np.int32).reshape(2, -1)
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(low | high << 16, pa.int32()))


def _list_words(docs: pa.Table, pattern: re.Pattern, n_parts: int) -> pa.Table:
    """A chunk's distinct words, packed by part."""
    reader, found = zstandard.ZstdDecompressor(), set()
    for packed in docs["packed"]:
        found.update(segments(unpack(packed.as_py(), reader), pattern))
    words = sorted(w.encode("utf-8", "surrogatepass") for w in found)
    part = np.fromiter(map(zlib.crc32, words), np.int64, len(words)) % n_parts
    order = np.argsort(part, kind="stable")
    parts, first = np.unique(part[order], return_index=True)
    packets = [pack_words([words[i] for i in order[a:z].tolist()])
               for a, z in zip(first.tolist(), [*first.tolist()[1:], len(words)], strict=True)]
    return pa.table({"part": pa.array(parts, pa.int32()), "chunk": pa.array([docs["chunk"][0].as_py()] * len(parts), pa.int32()),
                     "words": pa.array(packets, pa.binary())})


def _distinct_words(listed: pa.Table) -> pa.Table:
    """A part's distinct words, a row each, then its packets, a row each whose word is null."""
    words = pc.unique(pa.concat_arrays([unpack_words(p.as_py()) for p in listed["words"]]))
    n, m = len(words), listed.num_rows
    return pa.table({"part": pa.concat_arrays([pa.array(np.full(n, listed["part"][0].as_py()), pa.int32()),
                                               listed["part"].combine_chunks()]),
                     "word": pa.concat_arrays([words, pa.nulls(m, pa.string())]),
                     "chunk": pa.concat_arrays([pa.nulls(n, pa.int32()), listed["chunk"].combine_chunks()]),
                     "words": pa.concat_arrays([pa.nulls(n, pa.binary()), listed["words"].combine_chunks()])})


class PacketIds:
    """Ids of packets' words, from the ids of their part's words."""

    def __init__(self, words: pa.Table):
        self.number = {w: k for k, w in enumerate(words["word"].to_pylist())}
        self.flat = pc.list_flatten(words["ids"]).to_numpy()
        self.size = pc.list_value_length(words["ids"]).to_numpy().astype(np.int64)
        self.first = np.cumsum(self.size) - self.size

    def __call__(self, packet: bytes) -> bytes:
        words = unpack_words(packet).to_pylist()
        at = np.fromiter(map(self.number.__getitem__, words), np.int64, len(words))
        n = self.size[at]
        return pack_ids(n, self.flat[np.repeat(self.first[at] - (np.cumsum(n) - n), n) + np.arange(n.sum())])

    def rows(self, packets: pa.Table) -> pa.Table:
        return pa.table({"chunk": packets["chunk"], "words": packets["words"],
                         "ids": pa.array([self(p.as_py()) for p in packets["words"]], pa.binary())})


def _fill_packets(encoded: Iterator[pa.Table]) -> Iterator[pa.Table]:
    """Packets with their ids, from rows of :func:`_distinct_words` with ids: a part's words, its packets,
    the next part's words, and so on."""
    words: list[pa.Table] = []
    ids = None
    for rows in encoded:
        packet = pc.is_null(rows["word"]).to_numpy()
        bounds = [0, *(np.flatnonzero(np.diff(packet.astype(np.int8))) + 1).tolist(), len(packet)]
        for a, z in zip(bounds, bounds[1:], strict=False):
            run = rows.slice(a, z - a)
            if not packet[a]:
                words = [run] if ids else [*words, run]
                ids = None
                continue
            if ids is None:
                ids = PacketIds(pa.concat_tables(words))
            yield ids.rows(run)


def encode_documents(documents: DataFrame, table: PieceTable, fold: str = "merges") -> DataFrame:
    """Rows (doc_id, ids, n_tokens, round_trip), one per row of ``documents`` (doc_id, text);
    round_trip: decoding the ids gives the text back."""
    parts, pattern = id_bytes(table), table.segmenter()

    def encode(docs: pa.Table, packets: pa.Table) -> pa.Table:
        word = [pa.array([], pa.string()), *(unpack_words(p.as_py()) for p in packets["words"])]
        ids = [pa.array([], pa.list_(pa.int32())), *(unpack_ids(p.as_py()) for p in packets["ids"])]
        return encode_chunk(docs, pa.table({"word": pa.concat_arrays(word), "ids": pa.concat_arrays(ids)}), parts, pattern)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for packets in _fill_packets(_merged(batches, table)):
            yield from packets.to_batches()

    def fill(words: pa.Table, packets: pa.Table) -> pa.Table:
        return PacketIds(words).rows(packets)

    # Ids travel as text: a null among numbers would turn them to floats.
    rows = documents.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    dealt, n_chunks = deal(rows, ["doc_id"])
    # The edges of a partition's words are sorted in memory: several parts per chunk.
    n_parts = PARTS_PER_CHUNK * n_chunks
    listed = dealt.groupBy("chunk").applyInArrow(lambda docs: _list_words(docs, pattern, n_parts),
                                                 "part int, chunk int, words binary").repartition(n_parts, "part")
    # A part's words and packets stay in one partition, in this order, through the lattice and the fold.
    words = listed.groupBy("part").applyInArrow(_distinct_words, "part int, word string, chunk int, words binary")
    filled = "chunk int, words binary, ids binary"
    if fold == "merges":
        values = packed_edges(words.drop("part"), table).mapInArrow(merge, filled)
    else:
        encoded = encode_words(words.where(F.col("word").isNotNull()).select("word", "part"), table, fold)
        values = encoded.groupBy("part").cogroup(listed.groupBy("part")).applyInArrow(fill, filled)
    out = (dealt.groupBy("chunk").cogroup(values.groupBy("chunk"))
           .applyInArrow(encode, "doc_id string, ids array<int>, n_tokens int, round_trip boolean"))
    return out.withColumn("doc_id", F.col("doc_id").cast(documents.schema["doc_id"].dataType))


def decode_documents(encoded: DataFrame, table: PieceTable) -> DataFrame:
    """Rows (doc_id, text) from rows (doc_id, ids)."""
    parts = id_bytes(table)

    def decode(ids: pd.Series) -> pd.Series:
        return pd.Series([decode_ids(np.asarray(x, dtype=np.int64), parts) if x is not None else "" for x in ids])

    return encoded.select("doc_id", F.pandas_udf(decode, "string")("ids").alias("text"))


def sentencepiece_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's ids, their number, and whether they decode to the text."""
    return encode_documents(read_table(spark, sf_dir, "documents"), load_pieces(default_model()))
