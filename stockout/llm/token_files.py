"""Token-id files: one zstandard frame per document, one dictionary for all.

Documents are dealt out and sorted by id, tokenized, and written as shards in that order. A
shard holds, after a header with the id width and the hash of the dictionary, one compressed
frame of serialized ids per document, then an index (document ids, token counts, offsets of the
frames) and a footer that says where the index is, so one short document is read with two small
reads. The dictionary is trained once on a bounded sample of serialized id arrays and stored
beside the shards under its hash; readers refuse shards of another dictionary.

Every task attempt writes files of its own name and hands back one manifest row per finished
shard; the manifest table, committed by Spark, says which files count, so lost executors or
repeated attempts leave at most files that nobody reads. Token offsets across shards are running
sums over the manifest (one row per shard).

The tokenizer's result for a text is the concatenation of its results for the pieces between
blanks, tabs and line ends, as neither its normalizer nor its pre-tokenizer looks across them; so
each worker encodes a piece once and remembers it, up to a bounded number of pieces. Texts are split
and their pieces numbered by Arrow, so a piece is looked up once per batch, however often it occurs.

Defined results: a null text counts as empty and has the end id only; equal document ids keep
one entry per row, ordered by their text's hash; a null id comes first and is stored as null;
an empty table gives no shards. Extra columns are never read.
"""

from __future__ import annotations

import hashlib
import re
import struct
import uuid
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.fs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockout.llm.common import content, read_table
from stockout.session import ensure_checkpoint_dir
from stockout.stage import write_stage

MAGIC = b"TIDS\x01"
_HEADER = struct.Struct("<5sB32s")  # magic, bytes per id, dictionary hash
_FOOTER = struct.Struct("<QQ5s")  # offset of the index, documents, magic
_ENTRY = np.dtype([("doc_id", "<i8"), ("has_id", "u1"), ("n_tokens", "<u4"), ("offset", "<u8"), ("size", "<u4")])
_BLANKS = re.compile(r"[ \t\r\n]+")


@dataclass(frozen=True)
class TokenFileSettings:
    """``tokenizer``: path of the vocabulary file; ``end_id`` is appended to each document. The
    dictionary is trained on at most ``sample_documents`` whole documents of ``sample_bytes`` in all. ``shard_bytes``: compressed size at which a shard is closed; ``cache_pieces``: pieces
    that a worker remembers."""

    tokenizer: str
    end_id: int = 2
    sample_documents: int = 1000
    sample_bytes: int = 8 << 20
    dictionary_bytes: int = 65_536
    level: int = 3
    shard_bytes: int = 64 << 20
    cache_pieces: int = 800_000


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


_LETTERS = "".join(chr(c) for c in (*range(65, 91), *range(97, 123), *range(0xC0, 0x100)) if chr(c).isalpha())
_ENDS: dict[int, tuple[object, np.ndarray, re.Pattern | None]] = {}


def word_ends(encoder) -> tuple[np.ndarray, re.Pattern | None]:
    """Per id whether its token ends a word, and an expression for runs of those ``_LETTERS`` that
    alone are one such token: every word that ends in one of them has one end. None if the
    tokenizer marks no ends."""
    if id(encoder) not in _ENDS:
        suffix, runs = getattr(encoder.model, "end_of_word_suffix", None), None
        vocabulary = encoder.get_vocab(with_added_tokens=True)
        ends = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        if suffix:
            ends[[i for token, i in vocabulary.items() if token.endswith(suffix)]] = True
            single = [e.ids for e in encoder.encode_batch_fast(list(_LETTERS), add_special_tokens=False)]
            letters = "".join(c for c, x in zip(_LETTERS, single, strict=True) if len(x) == 1 and ends[x[0]])
            runs = re.compile(f"[{letters}]+") if letters else None
        _ENDS[id(encoder)] = encoder, ends, runs
    return _ENDS[id(encoder)][1:]


def _encode_runs(encoder, pieces: list[str], ends: np.ndarray) -> Iterator[bytes]:
    """Ids of pieces that are runs of letters of :func:`word_ends`, many in one text. Every word of it has one end, so a
    text with as many ends as pieces has one word a piece; the pieces of any other text go alone."""
    for start in range(0, len(pieces), 100):
        some = pieces[start:start + 100]
        ids = np.array(encoder.encode_batch_fast([" ".join(some)], add_special_tokens=False)[0].ids, dtype="<u4")
        cuts = np.flatnonzero(ends[ids]) + 1
        if len(cuts) == len(some) and cuts[-1] == len(ids):
            raw, at = ids.tobytes(), (4 * cuts).tolist()
            yield from [raw[a:b] for a, b in zip([0, *at], at, strict=False)]
        else:
            yield from (np.array(e.ids, dtype="<u4").tobytes()
                        for e in encoder.encode_batch_fast(some, add_special_tokens=False))


_MARK = "0"  # put between pieces that are encoded together


def _encode_pieces(encoder, pieces: list[str]) -> Iterator[bytes]:
    """Ids of each piece. The library is faster on few texts than on many short ones, so pieces
    are put together: runs of letters with a blank between, as :func:`_encode_runs` tells them
    apart, the others with a digit between blanks, whose id tells where one ends. Pieces with that
    digit go alone, and so does a group in which the id turns up elsewhere too."""
    ends, pattern = word_ends(encoder)
    if pattern:
        runs = [p for p in pieces if pattern.fullmatch(p)]
        if runs:
            found = dict(zip(runs, _encode_runs(encoder, runs, ends), strict=True))
            others = [p for p in pieces if p not in found]
            found.update(zip(others, _encode_marked(encoder, others), strict=True))
            yield from map(found.__getitem__, pieces)
            return
    yield from _encode_marked(encoder, pieces)


def _encode_marked(encoder, pieces: list[str]) -> Iterator[bytes]:
    """Ids of each piece, with a digit between those that are put together."""
    def alone(some: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, dtype="<u4") for e in encoder.encode_batch_fast(some, add_special_tokens=False)]

    if not pieces:
        return
    mark = alone([_MARK])[0]
    joint = len(mark) == 1 and alone([f"a {_MARK} a"])[0].tolist() == [*alone(["a"])[0], *mark, *alone(["a"])[0]]
    for start in range(0, len(pieces), 100):
        some = pieces[start:start + 100]
        together = [p for p in some if joint and _MARK not in p]
        parts: list[bytes] = []
        if together:
            ids = alone([f" {_MARK} ".join(together)])[0]
            cuts = np.flatnonzero(ids == mark[0])
            if len(cuts) == len(together) - 1:
                raw, at = ids.tobytes(), (4 * cuts).tolist()
                parts = [raw[a:b] for a, b in zip([0, *[c + 4 for c in at]], [*at, len(raw)], strict=True)]
            else:
                parts = [x.tobytes() for x in alone(together)]
        if len(together) == len(some):
            yield from parts
            continue
        done = dict(zip(together, parts, strict=True))
        rest = [p for p in some if p not in done]
        done.update(zip(rest, [x.tobytes() for x in alone(rest)], strict=True))
        for p in some:
            yield done[p]


_MARKED = re.compile(r"([A-Za-z]+)([!-&(-/:-@\[-`{-~]+)")  # a word and ASCII marks, without the apostrophe
_PROBES = ("a", "s", "ab", "Zq", "the", "ll", "Xanadu", "re")


def parts_at_marks(encoder) -> bool:
    """Whether the tokenizer cuts between letters and marks: then a word and its marks are encoded as
    the two are alone. Asked of words of several kinds before each mark, and before two."""
    marks = [chr(c) for c in range(33, 127) if not chr(c).isalnum() and chr(c) != "'"]
    whole = [(w, m) for w in _PROBES for m in (*marks, *(m + "." for m in marks))]
    ids = lambda texts: [e.ids for e in encoder.encode_batch_fast(texts, add_special_tokens=False)]
    return all(both == a + b for both, a, b in zip(ids([w + m for w, m in whole]), ids([w for w, _ in whole]),
                                                   ids([m for _, m in whole]), strict=True))


def _learn(encoder, cuts: bool, new: list[str], known: dict[str, bytes]) -> None:
    """Add the ids of ``new`` pieces to ``known``, those of a word with marks from the two."""
    marked, plain = [], {}
    for p in new:
        if cuts and not p.isalpha() and (m := _MARKED.fullmatch(p)):
            word, marks = m.groups()
            marked.append((p, word, marks))
            for x in (word, marks):
                if x not in known:
                    plain[x] = None
        else:
            plain[p] = None
    asked = list(plain)
    known.update(zip(asked, _encode_pieces(encoder, asked), strict=True))
    for p, word, marks in marked:
        known[p] = known[word] + known[marks]


_TOKENIZERS: dict[str, object] = {}
_PIECES: dict[str, dict[str, bytes]] = {}


def _split(texts: list[str]) -> pa.LargeListArray | pa.ListArray:
    """The pieces of each text between blanks, tabs and line ends; empty ones may be among them."""
    if any("\x0b" in t or "\x0c" in t for t in texts):  # white space to Arrow, but none to the tokenizer's pieces
        return pa.array([_BLANKS.split(t) for t in texts], pa.list_(pa.large_string()))
    return pc.ascii_split_whitespace(pa.array(texts, pa.large_string()))


def encode_texts(texts: list[str], tokenizer: str, cache_pieces: int) -> Iterator[bytes]:
    """Ids of each text, as little-endian unsigned 32-bit integers, without special tokens
    added. Tokenizer and pieces are kept for the worker's next tasks."""
    if tokenizer not in _TOKENIZERS:
        import os

        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Tokenizer.from_file(tokenizer)
        _TOKENIZERS[tokenizer] = encoder, parts_at_marks(encoder)
        _PIECES[tokenizer] = {"": b""}
    (encoder, cuts), known = _TOKENIZERS[tokenizer], _PIECES[tokenizer]
    for start in range(0, len(texts), 200):
        if len(known) > cache_pieces:
            known.clear()
            known[""] = b""
        split = _split(texts[start:start + 200])
        numbered = split.values.dictionary_encode()
        pieces = numbered.dictionary.to_numpy(zero_copy_only=False).tolist()
        new = [p for p in pieces if p not in known]
        if new:
            _learn(encoder, cuts, new, known)
        # Each distinct piece is looked up once; the texts are gathered by its number.
        parts = list(map(known.__getitem__, pieces))
        ids, size = np.frombuffer(b"".join(parts), dtype="<u4"), np.fromiter(map(len, parts), np.int64, len(parts)) // 4
        piece = numbered.indices.to_numpy()
        n = size[piece]
        ends = np.cumsum(n)
        first = (np.cumsum(size) - size)[piece]
        whole = ids[np.repeat(first - (ends - n), n) + np.arange(n.sum())]
        cut = np.concatenate([[0], ends])[split.offsets.to_numpy()].tolist()
        for a, b in zip(cut, cut[1:], strict=False):
            yield whole[a:b].tobytes()


def _open(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    return pyarrow.fs.FileSystem.from_uri(uri)


def train_dictionary(documents: DataFrame, settings: TokenFileSettings, width: int) -> bytes:
    """A zstandard dictionary from the id arrays of a bounded sample: distinct documents of the smallest
    hashes of id and text, as many as ``sample_documents`` and ``sample_bytes`` of text allow. It is
    the same for the same documents, however they lie."""
    digest = F.xxhash64("doc_id", "text")
    ranked = (documents.select(digest.alias("h"), F.octet_length("text").alias("size"))
              .where((F.col("size") > 0) & (F.col("size") <= settings.sample_bytes))
              .groupBy("h").agg(F.max("size").alias("size")).orderBy("h").limit(settings.sample_documents).collect())
    total = np.cumsum([r["size"] for r in ranked])
    chosen = [r["h"] for r, t in zip(ranked, total, strict=True) if t <= settings.sample_bytes]

    def serialize(texts: pd.Series) -> pd.Series:
        ids = encode_texts([t or "" for t in texts], settings.tokenizer, settings.cache_pieces)
        return pd.Series([_narrow(b, width) for b in ids])

    sample = [bytes(r["b"]) for r in documents.where(digest.isin(chosen)).dropDuplicates(["doc_id", "text"])
              .select(F.pandas_udf(serialize, "binary")("text").alias("b")).collect()] if chosen else []
    sample = sorted(b for b in sample if b)
    try:
        return zstandard.train_dictionary(settings.dictionary_bytes, sample).as_bytes()
    except zstandard.ZstdError:  # too little to train on: the sample itself is the dictionary
        return b"".join(sample)[-settings.dictionary_bytes:]


def _narrow(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, dtype="<u4").astype("<u2").tobytes()


def _widen(ids: bytes, width: int) -> bytes:
    return ids if width == 4 else np.frombuffer(ids, dtype="<u2").astype("<u4").tobytes()


def _zdict(dictionary: bytes) -> zstandard.ZstdCompressionDict | None:
    return zstandard.ZstdCompressionDict(dictionary) if dictionary else None


class _ShardWriter:
    def __init__(self, folder: str, width: int, dictionary: bytes):
        self.path = f"{folder}/shard-{uuid.uuid4().hex}.tids"
        fs, path = _open(self.path)
        self.out = fs.open_output_stream(path)
        self.out.write(_HEADER.pack(MAGIC, width, hashlib.sha256(dictionary).digest()))
        self.at, self.entries, self.n_tokens = _HEADER.size, [], 0

    def add(self, doc_id: int | None, n_tokens: int, frame: bytes) -> None:
        self.out.write(frame)
        self.entries.append((doc_id or 0, doc_id is not None, n_tokens, self.at, len(frame)))
        self.at += len(frame)
        self.n_tokens += n_tokens

    def close(self) -> None:
        self.out.write(np.array(self.entries, dtype=_ENTRY).tobytes())
        self.out.write(_FOOTER.pack(self.at, len(self.entries), MAGIC))
        self.out.close()


_MANIFEST = "part int, seq int, path string, n_docs long, n_tokens long"


def write_ids(documents: DataFrame, folder: str, settings: TokenFileSettings) -> DataFrame:
    """Write all documents (doc_id, text) to shards in ``folder``, a shared one. Returns the
    manifest, in order of (part, seq)."""
    from tokenizers import Tokenizer

    vocabulary = Tokenizer.from_file(settings.tokenizer).get_vocab_size(with_added_tokens=True)
    width = 2 if max(vocabulary, settings.end_id + 1) <= 1 << 16 else 4
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), content().alias("text"))
    dictionary = train_dictionary(rows, settings, width)
    name = hashlib.sha256(dictionary).hexdigest()
    fs, path = _open(folder)
    fs.create_dir(path, recursive=True)
    with fs.open_output_stream(f"{path}/{name}.zdict") as out:
        out.write(dictionary)
    end = np.array([settings.end_id], dtype="<u4").tobytes()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        compressor = zstandard.ZstdCompressor(level=settings.level, dict_data=_zdict(dictionary))
        shard, seq, done = None, 0, []
        part = TaskContext.get().partitionId()
        for batch in batches:
            encoded = encode_texts(batch["text"].tolist(), settings.tokenizer, settings.cache_pieces)
            for doc, ids in zip(batch["doc_id"], encoded, strict=True):
                shard = shard or _ShardWriter(folder, width, dictionary)
                ids += end
                shard.add(None if pd.isna(doc) else int(doc), len(ids) // 4, compressor.compress(_narrow(ids, width)))
                if shard.at >= settings.shard_bytes:
                    shard.close()
                    done.append((part, seq, shard.path, len(shard.entries), shard.n_tokens))
                    shard, seq = None, seq + 1
        if shard:
            shard.close()
            done.append((part, seq, shard.path, len(shard.entries), shard.n_tokens))
        yield pd.DataFrame(done, columns=["part", "seq", "path", "n_docs", "n_tokens"])

    # Ids travel as text: in a batch of numbers, one null id would turn all of them to floats.
    rows = rows.withColumn("tie", F.xxhash64("text"))
    dealt = rows.repartitionByRange("doc_id", "tie").sortWithinPartitions("doc_id", "tie")
    dealt = dealt.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return write_stage(dealt.mapInPandas(write, _MANIFEST), "token_files")


class Shard:
    """Reader of one shard. ``dictionary`` is read from the shard's folder unless given."""

    def __init__(self, uri: str, dictionary: bytes | None = None):
        fs, path = _open(uri)
        self.file = fs.open_input_file(path)
        size = self.file.size()
        magic, self.width, digest = _HEADER.unpack(self.file.read_at(_HEADER.size, 0))
        at, n, tail = _FOOTER.unpack(self.file.read_at(_FOOTER.size, size - _FOOTER.size))
        if magic != MAGIC or tail != MAGIC:
            raise ValueError(f"{uri} is no complete token-id file")
        if dictionary is None:
            with fs.open_input_file(f"{path.rpartition('/')[0]}/{digest.hex()}.zdict") as f:
                dictionary = f.read()
        if hashlib.sha256(dictionary).digest() != digest:
            raise ValueError(f"{uri} was written with another dictionary")
        self.index = np.frombuffer(self.file.read_at(n * _ENTRY.itemsize, at), dtype=_ENTRY)
        self.decompressor = zstandard.ZstdDecompressor(dict_data=_zdict(dictionary))

    def ids(self, k: int) -> bytes:
        """Ids of the shard's k-th document, as unsigned 32-bit integers."""
        e = self.index[k]
        frame = self.file.read_at(int(e["size"]), int(e["offset"]))
        return _widen(self.decompressor.decompress(frame), self.width)


def with_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``start``, the ids of all shards before each."""
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    return manifest.withColumn("start", F.coalesce(F.sum("n_tokens").over(before), F.lit(0)))


def read_ids(manifest: DataFrame) -> DataFrame:
    """One row per stored document, from the files: doc_id, start, n_tokens and ids_crc32."""
    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, start in zip(batch["path"], batch["start"], strict=True):
                shard = Shard(path)
                counts = shard.index["n_tokens"].astype(np.int64)
                starts = int(start) + np.concatenate([[0], np.cumsum(counts)[:-1]])
                for a in range(0, len(counts), 10_000):
                    part = slice(a, a + 10_000)
                    crc = []
                    for k, n in enumerate(counts[part].tolist(), a):
                        ids = shard.ids(k)
                        if len(ids) != 4 * n:
                            raise ValueError(f"{path}: document {k} has {len(ids) // 4} ids, not {n}")
                        crc.append(zlib.crc32(ids))
                    doc = pd.array(shard.index["doc_id"][part].astype(np.int64), dtype="Int64")
                    doc[shard.index["has_id"][part] == 0] = pd.NA
                    yield pd.DataFrame({"doc_id": doc, "start": starts[part], "n_tokens": counts[part],
                                        "ids_crc32": crc})

    n_shards = max(1, manifest.count())
    return (with_starts(manifest).select("path", "start").repartition(n_shards)
            .mapInPandas(read, "doc_id long, start long, n_tokens long, ids_crc32 long"))


def token_files_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place and digest, read back from the files."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/token_ids/{uuid.uuid4().hex}"
    manifest = write_ids(read_table(spark, sf_dir, "documents"), folder, TokenFileSettings(default_tokenizer()))
    return read_ids(manifest)
