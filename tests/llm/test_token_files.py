"""Token-id files against the tokenizers library itself."""

import tempfile
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from stockout.llm import token_files as T

SETTINGS = T.TokenFileSettings(T.default_tokenizer())
LIBRARY = Tokenizer.from_file(SETTINGS.tokenizer)
ODD = "aBé́ Σςß\t\n\r\x0b\x1c  İﬁ<|endoftext|>'s'LL0٣你\U0001f600ë"


@given(st.one_of(st.text(max_size=60), st.text(st.sampled_from(ODD), max_size=60),
                 st.lists(st.sampled_from(["<|endoftext|>", " ", "'s", "Ab", "́", "\n", "12"])).map("".join)))
@settings(max_examples=300, deadline=None)
def test_pieces_give_the_library_s_ids(text):
    text = text.encode("utf-8", "ignore").decode()
    got = np.frombuffer(next(T.encode_texts([text], SETTINGS.tokenizer, 1000)), dtype="<u4").tolist()
    assert got == LIBRARY.encode(text, add_special_tokens=False).ids


def test_a_batch_looks_up_each_distinct_piece_once(monkeypatch):
    class Counting(dict):
        asked = 0

        def __getitem__(self, piece):
            Counting.asked += 1
            return super().__getitem__(piece)

    texts = ["one two one\tone two ", "", "two\x0bthree one", "one  two"] * 50
    list(T.encode_texts(["one two"], SETTINGS.tokenizer, 1000))  # opens the tokenizer
    monkeypatch.setitem(T._PIECES, SETTINGS.tokenizer, Counting({"": b""}))
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in T.encode_texts(texts, SETTINGS.tokenizer, 1000)]
    assert got == [LIBRARY.encode(t, add_special_tokens=False).ids for t in texts]
    assert Counting.asked == 4  # the empty piece, one, two, and two\x0bthree


def expected(docs):
    rows, start = [], 0
    for doc, text in docs:
        ids = np.array([*LIBRARY.encode(text or "", add_special_tokens=False).ids, 2], dtype="<u4")
        rows.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return rows


def test_query_matches_the_library(spark):
    docs = [(r["doc_id"], r["text"]) for r in
            spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    got = sorted(tuple(r) for r in T.token_files_query(spark, "/root/testdata/sf0.01").collect())
    assert got == expected(docs)


def test_odd_rows_small_shards_and_access(spark):
    docs = [(None, "first"), (-5, ""), (1, None), (7, "same"), (7, "same"), (2**60, "big id " * 30_000), (2**60 + 1, "x")]
    df = spark.createDataFrame([(d, t, "p") for d, t in docs[::-1]], "doc_id long, text string, path string")
    folder = tempfile.mkdtemp()
    manifest = T.write_ids(df, folder, T.TokenFileSettings(SETTINGS.tokenizer, shard_bytes=40))
    got = sorted((tuple(r) for r in T.read_ids(manifest).collect()), key=lambda r: r[1])
    assert got == expected(docs)
    shard = T.Shard(manifest.orderBy("part", "seq").first()["path"])
    assert np.frombuffer(shard.ids(0), dtype="<u4").tolist() == [*LIBRARY.encode("first").ids, 2]
    with pytest.raises(ValueError):
        T.Shard(manifest.first()["path"], b"another dictionary")


def test_dictionary_pays_and_empty_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "text")
    d = T.train_dictionary(docs, SETTINGS, 2)
    ids = T._narrow(next(T.encode_texts([docs.first()["text"][:600]], SETTINGS.tokenizer, 1000)), 2)
    import zstandard

    with_dictionary = zstandard.ZstdCompressor(dict_data=zstandard.ZstdCompressionDict(d)).compress(ids)
    assert len(with_dictionary) < len(zstandard.ZstdCompressor().compress(ids)) < len(ids) + 20
    manifest = T.write_ids(docs.limit(0), tempfile.mkdtemp(), SETTINGS)
    assert T.read_ids(manifest).collect() == []


def test_dictionary_follows_from_the_documents_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    settings = T.TokenFileSettings(T.default_tokenizer(), sample_documents=60, sample_bytes=100_000)
    one = T.train_dictionary(docs, settings, 2)
    copies = docs.unionByName(docs.limit(20)).repartition(5).orderBy(F.desc("doc_id"))
    assert T.train_dictionary(copies, settings, 2) == one and len(one) > 0
    assert T.train_dictionary(docs.limit(0), settings, 2) == b""


def test_words_with_marks_are_the_two_parts(spark):
    assert T.parts_at_marks(LIBRARY)
    words = ["don", "S", "Ab", "re", "hello", "x" * 40, "ll", "I"]
    marks = ["!", "...", "%%%", "_", "-", "&&&", "()", "<|", "|>", "`", "~^", "*.", '"', "#"]
    pieces = [w + m for w in words for m in marks] + ["don't.", "a's", "s'", "(a)", "a.b", "a..b"]
    got = list(T.encode_texts([" ".join(pieces), *pieces], SETTINGS.tokenizer, 1000))
    assert [np.frombuffer(b, dtype="<u4").tolist() for b in got] == [LIBRARY.encode(t, add_special_tokens=False).ids for t in [" ".join(pieces), *pieces]]


def test_runs_of_letters_are_encoded_without_marks():
    class Recording:
        def __init__(self):
            self.model, self.asked = LIBRARY.model, []

        def __getattr__(self, name):
            return getattr(LIBRARY, name)

        def encode_batch_fast(self, texts, **options):
            self.asked += texts
            return LIBRARY.encode_batch_fast(texts, **options)

    encoder = Recording()
    T.word_ends(encoder)
    encoder.asked.clear()
    pieces = ["onoranes", "Ab", "éaneux", "ÀÉ", "x", "Xanadu", "İﬁ", "don't", "a0b", "你", "..."] * 30
    pieces = [p + "q" * (k % 5) for k, p in enumerate(pieces)]
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in T._encode_pieces(encoder, list(dict.fromkeys(pieces)))]
    assert got == [LIBRARY.encode(p, add_special_tokens=False).ids for p in dict.fromkeys(pieces)]
    assert " ".join(p for p in dict.fromkeys(pieces) if T.word_ends(encoder)[1].fullmatch(p)) in encoder.asked


def test_a_text_with_other_than_one_word_a_piece_is_not_cut_by_ends():
    ends, _ = T.word_ends(LIBRARY)
    got = [np.frombuffer(b, dtype="<u4").tolist() for b in T._encode_runs(LIBRARY, ["ab", "c d"], ends)]
    assert got == [LIBRARY.encode(p, add_special_tokens=False).ids for p in ["ab", "c d"]]
