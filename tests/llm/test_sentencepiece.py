"""Relational lattice against the sentencepiece library, and its folds against brute force."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from stockout.llm import sentencepiece as P

LIBRARY = SentencePieceProcessor(model_file=P.default_model())
TABLE = P.load_pieces(P.default_model())
PATTERN = TABLE.segmenter()
TEXTS = ["hello world", "  hello   world\n\nx  ", "", None, " ", "a\tb \x00 é 你好 ﬁ \U0001f600", "x" * 61 + " " + "ab" * 100,
         "The quick-brown (fox) can't jump_over 1,234.56% of it!!!", "=" * 70 + "ab", "Ünïcödé straße ñandú",
         "¿Qué? <s> </s> <unk> <0x41>", "supercalifragilisticexpialidocious" * 3]


@given(st.text(max_size=80))
@settings(max_examples=200, deadline=None)
def test_segments_never_cut_a_piece(text):
    text = text.encode("utf-8", "ignore").decode()
    marked = P.MARK + text.replace(" ", P.MARK)
    assert "".join(P.segments(text, PATTERN)) == (marked if text else "")


@given(st.text(st.sampled_from("abtheing 1.é▁"), max_size=90).filter(lambda t: P.MARK not in t))
@settings(max_examples=200, deadline=None)
def test_heap_merges_match_the_library(text):
    ranks = {p: (-s, i) for i, (p, s) in enumerate(zip(TABLE.pieces, TABLE.scores, strict=True)) if p}
    got = [i for w in P.segments(text, PATTERN) for i in P.merge_long(w, ranks, TABLE.byte_ids, TABLE.longest)]
    assert got == LIBRARY.encode(text)


def test_documents_match_the_library(spark):
    rng = random.Random(1)
    texts = TEXTS + ["".join(rng.choice("abcdethingr  .,A1é\n") for _ in range(rng.randint(1, 200))) for _ in range(150)]
    docs = spark.createDataFrame([(i if i != 5 else None, t, "x") for i, t in enumerate(texts + texts[:3])],
                                 "doc_id long, text string, word string")
    out = P.encode_documents(docs, TABLE)
    got = sorted((list(r["ids"]) for r in out.collect()))
    assert got == sorted(LIBRARY.encode(t or "") for t in texts + texts[:3])
    rows = {r["doc_id"]: r for r in out.collect()}
    assert all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows.values())
    decoded = {r["doc_id"]: r["text"] for r in P.decode_documents(out, TABLE).collect()}
    assert all(decoded[i if i != 5 else None] == (t or "") for i, t in enumerate(texts))


def test_query_matches_the_library(spark):
    sf = "/root/testdata/sf0.001"
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    rows = P.sentencepiece_query(spark, sf).collect()
    assert len(rows) == len(docs)
    for r in rows:
        assert list(r["ids"]) == LIBRARY.encode(docs[r["doc_id"]]) and r["round_trip"]


def test_documents_are_dealt_once(spark):
    """Both users of the dealt documents read one exchange."""
    out = P.encode_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet").limit(5), TABLE)
    out.collect()
    assert "ReusedExchange" in out._jdf.queryExecution().executedPlan().toString()


def best_path(word, scores, unknown=1e6):
    best = [(0.0, [])]
    for end in range(1, len(word) + 1):
        options = [(best[s][0] - scores[word[s:end]][0], best[s][1] + [scores[word[s:end]][1]])
                   for s in range(end) if word[s:end] in scores]
        if word[end - 1] not in scores:
            options.append((best[end - 1][0] + unknown, best[end - 1][1] + list(word[end - 1].encode())))
        best.append(min(options))
    return best[-1][1]


def test_viterbi_fold_matches_a_plain_search(spark):
    rng = random.Random(2)
    pieces = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))) for _ in range(60)} | {"a", "b"})
    # Binary fractions, so that equal sums are equal.
    table = P.PieceTable((*[None] * 256, *pieces), (*[0.0] * 256, *[-rng.randint(1, 64) / 8 for _ in pieces]),
                         tuple(range(256)))
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 12))) for _ in range(80)} | {"aéb", "d"})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r["word"]: list(r["ids"]) for r in P.encode_words(df, table, "viterbi").collect()}
    scores = {p: (table.scores[i], i) for i, p in enumerate(table.pieces) if p}
    assert got == {w: best_path(w, scores) for w in words}


def test_empty_table_and_bad_pieces(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert P.encode_documents(docs, TABLE).collect() == []
    with pytest.raises(ValueError):
        P.PieceTable(("a.b",), (0.0,), tuple(range(256)))


def test_a_chunk_s_words_take_little_memory():
    """A task holds all words of a chunk: their ids are one array, not an object for each."""
    import tracemalloc

    import pyarrow as pa
    import zstandard

    n = 200_000
    words = [f"{P.MARK}w", *(f"{P.MARK}{k}" for k in range(n - 1))]
    ids = pa.array([[5, 6, 7], *([k % 100, 1] for k in range(n - 1))], pa.list_(pa.int32()))
    table = pa.table({"word": words, "ids": ids})
    docs = pa.table({"doc_id": ["1", None], "packed": [zstandard.ZstdCompressor().compress(t) for t in (b"w w", b"")]})
    tracemalloc.start()
    got = P.encode_chunk(docs, table, [b"x"] * 100, PATTERN)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert got.to_pydict() == {"doc_id": ["1", None], "ids": [[5, 6, 7, 5, 6, 7], []], "n_tokens": [6, 0],
                               "round_trip": [False, True]}
    assert peak < 200 * n


def test_merges_of_many_words_match_the_heap(spark, monkeypatch):
    """All words' edges are folded together, whatever rows and words a batch cuts apart."""
    rng = random.Random(5)
    words = sorted({"".join(rng.choice("abcdethingr1é你") for _ in range(rng.choice([1, 2, 5, 9, 20, 61, 62, 90])))
                    for _ in range(300)})
    ranks = {p: (-s, i) for i, (p, s) in enumerate(zip(TABLE.pieces, TABLE.scores, strict=True)) if p}
    want = {w: P.merge_long(w, ranks, TABLE.byte_ids, TABLE.longest) for w in words}
    df = spark.createDataFrame([(w, len(w)) for w in words], "word string, size int").coalesce(1)
    rows = P.encode_words(df, TABLE).collect()
    assert {r["word"]: list(r["ids"]) for r in rows} == want and len(rows) == len(words)
    assert all(r["size"] == len(r["word"]) for r in rows)
    edges = P.packed_edges(df.drop("size"), TABLE).toArrow().combine_chunks()
    monkeypatch.setattr(P, "FOLD_EDGES", 50)
    got = [t for t in P._merged(iter(edges.to_batches(max_chunksize=7)), TABLE)]
    assert {r["word"]: r["ids"] for t in got for r in t.to_pylist()} == want


def test_words_travel_in_packets(spark):
    """Neither the words of the chunks nor their ids are a row for each word, and no grouping holds them."""
    out = P.encode_documents(spark.read.parquet("/root/testdata/sf0.001/documents.parquet"), TABLE)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan
    words = [b"a", "é".encode(), b"", b"x\n\x00y"]
    assert P.unpack_words(P.pack_words(words)).to_pylist() == [w.decode() for w in words]
    ids = P.np.array([0, 70_000, 5, 65_535], dtype=P.np.int32)
    assert P.unpack_ids(P.pack_ids(P.np.array([1, 0, 3]), ids)).to_pylist() == [[0], [], [70_000, 5, 65_535]]


def test_both_folds_encode_documents(spark):
    docs = spark.createDataFrame([(1, "ab abc d"), (None, None), (2, "cab  ab"), (1, "ab")], "doc_id long, text string")
    pieces = ["a", "b", "c", "d", "ab", P.MARK, P.MARK + "ab"]
    table = P.PieceTable((*[None] * 256, *pieces), (*[0.0] * 256, -4.0, -4.0, -4.0, -4.0, -2.0, -3.0, -1.0), tuple(range(256)))
    for fold in ("merges", "viterbi"):
        rows = P.encode_documents(docs, table, fold).collect()
        assert len(rows) == 4 and all(r["round_trip"] and r["n_tokens"] == len(r["ids"]) for r in rows)
