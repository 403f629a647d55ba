"""Greedy string tiling against a token-by-token version; contamination against brute force."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from stockout.llm import decontaminate as D


def brute_tiles(doc, item, k):
    """Textbook greedy string tiling on two word lists."""
    marked_d, marked_i, tiles = set(), set(), []
    while True:
        best, found = k, []
        for d in range(len(doc)):
            for i in range(len(item)):
                n = 0
                while (d + n < len(doc) and i + n < len(item) and doc[d + n] == item[i + n]
                       and d + n not in marked_d and i + n not in marked_i):
                    n += 1
                if n > best:
                    best, found = n, [(d, i)]
                elif n == best:
                    found.append((d, i))
        if not found:
            return tiles
        for d, i in found:
            if not any(d + j in marked_d or i + j in marked_i for j in range(best)):
                tiles.append((d, i, best))
                marked_d.update(range(d, d + best))
                marked_i.update(range(i, i + best))


@given(st.lists(st.sampled_from("abc"), max_size=30), st.lists(st.sampled_from("abc"), max_size=20), st.integers(1, 4))
@settings(max_examples=150, deadline=None)
def test_tiles_match_the_textbook(doc, item, k):
    seeds = [(d, i) for d in range(len(doc) - k + 1) for i in range(len(item) - k + 1) if doc[d:d + k] == item[i:i + k]]
    assert D.tile(seeds, k) == brute_tiles(doc, item, k)


def make(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


def corpus():
    rng = random.Random(3)
    items = [make(rng, rng.randint(14, 50)) for _ in range(12)] + [["short", "item"], []]
    docs = []
    for i in range(60):
        body = make(rng, rng.randint(0, 300))
        item = items[rng.randrange(12)]
        kind = i % 6
        if kind == 1:  # whole
            body[5:5] = item
        elif kind == 2:  # halves the other way round
            body[3:3] = item[len(item) // 2:] + ["gap"] + item[:len(item) // 2]
        elif kind == 3:  # a third only
            body[2:2] = item[:len(item) // 3]
        elif kind == 4:  # a changed word every eight
            body += [w if j % 8 else "changed" for j, w in enumerate(item)]
        docs.append((i, " ".join(body).upper() if kind == 4 else ", ".join(body)))
    docs += [(60, None), (61, ""), (62, "Short item!"), (None, " ".join(items[0])), (62, "nothing"), (1, docs[1][1])]
    return docs, [(i, " ".join(w)) for i, w in enumerate(items)] + [(99, None)]


def brute(docs, items, s):
    out = {}
    for d, text in docs:
        for i, item in items:
            a, b = D.words_of(text), D.words_of(item)
            if not b:
                continue
            tiles = brute_tiles(a, b, min(s.min_match, len(b)))
            share = sum(t[2] for t in tiles) / len(b)
            if share >= s.threshold and share > out.get((d, i), 0):
                out[d, i] = share
    return out


@pytest.mark.parametrize("local", [10**6, 0])
def test_pairs_match_brute_force(spark, local):
    docs, items = corpus()
    s = D.TilingSettings(max_local_seeds=local)
    df = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = D.contaminated(df, bench, s).collect()
    got = {}
    for r in found:
        got[r["doc_id"], r["item_id"]] = max(r["coverage"], got.get((r["doc_id"], r["item_id"]), 0))
    assert got == pytest.approx(brute(docs, items, s))
    assert {1, 2, 4, 7, 8, 62} <= {d for d, _ in got} and not {3, 9, 60, 61} & {d for d, _ in got}
    kept = D.clean(df, bench, s)
    assert kept.columns == df.columns
    bad_texts = {t for d, t in docs if any((d, i) in brute([(d, t)], items, s) for i, _ in items)}
    assert sorted(map(str, kept.collect())) == sorted(
        str(r) for r in df.collect() if r["text"] not in bad_texts)


def test_query_finds_every_planted_item(spark):
    sf = "/root/testdata/sf0.1"
    got = {(r["doc_id"], r["item_id"]) for r in D.decontaminate_query(spark, sf).collect()}
    items = [(r["item_id"], " ".join(D.words_of(r["text"]))) for r in spark.read.parquet(f"{sf}/benchmark.parquet").collect()]
    for r in spark.read.parquet(f"{sf}/documents.parquet").collect():
        text = f" {' '.join(D.words_of(r['text']))} "
        for item, words in items:
            assert ((r["doc_id"], item) in got) >= (f" {words} " in text)
    assert len(got) > 100


@pytest.mark.parametrize("no_docs", [True, False])
def test_empty_tables(spark, no_docs):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    bench = spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string")
    empty = (docs.limit(0), bench) if no_docs else (docs, bench.limit(0))
    assert D.contaminated(*empty).collect() == []
    assert D.clean(*empty).count() == (0 if no_docs else 1)
