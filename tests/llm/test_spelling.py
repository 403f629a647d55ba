"""Spelling variants against all pairs by edit distance, and against DuckDB."""

import random
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from stockout.llm import spelling as S

SF = "/root/testdata/sf0.001"
COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def one_edit(a, b):
    if a == b or abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return any(long[:k] + long[k + 1:] == short for k in range(len(long)))


def brute(docs, s):
    counts = Counter()
    for doc_id, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c < "\x80" else c for c in run)
            if s.typo_period:
                h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
                if h % s.typo_period == 0:
                    run = run[:h % len(run)] + run[h % len(run) + 1:]
            counts[run] += 1
    words = {w: n for w, n in counts.items() if len(w) >= s.min_length and n >= s.min_count}
    near = {w: [v for v in words if one_edit(w, v)] for w in words}
    form = {}
    for w, vs in near.items():
        best = min(vs, key=lambda v: (-words[v], v), default=None)
        form[w] = best if best is not None and words[best] >= s.form_ratio * words[w] else None
    def root(w):
        while form[w] is not None:
            w = form[w]
        return w
    return {(w, form[w], root(w), n, len(near[w]), form[w] and words[form[w]]) for w, n in words.items()}


def run(spark, docs, s, extra=""):
    table = spark.createDataFrame(docs, "doc_id long, text string")
    if extra:
        table = table.selectExpr("*", extra)
    out = S.spelling_variants(table, s)
    assert out.columns == COLUMNS
    return [tuple(r) for r in out.collect()]


@pytest.mark.parametrize("block", [1024, 5])
def test_equals_all_pairs(spark, block):
    rng = random.Random(block)
    stems = ["".join(rng.choice("abÀéc") for _ in range(rng.randrange(5, 9))) for _ in range(6)] + ["aaaaaaa", "ababab"]
    docs = []
    for k in range(300):
        words = []
        for _ in range(40):
            w = list(rng.choice(stems))
            for _ in range(rng.choice([0, 0, 0, 1, 1, 2])):
                at = rng.randrange(len(w))
                w[at:at + rng.randrange(2)] = rng.choice(["", "a", "b", "Z", "ß"])
            words.append("".join(w).upper() if rng.random() < 0.2 else "".join(w))
        docs.append((k, rng.choice([" ", "1", "_", ", "]).join(words)))
    s = S.SpellingSettings(min_count=2, form_ratio=2, typo_period=7, block=block, held_words=50)
    got = run(spark, docs, s)
    want = brute(docs, s)
    assert set(got) == want and len(got) == len(want)
    assert sum(r[1] is not None for r in got) > 30 and any(r[2] not in (r[0], r[1]) for r in got)


def test_one_prefix_holds_most_words(spark):
    rng = random.Random(1)
    words = {"prefixes" + "".join(rng.choice("abc") for _ in range(6)) for _ in range(400)}
    docs = [(k, " ".join(words)) for k in range(5)] + [(9, " ".join(sorted(words)[::7] * 30))]
    for s in (S.SpellingSettings(typo_period=None, block=40), S.SpellingSettings(typo_period=None)):
        assert set(run(spark, docs, s)) == brute(docs, s)


def test_odd_rows(spark):
    s = S.SpellingSettings()
    docs = [(1, "Letter letters " * 5), (1, "Letter letters " * 5), (None, None), (None, "letter " * 3), (3, ""), (4, "x y 123")]
    assert set(run(spark, docs, s, "'q' AS word")) == brute(docs, s)
    assert run(spark, [], s) == [] and run(spark, [(1, None)], s) == []


def test_chains_reach_their_last_form(spark):
    words = ["aaaaaaaa", "aaaaaaab", "aaaaaabb", "aaaaabbb", "aaaabbbb"]
    docs = [(k, " ".join([w] * (2 * 3 ** k))) for k, w in enumerate(words)]
    got = run(spark, docs, S.SpellingSettings(min_count=2, form_ratio=3, typo_period=None))
    assert {r[2] for r in got} == {words[-1]} and [r[1] for r in sorted(got)] == [*words[1:], None]


def test_very_long_texts_and_words(spark):
    word = "x" * 300_000
    docs = [(1, f"{word} {word}y {word[:-1]} " * 5), (2, "letters " * 400_000), (3, "lettern " * 6)]
    got = {r[0][-3:] + str(len(r[0])): r[3:] for r in run(spark, docs, S.SpellingSettings(typo_period=None))}
    assert got == {"xxx300000": (5, 2, None), "xxy300001": (5, 1, None), "xxx299999": (5, 1, None),
                   "ers7": (400_000, 1, None), "ern7": (6, 1, 400_000)}


def test_tiles_find_what_edit_distance_finds():
    rng = random.Random(2)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.choice([5, 6]))) for _ in range(60)})
    mats = S.matrices(words, 6)
    found = S.near_pairs(mats, mats, 5, np.zeros(len(words), dtype=bool))
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            assert found[i, j] == (one_edit(a, b) and max(len(a), len(b)) == 6)


def test_query_matches_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    got = [tuple(r) for r in S.spelling_query(spark, SF).select(COLUMNS).collect()]
    want = con.execute(S.SPELLING_SQL).fetchall()
    assert len(got) == len(want) and set(got) == set(want) and len(got) > 100
