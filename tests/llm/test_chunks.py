"""Content-defined chunks: hash and cuts against plain loops, passages against brute force."""

import random
from collections import defaultdict

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from stockout.llm import chunks as C

S = C.ChunkSettings()
TABLE = C.gear_table(S.seed)


@given(st.binary(max_size=300))
@settings(max_examples=60, deadline=None)
def test_gear_hash_is_the_rolling_hash(data):
    got = C.gear_hash(np.frombuffer(data, dtype=np.uint8), TABLE, 32)
    h = 0
    for i, b in enumerate(data):
        h = ((h << 1) + int(TABLE[b])) % 2**32
        assert int(got[i]) == h


@given(st.text(max_size=600))
@settings(max_examples=60, deadline=None)
def test_chunks_cover_the_text(text):
    out = C.chunk_text(text, S, TABLE)
    assert "".join(text[s:e] for _, _, s, e, _ in out) == text
    assert all(len(text[s:e].encode("utf-8", "surrogatepass")) <= S.max_bytes + 3 for _, _, s, e, _ in out)
    assert sum(w for *_, w in out) == len([w for w in _ascii_split(text) if w])


def _ascii_split(text):
    import re

    return re.split("[ \t\n\x0b\x0c\r]+", text)


def words(rng, n):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(2, 9))) for _ in range(n))


def test_insertion_shifts_only_nearby_chunks():
    rng = random.Random(5)
    text = words(rng, 2000)
    before = {c[:2] for c in C.chunk_text(text, S, TABLE)}
    after = {c[:2] for c in C.chunk_text(text[:3000] + "inserted words " + text[3000:], S, TABLE)}
    assert len(after - before) <= 8


def brute(docs, settings):
    owners = defaultdict(set)
    for d, t in docs:
        for c in C.chunk_text(t, settings, TABLE) if d is not None and t else ():
            owners[c[:2]].add(d)
    out = set()
    for d, t in docs:
        run = []
        for c in [*(C.chunk_text(t, settings, TABLE) if d is not None and t else ()), None]:
            if c and len(owners[c[:2]]) > 1:
                run.append(c)
                continue
            if run and sum(x[4] for x in run) >= settings.min_words:
                firsts = [min(owners[x[:2]]) for x in run]
                out.add((d, run[0][2], run[-1][3], sum(x[4] for x in run), firsts[0], all(f < d for f in firsts)))
            run = []
    return out


def test_passages_match_brute_force(spark):
    rng = random.Random(7)
    shared = [words(rng, n) for n in (55, 80, 200)]
    docs = []
    for i in range(40):
        parts = [words(rng, rng.randint(0, 60)), rng.choice([*shared, ""]), words(rng, 30)]
        docs.append((i, " ".join(parts) + (" é" if i % 3 else "")))
    docs += [(40, None), (41, ""), (None, shared[0]), (43, docs[2][1])]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, start string")
    got = {tuple(r) for r in C.repeated_passages(df).collect()}
    assert got == brute(docs, S)
    holders = {i for i, t in docs if i is not None and t and any(s in t for s in shared)}
    assert holders <= {g[0] for g in got}
    clean = {i for i, t in docs if i not in (2, 43) and not any(s in (t or "") for s in shared)}
    assert not clean & {g[0] for g in got}


def test_query_matches_brute_force(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = {tuple(r) for r in C.chunks_query(spark, "/root/testdata/sf0.01").collect()}
    assert got and got == brute(docs, S)


def test_repeated_rows_and_empty_table(spark):
    text = words(random.Random(1), 100)
    one = spark.createDataFrame([(1, text), (1, text)], "doc_id long, text string")
    assert C.repeated_passages(one).collect() == []  # one document, though on two rows
    assert C.repeated_passages(one.limit(0)).collect() == []
