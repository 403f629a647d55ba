"""ProbMinHash near duplicates against all pairs."""

import math
import random
from collections import Counter

import numpy as np
import pytest

from stockout.llm import minhash as M
from stockout.llm.common import WordHashes

S = M.MinHashSettings()


def weighted(text, k=5):
    w = M.words_of(text)
    runs = [tuple(w[i:i + k]) for i in range(len(w) - k + 1)] or ([tuple(w)] if w else [])
    return {r: 1 + math.log(n) for r, n in Counter(runs).items()}


def naive(a, b):
    every = set(a) | set(b)
    return sum(1 / sum(max(a.get(e, 0) / a[d], b.get(e, 0) / b[d]) for e in every) for d in set(a) & set(b))


def words(rng, n):
    return [f"w{rng.randrange(3000)}" for _ in range(n)]


def edited(rng, body, n):
    body = list(body)
    for _ in range(n):
        body[rng.randrange(len(body))] = f"edit{rng.randrange(10**6)}"
    return body


def test_exact_similarity_matches_the_definition():
    rng = random.Random(1)
    for n in (1, 4, 5, 30):
        a = " ".join(words(rng, n) * 2 + ["x"] * 8)
        b = " ".join(edited(rng, a.split(), 2) + ["x"] * 3)
        sets = [M.shingles(M.words_of(t), 5, WordHashes()) for t in (a, b)]
        assert M.probability_jaccard(*sets) == pytest.approx(naive(weighted(a), weighted(b)))


def test_registers_estimate_the_similarity():
    rng = random.Random(2)
    s = M.MinHashSettings(bands=200)
    a = words(rng, 150)
    for n in (1, 4, 12):
        sets = [M.shingles(t, 5, WordHashes()) for t in (a + ["x"] * 9, edited(rng, a, n) + ["x"] * 6)]
        owner = np.repeat([0, 1], [len(v) for v, _ in sets])
        r = M.prob_min_hash(owner, np.concatenate([v for v, _ in sets]), np.concatenate([w for _, w in sets]), 2, s)
        assert (r[0] == r[1]).mean() == pytest.approx(M.probability_jaccard(*sets), abs=0.06)


def test_registers_do_not_depend_on_the_batch():
    rng = random.Random(3)
    texts = [" ".join(words(rng, n)) for n in (0, 1, 7, 300, 20)]
    together = list(M.sketch_texts(texts, S))
    assert together == [next(M.sketch_texts([t], S)) for t in texts]


def brute(docs, s=S):
    sets = {i: weighted(t) for i, t in docs if i is not None}
    texts = {}
    for i, t in docs:
        if i is not None:
            texts.setdefault(i, []).append(t)
    parent = {i: i for i in texts}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(texts)
    for a in ids:
        for b in ids:
            if a < b and find(a) != find(b) and any(
                    M.words_of(x) == M.words_of(y) or naive(weighted(x), weighted(y)) >= s.threshold
                    for x in texts[a] for y in texts[b]):
                parent[max(find(a), find(b))] = min(find(a), find(b))
    assert sets is not None
    return {i: find(i) for i in ids}


def corpus():
    rng = random.Random(4)
    docs = []
    for _ in range(12):
        base = words(rng, rng.randint(20, 150))
        docs.append(base)
        for n in (0, 1, 2, 4, 30):
            docs.append(edited(rng, base, min(n, len(base) // 5 + n // 30)))
    chain = words(rng, 200)  # each close to the next only
    for _ in range(8):
        docs.append(chain)
        chain = edited(rng, chain, 3)
    line = "the same line again and again".split() * 40
    docs += [words(rng, 100) + line for _ in range(4)]
    rng.shuffle(docs)
    out = [(i, " ".join(d)) for i, d in enumerate(docs)]
    out += [(500, None), (501, ""), (502, " \n"), (503, "two words"), (504, "Two  WORDS"), (None, out[0][1]),
            (505, out[3][1].upper()), (506, out[1][1]), (506, out[2][1]), (507, "a " * 20_000)]
    return out


def test_components_match_all_pairs(spark):
    docs = corpus()
    df = spark.createDataFrame([(i, t, "x", 1) for i, t in docs], "doc_id long, text string, band string, a int")
    got = M.near_duplicates(df).collect()
    assert len(got) == len(docs)
    expected = brute(docs)
    for r in got:
        assert r["component_id"] == expected.get(r["doc_id"])
        assert r["kept"] == (r["doc_id"] is None or r["doc_id"] == r["component_id"])
    left = M.deduplicate(df)
    assert left.columns == df.columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted(set(expected.values())) and ids.count(None) == 1


def test_links_across_a_bucket_without_its_smallest_member(spark):
    """Members that are near each other but not near the bucket's smallest one still meet."""
    rng = random.Random(9)
    base = words(rng, 400)
    docs = [(i, " ".join(edited(rng, base, 14))) for i in range(60)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    s = M.MinHashSettings(threshold=0.66, bands=40, rows=3, slack=0.16)
    got = {r["doc_id"]: r["component_id"] for r in M.near_duplicates(df, s).collect()}
    assert got == brute(docs, s)


def test_query_keeps_one_of_each_group(spark):
    sf = "/root/testdata/sf0.01"
    got = M.minhash_query(spark, sf).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    assert {r["doc_id"] for r in got} == set(docs)
    by_words = {}
    for i in sorted(docs):
        by_words.setdefault(" ".join(M.words_of(docs[i])), i)
    assert all(r["class_id"] == by_words[" ".join(M.words_of(docs[r["doc_id"]]))] for r in got)
    sets = {i: weighted(t) for i, t in docs.items()}
    # Every removed document is near one of its group; groups are not near each other.
    groups = {}
    for r in got:
        groups.setdefault(r["component_id"], []).append(r["doc_id"])
    for members in groups.values():
        for i in members:
            assert len(members) == 1 or any(naive(sets[i], sets[j]) >= 0.8 for j in members if j != i)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert M.near_duplicates(df).collect() == [] and M.deduplicate(df).collect() == []


def test_last_stage_compares_every_text_of_an_id(spark):
    """An id with two texts is linked by either, whichever row comes first."""
    rng = random.Random(11)
    body = words(rng, 200)
    near, other = " ".join(edited(rng, body, 2)), " ".join(words(rng, 200))
    for rows in ([(2, near), (2, other)], [(2, other), (2, near)]):
        df = spark.createDataFrame([(1, " ".join(body)), *rows], "doc_id long, text string").coalesce(1)
        classes = df.select(M.F.col("doc_id").alias("rep"), M._sketch(S).alias("s")).select("rep", "s.*")
        open_ = spark.createDataFrame([(1, 1, 0, 7), (2, 2, 0, 7)], "rep long, component long, band int, key long")
        assert [tuple(sorted(r)) for r in M._links_across(open_, classes, df, S).collect()] == [(1, 2)]


def test_texts_of_pairs_are_never_broadcast(spark):
    docs = spark.createDataFrame([(k, "one two three four five six " * 3 + f"end{k % 2}") for k in range(6)], "doc_id long, text string")
    pairs = spark.createDataFrame([(0, 2), (1, 3), (0, 1), (2, 4)], "a long, b long")
    found = M.verified(pairs, docs, S)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("SortMergeJoin") == 2 and "BroadcastHashJoin" not in plan
    assert sorted(map(tuple, found.where("a % 2 = b % 2").collect())) == [(0, 2), (1, 3), (2, 4)]


def test_texts_travel_only_to_pairs_that_registers_leave_open(spark, monkeypatch):
    rng = random.Random(11)
    words = [f"w{k}" for k in range(400)]
    base = [rng.choice(words) for _ in range(120)]
    texts = [" ".join(base)]
    for change in (2, 4, 8, 12, 60, 120, 120, 120):  # changed words: similar to not at all
        copy = list(base)
        for k in rng.sample(range(120), change):
            copy[k] = f"z{rng.random()}"
        texts.append(" ".join(copy))
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    pairs = spark.createDataFrame([(i, j) for j in range(len(texts)) for i in range(j)], "a long, b long")
    sketches = docs.select("doc_id", M._sketch(S).alias("s")).select("doc_id", "s.*")
    held, write = {}, M.write_stage

    def spy(df, name, *rest, **named):
        held[name] = write(df, name, *rest, **named)
        return held[name]

    monkeypatch.setattr(M, "write_stage", spy)
    got = {(r["a"], r["b"]) for r in M.verified(pairs, docs, S, sketches).collect()}
    travelled = {r["doc_id"] for r in held["minhash_texts"].collect()}
    assert got == {(r["a"], r["b"]) for r in M.verified(pairs, docs, S).collect()}
    assert got and {x for p in got for x in p} <= travelled and not travelled & {6, 7, 8}
