"""Repeated passages against a plain search over all windows of words."""

import os
import random
from collections import defaultdict

from stockout.llm import passages as P
from stockout.llm.queries import QUERIES

S = P.PassageSettings()


def brute(docs, n=51):
    spans = [(d, [m.span() for m in P._WORD.finditer(t)], t) for d, t in docs if d is not None and t]
    windows = lambda s, t: [tuple(t[a:z] for a, z in s[k:k + n]) for k in range(len(s) - n + 1)]
    owners = defaultdict(set)
    for d, s, t in spans:
        for w in windows(s, t):
            owners[w].add(d)
    out = set()
    for d, s, t in spans:
        run = []
        found = [(k, min(owners[w])) for k, w in enumerate(windows(s, t)) if len(owners[w]) > 1]
        for k, first in [*found, (None, None)]:
            if run and (k is None or k - run[-1][0] > n):
                a, z = run[0][0], run[-1][0] + n
                out.add((d, s[a][0], s[z - 1][1], z - a, run[0][1], all(f < d for _, f in run)))
                run = []
            run.append((k, first))
    return out


def words(rng, n, short=True):
    return " ".join("".join(rng.choice("abcdefghij") for _ in range(rng.randint(1, 4) if short else rng.randint(2, 9)))
                    for _ in range(n))


def test_short_passages_of_short_words_are_all_found(spark, tmp_path):
    """51 words of 1 to 4 letters between random neighbours; 50 words are none. Through the
    registered query."""
    rng, docs = random.Random(3), []
    for k in range(60):
        n = (51, 52, 55, 60, 50)[k % 5]
        shared = words(rng, n)
        for i in (2 * k, 2 * k + 1):  # the words next to it differ
            docs.append((i, f"{words(rng, 40)} {'LR'[i % 2]} {shared} {'RL'[i % 2]} {words(rng, 40)}"))
    spark.createDataFrame(docs, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = {tuple(r) for r in QUERIES["op10_chunks"](spark, str(tmp_path)).collect()}
    assert got == brute(docs)
    assert sorted(g[0] for g in got) == [i for i, _ in docs if i // 2 % 5 != 4]


def test_matches_a_plain_search_and_odd_rows(spark):
    rng = random.Random(7)
    shared = [words(rng, n, False) for n in (55, 80, 200)]
    docs = []
    for i in range(40):
        parts = [words(rng, rng.randint(0, 60)), rng.choice([*shared, ""]), rng.choice(shared), words(rng, 30)]
        docs.append((i, "  ".join(parts) + (" é" if i % 3 else "") + " same word" * (40 if i % 7 == 0 else 0)))
    docs += [(40, None), (41, ""), (None, shared[0]), (43, docs[2][1]), (43, docs[2][1]), (44, "a " * 300)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, text string, start string")
    rows = [tuple(r) for r in P.repeated_passages(df).collect()]
    assert set(rows) == brute(docs) and len(rows) == len(set(rows))
    one = spark.createDataFrame([(1, shared[2]), (1, shared[2] + " more")], "doc_id long, text string")
    assert P.repeated_passages(one).collect() == [] == P.repeated_passages(one.limit(0)).collect()


def test_query_matches_a_plain_search(spark):
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").collect()]
    got = {tuple(r) for r in P.passages_query(spark, "/root/testdata/sf0.01").collect()}
    assert got and got == brute(docs)


def test_windows_are_few_bytes_on_disk(spark, monkeypatch):
    """There may be a window for every word, so what is kept of each decides the disk."""
    rng, kept = random.Random(8), {}

    def keep(df, name, **options):
        out = write_stage(df, name, **options)
        kept[name] = (sum(os.path.getsize(f.removeprefix("file://")) for f in out.inputFiles()), out.count())
        return out

    write_stage = P.write_stage
    monkeypatch.setattr(P, "write_stage", keep)
    shared = words(rng, 20_000, short=False)
    docs = [(1, shared), (2, "a b " + shared), (2, "another row " + shared), (3, words(rng, 60))]
    got = P.repeated_passages(spark.createDataFrame(docs, "doc_id long, text string")).collect()
    assert {tuple(r) for r in got} == {(1, 0, len(shared), 20_000, 1, False), (2, 4, 4 + len(shared), 20_000, 1, True),
                                       (2, 12, 12 + len(shared), 20_000, 1, True)}
    size, rows = kept["windows"]
    assert size < 16 * rows
