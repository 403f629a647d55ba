"""Spelling variants: words one edit apart, found by dense prefix-suffix tiling.

Words are the letter runs of the texts, lower-cased in A-Z only. Two of them are near if one
inserted, deleted or replaced code point makes one the other, that is if their common prefix and
common suffix together reach the longer length minus one.

So with m = longer length - 1, one of the two reaches half of m (rounded up): every word is
entered under its prefix and its suffix of that length, once as the longer (m = length - 1) and once
as the shorter (m = length) word of a pair. All words under one such key are compared block
against block as padded code-point matrices, one aligned to the left for prefixes and one to the right for
suffixes. A key with more words than a block is dealt to pairs of blocks, so it is spread over
tasks; keys with few words share a tile. A pair found under both its prefix and its suffix counts
under the prefix. Tasks return per word the number of its near words and the best of them, never
the pairs.

A word's form is its near word of the largest count (ties: the smallest in code-point order) if
that is at least ``form_ratio`` times its own. Counts grow at each step from word to form, so roots
are found by following forms in doubled steps, a few rounds whatever the corpus.

Defined results: null texts have no words, a null id counts as the empty text, repeated rows count
as often as they stand there; texts of any length are read through. Extra columns are never read.
An empty table has no words.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout.llm.common import read_table
from stockout.stage import write_stage


@dataclass(frozen=True)
class SpellingSettings:
    """``typo_period``: a word of a document loses a code point where this divides its hash (None:
    never). ``block``, ``block_bytes``: words of one block, and their bytes."""

    min_length: int = 6
    min_count: int = 5
    form_ratio: int = 5
    typo_period: int | None = 199
    block: int = 1024
    block_bytes: int = 4 << 20
    held_words: int = 200_000


def word_of(doc_id: str, run: str, period: int | None) -> str:
    """The lower-cased run, without one code point where ``period`` divides the hash of id and run."""
    if period is not None:
        h = zlib.crc32(f"{doc_id}:{run}".encode("utf-8", "surrogatepass"))
        if h % period == 0:
            at = h % len(run)
            return run[:at] + run[at + 1:]
    return run


def count_words(documents: DataFrame, s: SpellingSettings) -> DataFrame:
    """Words of at least ``min_length`` code points and ``min_count`` occurrences: (word, n)."""
    # Only A-Z change, so runs of the lower-cased text are the lower-cased runs; shorter runs than
    # min_length cannot become words.
    pattern = re.compile(rf"[a-zÀ-ÿ]{{{s.min_length},}}")

    def words(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held: dict[str, int] = {}
        for batch in batches:
            for doc_id, text in zip(batch["doc_id"], batch["text"], strict=True):
                lower = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
                for run, n in Counter(m[0] for m in pattern.finditer(lower)).items():
                    word = word_of(doc_id, run, s.typo_period)
                    if len(word) >= s.min_length:
                        held[word] = held.get(word, 0) + n
                if len(held) > s.held_words:
                    yield pd.DataFrame({"word": list(held), "n": list(held.values())})
                    held = {}
        if held:
            yield pd.DataFrame({"word": list(held), "n": list(held.values())})

    rows = documents.where(F.col("text").isNotNull()).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("doc_id"), "text")
    return (rows.mapInPandas(words, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= s.min_count))


def matrices(words: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Code points plus one, padded with 0 to ``width``: aligned left, and aligned right with the
    columns reversed, so that column 0 is the last code point."""
    left = np.array(words, dtype=f"<U{width}").view("<u4").reshape(len(words), width).copy()
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    filled = np.arange(width)[None] < lengths[:, None]
    left[filled] += 1
    at = np.where(filled, lengths[:, None] - 1 - np.arange(width)[None], 0)
    right = np.where(filled, np.take_along_axis(left, at, axis=1), 0)
    small = np.uint16 if left.max(initial=0) < 2**16 else np.uint32
    return left.astype(small), right.astype(small)


def _common(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Leading columns in which each row of ``a`` equals each row of ``b``."""
    alive = np.ones((len(a), len(b)), dtype=bool)
    out = np.zeros((len(a), len(b)), dtype=np.int32)
    for c in range(a.shape[1]):
        alive &= a[:, c, None] == b[None, :, c]
        if not alive.any():
            break
        out += alive
    return out


def near_pairs(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray], m: int, by_suffix: np.ndarray | bool) -> np.ndarray:
    """Which rows of ``a`` and ``b`` (matrices of words of m or m + 1 code points) are one edit apart,
    at least one of them having m + 1. Under a suffix (``by_suffix``, per row of ``a``) pairs that
    share half of m as a prefix are left out."""
    prefix = _common(a[0], b[0])
    found = prefix + _common(a[1], b[1]) >= m
    longer = (a[0][:, m] != 0)[:, None] | (b[0][:, m] != 0)[None]
    found &= longer & (prefix <= m)  # equal words share m + 1
    return found & ~(np.broadcast_to(by_suffix, len(a[0]))[:, None] & (prefix >= (m + 1) // 2))


_TILE = ["m", "side", "key", "lo", "hi"]
#: Cells of one matrix of a tile, and rows that small keys are gathered to.
_CELLS, _GATHER = 1 << 22, 96


class _Best:
    """Per word of a run of rows: near words counted and the best of them, by rank."""

    def __init__(self, words: list[str], counts: np.ndarray):
        self.words, self.counts = words, counts
        order = sorted(range(len(words)), key=lambda k: (-counts[k], words[k]))
        self.rank = np.empty(len(words), dtype=np.int64)
        self.rank[order] = np.arange(len(words))
        self.order = np.array(order, dtype=np.int64)
        self.near = np.zeros(len(words), dtype=np.int64)
        self.best = np.full(len(words), len(words), dtype=np.int64)

    def add(self, a: np.ndarray, b: np.ndarray, found: np.ndarray) -> None:
        """``found`` links rows ``a`` to rows ``b``; counted for ``a`` only."""
        i, j = np.nonzero(found)
        if len(i):
            self.near[a] += np.bincount(i, minlength=len(a))
            np.minimum.at(self.best, a[i], self.rank[b[j]])

    def rows(self) -> list[tuple[str, int, int, str]]:
        out = []
        for k in np.flatnonzero(self.near):
            best = int(self.order[self.best[k]])
            out.append((self.words[k], int(self.near[k]), int(self.counts[best]), self.words[best]))
        return out


def compare_run(m: int, words: list[str], counts: np.ndarray, group: np.ndarray, by_suffix: np.ndarray,
                first: np.ndarray) -> list[tuple[str, int, int, str]]:
    """Near words within each group of a run of rows that lie together; rows with ``first`` are
    compared with the group's others only, where the group is of two blocks."""
    best = _Best(words, counts)
    n = len(words)
    step = max(1, min(512, _CELLS // (m + 1)))
    for a in range(0, n, step):
        rows_a = np.arange(a, min(a + step, n))
        mat_a = matrices([words[k] for k in rows_a], m + 1)
        for b in range(a, n, step):
            rows_b = np.arange(b, min(b + step, n))
            if group[rows_a[-1]] < group[rows_b[0]]:
                break
            mat_b = mat_a if a == b else matrices([words[k] for k in rows_b], m + 1)
            found = near_pairs(mat_a, mat_b, m, by_suffix[rows_a])
            found &= (group[rows_a][:, None] == group[rows_b][None]) & (first[rows_a][:, None] != first[rows_b][None])
            best.add(rows_a, rows_b, found)
            if a != b:
                best.add(rows_b, rows_a, found.T)
    return best.rows()


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by tile; the last tile of a batch may go on in the next."""
    rest = None

    def done(frame: pd.DataFrame) -> pd.DataFrame:
        keys = frame[_TILE]
        new = (keys != keys.shift()).any(axis=1).to_numpy()
        group = np.cumsum(new) - 1
        starts = [*np.flatnonzero(new).tolist(), len(frame)]
        ms, words, counts = frame["m"].to_numpy(), frame["word"].tolist(), frame["n"].to_numpy()
        suffix = (frame["side"] == "s").to_numpy()
        # Within one block every pair counts: each row its own side. Between two blocks, the sides are the blocks.
        apart = (frame["lo"] != frame["hi"]).to_numpy()
        first = np.where(apart, (frame["at"] == frame["lo"]).to_numpy(), np.arange(len(frame)) + 2)
        out: list[tuple[str, int, int, str]] = []
        a = 0
        for g in range(len(starts) - 1):
            end, last = starts[g + 1], g == len(starts) - 2
            if last or end - starts[a] >= _GATHER or ms[end] != ms[starts[a]]:
                part = slice(starts[a], end)
                out += compare_run(int(ms[starts[a]]), words[part], counts[part], group[part], suffix[part], first[part])
                a = g + 1
        return pd.DataFrame(out, columns=["word", "near", "best_n", "best"])

    for batch in batches:
        frame = batch if rest is None else pd.concat([rest, batch], ignore_index=True)
        if not len(frame):
            continue
        same = (frame[_TILE] == frame[_TILE].iloc[-1]).all(axis=1).to_numpy()
        open_from = len(frame) - (int(np.argmin(same[::-1])) if not same.all() else len(frame))
        rest = frame.iloc[open_from:].reset_index(drop=True)
        if open_from:
            yield done(frame.iloc[:open_from].reset_index(drop=True))
    if rest is not None and len(rest):
        yield done(rest)


def near_words(words: DataFrame, s: SpellingSettings) -> DataFrame:
    """For every word of ``words`` (word, n) that has near words: (word, n_near, best_n, best)."""
    length = F.length("word")
    entries = []
    for m in (length - 1, length):
        half = F.floor((m + 1) / 2).cast("int")
        for side, key in (("p", F.substring(F.col("word"), F.lit(1), half)), ("s", F.substring(F.col("word"), length - half + 1, half))):
            entries.append(F.struct(m.alias("m"), F.lit(side).alias("side"), key.alias("key"), (length > m).alias("longer")))
    bucket = ["m", "side", "key"]
    entered = words.select("word", "n", F.explode(F.array(*entries)).alias("e")).select("word", "n", "e.*")
    # A key is of use if it has two words, one of them a longer one.
    sizes = (entered.groupBy(*bucket)
             .agg(F.count("*").alias("held"), F.max("longer").alias("used"), F.sum(F.octet_length("word")).alias("bytes"))
             .where((F.col("held") > 1) & F.col("used"))
             .select(*bucket, F.greatest(F.ceil(F.col("held") / s.block), F.ceil(F.col("bytes") / s.block_bytes)).alias("blocks")))
    at = F.pmod(F.xxhash64("word"), F.col("blocks"))
    dealt = (entered.drop("longer").join(sizes, bucket).withColumn("at", at)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("word", "n", *bucket, "at", F.least("at", "other").alias("lo"), F.greatest("at", "other").alias("hi")))
    found = (dealt.repartition(*_TILE).sortWithinPartitions(*_TILE)
             .mapInPandas(_compare, "word string, near long, best_n long, best string"))
    return (found.groupBy("word").agg(F.sum("near").alias("n_near"), F.min(F.struct((-F.col("best_n")).alias("k"), "best")).alias("b"))
            .select("word", "n_near", (-F.col("b.k")).alias("best_n"), F.col("b.best").alias("best")))


def roots(links: DataFrame) -> DataFrame:
    """(word, root) for rows (word, form): the last word reached by following forms. Each round
    doubles the steps taken; forms have larger counts than their words, so there are no circles."""
    links = write_stage(links.select("word", F.col("form").alias("root")), "spelling_links")
    while True:
        # The forms that have a form themselves; few, and one row each.
        onward = links.select("root").distinct().join(links.select(F.col("word").alias("root"), F.col("root").alias("next")), "root")
        moved = links.join(onward, "root", "left").select("word", F.coalesce("next", "root").alias("root"),
                                                          F.col("next").isNotNull().alias("moved"))
        moved = write_stage(moved, "spelling_links")
        links = moved.select("word", "root")
        if moved.where("moved").isEmpty():
            return links


def spelling_variants(documents: DataFrame, settings: SpellingSettings | None = None) -> DataFrame:
    """One row (word, form, root, n, n_near, form_n) per word of ``documents`` (doc_id, text)."""
    s = settings or SpellingSettings()
    words = write_stage(count_words(documents, s), "spelling_words")
    near = near_words(words, s)
    is_form = F.col("best_n") >= F.col("n") * s.form_ratio
    known = words.join(near, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0).cast("long")).alias("n_near"),
        F.when(is_form, F.col("best")).alias("form"), F.when(is_form, F.col("best_n")).alias("form_n"))
    known = write_stage(known, "spelling_forms")
    rooted = roots(known.where(F.col("form").isNotNull()))
    return known.join(rooted, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def spelling_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every frequent word of the documents with its near words, its form and its root."""
    return spelling_variants(read_table(spark, sf_dir, "documents").select("doc_id", "text"))


#: The hash is the CRC-32 polynomial worked bit by bit over the UTF-8 bytes (a step of -1 shifts one
#: bit out); near words are found by deleting a code point from either.
SPELLING_SQL = r"""
WITH RECURSIVE runs AS (
    SELECT coalesce(CAST(doc_id AS VARCHAR), '') AS id, run, count(*) AS n
    FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                   '[a-z\x{C0}-\x{FF}]+')) AS run FROM documents)
    WHERE length(run) >= 6 GROUP BY ALL
),
steps AS (
    SELECT id, run, n, flatten(list_transform(
        flatten(list_transform(string_split(id || ':' || run, ''),
                lambda c: CASE WHEN ord(c) < 128 THEN [ord(c)] ELSE [192 + ord(c) // 64, 128 + ord(c) % 64] END)),
        lambda b: [CAST(b AS BIGINT), -1, -1, -1, -1, -1, -1, -1, -1])) AS s
    FROM runs
),
hashed AS (
    SELECT run, n, xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), s),
                       lambda a, e: CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384 * (a & 1)) END), 4294967295) AS h
    FROM steps
),
words AS MATERIALIZED (
    SELECT word, CAST(sum(n) AS BIGINT) AS n
    FROM (SELECT CASE WHEN h % 199 = 0 THEN left(run, CAST(h % length(run) AS INT)) || substr(run, CAST(h % length(run) AS INT) + 2)
                      ELSE run END AS word, n FROM hashed)
    WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5
),
cut AS MATERIALIZED (
    SELECT word, n, k, left(word, k - 1) || substr(word, k + 1) AS rest
    FROM (SELECT word, n, unnest(generate_series(1, length(word))) AS k FROM words)
),
near AS (
    SELECT a.word, b.word AS other, b.n FROM cut a JOIN cut b ON a.k = b.k AND a.rest = b.rest AND a.word <> b.word
    UNION
    SELECT a.word, b.word, b.n FROM cut a JOIN words b ON b.word = a.rest
    UNION
    SELECT b.word, a.word, a.n FROM cut a JOIN words b ON b.word = a.rest
),
best AS (
    SELECT word, count(*) AS n_near, first(other ORDER BY n DESC, other) AS other, max(n) AS best_n FROM near GROUP BY word
),
known AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.best_n >= 5 * w.n THEN b.other END AS form,
           CASE WHEN b.best_n >= 5 * w.n THEN b.best_n END AS form_n
    FROM words w LEFT JOIN best b USING (word)
),
walk(word, reached) AS (
    SELECT word, word FROM known
    UNION ALL
    SELECT walk.word, known.form FROM walk JOIN known ON known.word = walk.reached WHERE known.form IS NOT NULL
)
SELECT k.word, k.form, w.reached AS root, k.n, k.n_near, k.form_n
FROM known k JOIN walk w USING (word) JOIN known e ON e.word = w.reached AND e.form IS NULL
"""
