"""Near-duplicate documents by ProbMinHash.

A document is the weighted set of its runs of five words (lower-cased, split at white space);
a run that occurs n times weighs 1 + ln n. For each run arrivals of a Poisson process, whose rate is its
weight and whose random numbers come from its hash alone, fall on random registers; a register
keeps the run that arrives first, and a document's runs stop as soon as they arrive later than
all registers are taken (early termination). Two documents agree in a register with probability
equal to their probability Jaccard similarity. Registers are grouped to bands; documents that
agree in a whole band are candidates and are verified by their exact probability Jaccard.

No group is ever expanded to all its pairs, and no link between groups is lost:

* documents with the same words in the same order form a class, whose smallest id stands for it;
* in every bucket of a band, members are verified against the smallest member only (their registers
  first, then their texts); verified links are merged to components;
* buckets whose members are still in different components are looked at again: in each of
  ``rounds`` rounds, members are verified against one member of another component, drawn anew
  per bucket by a hash, so that a large group falls together in a few rounds;
* what is then still apart is compared block against block: a task compares the registers of two
  blocks of a bucket, verifies pairs across components whose registers leave a similarity of
  ``threshold`` possible, each pair in the first band it shares, and returns only links that
  join components. No table of pairs is made, however many members are similar but not enough.

Defined results: rows with a null id are never compared and stay; a null text counts as empty;
texts without words form one class; a text of fewer than five words is one run; rows of one id
count as one document, whose texts are all linked (:func:`deduplicate` keeps one of the rows).
Extra columns are carried through by :func:`deduplicate` and never read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stockout.llm.common import WordHashes, by_group, content, free_name, read_table, rolling
from stockout.llm.components import connected_components
from stockout.stage import write_stage


@dataclass(frozen=True)
class MinHashSettings:
    """20 bands of 5 registers make a pair of similarity 0.8 a candidate with probability 0.9996,
    and with more if closer. ``slack``: how far the estimated similarity of a pair across
    components may fall below the threshold before it is not verified (four deviations of the
    estimate from 100 registers). ``pair_slack``: the same for pairs of a bucket that are verified one by
    one (six deviations: one link in ten million or less, far below what bands miss)."""

    words: int = 5
    threshold: float = 0.8
    bands: int = 20
    rows: int = 5
    slack: float = 0.16
    pair_slack: float = 0.24
    rounds: int = 2
    block: int = 256
    seed: int = 90_173

    @property
    def registers(self) -> int:
        return self.bands * self.rows


def shingles(words: list[str], k: int, hash_words: WordHashes) -> tuple[np.ndarray, np.ndarray]:
    """Distinct runs of ``k`` words (the whole text if shorter) as hashes, and their weights."""
    if not words:
        return np.zeros(0, dtype=np.uint64), np.zeros(0)
    h = rolling(hash_words(words), min(k, len(words))).view(np.uint64)
    values, counts = np.unique(h, return_counts=True)
    return values, 1.0 + np.log(counts)


def probability_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Sum over common elements d of 1 / sum over e of max(a_e / a_d, b_e / b_d). With the ratio
    b / a sorted, the inner sum is a prefix sum of a and a suffix sum of b."""
    common, ia, ib = np.intersect1d(a[0], b[0], assume_unique=True, return_indices=True)
    if not len(common):
        return 0.0
    wa, wb = a[1][ia], b[1][ib]
    order = np.argsort(wb / wa, kind="stable")
    wa, wb = wa[order], wb[order]
    only_a, only_b = a[1].sum() - wa.sum(), b[1].sum() - wb.sum()
    # Elements of ratio up to d's count by a, those above by b; of equal ratio both agree.
    below = only_a + np.cumsum(wa)
    above = only_b + wb.sum() - np.cumsum(wb)
    return float((1.0 / (below / wa + above / wb)).sum())


_M1, _M2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def _mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finalizer (splitmix)."""
    x = (x ^ (x >> np.uint64(30))) * _M1
    x = (x ^ (x >> np.uint64(27))) * _M2
    return x ^ (x >> np.uint64(31))


def prob_min_hash(owner: np.ndarray, element: np.ndarray, weight: np.ndarray, n: int, s: MinHashSettings) -> np.ndarray:
    """Registers (n, registers) of ``n`` weighted sets given as parallel arrays; an empty set
    has zeros. All elements' next arrivals are drawn together, round by round; an element whose
    arrival comes after all of its set's registers are taken earlier draws no more."""
    m = s.registers
    first = np.full(n * m, np.inf)
    taken = np.zeros(n * m, dtype=np.uint64)
    time = np.zeros(len(element))
    turn = 0
    while len(element):
        turn += 1
        draw = _mix(element + np.uint64((s.seed + turn * 0x9E3779B97F4A7C15) % 2**64))
        time = time - np.log(((draw >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53) / weight
        register = (_mix(draw ^ _M2) % np.uint64(m)).astype(np.int64) + owner * m
        # The earliest arrival per register; of equal ones the smaller element.
        order = np.lexsort((element, time, register))
        register_sorted = register[order]
        lead = np.concatenate([[True], register_sorted[1:] != register_sorted[:-1]])
        spot, winner = register_sorted[lead], order[lead]
        better = time[winner] < first[spot]
        spot, winner = spot[better], winner[better]
        first[spot], taken[spot] = time[winner], element[winner]
        alive = time < first.reshape(n, m).max(axis=1)[owner]
        owner, element, weight, time = owner[alive], element[alive], weight[alive], time[alive]
    return taken.reshape(n, m)


def band_keys(registers: np.ndarray, s: MinHashSettings) -> np.ndarray:
    """One number per band, from its registers and its place."""
    parts = registers.reshape(len(registers), s.bands, s.rows)
    key = np.broadcast_to(np.arange(1, s.bands + 1, dtype=np.uint64), parts.shape[:2])
    for r in range(s.rows):
        key = _mix(key * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r])
    return key.view(np.int64)


def words_of(text: str | None) -> list[str]:
    return text.lower().split() if text else []


def _together(texts: list[str | None], characters: int = 400_000) -> Iterator[list[str | None]]:
    """Texts that are sketched at once: their arrays take some 60 bytes a word, so they are counted by
    length; a longer text comes alone."""
    held: list[str | None] = []
    size = 0
    for t in texts:
        if held and (size + len(t or "") > characters or len(held) >= 256):
            yield held
            held, size = [], 0
        held.append(t)
        size += len(t or "")
    if held:
        yield held


def sketch_texts(texts: list[str | None], s: MinHashSettings) -> Iterator[tuple[int, int, bytes, bytes]]:
    """Per text: two numbers of the digest of its words, its band keys and the low 16 bits of its
    registers."""
    hash_words = WordHashes()
    for some in _together(texts):
        split = [words_of(t) for t in some]
        sets = [shingles(w, s.words, hash_words) for w in split]
        sizes = np.array([len(v) for v, _ in sets])
        owner = np.repeat(np.arange(len(sets)), sizes)
        registers = prob_min_hash(owner, np.concatenate([v for v, _ in sets]), np.concatenate([w for _, w in sets]),
                                  len(sets), s)
        bands = band_keys(registers, s)
        for k, words in enumerate(split):
            digest = xxhash.xxh3_128_digest(" ".join(words).encode("utf-8", "surrogatepass"))
            keys = bands[k].astype("<i8").tobytes() if words else b""
            yield (int.from_bytes(digest[:8], "little", signed=True), int.from_bytes(digest[8:], "little", signed=True),
                   keys, registers[k].astype("<u2").tobytes())


def _sketch(s: MinHashSettings) -> Column:
    def sketch(texts: pd.Series) -> pd.DataFrame:
        return pd.DataFrame(sketch_texts(texts.tolist(), s), columns=["c1", "c2", "bands", "registers"])

    return F.pandas_udf(sketch, "c1 long, c2 long, bands binary, registers binary")(F.col("text"))


def _similarity(s: MinHashSettings, a: str, b: str) -> Column:
    """Exact similarity of two packed texts. Pairs come sorted by their first text, which is
    unpacked once for its run of pairs."""
    def similarity(left: pd.Series, right: pd.Series) -> pd.Series:
        unpack = zstandard.ZstdDecompressor()
        hash_words = WordHashes()

        def open_(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
            text = unpack.decompress(raw).decode("utf-8", "surrogatepass")
            return shingles(words_of(text), s.words, hash_words)

        out, last, mine = [], None, None
        for x, y in zip(left, right, strict=True):
            if x != last:
                last, mine = x, open_(x)
            out.append(probability_jaccard(mine, open_(y)))
        return pd.Series(out, dtype=float)

    return F.pandas_udf(similarity, "double")(F.col(a), F.col(b))


def _packed() -> Column:
    def pack(texts: pd.Series) -> pd.Series:
        packer = zstandard.ZstdCompressor(level=1)
        return pd.Series([packer.compress((t or "").encode("utf-8", "surrogatepass")) for t in texts])

    return F.pandas_udf(pack, "binary")(F.col("text"))


def _numbers(column: str, n: int, size: int) -> Column:
    """The ``n`` numbers of ``size`` bytes in a binary column (as if big-endian: they are only
    compared with each other)."""
    hexed = F.hex(F.col(column))
    number = lambda i: F.conv(F.substring(hexed, i * 2 * size + 1, F.lit(2 * size)), 16, -10)
    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)),
                       lambda i: number(i).cast("long" if size == 8 else "int"))


def _agreement(a: str, b: str) -> Column:
    """Registers in which two sketches agree."""
    def agreement(left: pd.Series, right: pd.Series) -> pd.Series:
        x, y = (np.frombuffer(b"".join(side), dtype="<u2").reshape(len(side), -1) for side in (left, right))
        return pd.Series((x == y).sum(axis=1), dtype=np.int64)

    return F.pandas_udf(agreement, "long")(F.col(a), F.col(b))


def _with_both(pairs: DataFrame, rows: DataFrame, column: str) -> DataFrame:
    """``pairs`` (a, b) with ``column`` of the rows of both documents as ``column``_a and _b, by one plan at
    every size."""
    side = lambda c: rows.select(F.col("doc_id").alias(c), F.col(column).alias(f"{column}_{c}")).hint("merge")
    return pairs.join(side("b"), "b").join(side("a"), "a")


def verified(pairs: DataFrame, documents: DataFrame, s: MinHashSettings, sketches: DataFrame | None = None) -> DataFrame:
    """The pairs (a, b) of document ids whose texts are similar enough. Only texts that occur in
    a pair travel to the pairs, packed, and never as a broadcast: the plan is the same at every size.
    With ``sketches`` (doc_id, registers) the registers, a fraction of a text, go first: texts travel
    only to pairs whose estimated similarity does not rule the threshold out."""
    if sketches is not None:
        known = sketches.select("doc_id", "registers").join(
            pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct(), "doc_id", "left_semi").distinct()
        near = _agreement("registers_a", "registers_b") >= (s.threshold - s.pair_slack) * s.registers
        pairs = write_stage(_with_both(pairs, known, "registers").where(near).select("a", "b").distinct(), "minhash_near")
    involved = pairs.select(F.explode(F.array("a", "b")).alias("doc_id")).distinct()
    texts = write_stage(documents.select(F.col("doc_id").cast("long").alias("doc_id"), _packed().alias("packed"))
                        .join(involved, "doc_id", "left_semi"), "minhash_texts")
    return (_with_both(pairs, texts, "packed").where(_similarity(s, "packed_a", "packed_b") >= s.threshold)
            .select("a", "b").distinct())


def near_duplicates(documents: DataFrame, settings: MinHashSettings | None = None) -> DataFrame:
    """One row per row of ``documents`` (doc_id, text): doc_id, class_id (smallest id with the
    same words), component_id (smallest id reached by links) and kept (doc_id = component_id)."""
    s = settings or MinHashSettings()
    sketches = write_stage(documents.select(F.col("doc_id").cast("long").alias("doc_id"), _sketch(s).alias("s"))
                           .select("doc_id", "s.*"), "minhash_sketches")
    known = sketches.where(F.col("doc_id").isNotNull())
    classes = write_stage(known.groupBy("c1", "c2").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"),
                                                        F.first("registers").alias("registers")), "minhash_classes")
    places = (classes.where(F.length("bands") > 0)
              .select("rep", F.posexplode(_numbers("bands", s.bands, 8)).alias("band", "key")))
    hubs = (places.groupBy("band", "key").agg(F.min("rep").alias("hub"), F.count("*").alias("n"))
            .where("n > 1").drop("n"))
    members = write_stage(places.join(hubs, ["band", "key"]), "minhash_members")
    tried = write_stage(members.where("rep != hub").select(F.col("hub").alias("a"), F.col("rep").alias("b")).distinct(),
                        "minhash_pairs")
    # An id whose rows differ stands for several classes, which are linked by it.
    own = (known.join(classes.select("c1", "c2", "rep"), ["c1", "c2"]).where("doc_id != rep")
           .select(F.col("doc_id").alias("a"), F.col("rep").alias("b")))
    doubled = known.groupBy("doc_id").agg(F.min("c1").alias("x"), F.max("c1").alias("y")).where("x != y").select(
        F.col("doc_id").alias("a"))
    same_id = own.join(doubled, "a", "left_semi")
    links = write_stage(verified(tried, documents, s, sketches).unionByName(same_id), "minhash_links")
    components = connected_components(links)
    bucket = ["band", "key"]
    for turn in range(s.rounds + 1):
        placed = (members.select(*bucket, "rep").join(components.withColumnRenamed("node", "rep"), "rep", "left")
                  .withColumn("component", F.coalesce("component", "rep")))
        draw = F.xxhash64("rep", *bucket, F.lit(turn))
        mixed = (placed.groupBy(*bucket)
                 .agg(F.min("component").alias("x"), F.max("component").alias("y"),
                      F.min_by(F.struct("rep", "component"), draw).alias("drawn")).where("x != y"))
        open_ = write_stage(placed.join(mixed.select(*bucket, "drawn"), bucket), "minhash_open")
        if open_.isEmpty():
            break
        if turn < s.rounds:
            pairs = open_.where(F.col("component") != F.col("drawn.component")).select(
                F.least("rep", "drawn.rep").alias("a"), F.greatest("rep", "drawn.rep").alias("b"))
            pairs = write_stage(pairs.distinct().join(tried, ["a", "b"], "left_anti"), "minhash_pairs")
            tried = tried.unionByName(pairs)
            new = verified(pairs, documents, s, sketches)
        else:
            new = _links_across(open_, classes, documents, s)
        new = write_stage(new, "minhash_links")
        if not new.isEmpty():
            links = links.unionByName(new)
            components = connected_components(links)

    resolved = (classes.select("c1", "c2", F.col("rep").alias("class_id"))
                .join(components, F.col("class_id") == F.col("node"), "left")
                .select("c1", "c2", "class_id", F.coalesce("component", "class_id").alias("component_id")))
    out = sketches.select("doc_id", "c1", "c2").join(resolved, ["c1", "c2"], "left")
    identified = F.col("doc_id").isNotNull()
    return out.select("doc_id", F.when(identified, F.col("class_id")).alias("class_id"),
                      F.when(identified, F.col("component_id")).alias("component_id"),
                      (~identified | (F.col("doc_id") == F.col("component_id"))).alias("kept"))


def _compare_blocks(s: MinHashSettings):
    """For rows of one block pair: links that join two of its components."""
    def links(frame: pd.DataFrame) -> Iterator[tuple[int, int]]:
        reps, component = frame["rep"].tolist(), frame["component"].tolist()
        own, band = frame["own"].to_numpy(), int(frame["band"].iloc[0])
        lo, hi = int(frame["lo"].iloc[0]), int(frame["hi"].iloc[0])
        registers = np.stack([np.frombuffer(r, dtype="<u2") for r in frame["registers"]])
        keys = np.stack([np.frombuffer(r, dtype="<i8") for r in frame["bands"]])
        parent: dict[int, int] = {}

        def find(x: int) -> int:
            while parent.setdefault(x, x) != x:
                x = parent[x]
            return x

        reader, hash_words, opened = zstandard.ZstdDecompressor(), WordHashes(), {}

        def runs(k: int) -> tuple[np.ndarray, np.ndarray]:
            if k not in opened:
                text = reader.decompress(frame["packed"].iloc[k]).decode("utf-8", "surrogatepass")
                opened[k] = shingles(words_of(text), s.words, hash_words)
            return opened[k]

        second = np.flatnonzero(own == hi)
        for i in np.flatnonzero(own == lo).tolist():
            others = second[second > i] if lo == hi else second
            agree = (registers[others] == registers[i]).sum(axis=1)
            earlier = (keys[others, :band] == keys[i, :band]).any(axis=1)
            for j in others[(agree >= (s.threshold - s.slack) * s.registers) & ~earlier].tolist():
                x, y = find(component[i]), find(component[j])
                if x != y and probability_jaccard(runs(i), runs(j)) >= s.threshold:
                    parent[max(x, y)] = min(x, y)
                    yield reps[i], reps[j]

    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for group in by_group(batches, ["band", "key", "lo", "hi"]):
            yield pd.DataFrame(list(links(group)), columns=["a", "b"], dtype=np.int64)

    return compare


def _links_across(open_: DataFrame, classes: DataFrame, documents: DataFrame, s: MinHashSettings) -> DataFrame:
    """Links (a, b) between members of one bucket that are in different components."""
    bucket = ["band", "key"]
    n_blocks = open_.groupBy(*bucket).agg(F.ceil(F.count("*") / s.block).alias("n"))
    # An id may have rows of several classes: each class is compared by a text of its own.
    mine = documents.select(F.col("doc_id").cast("long").alias("rep"), "text").join(
        open_.select("rep").distinct(), "rep", "left_semi")
    texts = write_stage(mine.select("rep", _sketch(s).alias("s"), _packed().alias("packed"))
                        .select("rep", "s.c1", "s.c2", "packed").dropDuplicates(["rep", "c1", "c2"]), "minhash_texts")
    own, other = F.col("own"), F.col("other")
    rows = (open_.dropDuplicates([*bucket, "rep"]).join(n_blocks, bucket).withColumn("own", F.pmod(F.xxhash64("rep"), F.col("n")))
            .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1)))
            .select("rep", "component", *bucket, "own", F.least(own, other).alias("lo"), F.greatest(own, other).alias("hi"))
            .join(classes.select("rep", "c1", "c2", "bands", "registers").hint("merge"), "rep")
            .join(texts.hint("merge"), ["rep", "c1", "c2"]))
    place = [*bucket, "lo", "hi"]
    return (rows.repartition(*place).sortWithinPartitions(*place, "rep", "c1", "c2")
            .mapInPandas(_compare_blocks(s), "a long, b long"))


def deduplicate(documents: DataFrame, settings: MinHashSettings | None = None) -> DataFrame:
    """``documents`` with one row of each group: that of the smallest id and, of several rows of
    one id, that of the smallest text hash. Rows with a null id all stay."""
    names = documents.columns
    gone_id, alone, tie, place = (free_name(n, names) for n in ("_gone", "_alone", "_tie", "_place"))
    gone = (near_duplicates(documents.select("doc_id", "text"), settings).where(~F.col("kept"))
            .select(F.col("doc_id").alias(gone_id)).distinct())
    left = documents.join(gone, F.col("doc_id") == F.col(gone_id), "left_anti")
    # Rows without an id are alone, whatever their number; a column of their texts spreads them.
    left = left.withColumns({tie: F.xxhash64(content()),
                             alone: F.when(F.col("doc_id").isNull(), F.xxhash64(content()))})
    first = Window.partitionBy("doc_id", alone).orderBy(tie)
    return (left.withColumn(place, F.row_number().over(first))
            .where((F.col(place) == 1) | F.col("doc_id").isNull()).select(*names))


def minhash_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its class, its component and whether it stays."""
    return near_duplicates(read_table(spark, sf_dir, "documents"))
