r"""Secret scan with multipart credential linking, in DataFrame operations only.

Strong (base) parts are found per kind, leftmost and non-overlapping, in every whole text:

* ``assign``: a keyword, ``:`` or ``=`` and a value of 8 or more characters;
* ``access``: ``AKIA`` and capitals or digits, 16 or more characters in all;
* ``hex``: 32 or more lower-case hexadecimal digits.

Weak candidates prove nothing alone: ``ident`` (account names, short key ids), ``opaque``
(long mixed tokens without a keyword) and ``endpoint`` (URLs, host:port). They are linked by an
interval join: a weak candidate is reported when, within ``scope`` code points in the same
document, the parts that complete a credential occur: a secret (assign, hex, opaque) for an
identifier, an identifier (access, ident) for an opaque token, both for an endpoint. The join
needs only the smallest and largest position of each role in each scope-wide bucket, so its
rows grow with the parts, never with their pairs, however many parts one document has.

Positions come from the lengths of the gaps between matches (``split``) and of the matches, in
code points, end exclusive.

Defined results: a null text counts as empty; an empty text has no spans (its digest is that of
the empty string); weak candidates that overlap a base span are dropped; documents repeated
with the same id and text get the same spans each; a null id is a value like any other. Extra
columns are carried through by :func:`redact` and never read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout.llm.common import content, free_name, read_table
from stockout.stage import write_stage

# Kinds in the order in which they are listed and sorted.
KINDS = ("assign", "access", "hex", "ident", "opaque", "endpoint")
N_BASE = 3
# The base patterns. A run of fewer than 32 hexadecimal digits, or an access key
# of fewer than 16 characters, holds no longer match inside, so their lengths are in the pattern;
# a failed assignment still consumes its match, so its length is checked afterwards.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
MIN_ASSIGN = 8
ACCESS = r"AKIA[A-Z0-9]{12,}"
HEX = r"[0-9a-f]{32,}"
# Weak patterns.
IDENT = (r"""(?i:\b(?:user_?name|user_?id|login|account|client_?id|access_?key_?id)"""
         r"""["']?\x20*[:=]\x20*["']?[A-Za-z0-9@_.-]{3,})|\b(?:AKIA|ASIA|AIDA|AROA)[A-Z0-9]{6,}""")
OPAQUE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{20,}"
# No group is repeated in any pattern: the matcher would recurse once a turn. The names of a host
# are looked at afterwards.
ENDPOINT = (r"""(?i:\bhttps?://[^\s"'<>|,;)]+)|(?<![A-Za-z0-9.-])[A-Za-z0-9-][A-Za-z0-9.-]*+:[0-9]{2,5}(?![0-9])""")

IDENTIFIER, SECRET, HOST = 0, 1, 2
ROLES = (SECRET, IDENTIFIER, SECRET, IDENTIFIER, SECRET, HOST)  # of each kind
#: Roles that must occur near a weak candidate of each kind.
COMPLEMENT = {3: (SECRET,), 4: (IDENTIFIER,), 5: (IDENTIFIER, SECRET)}

_SPAN = "struct<start:int,kind:int,end:int>"
_NO_SPANS = f"cast(array() as array<{_SPAN}>)"


@dataclass(frozen=True)
class SecretSettings:
    """``scope``: largest distance, in code points, between the starts of linked parts."""

    scope: int = 200


def _span(start: Column, kind: int, end: Column) -> Column:
    return F.struct(start.cast("int").alias("start"), F.lit(kind).alias("kind"), end.cast("int").alias("end"))


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once: what a lambda only captures is worked out anew for
    every element."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _blocks(items: Column) -> Column:
    """The array in pieces of about the root of its length, so that work that is square in a piece, or in
    the number of pieces, stays far from square in the array."""
    def cut(whole: Column) -> Column:
        size = F.greatest(F.ceil(F.sqrt(F.size(whole))).cast("int"), F.lit(1))
        starts = F.sequence(F.lit(0), F.greatest(F.size(whole) - 1, F.lit(0)), size)
        return F.transform(starts, lambda at: F.slice(whole, at + 1, size))

    return _let(items, cut)


def _running(values: Column, combine: Callable[[Column, Column], Column], start: int) -> Column:
    """``combine`` of ``start`` and all values up to each place, that place included."""
    def grow(items: Column, first: Column) -> Column:
        return F.aggregate(items, F.struct(first.alias("at"), F.expr("cast(array() as array<int>)").alias("out")),
                           lambda acc, x: F.struct(combine(acc["at"], x).alias("at"),
                                                   F.concat(acc["out"], F.array(combine(acc["at"], x))).alias("out")),
                           lambda acc: acc["out"])

    def by_piece(pieces: Column) -> Column:
        ends = grow(F.transform(pieces, lambda piece: F.aggregate(piece, F.lit(start), combine)), F.lit(start))
        starts = F.slice(F.concat(F.array(F.lit(start)), ends), F.lit(1), F.size(pieces))
        return F.flatten(F.zip_with(pieces, starts, grow))

    return _let(_blocks(values), by_piece)


def _located(kind: int, gaps: Column, matches: Column, keep) -> Column:
    """Spans of the matches that ``keep`` accepts: each starts where the gaps and matches
    before it end."""
    lengths = F.zip_with(F.slice(gaps, F.lit(1), F.size(matches)), matches, lambda g, m: F.length(g) + F.length(m))
    ends = _running(lengths, lambda a, b: a + b, 0)
    located = F.zip_with(matches, ends, lambda m, end: F.struct(m.alias("match"), end.alias("end")))
    spans = F.transform(F.filter(located, keep),
                        lambda x: _span(x["end"] - F.length(x["match"]), kind, x["end"]))
    return F.when(F.size(matches) > 0, spans).otherwise(F.expr(_NO_SPANS))


def _clear_of(base: Column, candidates: Column) -> Column:
    """Candidates that overlap no base span: in order of start, no base span before one ends behind its
    start, and none after it starts before its end."""
    whole = F.array_sort(F.concat(base, candidates))
    is_base = lambda s: s["kind"] < N_BASE
    reach = _running(F.transform(whole, lambda s: F.when(is_base(s), s["end"]).otherwise(0)), lambda a, b: F.greatest(a, b), 0)
    nobody = 2**31 - 1
    following = F.reverse(_running(F.transform(F.reverse(whole), lambda s: F.when(is_base(s), s["start"]).otherwise(nobody)),
                                   lambda a, b: F.least(a, b), nobody))
    both = F.arrays_zip(whole.alias("span"), reach.alias("reach"), following.alias("following"))
    kept = F.filter(both, lambda x: ~is_base(x["span"]) & (x["reach"] <= x["span"]["start"]) & (x["following"] >= x["span"]["end"]))
    return F.when((F.size(base) > 0) & (F.size(candidates) > 0), F.transform(kept, lambda x: x["span"])).otherwise(candidates)


def _named_host(endpoint: Column) -> Column:
    """Whether a host and port has at least two names of 1 to 63 characters, the last of 2 to 24 letters."""
    names = F.split(F.substring_index(endpoint, ":", 1), r"\.")
    return ((F.size(names) > 1) & F.element_at(names, -1).rlike("^[A-Za-z]{2,24}$")
            & F.forall(names, lambda n: F.length(n).between(1, 63)))


def _document_key() -> Column:
    """Identity of a row for joins: its id (null included) and its text."""
    return F.concat_ws(":", F.coalesce(F.col("doc_id").cast("string"), F.lit("null")),
                       F.xxhash64(content()).cast("string"))


def parts(documents: DataFrame) -> DataFrame:
    """Rows (doc_id, doc_key, base, weak): sorted base spans and unlinked weak candidates."""
    patterns = (ASSIGN, ACCESS, HEX, IDENT, OPAQUE, ENDPOINT)
    t = F.col("t")
    found = (documents.select("doc_id", _document_key().alias("doc_key"), content().alias("t"))
             .select("doc_id", "doc_key", "t",
                     *[F.regexp_extract_all(t, F.lit(p), F.lit(0)).alias(f"m{i}") for i, p in enumerate(patterns)]))
    found = found.select("*", *[F.when(F.size(f"m{i}") > 0, F.split(t, p, -1)).alias(f"g{i}")
                                for i, p in enumerate(patterns)])
    # The value of an assignment is what follows the last character of its prefix.
    value = lambda m: F.regexp_extract(m, ASSIGN, 2)
    everything = lambda x: F.lit(True)
    keeps = {
        0: lambda x: F.length(value(x["match"])) >= MIN_ASSIGN,
        4: lambda x: x["match"].rlike("[0-9]") & x["match"].rlike("[A-Z]") & x["match"].rlike("[a-z]"),
        5: lambda x: x["match"].contains("://") | _named_host(x["match"]),
    }
    spans = [_located(i, F.col(f"g{i}"), F.col(f"m{i}"), keeps.get(i, everything)) for i in range(len(KINDS))]
    found = found.select("doc_id", "doc_key", F.array_sort(F.concat(*spans[:N_BASE])).alias("base"),
                         F.concat(*spans[N_BASE:]).alias("candidates"))
    return found.select("doc_id", "doc_key", "base", _clear_of(F.col("base"), F.col("candidates")).alias("weak"))


def _role(kind: Column) -> Column:
    return F.element_at(F.array(*[F.lit(r) for r in ROLES]), kind + 1)


def linked_weak(found: DataFrame, scope: int) -> DataFrame:
    """Rows (doc_key, linked): the weak candidates of :func:`parts` whose complementary parts
    lie within ``scope``. A candidate meets the extremes of its own bucket and its two
    neighbours: in the own bucket any part is near enough, before it the last one decides,
    after it the first."""
    bucket = lambda c: F.floor(F.col(c) / scope)
    rows = found.where(F.size("weak") > 0)
    extents = (rows.select("doc_key", F.explode(F.concat("base", "weak")).alias("p"))
               .select("doc_key", F.col("p.start").alias("at"), _role(F.col("p.kind")).alias("role"))
               .groupBy("doc_key", bucket("at").alias("bucket"), "role")
               .agg(F.min("at").alias("first"), F.max("at").alias("last")))
    needs = F.create_map(*[x for kind, roles in COMPLEMENT.items()
                           for x in (F.lit(kind), F.array(*[F.lit(r) for r in roles]))])
    wanted = (rows.select("doc_key", F.explode("weak").alias("w")).distinct()
              .withColumn("needed", needs[F.col("w.kind")])
              .select("doc_key", "w", F.size("needed").alias("n_needed"), F.explode("needed").alias("role"))
              .withColumn("at", F.col("w.start"))
              .withColumn("bucket", F.explode(F.sequence(bucket("at") - 1, bucket("at") + 1))))
    near = ((F.col("last") >= F.col("at") - scope) & (F.col("first") <= F.col("at") + scope))
    return (wanted.join(extents, ["doc_key", "bucket", "role"]).where(near)
            .groupBy("doc_key", "w", "n_needed").agg(F.count_distinct("role").alias("n_met"))
            .where(F.col("n_met") == F.col("n_needed"))
            .groupBy("doc_key").agg(F.collect_list("w").alias("linked")))


def find_secrets(documents: DataFrame, settings: SecretSettings | None = None) -> DataFrame:
    """One row (doc_id, doc_key, base, spans) per document: base spans, and all spans with the
    linked weak ones, each an array of (start, kind, end) in order."""
    settings = settings or SecretSettings()
    # The parts are few and read twice, the texts only once.
    found = write_stage(parts(documents), "secret_parts")
    linked = linked_weak(found, settings.scope)
    spans = F.array_sort(F.concat("base", F.coalesce(F.col("linked"), F.expr(_NO_SPANS))))
    return found.join(linked, "doc_key", "left").select("doc_id", "doc_key", "base", spans.alias("spans"))


def spans_text(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def redact(documents: DataFrame, settings: SecretSettings | None = None, mask: str = "[secret]") -> DataFrame:
    """``documents`` with every reported span of ``text`` replaced by ``mask`` (overlapping
    spans by one), and ``n_chars``, where there is one, set to the new length. Texts without
    spans, null ones included, stay as they are."""
    names = documents.columns
    key, spans, cut = (free_name(n, names) for n in ("_secret_key", "_secret_spans", "_secret_cuts"))
    hits = (find_secrets(documents.select("doc_id", "text"), settings).where(F.size("spans") > 0)
            .select(F.col("doc_key").alias(key), F.col("spans").alias(spans)).dropDuplicates([key]))

    # Spans are gathered to runs, and each run is cut out of its own stretch of the text.
    ends = _running(F.transform(F.col(spans), lambda s: s["end"]), lambda a, b: F.greatest(a, b), 0)
    cuts = _let(ends, lambda e: F.transform(F.col(spans), lambda s, k: F.struct(
        F.coalesce(F.get(e, k - 1), F.lit(0)).alias("from"), s["start"].alias("to"), F.get(e, k).alias("next"))))

    def stretch(piece: Column) -> Column:
        first, last = piece[0]["from"], F.element_at(piece, -1)["next"]
        part = F.struct(F.substring(F.col("text"), first + 1, last - first).alias("t"), first.alias("at"))
        return _let(part, lambda p: F.array_join(F.flatten(F.transform(
            F.filter(piece, lambda c: c["to"] >= c["from"]),
            lambda c: F.array(F.substring(p["t"], c["from"] - p["at"] + 1, c["to"] - c["from"]), F.lit(mask)))), ""))

    masked = F.concat(F.array_join(F.transform(_blocks(F.col(cut)), stretch), ""),
                      F.substring(F.col("text"), F.element_at(F.col(cut), -1)["next"] + 1, F.length("text")))
    text = F.when(F.col(spans).isNull(), F.col("text")).otherwise(masked)
    joined = (documents.withColumn(key, _document_key()).join(hits, key, "left")
              .withColumn(cut, F.when(F.col(spans).isNotNull(), cuts)))
    out = joined.withColumn("text", text)
    if "n_chars" in names:
        out = out.withColumn("n_chars", F.when(F.col(spans).isNull(), F.col("n_chars")).otherwise(
            F.length("text").cast(documents.schema["n_chars"].dataType)))
    return out.select(*names)


def secrets_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with its counts, the digest of its base spans, and all spans."""
    found = find_secrets(read_table(spark, sf_dir, "documents"))
    count = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return found.select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
                        F.sha2(spans_text(F.col("base")), 256).alias("base_sha256"),
                        spans_text(F.col("spans")).alias("spans"))
