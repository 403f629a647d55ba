"""URL filter: host and path rules first, gradient-boosted trees for the rest.

A rule fits its host and all subdomains when the path starts with the rule's path; the longest
fitting rule decides. URLs that a rule decides are the labelled ones: a gradient-boosted tree
classifier (Spark ML) learns from their lexical features (lengths, depth, digit ratio,
character entropy, parameter counts) and from statistics of their host suffixes, and judges
the URLs that no rule fits. Suffix statistics are smoothed block rates and frequencies counted
over all labelled URLs; when a URL's own label is in the counts it is taken out first, so the
trees do not learn to read it back.

The trees may be fitted on a bounded sample: about ``max_training_rows`` labelled URLs, chosen
by a hash of the URL. Suffix statistics always cover all of them, and every URL is scored.

Defined results: a null URL, or one without ``://``, has an empty host and an empty path and no
rule; its features are those of the empty text. Repeated rows each get a row. Without labelled
URLs everything else is allowed; with labels of one kind only, all get that kind. Extra
columns are carried through by :func:`judge` and never read.
"""

from __future__ import annotations

import string
from dataclasses import dataclass

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stockout.llm.common import read_table
from stockout.stage import write_stage

ALLOW, BLOCK = "allow", "block"


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


# The rules of the registered query.
RULES = (Rule(BLOCK, "net", "/"), Rule(ALLOW, "example.net", "/en/"),
         Rule(BLOCK, "example.com", "/de/"), Rule(ALLOW, "org", "/fr/"))


@dataclass(frozen=True)
class UrlSettings:
    """``threshold``: smallest block probability that blocks; ``prior_weight``: labelled URLs
    that the overall block rate counts for in a suffix's rate."""

    n_trees: int = 10
    depth: int = 4
    max_training_rows: int = 50_000
    threshold: float = 0.5
    prior_weight: float = 5.0
    seed: int = 11


FEATURES = ("n_url", "n_host", "n_path", "depth", "dots", "digits", "entropy", "params", "query", "fragment",
            "hyphens", "tld_rate", "tld_share", "site_rate", "site_share")
_SUFFIXES = {"tld": 1, "site": 2}


def host_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    return F.coalesce(F.translate(host, string.ascii_uppercase, string.ascii_lowercase), F.lit(""))


def path_of(url: Column) -> Column:
    rest = F.when(F.locate("://", url) > 0, F.substring(url, F.locate("://", url) + 3, F.length(url)))
    return F.coalesce(F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """Text of the longest fitting rule, null if none fits."""
    chosen = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: len(r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.lit(rule.text)).otherwise(chosen)
    return chosen


def verdict_of(rule: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    out = F.lit(None).cast("string")
    for r in rules:
        out = F.when(rule == r.text, F.lit(r.verdict)).otherwise(out)
    return out


def _entropy(text: Column) -> Column:
    """Bits per character of a short text."""
    n = F.greatest(F.length(text), F.lit(1))

    def bits(c: Column) -> Column:
        share = (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / n
        return -share * F.log2(share)

    return F.coalesce(F.aggregate(F.array_distinct(F.filter(F.split(text, ""), lambda c: c != "")),
                                  F.lit(0.0), lambda acc, c: acc + bits(c)), F.lit(0.0))


def lexical(urls: DataFrame, url: Column) -> DataFrame:
    """``urls`` with the lexical features, from the columns ``_host`` and ``_path``."""
    text = F.coalesce(url, F.lit(""))
    n = F.greatest(F.length(text), F.lit(1))
    query = F.regexp_extract(text, r"\?([^#]*)", 1)
    # The characters that only a copy of the text without them can tell.
    count = lambda c, chars: F.length(c) - F.length(F.translate(c, chars, ""))
    values = {
        "n_url": F.length(text), "n_host": F.length("_host"), "n_path": F.length("_path"),
        "depth": F.size(F.filter(F.split("_path", "/"), lambda p: p != "")),
        "dots": count(F.col("_host"), "."), "digits": count(text, string.digits) / n,
        "entropy": _entropy(text), "params": count(query, "=") + count(query, "&"), "query": F.length(query),
        "fragment": F.length(F.regexp_extract(text, "#(.*)", 1)), "hyphens": count(text, "-_"),
    }
    return urls.withColumns({f"_{k}": v.cast("double") for k, v in values.items()} | {
        f"_{s}": F.substring_index("_host", ".", -k) for s, k in _SUFFIXES.items()})


def _suffix_tables(labelled: DataFrame) -> tuple[dict[str, DataFrame], int, int]:
    """Per suffix kind, its URLs and blocked URLs among all labelled ones; and both totals."""
    totals = labelled.agg(F.count("*").alias("n"), F.sum("_label").alias("blocked")).collect()[0]
    tables = {s: labelled.groupBy(f"_{s}").agg(F.count("*").alias(f"_{s}_n"), F.sum("_label").alias(f"_{s}_blocked"))
              for s in _SUFFIXES}
    return tables, totals["n"], int(totals["blocked"] or 0)


def _with_suffix_statistics(urls: DataFrame, tables: dict[str, DataFrame], n: int, blocked: int,
                            weight: float) -> DataFrame:
    """Joined to the suffix tables; a row that carries a label does not count itself."""
    base_rate = blocked / max(n, 1)
    own, own_blocked = F.col("_label").isNotNull().cast("double"), F.coalesce(F.col("_label"), F.lit(0.0))
    for s, suffixes in tables.items():
        urls = urls.join(suffixes, f"_{s}", "left")
        seen = F.coalesce(F.col(f"_{s}_n"), F.lit(0)) - F.when(F.col(f"_{s}_n") > 0, own).otherwise(0.0)
        bad = F.coalesce(F.col(f"_{s}_blocked"), F.lit(0.0)) - F.when(F.col(f"_{s}_n") > 0, own_blocked).otherwise(0.0)
        urls = urls.withColumns({f"_{s}_rate": (bad + weight * base_rate) / (seen + weight),
                                 f"_{s}_share": F.log1p(seen / max(n, 1) * 1000.0)})
    return urls


def judge(pages: DataFrame, rules: tuple[Rule, ...] = RULES, settings: UrlSettings | None = None) -> DataFrame:
    """``pages`` with host, path, rule (text or null), verdict and block_probability (null where
    a rule decides)."""
    settings = settings or UrlSettings()
    names = pages.columns
    # A page's own columns travel in one, so that none is in the way.
    urls = pages.select(F.struct("*").alias("_page"), "url").withColumns({"_host": host_of(F.col("url")), "_path": path_of(F.col("url"))})
    urls = urls.withColumn("_rule", rule_of(F.col("_host"), F.col("_path"), rules))
    urls = urls.withColumn("_verdict", verdict_of(F.col("_rule"), rules))
    urls = urls.withColumn("_label", F.when(F.col("_verdict").isNotNull(),
                                            (F.col("_verdict") == BLOCK).cast("double")))
    # The URLs alone are read for the fit, once; the rest of a page never is.
    known = lexical(urls.where(F.col("_label").isNotNull())
                    .select("url", "_host", "_path", "_label"), F.col("url"))
    known = write_stage(known, "labelled_urls")
    tables, n, blocked = _suffix_tables(known)
    decided = F.col("_verdict").isNotNull()
    out = {"host": F.col("_host"), "path": F.col("_path"), "rule": F.col("_rule")}
    if blocked in (0, n):
        only = BLOCK if n and blocked == n else ALLOW
        verdict, probability = F.coalesce("_verdict", F.lit(only)), F.when(~decided, float(only == BLOCK))
    else:
        inputs = [f"_{f}" for f in FEATURES]
        assembler = VectorAssembler(inputCols=inputs, outputCol="_features")
        buckets = 1_000_000
        share = min(buckets, -(-buckets * settings.max_training_rows // n))
        train = _with_suffix_statistics(known.where(F.pmod(F.xxhash64("url"), F.lit(buckets)) < share),
                                        tables, n, blocked, settings.prior_weight)
        train = write_stage(assembler.transform(train.select("_label", *inputs)).select("_label", "_features"),
                            "url_training")
        trees = GBTClassifier(labelCol="_label", featuresCol="_features", maxIter=settings.n_trees,
                              maxDepth=settings.depth, seed=settings.seed, predictionCol="_prediction")
        model = trees.setRawPredictionCol("_raw").setProbabilityCol("_probability").fit(train)
        urls = _with_suffix_statistics(lexical(urls, F.col("url")), tables, n, blocked, settings.prior_weight)
        urls = model.transform(assembler.transform(urls))
        p = vector_to_array("_probability")[1]
        verdict = F.coalesce("_verdict", F.when(p >= settings.threshold, BLOCK).otherwise(ALLOW))
        probability = F.when(~decided, p)
    out |= {"verdict": verdict, "block_probability": probability}
    return urls.select(*[F.col("_page")[c].alias(c) for c in names if c not in out], *[v.alias(k) for k, v in out.items()])


def urls_query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page with host, path, rule and verdict of its URL."""
    pages = read_table(spark, sf_dir, "pages").select("page_id", "url")
    return judge(pages).select("page_id", "host", "path", "rule", "verdict", "block_probability")
