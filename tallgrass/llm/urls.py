"""URL filter by rules and, where none fits, by empirical-Bayes host reputation.

A page's host has a good rate with a beta posterior. Its prior comes from the
registered domain, whose prior comes from the suffix, whose prior comes from
all labelled pages; how strongly each level binds is fitted from the data
(analysis of variance of a beta-binomial). A host is blocked when even the upper
bound of its good rate lies below ``least_good``; a host without labels has the mean
of its domain, and is blocked where that is low enough.

Nulls and odd urls: a null url or one without ``://`` has empty host and path
and the reputation of the empty host. Without any label every prior is 1/2.
Repeated pages count once each. Empty tables give empty tables.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, functions as F

from tallgrass.operators.skew import lookup_join

LEAST_GOOD = 0.5
Z = 1.645
MAX_RULES = 200
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = (
    Rule("allow", "com"),
    Rule("block", "example.com", "/en/"),
    Rule("allow", "www.example.com", "/en/"),
    Rule("block", "net", "/es/"),
    Rule("block", "net", "/fr/"),
)


def _rest(url: str) -> Column:
    at = F.locate("://", F.col(url))
    return F.when(at > 0, F.col(url).substr(at + 3, F.length(url))).otherwise("")


def host_of(url: str = "url") -> Column:
    found = F.regexp_extract(_rest(url), "^[^/?#]*", 0)
    return F.coalesce(F.translate(found, _UPPER, _LOWER), F.lit(""))


def path_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), "^[^/?#]*([^?#]*)", 1), F.lit(""))


def longest_rule(host: str, path: str, rules: Sequence[Rule] = RULES) -> Column:
    """``rule`` and ``verdict`` of the longest rule that fits, else nulls: one expression, no join."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"at most {MAX_RULES} rules")
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):
        fits = (F.col(host) == rule.host) | F.col(host).endswith("." + rule.host)
        hit = F.struct(F.lit(rule.text).alias("rule"), F.lit(rule.verdict).alias("verdict"))
        found = F.when(fits & F.col(path).startswith(rule.path), hit).otherwise(found)
    return found


def _strength(level: DataFrame, group: str) -> DataFrame:
    """One row: overall rate ``_p`` and pseudo-count ``_m`` that binds the groups of ``level`` to it.

    One-way analysis of variance: the correlation of outcomes inside a group is
    (between - within) / (between + (n0 - 1) within), and m = 1 / correlation - 1.
    """
    seen = level.filter("_n > 0").groupBy(group).agg(F.sum("_good").alias("_g"), F.sum("_n").alias("_c"))
    total = seen.agg(
        F.count(F.lit(1)).alias("k"), F.sum("_g").alias("g"), F.sum("_c").alias("n"),
        F.sum(F.col("_c") * F.col("_c")).alias("nn"), F.sum(F.col("_g") * F.col("_g") / F.col("_c")).alias("gg"),
    )
    ratio = F.try_divide  # a level with one group, or with one page in each, has no fit
    p = ratio(F.col("g"), F.col("n"))
    between = ratio(F.col("gg") - F.col("n") * p * p, F.col("k") - 1)
    within = ratio(F.col("g") - F.col("gg"), F.col("n") - F.col("k"))
    size = ratio(F.col("n") - ratio(F.col("nn"), F.col("n")), F.col("k") - 1)
    shared = ratio(between - within, between + (size - 1) * within)
    fitted = F.when(shared > 0, ratio(F.lit(1.0), shared) - 1)
    bounded = F.least(F.greatest(F.coalesce(fitted, F.lit(1e4)), F.lit(1.0)), F.lit(1e4))
    return total.select(
        F.coalesce(F.when(F.col("n") > 0, p), F.lit(0.5)).alias("_p"), bounded.alias("_m")
    )


def reputations(pages: DataFrame) -> DataFrame:
    """From ``host, good`` (1, 0 or null) rows: ``host, pages, labelled, mean, upper`` per host."""
    hosts = pages.groupBy("host").agg(
        F.count(F.lit(1)).alias("pages"), F.count("good").alias("_n"), F.coalesce(F.sum("good"), F.lit(0)).alias("_good")
    )
    hosts = hosts.withColumn("_domain", F.substring_index("host", ".", -2)).withColumn("_suffix", F.substring_index("host", ".", -1))
    sums = (F.sum("_n").alias("_n"), F.sum("_good").alias("_good"))
    domains = hosts.groupBy("_domain", "_suffix").agg(*sums)
    suffixes = domains.groupBy("_suffix").agg(*sums)
    # One row each: fitted numbers, joined by a constant key.
    one = F.lit(1).alias("_one")
    fit = (
        _strength(suffixes, "_suffix").select(one, F.col("_p").alias("_p0"), F.col("_m").alias("_m0"))
        .join(_strength(domains, "_domain").select(one, F.col("_m").alias("_m1")), "_one")
        .join(_strength(hosts, "host").select(one, F.col("_m").alias("_m2")), "_one")
    )

    def shrunk(mean: str, m: str) -> Column:
        return (F.col("_good") + F.col(m) * F.col(mean)) / (F.col("_n") + F.col(m))

    def fitted(level: DataFrame) -> DataFrame:
        return level.withColumn("_one", F.lit(1)).join(F.broadcast(fit), "_one")  # one row

    suffixes = fitted(suffixes).select("_suffix", shrunk("_p0", "_m0").alias("_ps"))
    domains = fitted(domains).join(suffixes, "_suffix").select("_domain", shrunk("_ps", "_m1").alias("_pd"))
    posterior = fitted(hosts).join(domains, "_domain").withColumn("mean", shrunk("_pd", "_m2"))
    spread = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("_n") + F.col("_m2") + 1))
    return posterior.select("host", "pages", F.col("_n").alias("labelled"), "mean", (F.col("mean") + Z * spread).alias("upper"))


def page_outcomes(pages: DataFrame, labels: DataFrame) -> DataFrame:
    """``host, good`` per page: the label of the document that the url's last number names."""
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id").agg(F.max("quality").alias("good"))
    named = F.regexp_extract(path_of(), r"/([0-9]{1,18})(?:[^0-9/][^/]*)?/?$", 1).try_cast("long")
    hosts = pages.select(host_of().alias("host"), named.alias("doc_id"))
    return hosts.join(known, "doc_id", "left").select("host", "good")


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule] = RULES, least_good: float = LEAST_GOOD) -> DataFrame:
    """``page_id, host, path, rule, verdict, upper`` per page. ``outcomes``: ``host, good`` rows of the same pages."""
    parsed = pages.select("page_id", host_of().alias("host"), path_of().alias("path"))
    ruled = parsed.withColumn("_rule", longest_rule("host", "path", rules))
    known = lookup_join(ruled, reputations(outcomes), "host", "pages", ["page_id", "path"])
    own = F.when(F.col("upper") < least_good, "block").otherwise("allow")
    return known.select(
        "page_id", "host", "path", F.col("_rule.rule").alias("rule"),
        F.coalesce("_rule.verdict", own).alias("verdict"), "upper",
    )
