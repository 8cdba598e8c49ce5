"""URL filter: fixed rules first, else the reputation of the host by empirical Bayes.

Labelled page outcomes are counted for each host, registered domain and suffix. Shares of good pages
are shrunk down the hierarchy: each level's posterior mean is the prior mean of the level
below, with a strength (in pages) that the level's own spread implies: the intra-class
correlation of the beta-binomial, by analysis of variance. A host is allowed if the lower bound of its
posterior share of good pages reaches a limit; a host without labelled pages has its domain's.
"""

from __future__ import annotations

from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .store import saved

#: Standard deviations below the mean, and the least share of good pages.
BOUND, LEAST = 1.645, 0.5
STRENGTHS = (1.0, 1000.0)
#: Suffixes of two labels under which names are registered.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.uk", "gov.uk", "org.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "or.jp",
                      "co.nz", "com.br", "com.cn", "com.mx", "com.tr", "co.in", "co.kr", "co.za")


ADDRESS = r"^\d+(\.\d+){3}$|^\["


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; else empty."""
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    """From the host's end up to ``?``, ``#`` or the end; else empty."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def domain_of(host: Column, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> Column:
    """The registered name: the last two labels, three under one of ``suffixes``; without user and port.

    An address (IPv4, or in brackets) is a name of its own.
    """
    name = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":\d*$", "")
    two = F.substring_index(name, ".", -2)
    return (F.when(name.rlike(ADDRESS), name)
            .when(two.isin(*suffixes), F.substring_index(name, ".", -3)).otherwise(two))


def suffix_of(domain: Column) -> Column:
    """What follows the first label; addresses share the suffix of hosts without one."""
    return (F.when(domain.contains(".") & ~domain.rlike(ADDRESS), F.regexp_replace(domain, r"^[^.]*\.", ""))
            .otherwise(F.lit("")))


def rule_of(host: Column, path: Column, rules: Sequence[Rule]) -> Column:
    """The longest rule that fits (ties: the first given), as a struct, else null. ``rules`` is a short list."""
    out = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):  # what is applied last wins
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        out = F.when(fits, F.struct(F.lit(rule.name).alias("rule"), F.lit(rule.verdict).alias("verdict"))).otherwise(out)
    return out


def _strength(groups: DataFrame) -> DataFrame:
    """One row ``strength`` from ``groups(n, s)``: labelled and good pages of each."""
    sums = groups.where("n > 0").agg(
        F.count("*").cast("double").alias("g"), F.sum("n").cast("double").alias("t"),
        F.sum(F.col("n") * F.col("n")).cast("double").alias("t2"), F.sum("s").cast("double").alias("good"),
        F.sum(F.col("s") * F.col("s") / F.col("n")).alias("q"))
    between = "greatest((q - good * good / t) / (g - 1), 0)"
    within = "greatest((good - q) / (t - g), 1e-9)"
    size = "(t - t2 / t) / (g - 1)"
    share = f"({between} - {within}) / ({between} + ({size} - 1) * {within})"
    strength = f"least(greatest(1 / greatest({share}, 1e-6) - 1, {STRENGTHS[0]}), {STRENGTHS[1]})"
    return sums.select(F.expr(f"case when g > 1 and t > g then {strength} else {STRENGTHS[1]} end").alias("strength"))


def reputations(pages: DataFrame, bound: float = BOUND, suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``pages(host, good)``, good 1, 0 or null (not labelled) -> one row for each host:
    ``host, labelled, mean, lower``: the posterior mean and lower bound of its share of good pages.
    """
    hosts = saved(pages.groupBy("host").agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("s"))
                  .withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("domain"))),
                  "hosts")
    sums = [F.sum("n").alias("n"), F.sum("s").alias("s")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    whole = suffixes.agg(((F.coalesce(F.sum("s"), F.lit(0)) + 1.0) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("prior"))

    def shrunk(groups: DataFrame, strength: DataFrame) -> DataFrame:
        return (groups.crossJoin(F.broadcast(strength))  # one row
                .withColumn("mean", F.expr("(s + strength * prior) / (n + strength)")))

    by_suffix = shrunk(suffixes.crossJoin(F.broadcast(whole)), _strength(suffixes)).select("suffix", F.col("mean").alias("prior"))
    by_domain = shrunk(domains.join(by_suffix, "suffix"), _strength(domains)).select("domain", F.col("mean").alias("prior"))
    by_host = shrunk(hosts.join(by_domain, "domain"), _strength(hosts))
    spread = F.sqrt(F.expr("mean * (1 - mean) / (n + strength + 1)"))
    return by_host.select("host", F.col("n").alias("labelled"), "mean", (F.col("mean") - bound * spread).alias("lower"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: Sequence[Rule], least: float = LEAST,
          suffixes: Sequence[str] = TWO_LABEL_SUFFIXES) -> DataFrame:
    """``pages(page_id, url)``, ``outcomes(page_id, good)`` -> one row for each row of ``pages``:
    ``page_id, host, path, rule, verdict, mean, lower``.

    Several outcomes of a page count as their least; null ones do not count. A null url, or one
    without ``://``, has an empty host and path and is judged as the host "". Repeated page rows are
    labelled pages each. Without any outcome all hosts have the prior 1/2, so none reaches the limit. Other columns are
    not read.
    """
    good = outcomes.where("page_id is not null and good is not null").groupBy("page_id").agg(F.min("good").cast("int").alias("good"))
    named = (pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
             .withColumn("fit", rule_of(F.col("host"), F.col("path"), rules)))
    known = reputations(named.join(good, "page_id", "left").select("host", "good"), suffixes=suffixes)
    return named.join(known, "host", "left").select(
        "page_id", "host", "path", F.col("fit.rule").alias("rule"),
        F.coalesce("fit.verdict", F.when(F.col("lower") >= least, "allow").otherwise("block")).alias("verdict"), "mean", "lower")
