"""URL filters: empirical-Bayes host reputation under explicit rules.

Labelled page outcomes are counted per host, registered domain and public suffix.
From the top down, each level's beta prior has the mean of the level above and a
strength fitted by moments over the units of the level; a host's posterior decides
by its bound, so a host with few labels follows its domain and suffix.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ._store import Stash, cut, hot_join

#: Second labels that make a suffix of two labels under a country's two letters (as co in co.uk or com in com.sg); any other suffix is the last label. (fixed values)
SECOND = tuple("ac co com edu gob gov go mil ne net nom or org sch ltd plc".split())
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def name_of(host: Column) -> Column:
    """The host without user part, port and final dot."""
    return F.regexp_replace(F.regexp_replace(host, r"(?s)^.*@", ""), r"\.?(?::[0-9]*)?$", "")


def _is_address(name: Column) -> Column:
    return name.rlike(r"^(?:[0-9]{1,3}(?:\.[0-9]{1,3}){3}|\[.*\])$")


def suffix_of(host: Column, second: tuple[str, ...] = SECOND) -> Column:
    """The public suffix by the rule of SECOND; all IP addresses share an empty one."""
    name = name_of(host)
    two = F.substring_index(name, ".", -2)
    paired = name.rlike(rf"(?:^|\.)(?:{'|'.join(second)})\.[a-z][a-z]$")
    return F.when(_is_address(name), "").when(paired, two).otherwise(F.substring_index(name, ".", -1))


def domain_of(host: Column, second: tuple[str, ...] = SECOND) -> Column:
    """The public suffix and one label more; an IP address is its own domain."""
    name = name_of(host)
    paired = name.rlike(rf"(?:^|\.)(?:{'|'.join(second)})\.[a-z][a-z]$")
    return F.when(_is_address(name), name).when(paired, F.substring_index(name, ".", -3)).otherwise(F.substring_index(name, ".", -2))


def rule_for(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest matching rule, else nulls; rules are (verdict, host, path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1] + r[2])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, what).otherwise(verdict)
    return rule, verdict


def _strength(n: Column, k: Column, mean: Column) -> list[Column]:
    """Sums for the moment estimate of how strongly units of one level follow their mean."""
    return [F.sum(n).alias("N"), F.sum(n * n).alias("NN"), F.sum((k - n * mean) * (k - n * mean) / n).alias("Q"), F.sum(mean * (1 - mean) * n).alias("V"), F.count("*").alias("m")]


def _log_gamma(x: Column) -> Column:
    """By Stirling's series from x + 8 on."""
    y = x + 8
    low = F.lit(0.0)
    for k in range(8):
        low = low + F.log(x + k)
    return (y - 0.5) * F.log(y) - y + 0.5 * math.log(2 * math.pi) + 1 / (12 * y) - 1 / (360 * y * y * y) + 1 / (1260 * y * y * y * y * y) - low


def beta_tail(alpha: Column, beta: Column, x: float, steps: int = 300) -> Column:
    """The probability that a beta variable is below x: the regularised incomplete beta function.

    The continued fraction is evaluated backwards, in so many steps; beyond sums of
    20000, where it would need more, the normal distribution is closer than 0.01.
    """
    turned = x > (alpha + 1) / (alpha + beta + 2)
    a, b, z = F.when(turned, beta).otherwise(alpha), F.when(turned, alpha).otherwise(beta), F.when(turned, 1 - x).otherwise(x)
    front = F.exp(_log_gamma(a + b) - _log_gamma(a) - _log_gamma(b) + a * F.log(z) + b * F.log(1 - z)) / a

    def step(rest: Column, k: Column) -> Column:
        m = F.floor(k / 2).cast("double")
        even = m * (b - m) * z / ((a + 2 * m - 1) * (a + 2 * m))
        odd = -(a + m) * (a + b + m) * z / ((a + 2 * m) * (a + 2 * m + 1))
        return F.lit(1.0) + F.when(k % 2 == 0, even).otherwise(odd) / rest

    exact = front / F.aggregate(F.sequence(F.lit(steps), F.lit(1), F.lit(-1)), F.lit(1.0), step)
    exact = F.when(turned, 1 - exact).otherwise(exact)
    mean = alpha / (alpha + beta)
    score = (F.lit(x) - mean) / F.sqrt(mean * (1 - mean) / (alpha + beta + 1))
    t = 1 / (1 + 0.3275911 * F.abs(score) / math.sqrt(2))
    upper = (t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))) * F.exp(-score * score / 2) / 2  # Abramowitz and Stegun 7.1.26
    return F.when(alpha + beta > 20000, F.when(score > 0, 1 - upper).otherwise(upper)).otherwise(F.least(F.lit(1.0), F.greatest(F.lit(0.0), exact)))


def host_counts(outcomes: DataFrame) -> DataFrame:
    """(host, good) rows, good 0 or 1 -> host, domain, suffix, n, k. Null hosts and outcomes are left out; counts are summed before they are shuffled."""
    seen = outcomes.where("host IS NOT NULL AND good IS NOT NULL")
    hosts = seen.groupBy("host").agg(F.count("*").cast("double").alias("n"), F.sum(F.col("good").cast("double")).alias("k"))
    return hosts.withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))


def reputations(hosts: DataFrame, least: float = 1.0, most: float = 1e6) -> DataFrame:
    """Counts by host (as host_counts gives them, saved) -> host, domain, suffix, n, k, s_mean, d_mean, strength, alpha, beta: each host's posterior.

    Prior strengths stay in [least, most].
    """
    domains = hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("dn"), F.sum("k").alias("dk"))
    suffixes = domains.groupBy("suffix").agg(F.sum("dn").alias("sn"), F.sum("dk").alias("sk"))

    def strength(units: DataFrame, n: str, k: str, mean: str) -> float:
        r = units.where((F.col(mean) > 0) & (F.col(mean) < 1) & (F.col(n) > 0)).agg(*_strength(F.col(n), F.col(k), F.col(mean))).first()
        if not r["m"] or r["m"] < 2 or not r["V"]:
            return least
        p = r["V"] / r["N"]  # mean p(1 - p)
        spread = (r["Q"] - p * r["m"]) / (r["N"] - r["NN"] / r["N"]) if r["N"] > r["NN"] / r["N"] else 0.0
        return most if spread <= 0 else min(most, max(least, p / spread - 1))

    total = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = ((total["k"] or 0.0) + 1) / ((total["n"] or 0.0) + 2)
    s = suffixes.withColumn("mean", F.lit(overall))
    w = strength(s, "sn", "sk", "mean")
    s = s.select("suffix", ((F.col("sk") + w * overall) / (F.col("sn") + w)).alias("s_mean"))
    d = domains.join(s, "suffix")
    w = strength(d, "dn", "dk", "s_mean")
    d = d.select("domain", "suffix", "s_mean", ((F.col("dk") + w * F.col("s_mean")) / (F.col("dn") + w)).alias("d_mean"))
    h = hosts.join(d, ["domain", "suffix"])
    w = strength(h, "n", "k", "d_mean")
    return h.select("host", "domain", "suffix", "n", "k", "s_mean", "d_mean", F.lit(w).alias("strength"), (F.col("k") + w * F.col("d_mean")).alias("alpha"), (F.col("n") - F.col("k") + w * (1 - F.col("d_mean"))).alias("beta"))


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str, str]], bound: float = 0.6, risk: float = 0.05) -> DataFrame:
    """page_id, host, path, rule, verdict, good_rate, doubt: one row per page, also for equal rows.

    A matching rule decides; else ``allow`` if the posterior's quantile at ``risk``
    is ``bound`` or more, that is if the probability that the host's rate is below
    the bound (doubt) is ``risk`` or less, else ``block``. Hosts without labels have
    the prior of their domain, then that of their suffix, then the uniform one. Null
    urls have an empty host and path, however long a url is all of it counts. Other
    columns of ``pages`` are ignored; an empty table gives none.
    """
    with Stash(pages.sparkSession) as stash:
        base = pages.select("page_id", F.col("url").cast("string").alias("url"))
        base = base.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
        seen = stash.save(base.groupBy("host").agg(F.count("*").alias("c")), "seen").withColumn("domain", domain_of(F.col("host"))).withColumn("suffix", suffix_of(F.col("host")))
        known = stash.save(reputations(stash.save(host_counts(outcomes), "counts")), "known")
        by_host = known.select("host", "alpha", "beta")
        by_domain = known.groupBy("domain").agg(F.first("d_mean").alias("d_mean"))
        by_suffix = known.groupBy("suffix").agg(F.first("s_mean").alias("s_mean"))
        weight = known.agg(F.max("strength")).first()[0] or 2.0
        # each distinct host is judged once; pages only look its answer up
        hosts = seen.join(by_host, "host", "left").join(by_domain, "domain", "left").join(by_suffix, "suffix", "left")
        mean = F.coalesce("d_mean", "s_mean", F.lit(0.5))
        hosts = hosts.select("host", "c", F.coalesce("alpha", weight * mean).alias("alpha"), F.coalesce("beta", weight * (1 - mean)).alias("beta"))
        hosts = cut(hosts.select("host", "c", (F.col("alpha") / (F.col("alpha") + F.col("beta"))).alias("good_rate"), beta_tail(F.col("alpha"), F.col("beta"), bound).alias("doubt")))
    rule, said = rule_for(F.col("host"), F.col("path"), rules)
    out = hot_join(base, hosts, ["host"])
    return out.select("page_id", "host", "path", rule.alias("rule"), F.coalesce(said, F.when(F.col("doubt") <= risk, "allow").otherwise("block")).alias("verdict"), "good_rate", "doubt")


def page_outcomes(spark: SparkSession, pages: DataFrame, labels: DataFrame) -> DataFrame:
    """(host, good): the quality label of the document that a page shows, whose id ends the url's path."""
    seen = pages.select(host_of(F.col("url")).alias("host"), F.regexp_extract(path_of(F.col("url")), r"/(\d{1,18})(?:\.html)?/?$", 1).alias("id"))
    seen = seen.select("host", F.expr("try_cast(id AS BIGINT)").alias("doc_id")).where("doc_id IS NOT NULL")
    return seen.join(labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").alias("good")).where("quality IN (0, 1)"), "doc_id").select("host", "good")
