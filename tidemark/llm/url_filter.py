"""Host reputation by empirical Bayes, and path rules, for filtering urls.

Labelled page outcomes are shrunk through beta-binomial priors: all pages -> suffix -> registered
domain -> host. The prior of a level has the mean of the level above and a strength that the
method of moments takes from the spread of the level's own rates. A host is blocked when the upper
bound of its good rate stays below a threshold, so hosts with few labels keep the verdict of
their domain, and unknown hosts are allowed.

A null url, or one without ``://``, has an empty host and path, and is judged as the host ''.
Outcomes of the same page count one by one; a page without outcome counts for nothing. Repeated
pages give repeated rows. An empty table gives no rows.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Reputation:
    block_below: float = 0.5   # block when even the upper bound of the good rate is below
    z: float = 1.645           # one-sided 95 %
    least_strength: float = 2.0
    most_strength: float = 1000.0
    # Suffixes of two labels, under which names are registered.
    long_suffixes: tuple[str, ...] = ("co.uk", "org.uk", "ac.uk", "com.au", "com.br", "com.cn", "co.jp", "co.in", "co.nz", "co.za")


def _part(url: Column, pattern: str, group: int) -> Column:
    return F.coalesce(F.regexp_extract(url, pattern, group), F.lit(""))


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end; only A-Z become lower case."""
    host = _part(url, r"(?s)^(?:(?!://).)*://([^/?#]*)", 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def path_of(url: Column) -> Column:
    return _part(url, r"(?s)^(?:(?!://).)*://[^/?#]*([^?#]*)", 1)


def _tail(host: Column, labels: int) -> Column:
    parts = F.split(F.regexp_replace(host, r"^.*@|:[0-9]*$", ""), r"\.")
    return F.concat_ws(".", *[F.try_element_at(parts, F.lit(-i)) for i in range(labels, 0, -1)])


def suffix_of(host: Column, p: Reputation = Reputation()) -> Column:
    two = _tail(host, 2)
    return F.when(host.rlike(r"^[0-9.:]*$"), host).when(two.isin(*p.long_suffixes), two).otherwise(_tail(host, 1))


def domain_of(host: Column, p: Reputation = Reputation()) -> Column:
    """The suffix and one label more; the whole host where there is none."""
    two = _tail(host, 2)
    return F.when(host.rlike(r"^[0-9.:]*$"), host).when(two.isin(*p.long_suffixes), _tail(host, 3)).otherwise(two)


def strength(rates: DataFrame, p: Reputation) -> float:
    """Prior strength of a level from ``n, k`` of its members and the mean ``m`` of their parents."""
    m, n = F.col("m"), F.col("n")
    within = m * (1 - m)
    row = rates.where("n > 0").agg(
        F.sum(F.pow(F.col("k") - n * m, F.lit(2)) / n - within).alias("excess"), F.sum(within * (n - 1)).alias("room")).first()
    if not row["room"] or row["excess"] is None:
        return p.most_strength
    rho = max(row["excess"] / row["room"], 1e-9)
    return min(max(1 / rho - 1, p.least_strength), p.most_strength)


def host_reputation(pages: DataFrame, outcomes: DataFrame, p: Reputation = Reputation()) -> DataFrame:
    """One row per host of ``pages (page_id, host)``: labels, posterior mean and bounds, verdict.

    ``outcomes``: page_id, good (0 or 1, null for unknown).
    """
    told = outcomes.where(F.col("good").isNotNull()).groupBy("page_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("good").cast("long")).alias("k"))
    hosts = pages.join(told, "page_id", "left").groupBy("host").agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(F.sum("k"), F.lit(0)).alias("k"))
    hosts = hosts.withColumns({"domain": domain_of(F.col("host"), p), "suffix": suffix_of(F.col("host"), p)}).persist()
    try:
        return _shrunk(hosts, p)
    finally:
        hosts.unpersist()


def _shrunk(hosts: DataFrame, p: Reputation) -> DataFrame:
    def totals(*key: str) -> DataFrame:
        return hosts.groupBy(*key).agg(F.sum("n").alias("n"), F.sum("k").alias("k"))

    whole = hosts.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    overall = (whole["k"] or 0) / whole["n"] if whole["n"] else 0.5

    def posterior(level: DataFrame, s: float) -> DataFrame:
        return level.withColumn("mean", (F.lit(s) * F.col("m") + F.col("k")) / (F.lit(s) + F.col("n")))

    suffixes = totals("suffix").withColumn("m", F.lit(float(overall)))
    suffixes = posterior(suffixes, strength(suffixes, p)).select("suffix", F.col("mean").alias("m"))
    domains = totals("domain", "suffix").join(suffixes, "suffix")
    domains = posterior(domains, strength(domains, p)).select("domain", "suffix", F.col("mean").alias("m"))
    named = hosts.join(domains, ["domain", "suffix"])
    s = strength(named, p)
    total = F.lit(s) + F.col("n")
    named = posterior(named, s).withColumn("spread", F.lit(p.z) * F.sqrt(F.col("mean") * (1 - F.col("mean")) / (total + 1)))
    named = named.withColumns({
        "lower": F.greatest(F.col("mean") - F.col("spread"), F.lit(0.0)), "upper": F.least(F.col("mean") + F.col("spread"), F.lit(1.0))})
    return named.select("host", "domain", "suffix", "n", "k", "mean", "lower", "upper",
                        F.when(F.col("upper") < p.block_below, "block").otherwise("allow").alias("host_verdict"))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """The longest rule ``host/path`` that fits the host or a parent domain and starts the path; else null."""
    out = None
    for rule, _ in sorted(rules, key=lambda r: (-len(r[0]), r[0])):
        name, _, start = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(f"/{start}")
        out = F.when(fits, rule) if out is None else out.when(fits, rule)
    return F.lit(None).cast("string") if out is None else out


def judge_urls(pages: DataFrame, outcomes: DataFrame, rules: list[tuple[str, str]] = (), p: Reputation = Reputation()) -> DataFrame:
    """Every row of ``pages (page_id, url)`` with host, path, rule, verdict and the host's figures."""
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rated = host_reputation(rows, outcomes, p)
    out = rows.join(rated, "host", "left").withColumn("rule", rule_of(F.col("host"), F.col("path"), list(rules)))
    by_rule = F.lit(None).cast("string")
    for rule, verdict in rules:
        by_rule = F.when(F.col("rule") == rule, verdict).otherwise(by_rule)
    return out.select("page_id", "host", "path", "rule", F.coalesce(by_rule, "host_verdict").alias("verdict"),
                      "domain", "suffix", F.col("n").alias("labelled"), F.col("k").alias("good"))
