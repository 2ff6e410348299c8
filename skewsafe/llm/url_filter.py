"""Operator 8: URL filter by explicit rules and empirical-Bayes host reputation.

A url that a rule fits gets the verdict of the longest such rule. Any other is
judged by its host's bad rate: labelled page outcomes are counted per host,
registered domain and suffix, and shrunk down that chain. Each level has a beta
prior whose mean is the parent's posterior mean and whose strength is estimated
from the spread between the level's members (beta-binomial moments), so a host
with few labels follows its domain and one with many follows itself. While few
members show a spread, the strength stays near a weak one. Outcomes of one
member are alike, so they count for less in its parent: ``n`` of them as
``n / (1 + (n - 1) * ALIKE)``.

A host is blocked when even the lower posterior bound of its bad rate,
``mean - BOUND * sd``, is above ``MAX_BAD_RATE``: by Cantelli's inequality the
rate is above the bound with posterior probability 1 - 1 / (1 + BOUND^2), 90 %.
The variance holds that of the prior mean, level by level, so a host is never
blocked for a few labels elsewhere.

Only counts move: pages are reduced to hosts with map-side sums, so a hot host
costs one row per task; the last join is on the host, where AQE splits hot keys.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skewsafe.llm.common import staged

MAX_BAD_RATE = 0.25
BOUND = 3.0
# Correlation of a member's outcomes before any spread is seen, worth that of so many members.
ALIKE, ALIKE_MEMBERS = 0.2, 2.0
# Overall rate before any outcome, and the outcomes it is worth.
PRIOR_RATE, PRIOR_OUTCOMES = 0.25, 4.0


@dataclass(frozen=True)
class Rule:
    """``verdict`` (``allow`` or ``block``) for a host with all its subdomains, below ``path``."""

    verdict: str
    host: str
    path: str = "/"

    @property
    def name(self) -> str:
        return self.host + self.path


RULES = (
    Rule("block", "net"),
    Rule("allow", "example.net", "/en/"),
    Rule("block", "example.com", "/de/"),
    Rule("allow", "org", "/fr/"),
)

# Suffixes of more than one label below which names are registered; all
# other suffixes are the last label.
MULTI_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp",
                        "co.nz", "co.in", "co.kr", "co.za", "com.br", "com.cn", "com.mx", "com.tr", "com.tw")


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty where it is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    whole = F.coalesce(url, F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.translate(F.regexp_extract(whole, pattern, 1), upper, lower), F.regexp_extract(whole, pattern, 2)


def fitting_rule(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits (null: none). Equal lengths: the first given."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule in sorted(reversed(rules), key=lambda r: len(r.name)):  # the last match stands
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        name = F.when(fits, rule.name).otherwise(name)
        verdict = F.when(fits, rule.verdict).otherwise(verdict)
    return name, verdict


def domain_and_suffix(host: Column) -> tuple[Column, Column]:
    """Registered domain and suffix of a host (its port and user part left out).

    A bare suffix or single label is its own domain; so is an IPv4 address.
    """
    name = F.regexp_replace(host, r"(^.*@)|(:[0-9]*$)", "")
    address = name.rlike(r"^[0-9.]+$")
    two = F.substring_index(name, ".", -2)
    multi = two.isin(*MULTI_LABEL_SUFFIXES)
    suffix = F.when(address, name).when(multi, two).otherwise(F.substring_index(name, ".", -1))
    domain = F.when(address, name).when(multi, F.substring_index(name, ".", -3)).otherwise(two)
    return domain, suffix


def _strength(groups: DataFrame) -> Column:
    """Prior strength (a scalar subquery) from members with ``n`` labels, ``k`` bad, and prior mean ``m``.

    Moments of the beta-binomial: the spread of k beyond the binomial's gives
    the correlation r within a member, averaged over the members with more than
    one outcome and ``ALIKE_MEMBERS`` imagined ones; s = 1 / r - 1 (r kept in
    0.0001..0.5).
    """
    n, k, m = F.col("n"), F.col("k"), F.col("m")
    noise = m * (1 - m)
    several = groups.where(n > 1)
    over = F.sum(((k - n * m) * (k - n * m) - n * noise) / (n * n * noise))
    r = (F.coalesce(over, F.lit(0.0)) + ALIKE * ALIKE_MEMBERS) / (F.coalesce(F.sum((n - 1) / n), F.lit(0.0)) + ALIKE_MEMBERS)
    r = F.greatest(F.lit(0.0001), F.least(F.lit(0.5), r))
    return several.agg((1 / r - 1).alias("s")).scalar()


def _shrunk(groups: DataFrame) -> DataFrame:
    """``groups`` (``n, k``, prior mean ``m`` and its variance ``u``) with strength ``s``, posterior mean ``p``, variance ``v``."""
    n, s, p = F.col("n"), F.col("s"), F.col("p")
    known = groups.withColumn("s", _strength(groups)).withColumn("p", (F.col("k") + s * F.col("m")) / (n + s))
    share = s / (n + s)
    return known.withColumn("v", p * (1 - p) / (n + s + 1) + share * share * F.col("u"))


def host_reputation(labelled: DataFrame) -> DataFrame:
    """``host, n, k, mean, bound`` of every host in ``labelled`` (``host``, ``bad``: 0, 1 or null).

    ``n`` outcomes, ``k`` of them bad; ``mean`` and ``bound`` of the posterior bad
    rate. A host without outcomes has its domain's. No outcomes at all: the prior
    rate with little strength, so nothing is blocked. No rows: no rows.
    """
    hosts = labelled.groupBy("host").agg(
        F.count("bad").cast("double").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).cast("double").alias("k")
    )
    domain, suffix = domain_and_suffix(F.col("host"))
    # One row per host, written once: the levels and strengths below all read it.
    hosts = staged(hosts.withColumns({"domain": domain, "suffix": suffix}), "url-hosts")
    worth = 1 + (F.col("n") - 1) * ALIKE
    sums = [F.sum(F.col("n") / worth).alias("n"), F.sum(F.col("k") / worth).alias("k")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = domains.groupBy("suffix").agg(*sums)
    size = F.sum(F.col("n") / worth) + PRIOR_OUTCOMES
    rate = (F.sum(F.col("k") / worth) + PRIOR_RATE * PRIOR_OUTCOMES) / size
    everything = suffixes.agg(rate.alias("m"), (rate * (1 - rate) / (size + 1)).alias("u"))
    prior = [F.col("p").alias("m"), F.col("v").alias("u")]
    by_suffix = _shrunk(
        suffixes.withColumns({"m": everything.select("m").scalar(), "u": everything.select("u").scalar()})
    ).select("suffix", *prior)
    by_domain = _shrunk(domains.join(by_suffix, "suffix")).select("domain", *prior)
    by_host = _shrunk(hosts.join(by_domain, "domain"))
    return by_host.select(
        "host", "n", "k", F.col("p").alias("mean"), (F.col("p") - BOUND * F.sqrt("v")).alias("bound")
    )


def judge_pages(
    pages: DataFrame, outcomes: DataFrame, rules: tuple[Rule, ...] = RULES, max_bad_rate: float = MAX_BAD_RATE
) -> DataFrame:
    """Every page's ``page_id, host, path, rule, verdict, bad_rate, bound``.

    ``outcomes``: ``page_id`` and ``bad`` (0 or 1) of labelled pages; an id that
    repeats is bad if one of its rows says so. One output row per input row;
    a null url has an empty host, which is judged like any other host.
    """
    host, path = host_and_path(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    known = outcomes.where("page_id is not null and bad in (0, 1)").groupBy("page_id").agg(F.max("bad").alias("bad"))
    reputation = host_reputation(parsed.select("page_id", "host").join(known, "page_id", "left"))
    name, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    judged = parsed.join(reputation.select("host", "mean", "bound"), "host").withColumn("rule", name)
    by_method = F.when(F.col("bound") > max_bad_rate, "block").otherwise("allow")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce(verdict, by_method).alias("verdict"),
        F.col("mean").alias("bad_rate"), "bound",
    )
