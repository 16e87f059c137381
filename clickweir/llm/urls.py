"""URL filters: fixed rules first, then the host's empirical-Bayes reputation.

Labelled outcomes of pages (bad or not) are summed per host, registered domain and
suffix. The share of bad pages is shrunk level by level: the mean of all pages is the
prior of a suffix, the suffix's posterior mean that of a registered domain, the domain's
that of a host. The strength of each level's beta prior comes from how much its groups
differ beyond chance (moments of the beta-binomial). A page is blocked if even the lower
posterior bound of its host's bad share reaches the threshold.

Pages are aggregated before they meet anything, so a host with a third of all pages is
one row per task; on the way back the adaptive join splits it.

Defined results: a url that is null or lacks ``://`` has an empty host and path, which no
rule fits; hosts without labelled pages have the posterior of their domain, and without
any label nothing is blocked but by rules. Repeated pages count as often as they occur;
of several outcomes of one page the worst counts.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweir.llm.frames import position, shielded, unshielded
from clickweir.workspace import materialized

# Suffixes of two labels under which names are registered; all others have one label.
TWO_LABEL_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.au", "com.br", "gov.uk", "org.uk")
# Compiled into one expression; longer lists belong in a table.
MAX_RULES = 500
THRESHOLD = 0.5
# Standard deviations below the posterior mean.
BOUND = 1.645
# A prior is worth so many pages at least, however few groups its strength comes from.
MIN_STRENGTH = 2.0
MAX_STRENGTH = 10_000.0


@dataclass(frozen=True)
class UrlRule:
    """``pattern`` is a host, a slash and a path prefix."""

    verdict: str
    pattern: str

    @property
    def host(self) -> str:
        return self.pattern.partition("/")[0]

    @property
    def path(self) -> str:
        return "/" + self.pattern.partition("/")[2]


RULES = (UrlRule("block", "net/"), UrlRule("allow", "example.net/en/"),
         UrlRule("block", "example.com/de/"), UrlRule("allow", "org/fr/"))


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)
    lowered = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return F.coalesce(lowered, F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def suffix_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES) & (two != host), two).otherwise(
        F.substring_index(host, ".", -1))


def domain_of(host: Column) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*TWO_LABEL_SUFFIXES) & (two != host),
                  F.substring_index(host, ".", -3)).otherwise(two)


def longest_rule(host: Column, path: Column, rules: tuple[UrlRule, ...]) -> Column:
    """The pattern of the longest fitting rule, else null."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"more than {MAX_RULES} rules")
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.pattern), r.pattern)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, F.lit(rule.pattern)).otherwise(found)
    return found


def _strength(groups: DataFrame, n: str, k: str, parent_n: str, parent_k: str,
              parent: str) -> float:
    """Prior strength of a level from the spread of its groups around their parents."""
    labelled = groups.where(F.col(n) > 0)
    mean = F.try_divide(parent_k, parent_n)
    row = labelled.agg(
        F.sum(F.col(n) * F.pow(F.try_divide(k, n) - mean, 2)).alias("spread"),
        F.sum(F.col(n) * mean * (1 - mean)).alias("variance"),
        F.sum(n).alias("total"),
        F.sum(F.try_divide(F.col(n) * F.col(n), parent_n)).alias("squares"),
        F.count(F.lit(1)).alias("groups"),
    ).first()
    parents = labelled.select(parent).distinct().count()
    if not row["total"] or not row["variance"]:
        return MAX_STRENGTH
    variance, free = row["variance"] / row["total"], row["groups"] - parents
    room = variance * (row["total"] - row["squares"] - free)
    excess = (row["spread"] - variance * free) / room if room > 0 else 0.0
    return min(MAX_STRENGTH, max(MIN_STRENGTH, 1 / excess - 1)) if excess > 0 else MAX_STRENGTH


def reputations(hosts: DataFrame, bound: float = BOUND) -> DataFrame:
    """Posterior of each row of (host, n, k): labelled pages and bad ones.

    Returns host, n, k, ``bad_mean`` and ``bad_low``.
    """
    hosts = materialized(hosts.withColumns(
        {"domain": domain_of(F.col("host")), "suffix": suffix_of(F.col("host"))}), "hosts")
    domains = hosts.groupBy("domain", "suffix").agg(
        F.sum("n").alias("domain_n"), F.sum("k").alias("domain_k"))
    domains = materialized(domains, "domains")
    suffixes = domains.groupBy("suffix").agg(
        F.sum("domain_n").alias("suffix_n"), F.sum("domain_k").alias("suffix_k"))
    total = suffixes.agg(F.sum("suffix_n").alias("n"), F.sum("suffix_k").alias("k")).first()
    n, k = total["n"] or 0, total["k"] or 0
    mean = k / n if n else 0.0
    suffixes = suffixes.withColumns(
        {"all": F.lit(0), "all_n": F.lit(float(n)), "all_k": F.lit(float(k))})
    per_domain = domains.join(suffixes, "suffix")
    per_host = hosts.join(domains, ["domain", "suffix"])
    of_suffix = _strength(suffixes, "suffix_n", "suffix_k", "all_n", "all_k", "all")
    of_domain = _strength(per_domain, "domain_n", "domain_k", "suffix_n", "suffix_k", "suffix")
    of_host = _strength(per_host, "n", "k", "domain_n", "domain_k", "domain")

    def shrunk(strength: float, prior: Column, n: str, k: str) -> Column:
        return (strength * prior + F.col(k)) / (strength + F.col(n))

    levels = per_domain.withColumn(
        "suffix_mean", shrunk(of_suffix, F.lit(mean), "suffix_n", "suffix_k")
    ).withColumn("domain_mean", shrunk(of_domain, F.col("suffix_mean"), "domain_n", "domain_k"))
    found = hosts.join(levels.select("domain", "suffix", "domain_mean"), ["domain", "suffix"])
    found = found.withColumn("bad_mean", shrunk(of_host, F.col("domain_mean"), "n", "k"))
    deviation = F.sqrt(F.col("bad_mean") * (1 - F.col("bad_mean")) / (of_host + F.col("n") + 1))
    return found.select("host", "n", "k", "bad_mean", F.greatest(
        F.lit(0.0), F.col("bad_mean") - bound * deviation).alias("bad_low"))


def filter_urls(
    pages: DataFrame, outcomes: DataFrame, key: str = "page_id", url: str = "url",
    rules: tuple[UrlRule, ...] = RULES, threshold: float = THRESHOLD, bound: float = BOUND,
) -> DataFrame:
    """``pages`` with host, path, rule, verdict and ``bad_low``.

    ``outcomes`` has the key and ``bad`` (0 or 1) for the labelled pages.
    """
    rows, names = shielded(pages)
    id_, address = position(pages, key), position(pages, url)
    split = rows.withColumns({"host": host_of(F.col(address)), "path": path_of(F.col(address))})
    worst = outcomes.groupBy(F.col(key).alias("_key")).agg(F.max("bad").alias("_bad"))
    hosts = split.select(F.col(id_).alias("_key"), "host").join(worst, "_key", "left").groupBy(
        "host").agg(F.count("_bad").alias("n"),
                    F.coalesce(F.sum("_bad"), F.lit(0)).cast("long").alias("k"))
    known = materialized(reputations(hosts, bound), "reputations").select("host", "bad_low")
    judged = split.join(known, "host", "left").withColumn(
        "rule", longest_rule(F.col("host"), F.col("path"), rules))
    of_rule = F.lit(None).cast("string")
    for rule in rules:
        of_rule = F.when(F.col("rule") == rule.pattern, F.lit(rule.verdict)).otherwise(of_rule)
    by_host = F.when((F.col("bad_low") >= threshold) & (F.col("host") != ""), "block").otherwise(
        "allow")
    return unshielded(judged.withColumn("verdict", F.coalesce(of_rule, by_host)), names,
                      pages.columns, F.col("host"), F.col("path"), F.col("rule"),
                      F.col("verdict"), F.col("bad_low"))
