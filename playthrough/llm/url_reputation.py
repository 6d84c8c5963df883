"""Allow or block pages: fixed rules first, then the reputation of the host.

Reputation is an empirical-Bayes estimate: labelled outcomes of pages are counted per host, and each host's
share of good pages is shrunk towards its registered domain, that one towards its suffix, and the suffix
towards all pages, through beta priors. The strength of a level's priors follows from how much the shares
of its units scatter beyond chance. A page is allowed when the lower posterior bound of its host is high enough.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from playthrough.llm.common import ascii_lower, store

#: (verdict, host, path)
RULES = (
    ("allow", "org", "/"),
    ("block", "example.org", "/es/"),
    ("block", "example.org", "/en/1"),
    ("allow", "com", "/fr/"),
    ("block", "com", "/de/"),
)
#: Normal quantile of the bound, and the least share of good pages.
Z = 1.645
LEAST_GOOD = 0.5
#: Correlation within a unit: its limits, and its value where no unit has two labelled pages.
LEAST_RHO, MOST_RHO, USUAL_RHO = 0.001, 0.999, 0.1

_ADDRESS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """What stands after the first :// up to /, ? or #, with A-Z in lower case; empty without one."""
    return ascii_lower(F.coalesce(F.regexp_extract(url, _ADDRESS, 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _ADDRESS, 2), F.lit(""))


def domain_of(host: Column) -> Column:
    """The last two labels, without user and port; an address of numbers as it is."""
    name = F.regexp_replace(F.regexp_replace(host, "^.*@", ""), ":[0-9]*$", "")
    last_two = F.regexp_extract(name, r"([^.]*\.)?[^.]*$", 0)
    return F.when(name.rlike(r"^[0-9.]+$"), name).otherwise(last_two)


def suffix_of(domain: Column) -> Column:
    return F.substring_index(domain, ".", -1)


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]] = RULES) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits; null if none does."""
    name = verdict = F.lit(None).cast("string")
    for allow_or_block, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(allow_or_block)).otherwise(verdict)
    return name, verdict


def _strength(units: DataFrame) -> float:
    """Prior strength of units (good, n, prior) by the method of moments; one row comes to the driver."""
    chance = F.col("prior") * (1 - F.col("prior"))
    beyond = (F.col("good") - F.col("n") * F.col("prior")) ** 2 / F.col("n") - chance
    found, room = units.filter("n > 0").agg(F.sum(beyond), F.sum((F.col("n") - 1) * chance)).first()
    rho = min(MOST_RHO, max(LEAST_RHO, found / room)) if room else USUAL_RHO
    return 1 / rho - 1


def _shrunk(units: DataFrame) -> tuple[DataFrame, float]:
    strength = _strength(units)
    mean = (F.col("good") + F.col("prior") * strength) / (F.col("n") + strength)
    return units.withColumn("mean", mean), strength


def host_reputation(hosts: DataFrame, z: float = Z) -> DataFrame:
    """host, n, good, mean, bound from one row per host (host, n labelled pages, good ones).

    Each level is read back from storage; hosts without labels get the estimate of their domain.
    """
    hosts = hosts.withColumn("domain", domain_of(F.col("host")))
    hosts = store(hosts.withColumn("suffix", suffix_of(F.col("domain"))), "hosts")
    sums = [F.sum("n").alias("n"), F.sum("good").alias("good")]
    domains = hosts.groupBy("domain", "suffix").agg(*sums)
    suffixes = hosts.groupBy("suffix").agg(*sums)
    n, good = hosts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.coalesce(F.sum("good"), F.lit(0))).first()
    suffixes, _ = _shrunk(store(suffixes.withColumn("prior", F.lit((good + 1) / (n + 2))), "suffixes"))
    priors = suffixes.select("suffix", F.col("mean").alias("prior"))
    domains, _ = _shrunk(store(domains.join(priors, "suffix"), "domains"))
    priors = domains.select("domain", F.col("mean").alias("prior"))
    shrunk, strength = _shrunk(store(hosts.join(priors, "domain"), "priors"))
    mean = F.col("mean")
    spread = F.sqrt(mean * (1 - mean) / (F.col("n") + strength + 1))
    return store(shrunk.select("host", "n", "good", "mean", (mean - z * spread).alias("bound")), "reputation")


def judge(
    pages: DataFrame,
    outcomes: DataFrame,
    rules: Sequence[tuple[str, str, str]] = RULES,
    least_good: float = LEAST_GOOD,
    z: float = Z,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, n_labelled, mean, bound.

    ``outcomes`` has page_id and good (1 or 0; null is no label); of repeated labels of a page the smallest counts. A null url, or one without
    ``://``, has an empty host and path and is judged as a page of the host ''. Columns other than page_id and
    url are ignored; empty tables are fine: without labels every host has the same bound.
    """
    addressed = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    addressed = store(addressed, "addresses")
    labels = outcomes.filter("good is not null").groupBy("page_id").agg(F.min("good").cast("long").alias("good"))
    counts = (
        addressed.select("page_id", "host")
        .join(labels, "page_id", "left")
        .groupBy("host")
        .agg(F.count("good").alias("n"), F.coalesce(F.sum("good"), F.lit(0)).alias("good"))
    )
    reputation = host_reputation(counts, z)
    name, verdict = matching_rule(F.col("host"), F.col("path"), rules)
    by_host = F.when(F.col("bound") >= least_good, "allow").otherwise("block")
    return addressed.join(reputation, "host").select(
        "page_id",
        "host",
        "path",
        name.alias("rule"),
        F.coalesce(verdict, by_host).alias("verdict"),
        F.col("n").alias("n_labelled"),
        "mean",
        "bound",
    )
