"""URL filter by empirical-Bayes host reputation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from mergewell.session import cut_lineage

#: Standard deviations below the posterior mean from which a host's bad rate is judged, and the rate from which it is blocked.
DEVIATIONS, BLOCK_FROM = 1.0, 0.5
#: Bounds of the prior's weight, in pages, and its weight where the groups don't tell.
WEIGHT_LOW, WEIGHT_HIGH, WEIGHT_DEFAULT = 2.0, 200.0, 10.0
#: Suffixes of two parts under which domains are registered.
TWO_PART_SUFFIXES = ("ac.uk", "co.jp", "co.nz", "co.uk", "com.ar", "com.au", "com.br", "com.mx", "com.ve", "gov.uk", "net.au", "org.au", "org.uk")
#: The rules of the contract, (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host_of(url: Column) -> Column:
    rest = F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)).otherwise("")
    return F.coalesce(F.translate(rest, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.when(F.instr(url, "://") > 0, F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1)).otherwise(""), F.lit(""))


def bare(host: Column) -> Column:
    """The host without user and port, whose reputation is one."""
    return F.regexp_replace(F.substring_index(host, "@", -1), ":[0-9]*$", "")


def suffix_of(host: Column, suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> Column:
    two = F.substring_index(host, ".", -2)
    return F.when(two.isin(*suffixes), two).otherwise(F.substring_index(host, ".", -1))


def domain_of(host: Column, suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> Column:
    return F.when(F.substring_index(host, ".", -2).isin(*suffixes), F.substring_index(host, ".", -3)).otherwise(F.substring_index(host, ".", -2))


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule, as host and path together, that fits, and its verdict; null where none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for rule_host, rule_path, says in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == rule_host) | host.endswith("." + rule_host)) & path.startswith(rule_path)
        name = F.when(fits, rule_host + rule_path).otherwise(name)
        verdict = F.when(fits, says).otherwise(verdict)
    return name, verdict


def _weight(groups: DataFrame, rate: float) -> float:
    """How many pages the prior weighs: the method of moments on the groups' bad rates, within bounds."""
    if not 0 < rate < 1:
        return WEIGHT_DEFAULT
    row = groups.where("n > 1").agg(F.count("*").alias("g"), F.sum("n").alias("n"), F.sum(F.col("n") * F.pow(F.col("bad") / F.col("n") - rate, 2)).alias("spread")).first()
    if not row["g"] or row["g"] < 2:
        return WEIGHT_DEFAULT
    noise = rate * (1 - rate)
    between = row["spread"] / row["n"] - noise * row["g"] / row["n"]
    return WEIGHT_HIGH if between <= 0 else min(WEIGHT_HIGH, max(WEIGHT_LOW, noise / between - 1))


def host_reputation(pages: DataFrame, labels: DataFrame, suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> DataFrame:
    """(host, bad_rate, lower, blocked) for every host of pages, without user and port; suffixes are those of two parts.

    A labelled page is bad if it is toxic or of low quality; labels meet pages by id. Bad rates shrink
    from all pages to the suffix, the registered domain and the host: each level's posterior mean is the
    prior mean of the next. A host is blocked if the posterior's mean less DEVIATIONS standard deviations
    reaches BLOCK_FROM, so hosts without evidence follow their domain and are never blocked on a guess.
    Repeated labels of an id count by their mean, repeated pages as often as they come; a label with a
    null id, quality or toxicity is no evidence. Empty tables give an empty result or block nothing.
    """
    outcome = labels.select("doc_id", F.greatest(F.col("toxic"), 1 - F.col("quality")).cast("double").alias("y"), "toxic", "quality").where("doc_id is not null and toxic is not null and quality is not null").groupBy("doc_id").agg(F.avg("y").alias("y"))
    named = pages.select("page_id", bare(host_of(F.col("url"))).alias("host")).join(outcome, F.col("page_id") == F.col("doc_id"), "left")
    hosts = named.groupBy("host").agg(F.count("y").alias("n"), F.coalesce(F.sum("y"), F.lit(0.0)).alias("bad"))
    hosts = cut_lineage(hosts.withColumn("domain", domain_of(F.col("host"), suffixes)).withColumn("suffix", suffix_of(F.col("host"), suffixes)))
    known = hosts.count()
    domains = cut_lineage(hosts.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), known)
    suffixes = cut_lineage(domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")), known)
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).first()
    rate = (total["bad"] or 0.0) / total["n"] if total["n"] else 0.0
    weights = [_weight(level, rate) for level in (suffixes, domains, hosts)]

    def posterior(prior: Column, weight: float) -> Column:
        return (F.col("bad") + prior * weight) / (F.col("n") + weight)

    by_suffix = suffixes.select("suffix", posterior(F.lit(rate), weights[0]).alias("prior"))
    by_domain = domains.join(by_suffix, "suffix").select("domain", posterior(F.col("prior"), weights[1]).alias("prior"))
    judged = hosts.join(by_domain, "domain").withColumn("bad_rate", posterior(F.col("prior"), weights[2]))
    deviation = F.sqrt(F.col("bad_rate") * (1 - F.col("bad_rate")) / (F.col("n") + weights[2] + 1))
    return judged.withColumn("lower", F.col("bad_rate") - DEVIATIONS * deviation).select("host", "bad_rate", "lower", (F.col("lower") >= BLOCK_FROM).alias("blocked"))


def judge_pages(pages: DataFrame, labels: DataFrame, rules=RULES, suffixes: tuple[str, ...] = TWO_PART_SUFFIXES) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every page: a rule's verdict, else block for blocked hosts and allow for the rest.

    A null url, or one without ://, has an empty host and path, fits no rule and is judged like the
    other pages without a host.
    """
    blocked = cut_lineage(host_reputation(pages, labels, suffixes).where("blocked").select(F.col("host").alias("bad_host")))
    parts = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    name, says = matched_rule(F.col("host"), F.col("path"), rules)
    ruled = parts.withColumn("rule", name).withColumn("says", says)
    own = F.when(F.col("bad_host").isNotNull(), "block").otherwise("allow")
    return ruled.join(blocked, bare(ruled["host"]) == blocked["bad_host"], "left").select("page_id", "host", "path", "rule", F.coalesce("says", own).alias("verdict"))
