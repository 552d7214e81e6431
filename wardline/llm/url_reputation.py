"""URL rules, and empirical-Bayes reputation of hosts for urls without one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wardline.llm.common import stage, unique_key_join

URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
# Rule (host and path) and its verdict.
RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
# Hosts whose share of bad pages is above this at the lower posterior bound are blocked.
BAD_SHARE = 0.5
Z = 1.645
# Prior strength (pages) where a level has too few units to estimate it.
STRENGTH = 10.0
LEVELS = ("host", "domain", "suffix")


def split_url(pages: DataFrame) -> DataFrame:
    """Adds host (A-Z lower-cased) and path; both empty for null and for urls without `://`."""
    url = F.coalesce(F.col("url"), F.lit(""))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return pages.withColumns(
        {"host": F.translate(F.regexp_extract(url, URL, 1), upper, lower), "path": F.regexp_extract(url, URL, 2)}
    )


def rule_of(rules=RULES) -> Column:
    """(rule, verdict) of the longest rule that fits host and path, or null."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule, verdict in sorted(rules, key=lambda r: len(r[0])):
        host, _, rest = rule.partition("/")
        fits = (F.col("host") == host) | F.col("host").endswith(f".{host}")
        row = F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))
        found = F.when(fits & F.col("path").startswith(f"/{rest}"), row).otherwise(found)
    return found


def strength(units: DataFrame) -> Column:
    """Prior strength of a level as an aggregate over its units' n and y.

    The share of variance that lies between the units comes from the analysis of variance of
    grouped 0/1 outcomes; the beta prior has strength 1 / share - 1.
    """
    k, n, y = F.count("*"), F.sum("n"), F.sum("y")
    squares, rates = F.sum(F.col("n") * F.col("n")), F.sum(F.col("y") * F.col("y") / F.col("n"))
    between = (rates - y * y / n) / (k - 1)
    within = (y - rates) / (n - k)
    size = (n - squares / n) / (k - 1)
    share = (between - within) / (between + (size - 1) * within)
    bounded = F.least(F.greatest(share, F.lit(0.0001)), F.lit(0.99))
    usable = (k > 1) & (n > k) & (y > 0) & (y < n)
    return units.filter("n > 0").agg(F.when(usable, 1 / bounded - 1).otherwise(STRENGTH)).first()[0]


def reputations(hosts: DataFrame) -> DataFrame:
    """host, n, mean, bound of hosts with pages, n (labelled) and y (bad).

    The registered domain is a host's last two labels, the suffix its last one. Each level's
    prior mean is the posterior mean of the level above, down from the rate of all labelled
    pages; its strength is estimated from the spread of the level's own rates. `bound` is
    mean - Z standard deviations of the host's beta posterior.
    """
    parts = F.split("host", r"\.")
    hosts = hosts.withColumns(
        {"domain": F.array_join(F.slice(parts, F.greatest(F.size(parts) - 1, F.lit(1)), 2), "."), "suffix": F.element_at(parts, -1)}
    )
    counts = [F.sum("n").alias("n"), F.sum("y").alias("y"), F.sum("pages").alias("pages")]
    domains = stage(hosts.groupBy("domain", "suffix").agg(*counts), "url-domains")
    suffixes = stage(domains.groupBy("suffix").agg(*counts), "url-suffixes")
    n, y = suffixes.agg(F.sum("n"), F.sum("y")).first()
    rate = (y + 0.5) / (n + 1) if n else 0.5

    def shrunk(units: DataFrame, prior: Column) -> DataFrame:
        k = strength(units)
        return units.withColumn("a", F.col("y") + k * prior).withColumn("b", F.col("n") - F.col("y") + k * (1 - prior))

    mean = F.col("a") / (F.col("a") + F.col("b"))
    top = shrunk(suffixes, F.lit(rate)).select("suffix", mean.alias("prior"), F.col("pages").alias("_w"))
    total = suffixes.agg(F.sum("pages")).first()[0] or 0
    middle = stage(unique_key_join(domains, top, "suffix", "_w", total), "url-domains")
    middle = shrunk(middle, F.col("prior")).select("domain", mean.alias("prior"), F.col("pages").alias("_w"))
    low = stage(unique_key_join(hosts, middle, "domain", "_w", total), "url-hosts")
    spread = F.sqrt(mean * (1 - mean) / (F.col("a") + F.col("b") + 1))
    return shrunk(low, F.col("prior")).select("host", "pages", "n", mean.alias("mean"), (mean - Z * spread).alias("bound"))


def judge(pages: DataFrame, labels: DataFrame, rules=RULES, bad_share: float = BAD_SHARE) -> DataFrame:
    """page_id, host, path, rule, verdict, labelled (labelled pages of the host).

    The longest fitting rule decides. Other urls follow their host's reputation: labels count for
    the page of the same id, a page is bad if labelled toxic or of quality 0, and a host is
    blocked only if its share of bad pages is above `bad_share` even at the lower posterior bound.
    Urls that are null or have no `://` share the empty host. Repeated pages are judged each;
    repeated labels count once, the worst of them. Empty tables give an empty result, and without
    labels every host keeps its prior, which allows.
    """
    bad = F.max(F.when((F.col("toxic") == 1) | (F.col("quality") == 0), 1).otherwise(0)).alias("bad")
    known = labels.filter(F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("_id")).agg(bad)
    found = split_url(pages.select("page_id", "url")).withColumn("found", rule_of(rules)).drop("url")
    found = stage(found, "url-pages")
    labelled = found.select("page_id", "host").join(known, F.col("page_id") == F.col("_id"), "left")
    hosts = labelled.groupBy("host").agg(
        F.count("*").alias("pages"), F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("y")
    )
    ranked = stage(reputations(stage(hosts, "url-hosts")), "url-reputation")
    total = ranked.agg(F.sum("pages")).first()[0] or 0
    joined = unique_key_join(found, ranked, "host", "pages", total)
    own = F.when(F.col("bound") > bad_share, "block").otherwise("allow")
    verdict = F.coalesce(F.col("found.verdict"), own)
    return joined.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"), verdict.alias("verdict"), F.col("n").alias("labelled")
    )
