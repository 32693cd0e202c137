"""Host reputation by empirical Bayes, with site rules on top (built-in functions only).

Labelled pages are outcomes (1 bad, 0 good) of their host. Bad rates are shrunk down a hierarchy of
beta-binomial priors: all pages -> suffix (last name of the host) -> registered domain (last two
names) -> host. The strength of each level's prior is fitted to the counts by moments (how much the
rates of its groups differ beyond what counting alone explains). A host's posterior is a beta; the
page is blocked if the posterior's lower bound (mean - z sd) reaches ``block_rate``.

Scale: pages are reduced per host (partial sums before the shuffle), domains and suffixes come from
hosts; only the three fitted strengths and the base rate reach the driver. Host verdicts go back by a
join on host that AQE broadcasts or splits. Defined results: a null url, or one without ``://``, has
empty host and path and belongs to the empty host; labels that repeat count once a page with the
worst outcome; an unlabelled page has no outcome; without any label the base rate is 1/2.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
Z = 1.645
BLOCK_RATE = 0.5
# Limits of a fitted prior's strength, in outcomes.
MIN_STRENGTH, MAX_STRENGTH = 1.0, 1000.0


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """(rule text, verdict) of the longest of the (host, path prefix, verdict) rules that fits; a rule
    fits its host and all subdomains. The list is a parameter, tried in order of length."""
    text, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r[0] + r[1])):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        text, verdict = F.when(fits, F.lit(h + p)).otherwise(text), F.when(fits, F.lit(v)).otherwise(verdict)
    return text, verdict


def outcomes(labels: DataFrame, key: str = "doc_id") -> DataFrame:
    """One row per labelled page: bad = 1 for low quality or toxic."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    return labels.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("page_key")).agg(F.max(bad).alias("bad"))


def _strength(groups: DataFrame, rate: float) -> float:
    """Prior strength of a level from its groups' (n, k), by moments around the overall rate."""
    s = groups.agg(F.sum("n").alias("n"), F.sum(F.col("n") * F.col("n")).alias("nn"),
                   F.sum(F.col("k") * F.col("k")).alias("kk"), F.sum(F.col("k") * F.col("n")).alias("kn")).first()
    if not s["n"] or s["nn"] <= s["n"] or rate <= 0.0 or rate >= 1.0:
        return MAX_STRENGTH
    spread = s["kk"] - 2.0 * rate * s["kn"] + rate * rate * s["nn"]
    rho = (spread / (rate * (1.0 - rate)) - s["n"]) / (s["nn"] - s["n"])
    if rho <= 0.0:
        return MAX_STRENGTH
    return min(MAX_STRENGTH, max(MIN_STRENGTH, 1.0 / rho - 1.0))


def reputations(pages: DataFrame, labelled: DataFrame, z: float = Z, block_rate: float = BLOCK_RATE,
                page_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per host: labelled pages n, bad ones k, posterior mean and lower bound, blocked."""
    seen = pages.select(F.col(page_col).alias("page_key"), host_of(F.col(url_col)).alias("host"))
    hosts = (seen.join(labelled, "page_key", "left").groupBy("host")
             .agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("k"))
             .withColumn("domain", F.coalesce(F.nullif(F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1), F.lit("")), F.col("host")))
             .withColumn("suffix", F.regexp_extract("host", r"([^.]*)$", 1)))
    domains = hosts.groupBy("domain").agg(F.sum("n").alias("n"), F.sum("k").alias("k"),
                                          F.first("suffix").alias("suffix"))
    suffixes = domains.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = suffixes.agg(F.sum("n").alias("n"), F.sum("k").alias("k")).first()
    base = total["k"] / total["n"] if total["n"] else 0.5
    s1, s2, s3 = (_strength(level, base) for level in (suffixes, domains, hosts))
    suffixes = suffixes.select("suffix", ((F.col("k") + F.lit(s1 * base)) / (F.col("n") + F.lit(s1))).alias("suffix_rate"))
    domains = (domains.join(suffixes, "suffix")
               .select("domain", ((F.col("k") + F.lit(s2) * F.col("suffix_rate")) / (F.col("n") + F.lit(s2))).alias("domain_rate")))
    size = F.col("n") + F.lit(s3)
    mean = (F.col("k") + F.lit(s3) * F.col("domain_rate")) / size
    return (hosts.join(domains, "domain").withColumn("mean", mean)
            .withColumn("bound", F.col("mean") - F.lit(z) * F.sqrt(F.col("mean") * (F.lit(1.0) - F.col("mean")) / (size + F.lit(1.0))))
            .select("host", "n", "k", "mean", "bound", (F.col("bound") >= F.lit(block_rate)).alias("blocked")))


def judge(pages: DataFrame, labelled: DataFrame, rules: Sequence[tuple[str, str, str]] = (), z: float = Z,
          block_rate: float = BLOCK_RATE, page_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page id, host, path, rule, verdict, and the host's posterior mean and bound, for every page row."""
    hosts = reputations(pages, labelled, z, block_rate, page_col, url_col)
    rows = pages.select(F.col(page_col).alias("page"), host_of(F.col(url_col)).alias("host"),
                        path_of(F.col(url_col)).alias("path"))
    rule, verdict = fitting_rule(F.col("host"), F.col("path"), rules)
    return rows.join(hosts, "host", "left").select(
        F.col("page").alias(page_col), "host", "path", rule.alias("rule"),
        F.coalesce(verdict, F.when(F.col("blocked"), "block").otherwise("allow")).alias("verdict"), "mean", "bound")
