"""Url filter: rules by host and path, and empirical-Bayes host reputation.

Labelled page outcomes (1 good, 0 bad) are counted by host. A host's good share
is shrunk towards that of its registered domain, which is shrunk towards that
of its suffix, which is shrunk towards the share of all: each level's prior is
a beta distribution with its parent's posterior mean and a strength fitted to
all groups of the level by the method of moments (groups that differ little
from their parents give a strong prior). A host is blocked when the upper
bound of its posterior, ``z`` standard deviations above the mean, stays below
``threshold``: few bad pages do not block a host, many do.

A rule (host, path) fits its host and all subdomains if the page's path begins
with the rule's; the longest (host, then path characters) wins over the method.

Null urls and urls without "://" have empty host and path and take part as the
host "". Repeated pages are counted and returned as often as given; labels with
a null page_id or outcome are ignored. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, lower_ascii

#: Suffixes of two labels under which names are registered; else the last label.
TWO_LABEL_SUFFIXES = ("co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "ne.jp", "co.nz", "com.br", "co.in", "com.cn", "co.za")

Rule = tuple[str, str, str]  # host, path, verdict


def parsed(pages: DataFrame, *more: Column) -> DataFrame:
    """page_id, host, path of each page, and the columns ``more``."""
    after = F.coalesce(F.regexp_extract("url", r"(?s)^.*?://(.*)$", 1), F.lit(""))
    return pages.select("page_id", after.alias("after"), *more).select(
        "page_id",
        lower_ascii(F.regexp_extract("after", r"(?s)^([^/?#]*)", 1)).alias("host"),
        F.regexp_extract("after", r"(?s)^[^/?#]*([^?#]*)", 1).alias("path"),
        *pages.select("page_id", *more).columns[1:],
    )


def domain_and_suffix(host: str = "host") -> tuple[Column, Column]:
    labels = F.split(F.col(host), r"\.")
    last = lambda n: F.array_join(F.slice(labels, -n, n), ".")
    two = (F.size(labels) >= 2) & F.when(F.size(labels) >= 2, last(2)).isin(*TWO_LABEL_SUFFIXES)
    suffix = F.when(two, F.when(F.size(labels) >= 2, last(2))).otherwise(F.element_at(labels, -1))
    of_two = F.when(F.size(labels) >= 3, last(3)).otherwise(F.col(host))
    domain = F.when(two, of_two).otherwise(F.when(F.size(labels) >= 2, last(2)).otherwise(F.col(host)))
    return domain, suffix


def strength(children: DataFrame) -> DataFrame:
    """One row, m: the prior strength of a level, from its groups' n, k and
    parent mean mu: Pearson residuals beyond the binomial part give the
    between-group variance rho, and m = 1 / rho - 1, within 1 to 10,000."""
    ok = children.where("n > 1 and mu > 0 and mu < 1")
    square = F.sum((F.col("k") - F.col("n") * F.col("mu")) ** 2 / (F.col("mu") * (1 - F.col("mu"))))
    excess, pairs = square - F.sum("n"), F.sum(F.col("n") * (F.col("n") - 1))
    rho = F.when(pairs > 0, excess / pairs)
    bounded = F.greatest(F.lit(1e-4), F.least(F.lit(0.5), rho))
    return ok.agg(F.coalesce(1 / bounded - 1, F.lit(10.0)).alias("m"))


def reputations(hosts: DataFrame, z: float = 2.0) -> DataFrame:
    """(host, n, mean, upper, lower) from (host, n, k): posterior mean and
    bounds of the good share of each host, labelled or not."""
    domain, suffix = domain_and_suffix()
    named = cut(hosts.select("*", domain.alias("domain"), suffix.alias("suffix")))
    by_domain = named.groupBy("domain", "suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    by_suffix = by_domain.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    total = by_suffix.agg(((F.coalesce(F.sum("k"), F.lit(0)) + 1) / (F.coalesce(F.sum("n"), F.lit(0)) + 2)).alias("mu"))

    def shrunk(level: DataFrame, name: str) -> DataFrame:
        """Adds the posterior mean of each group of a level with mu."""
        m = float(strength(level).first()["m"])
        mean = (F.col("k") + m * F.col("mu")) / (F.col("n") + m)
        return level.select("*", mean.alias(name), F.lit(m).alias(f"{name}_m"))

    mu = float(total.first()["mu"])
    suffixes = shrunk(by_suffix.withColumn("mu", F.lit(mu)), "mean")
    upper = suffixes.select("suffix", F.col("mean").alias("mu"))
    domains = shrunk(by_domain.join(upper, "suffix"), "mean")
    above = domains.select("domain", "suffix", F.col("mean").alias("mu"))
    out = shrunk(named.join(above, ["domain", "suffix"]), "mean")
    deviation = F.sqrt(F.col("mean") * (1 - F.col("mean")) / (F.col("n") + F.col("mean_m") + 1))
    return out.select("host", "n", "mean", (F.col("mean") + z * deviation).alias("upper"), (F.col("mean") - z * deviation).alias("lower"))


def rule_columns(rules: list[Rule]) -> tuple[Column, Column]:
    """The string and verdict of the longest rule that fits host and path."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for host, path, said in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):  # the longest is asked first
        fits = ((F.col("host") == host) | F.col("host").endswith("." + host)) & F.col("path").startswith(path)
        name, verdict = F.when(fits, F.lit(host + path)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def judge(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], threshold: float, z: float = 2.0) -> DataFrame:
    """page_id, host, path, rule, verdict, n_labelled, mean, upper per page.

    ``outcomes``: (page_id, good 0/1)."""
    read = parsed(pages)
    known = outcomes.where("page_id is not null and good is not null").select("page_id", F.col("good").cast("double").alias("good"))
    labelled = read.select("page_id", "host").join(known, "page_id")
    return _judged(read, labelled, rules, threshold, z)


def judge_rows(pages: DataFrame, outcomes: DataFrame, rules: list[Rule], threshold: float, z: float = 2.0) -> DataFrame:
    """The same with ``outcomes`` (page_id, url, good 0/1) of each row of ``pages``."""
    known = outcomes.where("good is not null")
    labelled = parsed(known, F.col("good").cast("double").alias("good")).select("host", "good")
    return _judged(parsed(pages), labelled, rules, threshold, z)


def _judged(read: DataFrame, outcomes: DataFrame, rules: list[Rule], threshold: float, z: float) -> DataFrame:
    labelled = outcomes.groupBy("host").agg(F.count("*").alias("n"), F.sum("good").alias("k"))
    seen = read.select("host", F.lit(0).cast("long").alias("n"), F.lit(0.0).alias("k")).distinct()
    hosts = labelled.union(seen).groupBy("host").agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    scored = cut(reputations(hosts, z))
    name, verdict = rule_columns(rules)
    method = F.when(F.col("upper") < threshold, "block").otherwise("allow")
    return read.join(scored, "host", "left").select(
        "page_id", "host", "path", name.alias("rule"), F.coalesce(verdict, method).alias("verdict"), F.col("n").alias("n_labelled"), "mean", "upper"
    )
