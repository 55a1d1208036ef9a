"""URL filter: fixed rules first, then the reputation of the host.

A host's rate of bad pages is the posterior of a beta-binomial model: its labelled pages are shrunk towards its
registered domain's rate, that towards the suffix's, that towards the rate of all. How strongly is estimated at each
level from the spread of its units. A host without labelled pages has the rate of its domain, else of its suffix. A
host is blocked if its bad rate is above a threshold even at a posterior bound.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .columns import fresh

#: Fixed values: (verdict, host, path).
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))
#: Suffixes of two labels under which names are registered, unless others are given; no full list of public suffixes.
WIDE_SUFFIXES = ("ac.uk", "co.in", "co.jp", "co.kr", "co.nz", "co.uk", "co.za", "com.ar", "com.au", "com.br", "com.cn", "com.mx", "com.tr", "org.uk")
Z, THRESHOLD = 1.645, 0.5


def url_host(url: Column) -> Column:
    """Between the first ``://`` and ``/``, ``?``, ``#`` or the end, A-Z lowered; empty without ``://`` or if null."""
    found = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(found, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), F.lit(""))


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matched_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """The longest rule that fits, as host and path, and its verdict; null if none fits."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1], r[2])):  # later and longer ones win
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(what)).otherwise(verdict)
    return name, verdict


def suffix_and_domain(host: Column, wide_suffixes: Sequence[str] = WIDE_SUFFIXES) -> tuple[Column, Column]:
    """The public suffix and the registered domain of a host, user and port left out; a number address is both.

    A suffix is the last label, or two labels if those are in ``wide_suffixes``.
    """
    bare = F.regexp_replace(F.regexp_replace(host, r"^.*@", ""), r":[0-9]*$", "")
    two, last = F.substring_index(bare, ".", -2), F.substring_index(bare, ".", -1)
    number = bare.rlike(r"^[0-9.]+$|^\[")
    wide = two.isin(*wide_suffixes)
    suffix = F.when(number, bare).when(wide, two).otherwise(last)
    return suffix, F.when(number, bare).when(wide, F.substring_index(bare, ".", -3)).otherwise(two)


def _shrunk(units: DataFrame, prior: str, mean: str) -> tuple[DataFrame, float]:
    """Posterior means of units (n, bad, prior), and the strength of the prior by the method of moments."""
    m = F.col(prior)
    var = m * (1 - m)
    row = units.agg(
        F.sum((F.col("bad") - F.col("n") * m) ** 2 - F.col("n") * var), F.sum(F.col("n") * (F.col("n") - 1) * var)
    ).first()
    tie = min(0.999, max(0.001, row[0] / row[1])) if row[1] else 0.5
    strength = round(1 / tie - 1, 6)
    return units.withColumn(mean, (F.col("bad") + strength * m) / (F.col("n") + strength)), strength


def host_reputation(outcomes: DataFrame, wide_suffixes: Sequence[str] = WIDE_SUFFIXES) -> DataFrame:
    """Hosts of pages (host, bad 0 or 1, or null without a label): host, bad_rate, bound (lower, at ``Z`` deviations).

    One row per host; counts are combined before they are shuffled. A host without labels adds nothing to the rates and
    strengths, and its bad rate is that of its domain or, if that has no label either, of its suffix; the strength above
    counts as known, as for labelled hosts. Null hosts and hosts of a suffix without any label have no row.
    """
    suffix, domain = suffix_and_domain(F.col("host"), wide_suffixes)
    hosts = outcomes.filter("host IS NOT NULL").groupBy("host").agg(F.count("bad").alias("n"), F.coalesce(F.sum("bad"), F.lit(0)).alias("bad"))
    hosts = hosts.select("host", "n", "bad", suffix.alias("suffix"), domain.alias("domain"))
    total = hosts.agg(F.sum("n"), F.sum("bad")).first()
    rate = ((total[1] or 0) + 0.5) / ((total[0] or 0) + 1)
    suffixes, _ = _shrunk(hosts.groupBy("suffix").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).withColumn("m0", F.lit(rate)), "m0", "m1")
    suffixes = suffixes.filter("n > 0")
    domains = hosts.groupBy("suffix", "domain").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).join(suffixes.select("suffix", "m1"), "suffix")
    domains, _ = _shrunk(domains, "m1", "m2")
    hosts, k = _shrunk(hosts.join(domains.select("suffix", "domain", "m2"), ["suffix", "domain"]), "m2", "m3")
    spread = F.sqrt(F.col("m3") * (1 - F.col("m3")) / (F.col("n") + k + 1))
    return hosts.select("host", F.col("m3").alias("bad_rate"), (F.col("m3") - Z * spread).alias("bound"))


def judge(
    pages: DataFrame, outcomes: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, threshold: float = THRESHOLD,
    wide_suffixes: Sequence[str] = WIDE_SUFFIXES,
) -> DataFrame:
    """All pages with host, path, rule and verdict (allow or block).

    ``outcomes`` (page_id, bad) are labelled pages. A page that no rule fits is blocked if its host's posterior bound
    of the bad rate is above ``threshold``, also if the host has no label and only its domain or suffix speaks against
    it; hosts of a suffix without labels are allowed. A null url or one without ``://`` has the empty host, which is a
    host like others. Columns of ``pages`` named like results must be renamed before.
    """
    (h2,) = fresh(pages, "host")
    parts = pages.withColumns({"host": url_host(F.col("url")), "path": url_path(F.col("url"))})
    labelled = outcomes.select(F.col("page_id").alias("p"), "bad").join(parts.select("page_id", "host"), F.col("p") == F.col("page_id"))
    known = labelled.select("host", "bad").union(parts.select("host", F.lit(None).cast("bigint")))
    scores = host_reputation(known, wide_suffixes).filter(F.col("bound") > threshold).select(F.col("host").alias(h2))
    joined = parts.join(scores, parts["host"] == scores[h2], "left")
    name, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    own = F.when(F.col(h2).isNotNull(), "block").otherwise("allow")
    return joined.withColumns({"rule": name, "verdict": F.coalesce(verdict, own)}).drop(h2)
