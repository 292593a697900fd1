"""URL rules matched by hashed host-suffix and path-prefix expressions.

Every rule is an expression `host + path`. A URL matches a rule if the rule's host is the URL's
host or a suffix of it that starts after a dot, and the URL's path starts with the rule's path.
Each URL is expanded into all such expressions that have as many labels and as long a path as some
rule, so their number depends on the rules and not on the URL. These are joined with the rules on a short hash
prefix, and full digests confirm. The longest expression wins, on equal length the longer host.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.session import materialised, small_side

PREFIX_HEX = 8
RULES = [
    ("net", "/", "block"), ("example.net", "/en/", "allow"),
    ("example.com", "/de/", "block"), ("org", "/fr/", "allow"),
]
DEFAULT = "allow"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: str) -> Column:
    """From the first `://` up to `/`, `?`, `#` or the end, A-Z lower-cased; else empty."""
    rest = F.expr(f"substring({url}, locate('://', {url}) + 3)")
    found = F.expr(f"locate('://', {url}) > 0")
    host = F.translate(F.regexp_extract(rest, r"^([^/?#]*)", 1), _UPPER, _LOWER)
    return F.when(found, host).otherwise("")


def path_of(url: str) -> Column:
    """After the host up to `?`, `#` or the end; else empty."""
    rest = F.expr(f"substring({url}, locate('://', {url}) + 3)")
    found = F.expr(f"locate('://', {url}) > 0")
    return F.when(found, F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)).otherwise("")


def rule_table(spark: SparkSession, rules=RULES) -> DataFrame:
    rows = [
        F.struct(F.lit(host).alias("rule_host"), F.lit(path).alias("rule_path"), F.lit(verdict).alias("verdict"))
        for host, path, verdict in rules
    ]
    return spark.range(1).select(F.inline(F.array(*rows)))


def _expressions(urls: DataFrame, labels: list[int], lengths: list[int]) -> DataFrame:
    """One row per expression of a (host, path): host suffixes at dots with the numbers of labels
    that rule hosts have, path prefixes at the lengths that rule paths have."""
    held = "length(host) - length(replace(host, '.', '')) + 1"
    suffixes = (
        f"transform(filter(array({', '.join(map(str, labels))}), k -> k <= {held}), k -> substring_index(host, '.', -k))"
    )
    wanted = ", ".join(map(str, lengths))
    prefixes = f"transform(filter(array({wanted}), n -> n <= length(path)), n -> substring(path, 1, n))"
    hosts = urls.select("host", "path", F.explode_outer(F.expr(suffixes)).alias("suffix"))
    spread = hosts.select("host", "path", "suffix", F.explode_outer(F.expr(prefixes)).alias("prefix")).where("prefix IS NOT NULL")
    digest = F.sha2(F.concat("suffix", F.lit("\n"), "prefix"), 256)
    return spread.select("host", "path", digest.alias("digest"))


def judged(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = DEFAULT) -> DataFrame:
    """All rows and columns of `pages` with host, path, rule and verdict added or replaced.

    A null URL or one without `://` has empty host and path and gets the default verdict, as does
    any URL without a rule; its rule is null. Rules with a null host or path fit nothing, an empty
    path fits every path. Of two verdicts for one rule `block` is taken. Repeated pages are judged
    alike, each distinct host and path once. Without rules or pages nothing fails.
    """
    rules = materialised(
        rules.where("rule_host IS NOT NULL AND rule_path IS NOT NULL")
        .groupBy("rule_host", "rule_path").agg(F.max("verdict").alias("verdict"))
    )
    # Lengths of rule paths: one small number per distinct length, not one per rule.
    lengths = sorted(r[0] for r in rules.select(F.length("rule_path")).distinct().collect()) or [0]
    # Numbers of labels of rule hosts, likewise.
    dots = F.length("rule_host") - F.length(F.replace("rule_host", F.lit("."), F.lit("")))
    labels = sorted(r[0] for r in rules.select(dots + 1).distinct().collect()) or [1]
    digest = F.sha2(F.concat("rule_host", F.lit("\n"), "rule_path"), 256)
    keyed = small_side(rules.select(
        digest.alias("rule_digest"), F.substring(digest, 1, PREFIX_HEX).alias("key"),
        F.concat("rule_host", "rule_path").alias("rule"),
        F.length("rule_host").alias("host_length"), F.col("verdict").alias("rule_verdict"),
    ))
    parts = pages.drop("host", "path", "rule", "verdict").withColumns(
        {"host": host_of(f"`{url}`"), "path": path_of(f"`{url}`")}
    )
    spread = _expressions(parts.select("host", "path").distinct(), labels, lengths)
    spread = spread.withColumn("key", F.substring("digest", 1, PREFIX_HEX))
    fits = spread.join(keyed, "key").where("digest = rule_digest")
    rank = F.struct(F.length("rule").alias("n"), "host_length", "rule", "rule_verdict")
    best = materialised(fits.groupBy("host", "path").agg(F.max(rank).alias("best")))
    best = best.select("host", "path", "best.rule", "best.rule_verdict")
    found = parts.join(best, ["host", "path"], "left")
    return found.withColumn("verdict", F.coalesce("rule_verdict", F.lit(default))).drop("rule_verdict")
