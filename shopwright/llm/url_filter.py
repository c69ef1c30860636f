"""URL allow and block rules by hash prefixes.

A URL's host is expanded into itself and everything after each of its dots, its
path into its beginnings of the lengths that occur among the rules. Host suffix
and path prefix together form an expression; expressions and rules are joined on
the first four bytes of a SHA-256 digest, then the whole digests and the texts
are compared. Of the rules that fit, the longest wins.

The rule side is repeated ``SALT`` times and each URL picks one repetition, so
that a rule which fits a third of all URLs is spread over tasks when Spark does not
broadcast the rules. The set of rule path lengths is collected; it can't have more
members than the longest rule path has characters.

Defined cases: without "://" or with a null URL host and path are empty and only
a rule with an empty host could fit. A path that does not start with the rule's,
such as the empty path for "/", does not fit. Of equal rules with different verdicts,
block wins. Rows are judged one by one, so repeated rows are repeated. Rules with
a null host, path or verdict are not used. Of pages, only page_id and url are read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shopwright.llm.expr import filled, literal_rows

SALT = 16
DEFAULT = "allow"

# Verdict, host, path.
RULES = [
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
]


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]] = RULES) -> DataFrame:
    return literal_rows(spark, rules, "verdict string, host string, path string")


def _digest(host: F.Column, path: F.Column) -> F.Column:
    return F.sha2(F.concat(host, path), 256)


def judged_urls(pages: DataFrame, rules: DataFrame, default: str = DEFAULT) -> DataFrame:
    """One row per page: page_id, host, path, rule (the winning rule's host and path, or null), verdict."""
    rules = rules.dropna(subset=["verdict", "host", "path"])
    lengths = [r[0] for r in rules.select(F.length("path")).distinct().collect()] or [0]
    url = filled(F.col("url"))
    after = F.regexp_extract(url, r"(?s)^.*?://(.*)$", 1)
    authority = F.regexp_extract(after, r"(?s)^[^/?#]*", 0)
    # Only A-Z change: other letters are kept by translating one by one.
    host = F.translate(authority, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    path = F.regexp_extract(F.substr(after, F.length(authority) + 1), r"(?s)^[^?#]*", 0)
    parts = pages.select(F.monotonically_increasing_id().alias("row"), "page_id", host.alias("host"), path.alias("path"))

    labels = F.split("host", r"\.")
    suffixes = F.transform(labels, lambda _, i: F.array_join(F.slice(labels, i + 1, F.size(labels)), "."))
    wanted = F.filter(F.array(*(F.lit(n) for n in sorted(lengths))), lambda n: n <= F.length("path"))
    prefixes = F.transform(wanted, lambda n: F.left("path", n))
    expanded = (
        parts.withColumn("suffix", F.explode(F.array_distinct(suffixes)))
        .withColumn("prefix", F.explode_outer(prefixes))
        .withColumn("digest", _digest(F.col("suffix"), F.col("prefix")))
    )
    known = rules.select(
        F.col("host").alias("rule_host"),
        F.col("path").alias("rule_path"),
        F.col("verdict").alias("rule_verdict"),
        _digest(F.col("host"), F.col("path")).alias("rule_digest"),
        F.explode(F.array(*(F.lit(i) for i in range(SALT)))).alias("rule_salt"),
    )
    # Only the short prefix (and the salt) are join keys; as no plain equalities, the rest is confirmed on what meets.
    confirmed = F.coalesce(
        (F.col("digest") == F.col("rule_digest")) & (F.col("suffix") == F.col("rule_host")) & (F.col("prefix") == F.col("rule_path")),
        F.lit(False),
    )
    fits = (
        (F.left("digest", F.lit(8)) == F.left("rule_digest", F.lit(8)))
        & (F.pmod("row", F.lit(SALT)).cast("int") == F.col("rule_salt"))
        & confirmed
    )
    rule = F.concat("rule_host", "rule_path")
    best = F.max(F.when(F.col("rule_host").isNotNull(), F.struct(F.length(rule).alias("n"), (F.col("rule_verdict") == "block").alias("blocks"), rule.alias("rule"), F.col("rule_verdict").alias("verdict"))))
    return (
        expanded.join(known, fits, "left")
        .groupBy("row", "page_id", "host", "path")
        .agg(best.alias("best"))
        .select("page_id", "host", "path", "best.rule", F.coalesce("best.verdict", F.lit(default)).alias("verdict"))
    )
