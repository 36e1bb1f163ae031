"""URL filters by host-suffix and path-prefix expressions, joined on short hash prefixes.

Native: built-in column functions and joins only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidewater.llm.common import staged, whole_row

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Group 1 is the host, group 2 the path.
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
#: Hex digits of the short hash that the join runs on; the full digest is compared afterwards.
SHORT = 8


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def rules_table(spark: SparkSession, rules: Sequence[tuple[str, str]]) -> DataFrame:
    """(action, rule) pairs such as ("block", "example.org/es/") as a table."""
    values = F.array(*[F.struct(F.lit(a).alias("action"), F.lit(r).alias("rule")) for a, r in rules])
    return spark.range(1).select(F.inline(values))


def _digest(host: Column, path: Column) -> Column:
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def filter_urls(pages: DataFrame, rules: DataFrame, url: str = "url", default: str = "allow") -> DataFrame:
    """`pages` with host, path, rule and verdict (columns of these names are replaced).

    A rule `host/path` fits its host and all subdomains when the url's path starts with the rule's
    path; the longest rule wins, then the longer host, then block before allow. Without a fitting
    rule the verdict is `default` and the rule null. Null urls and urls without `://` have an empty
    host and path, which no rule fits. Rules that are null or have no host are passed over; repeated
    rules and pages change nothing; with no rules every verdict is the default.

    Each distinct (host, path) is expanded once: host suffixes at label borders times path prefixes
    of the lengths that rules have. Only those lengths are read by the driver: at most one number
    per possible path length. Rows meet on 32 hash bits and are confirmed by the whole digest.
    """
    cut = F.instr("rule", "/")
    known = (
        rules.select("action", "rule")
        .withColumn("r_host", F.translate(F.when(cut > 0, F.substring("rule", F.lit(1), cut - 1)).otherwise(F.col("rule")), UPPER, LOWER))
        .withColumn("r_path", F.when(cut > 0, F.substring("rule", cut, F.length("rule"))).otherwise(F.lit("")))
        .filter(F.col("action").isin("allow", "block") & (F.length("r_host") > 0))
        .distinct()
        .withColumn("r_digest", _digest(F.col("r_host"), F.col("r_path")))
        .withColumn("short", F.substring("r_digest", 1, SHORT))
    )
    lengths = sorted(r[0] for r in known.select(F.length("r_path")).distinct().collect())
    seen = pages.select(host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path")).filter("host <> ''").distinct()
    labels = F.split("host", r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), ".")
    )
    prefixes = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("path"))
    expressions = (
        seen.select("host", "path", F.explode(suffixes).alias("suffix"))
        .select("host", "path", "suffix", F.explode(prefixes).alias("n"))
        .select("host", "path", _digest(F.col("suffix"), F.substring(F.col("path"), F.lit(1), F.col("n"))).alias("digest"))
        .withColumn("short", F.substring("digest", 1, SHORT))
    )
    order = F.struct(
        F.length("r_host") + F.length("r_path"), F.length("r_host"), F.col("action"), F.col("rule")
    )
    # Written before it is joined: then the rows of a url that a third of the pages have can be split.
    best = staged(
        expressions.join(known, "short").filter("digest = r_digest")
        .groupBy("host", "path").agg(F.max_by(F.struct("rule", "action"), order).alias("best"))
    )
    kept = [c for c in pages.columns if c not in ("host", "path", "rule", "verdict")]
    rows = pages.select(*[F.col(f"`{c}`") for c in kept])
    judged = pages.select(whole_row(rows).alias("row"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    # Rows without a host fit no rule. They pass by, or they would all be one key of the join.
    ruled = judged.filter("host <> ''").join(best, ["host", "path"], "left")
    bare = judged.filter("host = ''").withColumn("best", F.lit(None).cast(best.schema["best"].dataType))
    return ruled.unionByName(bare).select(
        *[F.col("row")[c].alias(c) for c in kept], "host", "path", F.col("best.rule").alias("rule"),
        F.coalesce("best.action", F.lit(default)).alias("verdict"),
    )
