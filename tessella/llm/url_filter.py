"""URL filter rules by expansion and hash-prefix lookup, in DataFrame operations alone.

Each url becomes its host's suffixes (at label borders) times its path's prefixes. Paths are cut at the lengths that rule
paths have, as a rule's path may end inside a segment; there are only as many lengths as rules differ in. Of the digest
of host and path four bytes are joined with the rules' first; the whole digest then confirms, so a collision of prefixes
costs a row, not an error. Of the confirmed rules of a page the longest wins; equal rules with two actions: block wins.

The rules are broadcast if their serialised size is at most BROADCAST_BYTES. A larger table is joined by shuffle: each
rule prefix is there once, and frequent expressions of the pages are split among tasks by adaptive execution.

Cases: a url that is null or has no "://" has an empty host and path and meets no rule; an empty path meets no rule with
a path; hosts compare after lower-casing A-Z alone, ports and user names are part of them; repeated pages are judged
alike, as rows; empty tables of pages or rules work; other columns of pages are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

BROADCAST_BYTES = 8 << 20
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def rule_table(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(host, path, verdict) from a list of (verdict, host, path)."""
    return spark.createDataFrame([(h, p, v) for v, h, p in rules], "host string, path string, verdict string")


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    return F.coalesce(F.translate(host, UPPER, LOWER), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def digest(host: Column, path: Column) -> Column:
    return F.unhex(F.sha2(F.concat(host, F.lit("\n"), path).cast("binary"), 256))


def judge(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """page_id, host, path, rule, verdict of every page."""
    rules = rules.where("host is not null and path is not null and verdict in ('allow', 'block')")
    rules = rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    size = rules.agg(F.coalesce(F.sum(F.length("host") + F.length("path") + 64), F.lit(0)).alias("bytes"), F.sort_array(F.collect_set(F.length("path"))).alias("cuts")).first()
    held = rules.select(
        digest(F.col("host"), F.col("path")).alias("full"), F.concat("host", "path").alias("rule"), F.col("verdict").alias("ruled"), (F.length("host") + F.length("path")).alias("length")
    ).withColumn("prefix", F.substring("full", 1, 4))
    if size["bytes"] <= BROADCAST_BYTES:
        held = F.broadcast(held)
    rows = pages.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    labels = F.split("host", r"\.", -1)
    hosts = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda k: F.array_join(F.slice(labels, k, F.size(labels)), "."))
    cuts = F.filter(F.array(*[F.lit(c) for c in size["cuts"]]).cast("array<int>"), lambda c: c <= F.length("path"))
    paths = F.transform(cuts, lambda c: F.substring(F.col("path"), F.lit(1), c))
    spread = rows.select("page_id", "host", "path", "row", F.explode_outer(hosts).alias("h"), paths.alias("paths")).select("page_id", "host", "path", "row", "h", F.explode_outer("paths").alias("p"))
    looks = spread.withColumn("digest", digest(F.col("h"), F.col("p"))).withColumn("prefix", F.substring("digest", 1, 4))
    found = looks.join(held, "prefix", "left").withColumn("sure", F.col("digest") == F.col("full"))
    best = F.max(F.when(F.col("sure"), F.struct("length", "ruled", "rule"))).alias("best")
    return found.groupBy("row", "page_id", "host", "path").agg(best).select("page_id", "host", "path", F.col("best.rule").alias("rule"), F.coalesce("best.ruled", F.lit(default)).alias("verdict"))
