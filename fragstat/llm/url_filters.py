"""URL filters: pattern rules behind a rarest-token index.

A rule is a host and a path prefix with a verdict.  It is kept under one of
its literal tokens, the one that the fewest URLs hold; a URL fetches the rules
that lie under its own tokens, and only those are run as regular expressions.
DataFrame expressions throughout.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Up to so many rules, the index is broadcast; more are joined by a shuffle.
MAX_BROADCAST_RULES = 50_000


def url_host(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z
    lower-cased; empty for null and for URLs without ``://``."""
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(host, UPPER, LOWER)


def url_path(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rules_frame(spark: SparkSession, rules: list[tuple[str, str, str]]) -> DataFrame:
    """(verdict, host, path) rules as a DataFrame; null-free, any number."""
    if not rules:
        return spark.sql("SELECT '' AS verdict, '' AS host, '' AS path WHERE false")
    rows = F.array(*(F.struct(F.lit(v).alias("verdict"), F.lit(h).alias("host"), F.lit(p).alias("path"))
                     for v, h, p in rules))
    return spark.range(1).select(F.inline(rows))


def _tokens(host: Column, path: Column) -> Column:
    """Literal tokens that a URL of this host and path is sure to hold: the
    host's labels and the path's segments that a slash ends; and one empty
    token, for rules that have no other."""
    labels = F.transform(F.split(host, r"\."), lambda x: F.concat(F.lit("."), x))
    closed = F.split(F.regexp_replace(path, r"[^/]*$", ""), "/")
    segments = F.transform(closed, lambda x: F.concat(F.lit("/"), x))
    literal = F.filter(F.concat(labels, segments), lambda x: F.length(x) > 1)
    return F.array_distinct(F.concat(F.array(F.lit("")), literal))


def _quoted(text: Column) -> Column:
    return F.regexp_replace(text, r"([^A-Za-z0-9/_-])", r"\\$1")


def rule_index(rules: DataFrame, urls: DataFrame) -> DataFrame:
    """``token, rule, verdict, pattern``: each rule once, under its rarest token
    in ``urls`` (``host, path``).  Repeated rules count once; of rules with the
    same host and path but two verdicts, ``block`` wins."""
    distinct = (
        rules.groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
        .select(
            F.concat("host", "path").alias("rule"), "verdict",
            F.concat(
                F.lit(r"^(?:[^/]*\.)?"), _quoted(F.col("host")),
                F.when(F.col("path") == "", F.lit("(?:/|$)")).otherwise(_quoted(F.col("path"))),
            ).alias("pattern"),
            F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))
    )
    wanted = distinct.select("token").distinct()
    counts = (
        urls.select(F.explode(_tokens(F.col("host"), F.col("path"))).alias("token"))
        .join(F.broadcast(wanted) if rules.count() <= MAX_BROADCAST_RULES else wanted, "token")
        .groupBy("token").agg(F.count(F.lit(1)).alias("n"))
    )
    rarity = F.struct(F.coalesce("n", F.lit(0)), F.col("token") == "", "token")
    return (
        distinct.join(counts, "token", "left")
        .groupBy("rule", "verdict", "pattern").agg(F.min_by("token", rarity).alias("token"))
        .select("token", "rule", "verdict", "pattern")
    )


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow",
               id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row per page: ``id_col, url, host, path, rule, verdict``.

    A rule fits its host and all subdomains if the path starts with the
    rule's; the longest ``host + path`` wins (of two equally long ones, the
    later in text order).  Pages that no rule fits, those with a null or
    empty URL or one without ``://`` among them, get ``rule`` null and the
    default verdict.  Rows that repeat id and URL are judged once and come back as often as
    they were; other columns are not read.  Empty tables give no rows.
    """
    rows = pages.groupBy(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")).agg(
        F.count(F.lit(1)).alias("_times"))
    parts = {"_host": url_host(F.col("_url")), "_path": url_path(F.col("_url"))}
    index = rule_index(rules, pages.select(
        url_host(F.col(url_col)).alias("host"), url_path(F.col(url_col)).alias("path")))
    if rules.count() <= MAX_BROADCAST_RULES:
        index = F.broadcast(index)
    candidates = (
        rows.withColumns(parts)
        .withColumn("token", F.explode(_tokens(F.col("_host"), F.col("_path"))))
        .join(index, "token", "left")
    )
    fits = F.rlike(F.concat("_host", "_path"), F.col("pattern")) & (F.col("_host") != "")
    found = F.when(fits, F.struct(F.length("rule").alias("length"), "rule", "verdict"))
    return (
        candidates.groupBy("_id", "_url").agg(F.max(found).alias("_best"), F.max("_times").alias("_times"))
        .withColumns(parts)
        .withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_times"))))
        .select(
            F.col("_id").alias(id_col), F.col("_url").alias("url"),
            F.col("_host").alias("host"), F.col("_path").alias("path"),
            F.col("_best.rule").alias("rule"),
            F.coalesce(F.col("_best.verdict"), F.lit(default)).alias("verdict"))
    )
