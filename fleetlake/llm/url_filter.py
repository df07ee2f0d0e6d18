"""URL filters by hashed host-suffix and path-prefix expressions.

A rule has a host, a path and a verdict. It fits a URL if the URL's host is the rule's or a
subdomain of it and the URL's path starts with the rule's path. Every URL is expanded into the
expressions that some rule could have, expressions meet rules in an equi-join on the first eight
hex digits of their SHA-256, and the full digests confirm. Only column functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetlake.llm.common import ascii_lower, checked_broadcast

#: Scheme, host and path of a URL; the lazy start ends at the first "://".
URL_PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
SHORT_DIGITS = 8
#: Bytes that a rule takes when it is broadcast: two digests, texts and overhead.
RULE_BYTES = 512
#: Most repeats that one array holds when equal rows are written out again.
REPEATS = 100_000


def url_host(url: Column) -> Column:
    """From behind the first ``://`` to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 1))


def url_path(url: Column) -> Column:
    """From behind the host to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), URL_PARTS, 2)


def _labels(host: Column) -> Column:
    return F.size(F.split(host, r"\."))


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """``page_id, url, host, path, rule, verdict``, one row for every row of ``pages``.

    ``rules`` has ``host, path, verdict``. Of the rules that fit, the longest (characters of host
    and path) wins, then the longer host, then ``block``. ``rule`` is host and path of the winner;
    without one it is null and the verdict is ``default``.

    A null URL, or one without ``://``, has an empty host and path. Repeated rows are judged each;
    they are counted per input partition first, so that a hot URL is expanded once per partition.
    Rules with a null host or path never fit. Other columns of ``pages`` are ignored. No rules, or
    an empty table of pages: all default, or no rows.
    """
    rules = (
        rules.where(F.col("host").isNotNull() & F.col("path").isNotNull())
        .select(ascii_lower("host").alias("host"), "path", "verdict")
        .distinct()
    )
    # The shapes of rules: how many labels the host has, how long the path is. Their number is bounded by
    # the labels a host can have times the longest path, whatever the number of rules.
    shapes = [
        f"named_struct('labels', {s.labels}, 'chars', {s.chars})"
        for s in rules.select(_labels(F.col("host")).alias("labels"), F.length("path").alias("chars"))
        .distinct()
        .orderBy("labels", "chars")
        .collect()
    ]
    keyed = rules.select(
        F.concat("host", "path").alias("rule"),
        F.col("verdict").alias("says"),
        F.sha2(F.concat("host", "path"), 256).alias("rule_digest"),
        F.struct(
            (F.length("host") + F.length("path")).alias("chars"),
            F.length("host").alias("host_chars"),
            (F.col("verdict") == "block").alias("blocks"),
            F.concat("host", "path").alias("rule"),
            F.col("verdict").alias("says"),
        ).alias("rank"),
    ).select(F.substring("rule_digest", 1, SHORT_DIGITS).alias("short"), "rule_digest", "rank")

    rows = (
        pages.select("page_id", "url", F.spark_partition_id().alias("part"))
        .groupBy("page_id", "url", "part")
        .agg(F.count(F.lit(1)).alias("copies"))
        .withColumn("host", url_host(F.col("url")))
        .withColumn("path", url_path(F.col("url")))
    )
    expressions = f"""
        transform(
            filter(cast(array({', '.join(shapes)}) AS array<struct<labels:int,chars:int>>),
                   s -> s.labels <= size(split(host, '[.]')) AND s.chars <= length(path)),
            s -> sha2(concat(substring_index(host, '.', -s.labels), left(path, s.chars)), 256))
    """
    hits = rows.withColumn("digest", F.explode_outer(F.expr(expressions))).withColumn(
        "short", F.substring("digest", 1, SHORT_DIGITS)
    )
    best = (
        hits.join(checked_broadcast(keyed, RULE_BYTES), "short", "left")
        .groupBy("page_id", "url", "part", "copies")
        .agg(F.max(F.when(F.col("digest") == F.col("rule_digest"), F.col("rank"))).alias("best"))
    )
    turns = F.ceil(F.col("copies") / REPEATS)
    return (
        best.withColumn("turn", F.explode(F.sequence(F.lit(1).cast("long"), turns.cast("long"))))
        .withColumn(
            "copy",
            F.explode(
                F.array_repeat(
                    F.lit(0), F.least(F.lit(REPEATS), F.col("copies") - (F.col("turn") - 1) * REPEATS).cast("int")
                )
            ),
        )
        .select(
            "page_id",
            url_host(F.col("url")).alias("host"),
            url_path(F.col("url")).alias("path"),
            F.col("best.rule").alias("rule"),
            F.coalesce(F.col("best.says"), F.lit(default)).alias("verdict"),
            "url",
        )
    )
