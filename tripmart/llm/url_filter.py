"""URL filter: host-suffix and path-prefix expressions of each URL, looked up by short hash prefix.

Every distinct (host, path) is expanded into the expressions a rule could be written as. Expressions and rules meet
in an equi-join on the first four bytes of their SHA-256; full digests confirm, and the longest rule wins (ties:
more host, then block). Only suffixes of as many labels and prefixes of such lengths as some rule has are made, which
drops no match. Work per URL is bounded by the rules, not by the URL's length.

Defined results: null URL or one without "://": host and path empty. No rule fits: rule null, verdict `default`.
Repeated pages each get a row. Null or blank rules are ignored; a rule without "/" covers every path. Other columns
of the pages, whatever their names, are kept after the results if `keep` names them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmart.llm.common import lower_ascii, own

PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"
PREFIX_BYTES = 4


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, PARTS, 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def digest(expression: Column) -> Column:
    return F.unhex(F.sha2(expression, 256))


def compile_rules(rules: DataFrame) -> DataFrame:
    """One row per rule expression; of contradicting rules with one expression, block stays."""
    host = lower_ascii(F.regexp_extract("rule", r"^[^/]*", 0))
    return (
        rules.where(F.length(F.trim("rule")) > 0)
        .select("rule", "verdict", host.alias("host"), F.regexp_extract("rule", r"(?s)^[^/]*(.*)$", 1).alias("path"))
        .groupBy("host", "path")
        .agg(F.max(F.struct((F.col("verdict") == "block").alias("blocks"), "rule", "verdict")).alias("best"))
        .select(
            F.col("best.rule").alias("rule"),
            F.col("best.verdict").alias("verdict"),
            digest(F.concat("host", "path")).alias("rule_digest"),
            F.length("host").alias("host_length"),
            (F.length("host") + F.length("path")).alias("rule_length"),
            F.size(F.split("host", r"\.")).alias("labels"),
            F.length("path").alias("path_length"),
        )
    )


def expressions(host: Column, path: Column, labels: int, path_lengths: list[int]) -> Column:
    """Every (host suffix)(path prefix) of a size that some rule has."""
    names = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.least(F.size(names), F.lit(labels))),
        lambda n: F.array_join(F.slice(names, -n, n), "."),
    )
    lengths = F.filter(F.array(*[F.lit(n) for n in path_lengths]), lambda n: n <= F.length(path))
    return F.flatten(
        F.transform(
            suffixes,
            lambda suffix: F.transform(lengths, lambda n: F.concat(suffix, F.substring(path, F.lit(1), n))),
        )
    )


def filter_urls(
    pages: DataFrame, rules: DataFrame, *, id_column: str = "page_id", url_column: str = "url",
    default: str = "allow", keep: tuple[str, ...] = (),
) -> DataFrame:
    """rules: columns rule (such as example.com/en/) and verdict (allow or block)."""
    compiled = compile_rules(rules)
    # At most one length per possible path length: a few thousand numbers, however many rules there are.
    shape = compiled.agg(F.max("labels").alias("labels"), F.collect_set("path_length").alias("lengths")).first()
    kept = [F.col(name).alias(own(name)) for name in keep]
    judged = pages.select(
        F.col(id_column).alias("page_id"), url_host(F.col(url_column)).alias("host"),
        url_path(F.col(url_column)).alias("path"), *kept,
    )
    back = [F.col(own(name)).alias(name) for name in keep]
    if not shape["labels"]:
        return judged.select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"),
                             F.lit(default).alias("verdict"), *back)
    short = lambda column: F.substring(column, 1, PREFIX_BYTES)
    found = (
        judged.select("host", "path").distinct()
        .select("host", "path", F.explode(
            expressions(F.col("host"), F.col("path"), shape["labels"], sorted(shape["lengths"]))
        ).alias("expression"))
        .select("host", "path", digest(F.col("expression")).alias("url_digest"))
        .withColumn("short", short(F.col("url_digest")))
        .join(compiled.withColumn("short", short(F.col("rule_digest"))), "short")
        .where(F.col("url_digest") == F.col("rule_digest"))
        .groupBy("host", "path")
        .agg(F.max(F.struct("rule_length", "host_length", (F.col("verdict") == "block").alias("blocks"),
                            "rule", "verdict")).alias("best"))
        .select("host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))
    )
    return judged.join(found, ["host", "path"], "left").select(
        "page_id", "host", "path", "rule", F.coalesce("verdict", F.lit(default)).alias("verdict"), *back
    )
