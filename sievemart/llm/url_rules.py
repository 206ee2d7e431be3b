"""URL rules by host suffix and path prefix.

Each distinct URL is expanded into the expressions that a rule could equal: its
host and parent domains, each with the path's beginnings of the lengths that
occur in the rule table.  Expressions meet rules in an equi-join on a short hash
prefix; full digests then confirm, and the longest rule wins.

Defined results: a NULL URL or one without ``://`` has an empty host and path
and gets the default verdict unless a rule has an empty host; repeated rows are
judged alike; of several rules with the same host and path ``block`` wins; an
empty rule table gives the default everywhere; other columns are ignored.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PREFIX_HEX = 8  # short hash: the first 32 bits of the digest

RULE_SCHEMA = "verdict string, host string, path string"

# The production rules.
RULES = (
    ("block", "net", "/"),
    ("allow", "example.net", "/en/"),
    ("block", "example.com", "/de/"),
    ("allow", "org", "/fr/"),
)


def host_of(url: Column) -> Column:
    host = F.regexp_extract(F.coalesce(url, F.lit("")), r"://([^/?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"://[^/?#]*([^?#]*)", 1)


def _digest(host: Column, path: Column) -> Column:
    # Neither part of an expression can hold a line break made by joining them:
    # the host's length keeps the two parts apart.
    return F.sha2(F.concat_ws(":", F.char_length(host).cast("string"), host, path), 256)


def judge_urls(
    pages: DataFrame,
    rules: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    default: str = "allow",
) -> DataFrame:
    """Per row: id, host, path, the winning rule (NULL if none) and the verdict.

    ``rules`` has verdict, host and path; its size is unknown here, so the join
    carries no hint and Spark broadcasts it only below its own limit.
    """
    listed = rules.select(
        F.col("verdict").alias("_verdict"),
        F.coalesce("host", F.lit("")).alias("_rule_host"),
        F.coalesce("path", F.lit("")).alias("_rule_path"),
    ).filter(F.col("_verdict").isNotNull())
    # The shapes that occur among the rules: two short arrays in one row.
    shapes = listed.agg(
        F.coalesce(F.max(F.size(F.split("_rule_host", r"\."))), F.lit(0)).alias("_labels"),
        F.collect_set(F.char_length("_rule_path")).alias("_lengths"),
    ).first()
    lengths = sorted(shapes["_lengths"])
    rows = pages.select(F.col(id_col).alias("_id"), F.col(url_col).alias("_url")).select(
        "*", host_of(F.col("_url")).alias("_host"), path_of(F.col("_url")).alias("_path")
    )
    if not lengths:
        found = rows.select("*", F.lit(None).cast("string").alias("_rule"), F.lit(None).alias("_won"))
    else:
        found = rows.join(_winners(rows, listed, shapes["_labels"], lengths), ["_host", "_path"], "left")
    return found.select(
        F.col("_id").alias(id_col),
        F.col("_host").alias("host"),
        F.col("_path").alias("path"),
        F.col("_rule").alias("rule"),
        F.coalesce("_won", F.lit(default)).alias("verdict"),
    )


def _winners(rows: DataFrame, listed: DataFrame, labels: int, lengths: list[int]) -> DataFrame:
    """The winning rule per distinct host and path that any rule fits."""
    parts = F.split("_host", r"\.")
    first = F.greatest(F.size(parts) - F.lit(labels), F.lit(0))
    suffixes = F.transform(
        F.sequence(first, F.size(parts) - 1),
        lambda i: F.array_join(F.slice(parts, i + 1, F.size(parts)), "."),
    )
    fitting = F.filter(
        F.array(*[F.lit(n) for n in lengths]), lambda n: n <= F.char_length("_path")
    )
    expanded = (
        rows.select("_host", "_path")
        .distinct()
        .select("_host", "_path", F.explode(suffixes).alias("_suffix"), fitting.alias("_fit"))
        .select("_host", "_path", "_suffix", F.explode("_fit").alias("_length"))
        .select("_host", "_path", "_suffix", F.expr("left(_path, _length)").alias("_begin"))
        .select("_host", "_path", _digest(F.col("_suffix"), F.col("_begin")).alias("_full"))
        .withColumn("_short", F.substring("_full", 1, PREFIX_HEX))
    )
    keyed = listed.withColumn(
        "_rule_full", _digest(F.col("_rule_host"), F.col("_rule_path"))
    ).withColumn("_short", F.substring("_rule_full", 1, PREFIX_HEX))
    rule = F.concat("_rule_host", "_rule_path")
    order = F.struct(F.char_length(rule), F.col("_verdict") == "block", F.col("_rule_host"))
    return (
        expanded.join(keyed, "_short")
        .filter(F.col("_full") == F.col("_rule_full"))
        .groupBy("_host", "_path")
        .agg(F.max_by(F.struct(rule.alias("rule"), F.col("_verdict").alias("won")), order).alias("_best"))
        .select("_host", "_path", F.col("_best")["rule"].alias("_rule"), F.col("_best")["won"].alias("_won"))
    )
