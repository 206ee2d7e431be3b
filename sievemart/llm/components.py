"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.session import cut_lineage

#: Links per task of a round; few links need few tasks.
TASK_LINKS = 1 << 18


def _dealt(rows: DataFrame, count: int) -> DataFrame:
    """``rows`` of ``count`` links as they are, or in one partition if one task may hold them.

    What is in one partition is grouped and joined without an exchange.
    """
    return rows.coalesce(1) if count <= TASK_LINKS else rows


def _state(links: DataFrame, count: int) -> tuple[int, int]:
    """For ``count`` links at most: how many links there are, and how many nodes are neither a root nor tied to one only."""
    ends = links.select(F.col("u").alias("node"), F.lit(1).alias("tied"), F.lit(0).alias("least"))
    ends = _dealt(ends.union(links.select("v", F.lit(0), F.lit(1))), count)
    nodes = ends.groupBy("node").agg(F.sum("tied").alias("tied"), F.max("least").alias("least"))
    row = nodes.agg(F.sum("tied"), F.count_if((F.col("tied") > 0) & (F.col("tied") + F.col("least") > 1))).first()
    return row[0] or 0, row[1]


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """Per linked node its component's least node: columns ``node`` and ``root``.

    Alternates two steps until every node is tied to one root and to nothing else:
    every node's larger neighbours are tied to its least neighbour, then its smaller
    ones.  As a link always leads to a lesser node, such a root is its component's
    least.  Each step only joins a link with its node's minimum, and the number of
    links never grows, so a node with very many neighbours costs a row for each and no
    more.  A round's result is written by as many tasks as the counted links need, not
    by one per shuffle partition; up to ``TASK_LINKS`` links, counted before, a round is
    one task and shuffles nothing.
    """
    ends = [F.least(left, right).alias("v"), F.greatest(left, right).alias("u")]
    links = cut_lineage(links.filter(F.col(left) != F.col(right)).select(*ends).distinct())
    count, astray = _state(links, links.count())
    while astray:
        tasks = 1 + count // TASK_LINKS
        both = _dealt(links.select("u", "v").union(links.select("v", "u")), count)
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = (
            both.filter(F.col("v") > F.col("u"))
            .join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") != F.col("v"))
            .distinct()
        )
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        ends = (
            large.join(least, "u")
            .select(F.col("v").alias("u"), F.col("m").alias("v"))
            .filter(F.col("u") != F.col("v"))
            .union(least.select("u", F.col("m").alias("v")))
        )
        links = cut_lineage(_dealt(ends, count).distinct().coalesce(tasks))
        count, astray = _state(links, count)
    stars = links.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.union(stars.select("root", "root").distinct())
