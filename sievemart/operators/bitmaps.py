"""Exact distinct counts that can be merged: bitmaps of numbered items.

A count of distinct items cannot be added up over days or parts; a bitmap can be
joined.  Items are numbered densely once, and each key keeps 4-kilobyte bitmaps of
the 32,768-wide ranges of numbers in which it has any.  The bitmaps combine before
the shuffle, and a hot key is spread over its ranges.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.operators.ranking import category_index
from sievemart.session import cut_lineage

RANGE_NO = "bitmap_range"
BITS = "bitmap"


def number_items(df: DataFrame, item: str) -> DataFrame:
    """Every item that is not NULL and its dense ``number``, the most frequent ones first.

    Stored, so that numbers stay as they are for all later bitmaps.
    """
    known = df.filter(F.col(item).isNotNull())
    return cut_lineage(category_index(known, item).select(item, F.col("idx").cast("long").alias("number")))


def item_bitmaps(df: DataFrame, key: str, number: str = "number") -> DataFrame:
    """Bitmaps of the numbers that each key has, one row per key and range of numbers.

    A NULL number sets no bit, so a key without items keeps an empty bitmap.
    """
    return df.groupBy(key, F.bitmap_bucket_number(number).alias(RANGE_NO)).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias(BITS)
    )


def merge_bitmaps(first: DataFrame, *others: DataFrame) -> DataFrame:
    """The bitmaps of all parts together, as if made from all rows at once."""
    parts = reduce(DataFrame.unionByName, others, first)
    keys = [c for c in first.columns if c != BITS]
    return parts.groupBy(*keys).agg(F.bitmap_or_agg(BITS).alias(BITS))


def count_bitmaps(bitmaps: DataFrame, key: str, name: str) -> DataFrame:
    """Distinct items per key, exact."""
    return bitmaps.groupBy(key).agg(F.sum(F.bitmap_count(BITS)).alias(name))
