"""One row per key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def first_by_key(df: DataFrame, key: str) -> DataFrame:
    """The least row of each key, comparing columns left to right, NULLs first.

    All NULL keys count as one key.  ``dropDuplicates`` keeps an arbitrary row,
    which may change when a lost task is run again; the least row does not.
    The minimum is combined before the shuffle, so a hot key sends one row per
    task, where a window would send them all.
    """
    others = [c for c in df.columns if c != key]
    if not others:
        return df.distinct()
    least = df.groupBy(key).agg(F.min(F.struct(*others)).alias("_least"))
    return least.select(
        *[F.col(key) if c == key else F.col("_least").getField(c).alias(c) for c in df.columns]
    )


def any_by_key(df: DataFrame, key: str) -> DataFrame:
    """One arbitrary row of each key."""
    return df.dropDuplicates([key])
