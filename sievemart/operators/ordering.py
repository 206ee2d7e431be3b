"""Sorting, top-k and running totals over a whole table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemart.session import cut_lineage

RANGE = "_range"


def top_k(df: DataFrame, k: int, by: str, tie_break: str) -> DataFrame:
    """The ``k`` rows with the largest ``by``; equal values go by ``tie_break``."""
    return df.orderBy(F.desc(by), F.asc_nulls_first(tie_break)).limit(k)


def largest_ascending(df: DataFrame, k: int, by: str, tie_break: str) -> DataFrame:
    """The ``k`` largest rows, smallest of them first."""
    return top_k(df, k, by, tie_break).orderBy(F.asc(by), F.desc_nulls_last(tie_break))


def range_split(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``df`` cut into ordered ranges of about equal size, numbered in ``_range``.

    The result is written to the checkpoint folder: the cut points come from a
    sample, so the numbers must be fixed before two later steps may share them.
    """
    ranged = df.repartitionByRange(*order)
    return cut_lineage(ranged.withColumn(RANGE, F.spark_partition_id()))


def running_totals(
    df: DataFrame, order: Sequence[Column], totals: Mapping[str, str]
) -> DataFrame:
    """Running totals over the whole table, with no task that sees all rows.

    ``totals`` maps each new column to the column it sums, the current row
    included.  Each range is summed by itself and then lifted by the total of
    the ranges before it.  The table of range totals has at most
    ``spark.sql.shuffle.partitions`` rows, so one task can sum and every task
    can hold it.  ``order`` must be unique per row.
    """
    ranged = range_split(df, order)
    before = Window.orderBy(RANGE).rowsBetween(Window.unboundedPreceding, -1)
    lifts = (
        ranged.groupBy(RANGE)
        .agg(*[F.sum(source).alias(new) for new, source in totals.items()])
        .select(
            RANGE,
            *[F.coalesce(F.sum(new).over(before), F.lit(0)).alias(f"_before_{new}") for new in totals],
        )
    )
    within = (
        Window.partitionBy(RANGE).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    )
    # Hashing so few range numbers would put several ranges into one task.
    return (
        ranged.repartitionByRange(RANGE)
        .join(F.broadcast(lifts), RANGE)
        .withColumns(
            {
                new: F.col(f"_before_{new}") + F.sum(source).over(within)
                for new, source in totals.items()
            }
        )
        .drop(RANGE, *[f"_before_{new}" for new in totals])
    )
