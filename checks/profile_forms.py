"""The group profile as separate rollups joined on the key, for comparison."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.operators.grouping import group_distinct, group_mean_median, group_share
from sievemart.operators.joins import join_inner, join_left


def joined_profile(df: DataFrame, accuracy: int = 10_000) -> DataFrame:
    """Three scans, three rollups, an inner and a left join, and a sort."""
    rows = df.filter(F.col("salary_mid").isNotNull())
    salary = group_mean_median(rows, "area_name", "salary_mid", accuracy)
    counts = group_distinct(rows, "area_name", "id")
    shares = group_share(rows, "area_name", "test_required")
    joined = join_left(join_inner(salary, counts, "area_name"), shares, "area_name")
    return joined.orderBy(F.desc("vac_count"))
