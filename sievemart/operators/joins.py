"""Joins of rollups on their common key."""

from __future__ import annotations

from pyspark.sql import DataFrame


def join_inner(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Inner join on a common column; a NULL key matches nothing and drops out."""
    return left.join(right, key, "inner")


def join_left(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left join on a common column; rows without a partner get NULLs."""
    return left.join(right, key, "left")
