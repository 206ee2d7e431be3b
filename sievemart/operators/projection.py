"""Choosing, defaulting and naming columns of frames whose schema may vary."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemart.functions import lenient_number, midpoint
from sievemart.functions.typed import null_of


def keep_available(df: DataFrame, wanted: Iterable[str]) -> DataFrame:
    """The wanted columns the frame has, in the wanted order."""
    return df.select([c for c in wanted if c in df.columns])


def with_defaults(df: DataFrame, defaults: Mapping[str, Column]) -> DataFrame:
    """Add each missing column as its (typed) default."""
    missing = {name: value for name, value in defaults.items() if name not in df.columns}
    return df.withColumns(missing) if missing else df


def with_ratio(df: DataFrame, part: str, whole: str, name: str) -> DataFrame:
    """``part / whole`` as a new column; NULL over an empty whole."""
    return df.withColumn(name, F.try_divide(F.col(part), F.col(whole)))


def with_midpoint(
    df: DataFrame,
    low: str = "salary_from",
    high: str = "salary_to",
    name: str = "salary_mid",
) -> DataFrame:
    """The midpoint of two dirty columns, either of which may be missing.

    The ends are columns of a projection of their own: each is used twice, and
    Spark does not merge projections where that would parse a text twice.
    """
    ends = {
        f"_{c}": lenient_number(df, c) if c in df.columns else null_of("double")
        for c in (low, high)
    }
    middle = midpoint(F.col(f"_{low}"), F.col(f"_{high}"))
    return df.withColumns(ends).withColumn(name, middle).drop(*ends)


def find_column(df: DataFrame, candidates: Sequence[str], fallback: int) -> str:
    """First candidate present, ignoring case, else the column at ``fallback``."""
    by_lower = {}
    for name in df.columns:
        by_lower.setdefault(name.lower(), name)
    for candidate in candidates:
        if candidate.lower() in by_lower:
            return by_lower[candidate.lower()]
    return df.columns[fallback]
