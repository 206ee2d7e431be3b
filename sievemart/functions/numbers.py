"""Numbers hidden in dirty text.

Each function takes a frame and a column name rather than a bare ``Column``: a
column that is numeric already is only widened to double.  Sending it through
its text form would damage it, since 10000000 prints as ``1.0E7``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemart.functions.typed import is_numeric

# What counts as part of a number, and what a number looks like.
NOISE = r"[^0-9,.\-]"
WHOLE_NUMBER = r"^(-?\d+(\.\d+)?)$"
FIRST_NUMBER = r"(-?\d+(?:\.\d+)?)"
DIGITS_ONLY = r"^\s*\d+\s*$"
PARSEABLE = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity)\s*$"


def _extracted(name: str, pattern: str) -> Column:
    """The part of the text without noise that the pattern finds, as a double.

    Nothing found is an empty text, which casts to NULL; so the patterns run once
    per row, with no test in front of the cast.
    """
    text = F.translate(F.regexp_replace(F.col(name), NOISE, ""), ",", ".")
    return F.regexp_extract(text, pattern, 1).try_cast("double")


def strict_number(df: DataFrame, name: str) -> Column:
    """A double only if what is left without noise is one whole number."""
    if is_numeric(df, name):
        return F.col(name).cast("double")
    return _extracted(name, WHOLE_NUMBER)


def lenient_number(df: DataFrame, name: str) -> Column:
    """The first number found in the text without noise, or NULL."""
    if is_numeric(df, name):
        return F.col(name).cast("double")
    return _extracted(name, FIRST_NUMBER)


def coerce_number(df: DataFrame, name: str) -> Column:
    """A plain parse of the whole text; whatever does not parse is NULL."""
    if is_numeric(df, name):
        value = F.col(name).cast("double")
        return F.when(~F.isnan(value), value)
    # The pattern keeps out Java spellings such as '1.5d', which a cast accepts.
    text = F.col(name).cast("string")
    return F.when(text.rlike(PARSEABLE), text.try_cast("double"))


def guarded_id(df: DataFrame, name: str) -> Column:
    """An id of digits only as a double; anything else is 0.0."""
    if is_numeric(df, name):
        return zero_if_null(F.col(name).cast("double"))
    text = F.col(name).cast("string")
    return F.when(text.rlike(DIGITS_ONLY), text.try_cast("double")).otherwise(0.0)


def zero_if_null(value: Column) -> Column:
    return F.coalesce(value, F.lit(0.0))


def midpoint(low: Column, high: Column) -> Column:
    """Mean of both ends, or the one end there is, or NULL."""
    return F.coalesce((low + high) / 2, low, high)
