"""Yes/no values in their many spellings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemart.functions.numbers import DIGITS_ONLY
from sievemart.functions.typed import is_numeric

# The spellings each flag accepts.
YES_WORDS = ("true", "yes", "да", "y", "1")
GROSS_WORDS = ("true", "1", "yes", "да")
EXACT_TRUE = ("1", "true", "True", "TRUE")
EXACT_FALSE = ("0", "false", "False", "FALSE")
FLAG_SOURCES = ("test_required", "has_test")


def _lowered(name: str) -> Column:
    return F.lower(F.col(name).cast("string"))


def _is(condition: Column) -> Column:
    """1 where the condition holds; 0 where it does not or is unknown."""
    return F.coalesce(condition.cast("int"), F.lit(0))


def true_flag(name: str) -> Column:
    """1 for the word 'true' in any case, else 0; NULL gives 0."""
    return _is(_lowered(name) == "true")


def any_flag(df: DataFrame, sources: Sequence[str] = FLAG_SOURCES) -> Column:
    """0/1 from the first source column the frame has; 0 when it has none.

    A run of digits is 1 unless it is all zeros, whatever its length; the
    yes-words give 1; no-words, junk and NULL give 0.
    """
    present = [c for c in sources if c in df.columns]
    if not present:
        return F.lit(0)
    text = F.col(present[0]).cast("string")
    non_zero = text.rlike(DIGITS_ONLY) & text.rlike("[1-9]")
    return _is(non_zero | F.lower(F.trim(text)).isin(*YES_WORDS))


def gross_flag(name: str) -> Column:
    return _is(F.trim(_lowered(name)).isin(*GROSS_WORDS))


def three_state_flag(df: DataFrame, name: str) -> Column:
    """1.0 / 0.0 for the exact spellings, NULL for everything else."""
    if is_numeric(df, name):
        true, false = F.col(name) == 1, F.col(name) == 0
    else:
        text = F.col(name).cast("string")
        true, false = text.isin(*EXACT_TRUE), text.isin(*EXACT_FALSE)
    return F.when(true, 1.0).when(false, 0.0)


def two_way_label(name: str, if_true: str, otherwise: str) -> Column:
    """One label for 'true' in any case, the other for all else and NULL."""
    return F.when(_lowered(name) == "true", if_true).otherwise(otherwise)
