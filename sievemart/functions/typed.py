"""Look at a column's type before choosing how to read it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType


def is_numeric(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, NumericType)


def null_of(type_name: str) -> Column:
    return F.lit(None).cast(type_name)
