"""Report frames reshaped for a chart: two columns, numeric, in drawing order."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.functions import coerce_number
from sievemart.operators.ordering import largest_ascending
from sievemart.operators.projection import find_column

# Bars per chart and the accepted names of the time column.
BARS = 20
TIME_NAMES = ("avg", "avg_sec", "avg_seconds", "time", "avg_time", "avg_time_s")
STEP_NAMES = ("m", "multiplier")


def _pair(df: DataFrame, label: str, value: str, names: tuple[str, str]) -> DataFrame:
    return df.select(F.col(label).alias(names[0]), coerce_number(df, value).alias(names[1]))


def _bars(df: DataFrame, label: str, value: str, value_name: str) -> DataFrame:
    pair = _pair(df, label, value, ("city", value_name)).dropna(subset=[value_name])
    return largest_ascending(pair, BARS, value_name, "city")


def top_city_feed(df: DataFrame) -> DataFrame:
    """The largest bars of a count report, smallest first."""
    has_count = "vacancies" in {c.lower() for c in df.columns}
    label = find_column(df, ["city"] if has_count else [], 0)
    value = find_column(df, ["vacancies"], min(1, len(df.columns) - 1))
    return _bars(df, label, value, "vacancies")


def salary_feed(df: DataFrame) -> DataFrame:
    """The largest bars of a salary report, smallest first."""
    return _bars(df, find_column(df, ["city"], 0), find_column(df, ["avg_rub"], -1), "avg_rub")


def flag_feed(df: DataFrame) -> DataFrame:
    """Label and count of a flag report; a count that is no number is 0."""
    label, value = df.columns[:2]
    return _pair(df, label, value, ("flag", "cnt")).fillna(0.0, subset=["cnt"])


def scaling_feed(df: DataFrame) -> DataFrame:
    """Multiplier and time of a scaling report, by multiplier."""
    pair = _pair(
        df,
        find_column(df, STEP_NAMES, 0),
        find_column(df, TIME_NAMES, 1),
        ("multiplier_m", "time"),
    )
    return pair.dropna(subset=["time"]).orderBy("multiplier_m")
