"""The three area reports and the salary mart."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.functions import any_flag, lenient_number, norm_code
from sievemart.operators.grouping import (
    flag_totals,
    group_count,
    group_mean,
    having_at_least,
)
from sievemart.operators.ordering import top_k
from sievemart.operators.projection import with_midpoint, with_ratio
from sievemart.sources.files import write_report

# Sizes of the reports and the least group size for a mean.
TOP_AREAS = 20
TOP_SALARIES = 30
MIN_ROWS = 30

# Roubles per unit where no rates are given.
ROUBLES = {"RUR": 1.0}

LENIENT_COLUMNS = ("salary_from", "salary_to", "address_lat")


def clean_leniently(df: DataFrame) -> DataFrame:
    """Lenient numbers where present, and the 0/1 ``test_flag``."""
    columns = {c: lenient_number(df, c) for c in LENIENT_COLUMNS if c in df.columns}
    return df.withColumns({**columns, "test_flag": any_flag(df)})


def top_areas(df: DataFrame) -> DataFrame:
    """The areas with the most rows."""
    return top_k(group_count(df, "area_name", "vacancies"), TOP_AREAS, "vacancies", "area_name")


def salary_by_area(df: DataFrame, min_rows: int = MIN_ROWS) -> DataFrame:
    """The areas with the highest mean lower salary, among those with enough rows."""
    means = group_mean(df, "area_name", "salary_from", "with_salary", "avg_salary_from")
    return top_k(
        having_at_least(means, "with_salary", min_rows),
        TOP_SALARIES,
        "avg_salary_from",
        "area_name",
    )


def test_share(df: DataFrame) -> DataFrame:
    """All rows, rows with the flag, and their ratio."""
    return with_ratio(flag_totals(df, "test_flag"), "with_test", "total", "share")


def area_rollup(df: DataFrame) -> DataFrame:
    """Everything the three reports need, per area, from one scan."""
    return df.groupBy("area_name").agg(
        F.count("*").alias("vacancies"),
        F.count("salary_from").alias("with_salary"),
        F.avg("salary_from").alias("avg_salary_from"),
        F.sum(F.col("test_flag").cast("long")).alias("with_test"),
    )


def reports_of_rollup(rollup: DataFrame, min_rows: int = MIN_ROWS) -> dict[str, DataFrame]:
    """The three reports from an ``area_rollup``; each equals its direct form."""
    totals = rollup.agg(
        F.coalesce(F.sum("vacancies"), F.lit(0)).alias("total"),
        F.sum("with_test").alias("with_test"),
    )
    counts = rollup.select("area_name", "vacancies")
    means = rollup.filter("with_salary > 0").select("area_name", "with_salary", "avg_salary_from")
    return {
        "top_cities": top_k(counts, TOP_AREAS, "vacancies", "area_name"),
        "salary_by_city": top_k(
            having_at_least(means, "with_salary", min_rows),
            TOP_SALARIES,
            "avg_salary_from",
            "area_name",
        ),
        "test_share": with_ratio(totals, "with_test", "total", "share"),
    }


def run_reports(stage: DataFrame, out_dir: str) -> None:
    """All reports of a stage table as CSV.

    What is kept between them is the rollup, one row per area, not the table.
    """
    cleaned = clean_leniently(stage)
    rollup = None
    if {"area_name", "salary_from"} <= set(cleaned.columns):
        rollup = area_rollup(cleaned).cache()
        reports = reports_of_rollup(rollup)
    else:
        reports = {"test_share": test_share(cleaned)}
        if "area_name" in cleaned.columns:
            reports["top_cities"] = top_areas(cleaned)
    for name, report in reports.items():
        write_report(report, f"{out_dir}/{name}")
    if rollup is not None:
        rollup.unpersist()


def salary_mart(df: DataFrame, rates: Mapping[str, float] | None = None) -> DataFrame:
    """Rows with a salary, and how many of them have a known rate and their mean in roubles.

    ``rates`` gives roubles per unit of each currency code; without it only
    amounts in roubles are known.  Rows with another code add nothing to the mean.
    The rates become a literal map, so there is no join.
    """
    known = ROUBLES if rates is None else rates
    pairs = [F.lit(x) for code, rate in known.items() for x in (code, float(rate))]
    rate = F.try_element_at(F.create_map(*pairs), norm_code("salary_currency"))
    amount = F.col("salary_mid") * (rate if pairs else F.lit(None).cast("double"))
    return (
        with_midpoint(df)
        .withColumn("_amount", amount)
        .groupBy("area_name")
        .agg(
            F.count("salary_mid").alias("vacancies_with_salary"),
            F.count("_amount").alias("converted"),
            F.avg("_amount").alias("avg_rub"),
        )
        .filter("vacancies_with_salary > 0")
    )
