"""Catalog tables and SQL text."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import DataFrame, SparkSession

# The tables the SQL reports read, and the labels of the flag report.
RAW = "it_vacancies_raw"
CLEAN = "it_vacancies_clean"
MART = "it_salary_by_area"
WITH_TEST = "test_required=true"
WITHOUT_TEST = "test_required=false/empty"

TOP_AREAS_SQL = f"""
SELECT area_name, count(*) AS vacancies
FROM {CLEAN}
GROUP BY area_name
ORDER BY vacancies DESC, area_name NULLS FIRST
LIMIT :rows
"""

TOP_CITIES_SQL = f"""
SELECT area_name AS city, count(*) AS vacancies
FROM {CLEAN}
GROUP BY area_name
ORDER BY vacancies DESC, city NULLS FIRST
LIMIT :rows
"""

MART_ROWS_SQL = f"""
SELECT area_name, vacancies_with_salary, avg_rub
FROM {MART}
ORDER BY vacancies_with_salary DESC, area_name NULLS FIRST
LIMIT :rows
"""

CITY_SALARY_SQL = f"""
SELECT area_name AS city, vacancies_with_salary, avg_rub
FROM {MART}
WHERE avg_rub IS NOT NULL
ORDER BY vacancies_with_salary DESC, city NULLS FIRST
LIMIT :rows
"""

FLAG_COUNT_SQL = f"""
SELECT if(lower(test_required) = 'true', :yes, :no) AS test_flag, count(*) AS cnt
FROM {RAW}
GROUP BY 1
"""


def quoted(name: str) -> str:
    """An identifier as it stands in SQL text."""
    return "`" + name.replace("`", "``") + "`"


def register(spark: SparkSession, tables: Mapping[str, DataFrame]) -> None:
    """Make frames readable by name in SQL for this session."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)


def save_table(df: DataFrame, name: str, database: str | None = None, statistics: bool = True) -> str:
    """Keep a frame as a Parquet table of the catalog; returns its full name.

    With ``statistics`` the catalog also gets the table's bytes and rows and each
    column's distinct values, NULLs and ends, from one more scan of it.  Spark plans
    joins by the bytes; by the rest too where ``spark.sql.cbo.enabled`` is set.
    """
    full = f"{quoted(database)}.{quoted(name)}" if database else quoted(name)
    if database:
        df.sparkSession.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(database)}")
    df.write.mode("overwrite").format("parquet").saveAsTable(full)
    if statistics:
        df.sparkSession.sql(f"ANALYZE TABLE {full} COMPUTE STATISTICS FOR ALL COLUMNS")
    return full


def read_catalog(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The tables of a database, or what the session sees by bare names.

    A session's temporary views belong to no database, so a named one has none.
    """
    if database is None:
        return spark.sql("SHOW TABLES")
    return spark.sql(f"SHOW TABLES IN {quoted(database)}").filter("NOT isTemporary")


def run_sql(
    spark: SparkSession,
    text: str,
    args: Mapping[str, Any] | None = None,
    database: str | None = None,
) -> DataFrame:
    """Any SQL text over catalog tables, with values bound by name.

    Bare table names are looked up in ``database`` if one is given.  The names are
    resolved when the text is read, so the session's own choice is put back.
    """
    previous = spark.catalog.currentDatabase()
    if database:
        spark.catalog.setCurrentDatabase(database)
    try:
        return spark.sql(text, args=dict(args or {}))
    finally:
        spark.catalog.setCurrentDatabase(previous)


def top_areas(spark: SparkSession, rows: int = 20, database: str | None = None) -> DataFrame:
    return run_sql(spark, TOP_AREAS_SQL, {"rows": rows}, database)


def top_cities(spark: SparkSession, rows: int = 30, database: str | None = None) -> DataFrame:
    return run_sql(spark, TOP_CITIES_SQL, {"rows": rows}, database)


def mart_rows(spark: SparkSession, rows: int = 30, database: str | None = None) -> DataFrame:
    return run_sql(spark, MART_ROWS_SQL, {"rows": rows}, database)


def city_salaries(spark: SparkSession, rows: int = 30, database: str | None = None) -> DataFrame:
    return run_sql(spark, CITY_SALARY_SQL, {"rows": rows}, database)


def flag_counts(spark: SparkSession, database: str | None = None) -> DataFrame:
    return run_sql(spark, FLAG_COUNT_SQL, {"yes": WITH_TEST, "no": WITHOUT_TEST}, database)
