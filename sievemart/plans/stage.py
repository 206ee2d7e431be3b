"""Raw rows to the clean stage table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from sievemart.functions import strict_number, true_flag
from sievemart.operators.dedup import first_by_key
from sievemart.operators.projection import keep_available
from sievemart.sources.files import STAGE_SCHEMA, read_csv, write_stage

STAGE_COLUMNS = STAGE_SCHEMA.fieldNames()
NUMBERS = ("salary_from", "salary_to", "count_key_skills")
FLAGS = ("has_test", "premium", "archived")


def clean_columns(df: DataFrame) -> DataFrame:
    """Dirty numbers to doubles and true-words to 0/1, where present."""
    cleaned = {c: strict_number(df, c) for c in NUMBERS if c in df.columns}
    cleaned |= {c: true_flag(c) for c in FLAGS if c in df.columns}
    return df.withColumns(cleaned) if cleaned else df


def stage_rows(raw: DataFrame, wanted: Sequence[str] = STAGE_COLUMNS) -> DataFrame:
    """Project, clean and keep one row per id.

    Cleaning comes before the shuffle of the de-duplication, so that numbers and
    flags travel as such and not as text.
    """
    staged = raw.transform(keep_available, wanted).transform(clean_columns)
    return first_by_key(staged, "id") if "id" in staged.columns else staged


def run_stage(spark: SparkSession, raw_csv: str, out: str, multi_line: bool = True) -> None:
    """CSV in, Parquet out."""
    write_stage(stage_rows(read_csv(spark, raw_csv, multi_line=multi_line)), out)
