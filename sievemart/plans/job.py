"""The whole job in one session."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession

from sievemart.plans.model import run_model
from sievemart.plans.reports import clean_leniently, run_reports, salary_mart
from sievemart.plans.scaling import MULTIPLIERS, REPEATS, scaling_runs, summarise_runs
from sievemart.plans.stage import stage_rows
from sievemart.session import intermediates
from sievemart.sources import catalog
from sievemart.sources.files import read_csv, read_stage, split_bad_records, write_report, write_stage
from sievemart.sources.publish import Publisher, input_state


def publish_tables(
    raw: DataFrame,
    stage: DataFrame,
    database: str | None = None,
    rates: Mapping[str, float] | None = None,
) -> None:
    """The three catalog tables that the SQL reports read."""
    catalog.save_table(raw, catalog.RAW, database)
    catalog.save_table(stage, catalog.CLEAN, database)
    catalog.save_table(salary_mart(stage, rates), catalog.MART, database)


def run_job(
    spark: SparkSession,
    raw_csv: str,
    out_dir: str,
    multipliers: Iterable[int] = MULTIPLIERS,
    repeats: int = REPEATS,
    database: str | None = None,
    rates: Mapping[str, float] | None = None,
    multi_line: bool = True,
    resume: bool = False,
    quarantine: bool = False,
) -> list[str]:
    """Stage, then reports and model, then the scaling sweep; returns the steps made.

    Steps hand over through Parquet and appear whole (``sources.publish``).  With a
    ``database`` the tables of the SQL reports are saved there too.  The first error
    ends the job and is raised; a later call with ``resume`` starts at the first step
    that is missing, if input and parameters are the same.  With ``quarantine``
    records that do not fit the header go to the table ``quarantine`` of ``out_dir``.
    """
    multipliers = list(multipliers)
    made_from = f"{input_state(spark, raw_csv)}; {multipliers} {repeats} {database} {rates} {multi_line} {quarantine}"
    steps = Publisher(spark, out_dir, made_from, resume)

    def read_raw() -> DataFrame:
        if not quarantine:
            return read_csv(spark, raw_csv, multi_line=multi_line)
        return split_bad_records(spark, raw_csv, multi_line=multi_line)[0]

    def write_quarantined(path: str) -> None:
        split_bad_records(spark, raw_csv, multi_line=multi_line)[1].write.parquet(path)

    with intermediates(spark):
        if quarantine:
            steps.publish("quarantine", write_quarantined)
        stage = read_stage(spark, steps.publish("stage", lambda to: write_stage(stage_rows(read_raw()), to)))
        if database:
            steps.once("tables", lambda: publish_tables(read_raw(), stage, database, rates))
        steps.publish("reports", lambda to: run_reports(stage, to))
        steps.publish("reports/ml_results", lambda to: run_model(clean_leniently(stage), to))
        steps.publish(
            "reports/scalability_results",
            lambda to: write_report(summarise_runs(scaling_runs(stage, multipliers, repeats)), to),
        )
    return steps.made
