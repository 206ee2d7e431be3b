"""Quarantine of bad records, staged publishing, resumed jobs, statistics of saved tables."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from checks.postings import postings
from sievemart.operators.grouping import group_profile
from sievemart.plans import job, scaling
from sievemart.sources import catalog, files
from sievemart.sources.publish import MANIFEST, Publisher, input_state

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("multi_line", [True, False])
def test_bad_records_are_kept_apart(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text('﻿id,x\n1,a\n2\n\n3,b,c\n4,\n5,"say ""hi"", twice"\n', encoding="utf-8")
    good, bad = files.split_bad_records(spark, str(tmp_path / "a.csv"), multi_line=multi_line)
    assert sorted(map(tuple, good.collect())) == [("1", "a"), ("4", None), ("5", 'say "hi", twice')]
    assert good.columns == ["id", "x"]
    assert sorted(r.record for r in bad.collect()) == ["2", "3,b,c"]
    assert {r.file.rsplit("/", 1)[1] for r in bad.collect()} == {"a.csv"}
    # Reading one column must not hide how many fields a record has.
    assert good.select("id").count() == 3


def test_bad_values_are_kept_apart(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\n1,2.5\nz,1\n2,\n", encoding="utf-8")
    typed = StructType.fromDDL("id long, x double")
    good, bad = files.split_bad_records(spark, str(tmp_path / "a.csv"), typed)
    assert sorted(map(tuple, good.collect())) == [(1, 2.5), (2, None)]
    assert [r.record for r in bad.collect()] == ["z,1"]


def test_a_stopped_step_leaves_the_last_result(spark, tmp_path):
    out = str(tmp_path)
    write = lambda n: lambda to: spark.range(n).write.parquet(to)
    Publisher(spark, out).publish("deep/a", write(3))

    def broken(to):
        write(9)(to)
        raise RuntimeError("stopped")

    again = Publisher(spark, out)
    with pytest.raises(RuntimeError):
        again.publish("deep/a", broken)
    assert spark.read.parquet(f"{out}/deep/a").count() == 3
    assert again.made == [] and again.manifest().count() == 1
    again.publish("deep/a", write(4))
    assert spark.read.parquet(f"{out}/deep/a").count() == 4


def test_resume_skips_only_what_is_still_right(spark, tmp_path):
    out, runs = str(tmp_path), []

    def run(made_from="x", resume=True, gone=()):
        steps = Publisher(spark, out, made_from, resume)
        for name in ("a", "b", "c"):
            if name not in gone:
                steps.publish(name, lambda to: spark.range(1).write.parquet(to))
        steps.once("d", lambda: runs.append(made_from))
        return steps.made

    assert run() == ["a", "b", "c", "d"]
    assert run() == []
    assert run(resume=False) == ["a", "b", "c", "d"]
    assert run("y") == ["a", "b", "c", "d"]
    assert run("x") == ["a", "b", "c", "d"]  # what is there was made from y
    files_of_b = tmp_path / "b"
    files_of_b.rename(tmp_path / "elsewhere")
    assert run("x") == ["b", "c", "d"]
    assert runs == ["x", "x", "y", "x", "x"]


def test_a_stopped_job_goes_on(spark, tmp_path, monkeypatch):
    raw, out = str(tmp_path / "raw"), str(tmp_path / "out")
    files.write_csv(postings(spark, SF), raw)
    (tmp_path / "raw" / "more.csv").write_text(
        ",".join(postings(spark, SF).columns) + "\nonly,three,fields\n", encoding="utf-8"
    )
    run = lambda **more: job.run_job(
        spark, raw, out, multipliers=(1,), repeats=1, quarantine=True, database="resumed", **more
    )

    def stopped(*_):
        raise RuntimeError("stopped")

    with monkeypatch.context() as patch:
        patch.setattr(job, "run_model", stopped)
        with pytest.raises(RuntimeError):
            run()
    last = ["reports/ml_results", "reports/scalability_results"]
    assert run(resume=True) == last
    assert run(resume=True) == []
    assert [r.record for r in spark.read.parquet(f"{out}/quarantine").collect()] == ["only,three,fields"]
    assert spark.table("resumed.it_vacancies_raw").count() == postings(spark, SF).count()
    assert (tmp_path / "out" / MANIFEST).exists()
    (tmp_path / "raw" / "more.csv").write_text(",".join(postings(spark, SF).columns) + "\n", encoding="utf-8")
    assert run(resume=True) == ["quarantine", "stage", "tables", "reports", *last]


def test_input_state_sees_changes(spark, tmp_path):
    (tmp_path / "a.csv").write_text("x\n")
    before = input_state(spark, str(tmp_path / "*.csv"))
    (tmp_path / "b.csv").write_text("x\n")
    assert before != input_state(spark, str(tmp_path / "*.csv"))
    assert "0 files" in input_state(spark, str(tmp_path / "none"))


def test_saved_tables_have_statistics(spark):
    rows = spark.range(100).select("id", (F.col("id") % 7).alias("k"))
    for statistics in (True, False):
        name = catalog.save_table(rows, f"counted_{statistics}", "counted", statistics=statistics)
        described = spark.sql(f"DESCRIBE EXTENDED {name}").filter("col_name = 'Statistics'").collect()
        assert bool(described and "100 rows" in described[0].data_type) == statistics
    found = {r.info_name: r.info_value for r in spark.sql("DESCRIBE EXTENDED counted.counted_True k").collect()}
    assert (found["min"], found["max"], found["num_nulls"]) == ("0", "6", "0")


def test_sweep_counts_rows(spark):
    base = spark.range(50).select(
        F.col("id").cast("string").alias("id"), F.lit("x").alias("area_name"), F.lit("5").alias("salary_from"),
        F.lit(None).cast("string").alias("salary_to"), F.lit("true").alias("test_required"),
    )
    found = scaling.scaling_runs(base, multipliers=(1, 3), repeats=2).collect()
    assert sorted((r.multiplier, r.rows) for r in found) == [(1, 50), (1, 50), (3, 150), (3, 150)]


def test_profile_sweep_repeats_the_profile(spark):
    base = spark.range(20).select(
        F.col("id"), F.concat(F.lit("x"), F.col("id") % 3).alias("area_name"),
        F.col("id").cast("double").alias("salary_mid"), F.lit("true").alias("test_required"),
    )
    one = {r.area_name: r for r in group_profile(base, exact_median=True).collect()}
    for r in scaling.profile_sweep(base, (1, 2)).collect():
        assert r.vac_count == r.multiplier * one[r.area_name].vac_count
        assert r.vac_distinct == one[r.area_name].vac_distinct
        assert r.median_salary == one[r.area_name].median_salary
