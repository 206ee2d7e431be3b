"""What the plans must and must not hold, whatever the data."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as contract
from sievemart.operators.dedup import first_by_key
from sievemart.operators.grouping import group_profile
from sievemart.operators.projection import with_midpoint
from sievemart.plans import reports, stage
from sievemart.sources.files import write_stage
from checks.postings import postings, read_table
from tests.helpers import plan_of

SF = "/root/testdata/sf0.001"
EAGER = {"logreg_predictions", "logreg_scored_rows", "fit_gradient"}


@pytest.mark.parametrize("name", sorted(set(contract.all_queries()) - EAGER))
def test_no_cross_join_and_no_python(spark, name):
    plan = plan_of(contract.all_queries()[name](spark, SF))
    assert not re.search("CartesianProduct|NestedLoopJoin|EvalPython|InPandas|InArrow", plan)


@pytest.fixture(scope="module")
def stage_table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stage") / "s")
    write_stage(stage.stage_rows(postings(spark, SF)), path)
    return spark.read.parquet(path)


def scans(plan):
    return re.findall(r"ReadSchema: struct<([^>]*)>", plan)


def test_rollup_reads_only_its_columns_once(stage_table):
    plan = plan_of(reports.area_rollup(reports.clean_leniently(stage_table)))
    assert [s.split(",") for s in scans(plan)] == [["area_name:string", "salary_from:double", "test_required:string"]]


def test_profile_prunes_and_pushes(stage_table):
    plan = plan_of(group_profile(with_midpoint(stage_table)))
    assert len(scans(plan)) == 2
    assert all("name:string," not in s.replace("area_name:string,", "") for s in scans(plan))
    assert plan.count("PushedFilters: [IsNotNull(area_name)]") == 2
    # the sketch and the distinct count never meet in one aggregate
    assert not re.search(r"percentile_approx[^\n]*distinct", plan)


def test_text_is_parsed_once(spark):
    plan = plan_of(reports.salary_mart(postings(spark, SF)))
    assert plan.count("regexp_extract") == 2  # one for each end of the salary


def test_dedup_combines_before_the_shuffle(spark):
    plan = plan_of(first_by_key(read_table(spark, SF, "lineitem"), "l_orderkey"))
    above, below = plan.split("Exchange", 1)
    assert "partial_min" in below and "Window" not in plan


def test_top_k_does_not_sort_everything(spark):
    assert "TakeOrderedAndProject" in plan_of(reports.top_areas(postings(spark, SF)))
