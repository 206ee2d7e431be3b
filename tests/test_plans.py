from __future__ import annotations

import json

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from sievemart.operators.grouping import group_profile
from sievemart.operators.split import split_rows
from sievemart.plans import feeds, job, model, reports, scaling, stage
from sievemart.sources import catalog, files
from checks.postings import postings

SF = "/root/testdata/sf0.001"

RAW_CSV = (
    "﻿id,area_name,name,salary_from,salary_to,salary_currency,experience,employment,"
    "schedule,has_test,premium,archived,count_key_skills,published_at,extra\n"
    '1,Москва,"Senior ""C++"" dev, remote","1500,5",2000,RUR,3-6,full,Полный день,True,false,TRUE,4,2024-01-01,x\n'
    '1,Москва,"Senior ""C++"" dev, remote","1500,5",2000,RUR,3-6,full,Полный день,True,false,TRUE,4,2024-01-01,x\n'
    '2,Омск,"two\nlines",100-200,,usd,,part,remote,False,true,,n/a,2024-01-02,x\n'
    ',Омск,"",-5,10,,,,,,,,,,x\n'
)


@pytest.fixture(scope="module")
def raw_path(tmp_path_factory):
    path = tmp_path_factory.mktemp("raw") / "raw.csv"
    path.write_text(RAW_CSV, encoding="utf-8")
    return str(path)


def test_csv_reader(spark, raw_path):
    df = files.read_csv(spark, raw_path)
    assert df.columns[0] == "id"
    assert {t for _, t in df.dtypes} == {"string"}
    rows = {r.id: r for r in df.collect()}
    assert df.count() == 4
    assert rows["1"].name == 'Senior "C++" dev, remote'
    assert rows["2"].name == "two\nlines"
    assert rows["2"].salary_to is None


def test_csv_inference_and_schema(spark, tmp_path):
    path = tmp_path / "n.csv"
    path.write_text("a,b\n1,x\n2,y\n", encoding="utf-8")
    assert files.read_csv(spark, str(path), infer=True).dtypes == [("a", "int"), ("b", "string")]
    assert files.read_csv(spark, str(path)).dtypes == [("a", "string"), ("b", "string")]
    from pyspark.sql.types import StructType

    schema = StructType.fromDDL("a double, b string")
    assert files.read_csv(spark, str(path), schema=schema).dtypes == [("a", "double"), ("b", "string")]


def test_missing_input_is_an_error(spark, tmp_path):
    with pytest.raises(AnalysisException):
        files.read_csv(spark, str(tmp_path / "no.csv"))
    with pytest.raises(AnalysisException):
        files.read_stage(spark, str(tmp_path / "no"))
    with pytest.raises(AnalysisException):
        job.run_job(spark, str(tmp_path / "no.csv"), str(tmp_path / "out"))
    assert not (tmp_path / "out").exists()


def test_csv_round_trip(spark, tmp_path):
    rows = [('a "b", c', "x\ny"), ("", None), ("да", "'"), (" pad ", "\\"), (None, ""), ('"', '""'), ("a\r\nb", "\\q")]
    df = spark.createDataFrame(rows, "s string, t string")
    files.write_csv(df, str(tmp_path / "c"))
    back = files.read_csv(spark, str(tmp_path / "c"), keep_empty=True)
    assert {tuple(r) for r in back.collect()} == set(rows)
    plain = files.read_csv(spark, str(tmp_path / "c"))
    assert {tuple(r) for r in plain.collect()} == {tuple(v or None for v in r) for r in rows}


@pytest.mark.parametrize("multi_line", [True, False])
def test_postings_round_trip_through_csv(spark, tmp_path, multi_line):
    raw = postings(spark, SF)
    files.write_csv(raw, str(tmp_path / "raw"))
    back = files.read_csv(spark, str(tmp_path / "raw"), multi_line=multi_line, keep_empty=True)
    direct, via_csv = stage.stage_rows(raw), stage.stage_rows(back)
    assert direct.exceptAll(via_csv).count() == via_csv.exceptAll(direct).count() == 0


def test_stage_job(spark, raw_path, tmp_path):
    out = str(tmp_path / "stage")
    stage.run_stage(spark, raw_path, out)
    staged = files.read_stage(spark, out)
    assert staged.schema.fields == files.STAGE_SCHEMA.fields[: len(staged.columns)]
    rows = {r.id: r for r in staged.collect()}
    assert set(rows) == {"1", "2", None}
    assert (rows["1"].salary_from, rows["1"].has_test, rows["1"].archived) == (1500.5, 1, 1)
    assert (rows["2"].salary_from, rows["2"].premium, rows["2"].count_key_skills) == (None, 1, None)
    assert (rows[None].salary_from, rows[None].salary_to, rows[None].has_test) == (-5.0, 10.0, 0)


def test_stage_with_missing_columns(spark):
    df = spark.createDataFrame([("a", "5"), ("a", "5")], "area_name string, salary_from string")
    staged = stage.stage_rows(df)
    assert staged.dtypes == [("area_name", "string"), ("salary_from", "double")]
    assert staged.count() == 2  # no id, nothing to de-duplicate by
    assert stage.stage_rows(df.select("area_name")).columns == ["area_name"]


@pytest.fixture(scope="module")
def staged(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stage") / "s")
    files.write_stage(stage.stage_rows(postings(spark, SF)), path)
    return files.read_stage(spark, path)


def test_reports_from_rollup_equal_direct_forms(staged):
    cleaned = reports.clean_leniently(staged)
    made = reports.reports_of_rollup(reports.area_rollup(cleaned), min_rows=5)
    direct = {
        "top_cities": reports.top_areas(cleaned),
        "salary_by_city": reports.salary_by_area(cleaned, min_rows=5),
        "test_share": reports.test_share(cleaned),
    }
    for name, expected in direct.items():
        assert made[name].columns == expected.columns
        assert made[name].collect() == expected.collect()


def test_reports_job(spark, staged, tmp_path):
    out = str(tmp_path)
    reports.run_reports(staged, out)
    top = files.read_report(spark, f"{out}/top_cities")
    assert top.columns == ["area_name", "vacancies"]
    assert top.count() == 20
    share = files.read_report(spark, f"{out}/test_share").first()
    assert share.total == staged.count()
    assert share.share == pytest.approx(share.with_test / share.total)
    assert len(list((tmp_path / "top_cities").glob("*.csv"))) == 1


def test_reports_without_area_or_salary(spark, tmp_path):
    df = spark.createDataFrame([("true",), ("no",)], "has_test string")
    reports.run_reports(df, str(tmp_path))
    assert files.read_report(spark, str(tmp_path / "test_share")).first().with_test == 1
    assert not (tmp_path / "top_cities").exists()
    areas = spark.createDataFrame([("a",), ("a",), ("b",)], "area_name string")
    reports.run_reports(areas, str(tmp_path / "b"))
    assert files.read_report(spark, str(tmp_path / "b" / "top_cities")).first().vacancies == 2
    assert not (tmp_path / "b" / "salary_by_city").exists()


def test_reports_are_written_in_full(spark, tmp_path):
    files.write_report(spark.range(60_000), str(tmp_path / "r"))
    assert files.read_report(spark, str(tmp_path / "r")).count() == 60_000


@pytest.mark.parametrize("multi_line", [True, False])
def test_files_with_other_headers(spark, tmp_path, multi_line):
    (tmp_path / "a.csv").write_text("id,area_name,extra\n1,X,e\n", encoding="utf-8")
    (tmp_path / "b.csv").write_text("area_name,id\nY,3\n", encoding="utf-8")
    with pytest.raises(Exception, match="CSV header|header"):
        files.read_csv(spark, str(tmp_path / "*.csv"), multi_line=multi_line).collect()
    both = files.read_csv(spark, str(tmp_path / "*.csv"), multi_line=multi_line, mixed_headers=True)
    assert {(r.id, r.area_name, r.extra) for r in both.collect()} == {("1", "X", "e"), ("3", "Y", None)}


def test_intermediates_are_removed(spark, tmp_path):
    import os

    from sievemart.operators.ranking import rank_auc
    from sievemart.session import ensure_checkpoint_dir, intermediates

    folder = ensure_checkpoint_dir(spark).removeprefix("file:")
    before = set(os.listdir(folder)) if os.path.isdir(folder) else set()
    scored = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.9)], "y int, s double")
    with intermediates(spark) as written:
        assert rank_auc(scored, "y", "s").first().auc == 0.75
        assert written and set(os.listdir(folder)) > before
    assert set(os.listdir(folder)) == before


def test_a_cluster_needs_a_named_folder(spark, monkeypatch):
    from sievemart import session

    class Context:
        applicationId = "x"
        master = "local-cluster[2,1,1024]"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, name, default=None):
            return default

    class Session:
        sparkContext, conf = Context(), Conf()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.ensure_checkpoint_dir(Session())
    Context.master = "local[4]"
    assert session.ensure_checkpoint_dir(Session()) == session.ensure_checkpoint_dir(Session())


def test_rows_without_an_id_are_split_too(spark):
    rows = spark.createDataFrame([(None, str(i)) for i in range(5000)], "id string, other string")
    train, test = split_rows(rows, ["id"], instead=["other"])
    assert 0.18 < test.count() / 5000 < 0.22
    assert train.count() + test.count() == 5000


def test_quoted_database_names(spark):
    name = catalog.save_table(spark.range(3), "order", "select")
    assert catalog.read_catalog(spark, name).count() == 3
    assert [r.tableName for r in catalog.list_tables(spark, "select").collect()] == ["order"]


def test_a_database_lists_no_views(spark):
    catalog.save_table(spark.range(3), "kept", "listed")
    catalog.register(spark, {"some_view": spark.range(2)})
    assert [r.tableName for r in catalog.list_tables(spark, "listed").collect()] == ["kept"]
    assert "some_view" in [r.tableName for r in catalog.list_tables(spark).collect()]


def test_optional_columns_reach_the_model(staged):
    data = model.labelled_features(reports.clean_leniently(staged))
    for name in ("salary_gross_bin", "area_id_num", "address_lat", "label"):
        assert data.select(name).distinct().count() > 1
    from sievemart.operators.projection import with_midpoint

    assert group_profile(with_midpoint(staged)).filter("test_share IS NOT NULL").count() > 0


def test_mart_with_rates(spark):
    rows = [("a", "10", "20", "rur"), ("a", "1", None, " usd "), ("a", "5", None, "xyz"), ("b", None, None, "rur")]
    df = spark.createDataFrame(rows, "area_name string, salary_from string, salary_to string, salary_currency string")
    assert {tuple(r) for r in reports.salary_mart(df).collect()} == {("a", 3, 1, 15.0)}
    rated = reports.salary_mart(df, {"RUR": 1, "USD": 90}).collect()
    assert {tuple(r) for r in rated} == {("a", 3, 2, 52.5)}
    assert {tuple(r) for r in reports.salary_mart(df, {}).collect()} == {("a", 3, 0, None)}


def test_catalog_tables(spark, staged):
    raw = postings(spark, SF)
    name = catalog.save_table(reports.salary_mart(raw), catalog.MART, "marts")
    assert catalog.read_catalog(spark, name).count() == reports.salary_mart(raw).count()
    listed = {r.tableName for r in catalog.list_tables(spark, "marts").collect()}
    assert catalog.MART in listed
    catalog.register(spark, {catalog.RAW: raw, catalog.CLEAN: staged})
    assert catalog.CLEAN in {r.tableName for r in catalog.list_tables(spark).collect()}
    plain = catalog.run_sql(
        spark,
        "SELECT area_name, COUNT(*) AS n FROM it_vacancies_clean GROUP BY area_name ORDER BY n DESC LIMIT 20",
    )
    assert [r.n for r in plain.collect()] == [r.vacancies for r in catalog.top_areas(spark).collect()]
    quoted = catalog.run_sql(spark, "SELECT :text AS t", {"text": "'; DROP TABLE x"})
    assert quoted.first().t == "'; DROP TABLE x"


def test_feeds(spark):
    named = spark.createDataFrame([("1", "a", "x"), ("3", "b", "x"), ("bad", "c", "x")], "Vacancies string, City string, o string")
    assert [tuple(r) for r in feeds.top_city_feed(named).collect()] == [("a", 1.0), ("b", 3.0)]
    unnamed = spark.createDataFrame([("a", 2), ("b", 1)], "k string, n int")
    assert [tuple(r) for r in feeds.top_city_feed(unnamed).collect()] == [("b", 1.0), ("a", 2.0)]
    many = spark.createDataFrame([(f"c{i:02}", i) for i in range(30)], "city string, vacancies int")
    assert [r.vacancies for r in feeds.top_city_feed(many).collect()] == [float(i) for i in range(10, 30)]
    salary = spark.createDataFrame([("a", 5, "9.5"), ("b", 6, "x")], "area string, n int, mean string")
    assert [tuple(r) for r in feeds.salary_feed(salary).collect()] == [("a", 9.5)]
    flags = spark.createDataFrame([("yes", "4"), ("no", "?")], "f string, c string")
    assert {tuple(r) for r in feeds.flag_feed(flags).collect()} == {("yes", 4.0), ("no", 0.0)}


def test_scaling(spark, staged, tmp_path):
    runs = scaling.scaling_runs(staged, multipliers=(1, 2), repeats=2, partitions=4)
    summary = scaling.summarise_runs(runs)
    rows = summary.collect()
    assert [(r.multiplier, r.rows) for r in rows] == [(1, staged.count()), (2, 2 * staged.count())]
    assert all(0 < r.min_time_s <= r.avg_time_s <= r.max_time_s for r in rows)
    files.write_report(summary, str(tmp_path / "s"))
    curve = feeds.scaling_feed(files.read_report(spark, str(tmp_path / "s"))).collect()
    assert [(r.multiplier_m, r.time) for r in curve] == [(float(r.multiplier), r.avg_time_s) for r in rows]


def max_gradient(fitted, df):
    """Largest part of the penalised loss's gradient at the fitted coefficients."""
    import numpy as np

    train, _ = model.split_data(model.labelled_features(df, "id"))
    rows = fitted.transform(train).select("features", "label").collect()
    x = np.array([r.features.toArray() for r in rows])
    y = np.array([r.label for r in rows], dtype=float)
    fit = fitted.stages[-1]
    w = fit.coefficients.toArray()
    error = 1 / (1 + np.exp(-(x @ w + fit.intercept))) - y
    # The penalty is on standardised columns; constant columns have no coefficient.
    scale = x.std(axis=0, ddof=1)
    used = scale > 0
    part = (x[:, used] / scale[used]).T @ error / len(y) + model.REG_PARAM * w[used] * scale[used]
    return max(np.abs(part).max(), abs(error.mean()))


def test_model(spark):
    df = reports.clean_leniently(postings(spark, SF))
    fitted, scored = model.fit_and_score(df)
    assert [type(s).__name__ for s in fitted.stages] == [
        "CodeIndexModel", "OneHotEncoderModel", "VectorAssembler", "LogisticRegressionModel",
    ]
    row = scored.first()
    assert 0 <= row.score <= 1 and row.prediction in (0.0, 1.0)
    assert fitted.stages[1].categorySizes == [4]  # three codes and the NULL bucket
    assert row.features.size == 5 + 4  # five numbers, three codes and the NULL bucket
    assert max_gradient(fitted, df) < 1e-3


def test_model_without_optional_columns(spark, tmp_path):
    df = reports.clean_leniently(postings(spark, SF).select("test_required", "salary_from"))
    data = model.labelled_features(df)
    assert data.columns == ["label", *model.FEATURES]
    constants = data.select("salary_gross_bin", "address_lat", "area_id_num", "salary_currency_norm")
    assert {tuple(r) for r in constants.distinct().collect()} == {(0, 0.0, 0.0, "NA")}
    model.run_model(df, str(tmp_path / "m"))
    (part,) = (tmp_path / "m").glob("*.json")
    report = json.loads(part.read_text())
    assert 0 <= report["auc"] <= 1
    assert report["features"].split(", ") == list(model.FEATURES)


def test_whole_job(spark, tmp_path):
    raw = postings(spark, SF)
    files.write_csv(raw, str(tmp_path / "raw"))
    job.run_job(
        spark, str(tmp_path / "raw"), str(tmp_path / "out"), multipliers=(1, 2), repeats=1, database="jobs"
    )
    made = {p.name for p in (tmp_path / "out" / "reports").iterdir()}
    assert made == {"top_cities", "salary_by_city", "test_share", "ml_results", "scalability_results"}

    before = spark.catalog.currentDatabase()
    staged = files.read_stage(spark, str(tmp_path / "out" / "stage"))
    areas = catalog.top_cities(spark, database="jobs").collect()
    assert [r.vacancies for r in areas] == [
        r.n for r in staged.groupBy("area_name").agg(F.count("*").alias("n")).orderBy(F.desc("n")).limit(30).collect()
    ]
    assert {r.test_flag: r.cnt for r in catalog.flag_counts(spark, "jobs").collect()} == {
        catalog.WITH_TEST: raw.filter("lower(test_required) = 'true'").count(),
        catalog.WITHOUT_TEST: raw.filter("lower(test_required) <> 'true' OR test_required IS NULL").count(),
    }
    assert catalog.city_salaries(spark, database="jobs").columns == ["city", "vacancies_with_salary", "avg_rub"]
    assert catalog.mart_rows(spark, 3, "jobs").count() == 3
    assert spark.catalog.currentDatabase() == before


def test_sweep_holds_its_input(spark, staged):
    from sievemart.session import intermediates

    with intermediates(spark) as written:
        scaling.scaling_runs(staged, multipliers=(1,), repeats=1, partitions=3)
        (held,) = written
        frame = spark.read.parquet(held)
        assert frame.columns == ["salary_mid", "id", "area_name", "test_required"]
        assert len(frame.inputFiles()) == 3 and frame.count() == staged.count()


def test_profile_of_stage(staged):
    from sievemart.operators.projection import with_midpoint

    found = group_profile(with_midpoint(staged)).agg(F.sum("vac_count")).first()[0]
    expected = with_midpoint(staged).filter("salary_mid IS NOT NULL AND area_name IS NOT NULL").count()
    assert found == expected
