from __future__ import annotations

import math
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from checks.profile_forms import joined_profile
from sievemart.operators import dedup, grouping, joins, ordering, projection, ranking, split
from sievemart.operators.replicate import replicate_rows
from tests.helpers import auc_rule, median_rule

POSTING = "id string, area_name string, salary_mid double, test_required string"


@pytest.fixture(scope="module")
def skewed(spark):
    """A third of all rows in one area and half of the ids of another area NULL."""
    rng = random.Random(5)
    rows = []
    for i in range(6000):
        area = "hot" if i % 3 == 0 else rng.choice(["a", "b", "c", None])
        key = None if area == "a" and i % 2 else str(rng.randrange(3000))
        value = rng.choice([None, 100.0, float(rng.randrange(5000)), rng.random()])
        rows.append((key, area, value, rng.choice(["True", "false", "1", "junk", None])))
    df = spark.createDataFrame(rows, POSTING).repartition(7).cache()
    yield df, rows
    df.unpersist()


def as_set(df):
    return {tuple(r) for r in df.collect()}


def profile_by_hand(rows):
    groups = {}
    for key, area, value, flag in rows:
        if area is not None and value is not None:
            groups.setdefault(area, []).append((key, value, flag))
    out = {}
    for area, group in groups.items():
        numbers = [v for _, v, _ in group]
        flags = [{"True": 1, "1": 1, "false": 0}.get(f) for _, _, f in group]
        flags = [f for f in flags if f is not None]
        out[area] = (
            pytest.approx(math.fsum(numbers) / len(numbers)),
            median_rule(numbers),
            len(group),
            len({k for k, _, _ in group if k is not None}),
            pytest.approx(sum(flags) / len(flags)),
        )
    return out


@pytest.mark.parametrize("exact", [True, False])
def test_profile_by_hand(skewed, exact):
    df, rows = skewed
    found = grouping.group_profile(df, accuracy=1_000_000, exact_median=exact).collect()
    assert {r[0]: tuple(r[1:]) for r in found} == profile_by_hand(rows)
    assert [r.vac_count for r in found] == sorted((r.vac_count for r in found), reverse=True)


def test_profile_equals_joined_form(skewed):
    df, _ = skewed
    one = grouping.group_profile(df, accuracy=1_000_000)
    three = joined_profile(df, accuracy=1_000_000).select(one.columns)
    assert as_set(one) == as_set(three)


def test_profile_when_rows_are_replicated(skewed):
    df, _ = skewed
    once = {r.area_name: r for r in grouping.group_profile(df, exact_median=True).collect()}
    thrice = grouping.group_profile(replicate_rows(df, 3), exact_median=True).collect()
    assert len(thrice) == len(once)
    for row in thrice:
        base = once[row.area_name]
        assert row.vac_count == 3 * base.vac_count
        assert row.vac_distinct == base.vac_distinct
        assert row.median_salary == base.median_salary
        assert row.avg_salary == pytest.approx(base.avg_salary)


def test_profile_without_optional_columns(skewed):
    df, _ = skewed
    bare = grouping.group_profile(df.select("area_name", "salary_mid"))
    assert dict(bare.dtypes)["vac_distinct"] == "bigint"
    assert dict(bare.dtypes)["test_share"] == "double"
    assert all(r.vac_distinct is None and r.test_share is None for r in bare.collect())
    with pytest.raises(ValueError, match="area_name"):
        grouping.group_profile(df.drop("area_name"))


def test_approximate_median_keeps_its_bound(spark):
    df = spark.range(200_000).select(F.lit("a").alias("k"), F.rand(3).alias("v")).cache()
    accuracy = 1000
    found = grouping.group_mean_median(df, "k", "v", accuracy).first().median_salary
    rank = df.filter(F.col("v") <= found).count()
    assert abs(rank - 100_000) <= 200_000 / accuracy
    df.unpersist()


@pytest.mark.parametrize("share", [0.01, 0.5, 0.9, 1.0])
def test_exact_percentile_by_hand(skewed, share):
    df, rows = skewed
    groups = {}
    for _, area, value, _ in rows:
        if value is not None:
            groups.setdefault(area, []).append(value)
    expected = {
        (area, sorted(v)[max(math.ceil(len(v) * share), 1) - 1]) for area, v in groups.items()
    }
    assert as_set(grouping.exact_percentile(df, "area_name", "salary_mid", share, "p")) == expected


def test_exact_percentile_outside_its_bracket(skewed, monkeypatch):
    df, _ = skewed
    right = as_set(grouping.exact_percentile(df, "area_name", "salary_mid", 0.5, "p"))
    for errors in (-3000, 3000):  # brackets that hold no value, and nearly all of them
        monkeypatch.setattr(grouping, "BRACKET_ERRORS", errors)
        assert as_set(grouping.exact_percentile(df, "area_name", "salary_mid", 0.5, "p")) == right


@pytest.mark.parametrize("type_name", ["int", "decimal(10,2)"])
def test_exact_percentile_of_other_types(spark, type_name):
    df = spark.range(1001).select(F.lit("a").alias("k"), F.col("id").cast(type_name).alias("v"))
    found = grouping.exact_percentile(df, "k", "v", 0.5, "p")
    assert dict(found.dtypes)["p"] == type_name
    assert int(found.first().p) == 500


def test_exact_percentile_of_groups_without_values(spark):
    df = spark.createDataFrame([("a", None), ("a", None), ("b", 1.0)], "k string, v double")
    assert as_set(grouping.exact_percentile(df, "k", "v", 0.5, "p")) == {("b", 1.0)}


def test_group_mean_drops_groups_without_values(spark):
    df = spark.createDataFrame([("a", None), ("b", 1.0), ("b", None), (None, 3.0)], "k string, v double")
    assert as_set(grouping.group_mean(df, "k", "v", "n", "m")) == {("b", 1, 1.0), (None, 1, 3.0)}


def test_having_keeps_thirty(spark):
    df = spark.createDataFrame([("a", 1.0)] * 29 + [("b", 1.0)] * 30, "k string, v double")
    means = grouping.group_mean(df, "k", "v", "n", "m")
    assert [r.k for r in grouping.having_at_least(means, "n", 30).collect()] == ["b"]


def test_flag_totals_of_nothing(spark):
    empty = spark.createDataFrame([], "test_flag int")
    totals = projection.with_ratio(grouping.flag_totals(empty, "test_flag"), "with_test", "total", "share")
    assert tuple(totals.first()) == (0, None, None)


def test_running_totals_by_hand(spark):
    rng = random.Random(2)
    rows = [(rng.randrange(50), i, rng.randrange(10)) for i in range(3000)]
    df = spark.createDataFrame(rows, "a int, b int, n int").repartition(5)
    found = ordering.running_totals(df, [F.desc("a"), F.asc("b")], {"upto": "n"}).collect()
    total, expected = 0, {}
    for a, b, n in sorted(rows, key=lambda r: (-r[0], r[1])):
        total += n
        expected[b] = total
    assert {r.b: r.upto for r in found} == expected


def test_range_split_is_even_and_ordered(spark):
    df = spark.range(20_000).select((F.col("id") * 7919 % 20_000).alias("v"))
    parts = (
        ordering.range_split(df, [F.asc("v")])
        .groupBy(ordering.RANGE)
        .agg(F.count("*").alias("n"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        .orderBy(ordering.RANGE)
        .collect()
    )
    assert all(x.hi < y.lo for x, y in zip(parts, parts[1:], strict=False))
    assert sum(p.n for p in parts) == 20_000


def test_top_k_breaks_ties_by_key(spark):
    df = spark.createDataFrame([("b", 2), ("a", 2), (None, 2), ("c", 5)], "k string, n int")
    assert [r.k for r in ordering.top_k(df, 3, "n", "k").collect()] == ["c", None, "a"]
    assert [r.k for r in ordering.largest_ascending(df, 3, "n", "k").collect()] == ["a", None, "c"]


def test_dedup(spark):
    rows = [("1", "b", 2), ("1", "a", 9), ("2", None, 1), (None, "x", 1), (None, "y", 0), ("1", "a", 3)]
    df = spark.createDataFrame(rows, "id string, t string, n int").repartition(3)
    kept = dedup.first_by_key(df, "id")
    assert kept.columns == df.columns
    assert as_set(kept) == {("1", "a", 3), ("2", None, 1), (None, "x", 1)}
    assert dedup.any_by_key(df, "id").count() == 3
    assert as_set(dedup.first_by_key(df.select("id"), "id")) == {("1",), ("2",), (None,)}


@pytest.mark.parametrize("times, factor", [(0, 1), (1, 1), (2, 2), (16, 16)])
def test_replicate(spark, times, factor):
    df = spark.range(10)
    grown = replicate_rows(df, times)
    assert grown.columns == ["id"]
    assert {tuple(r) for r in grown.groupBy("id").count().collect()} == {(i, factor) for i in range(10)}


def test_joins_and_null_keys(spark):
    left = spark.createDataFrame([("a", 1), (None, 2), ("b", 3)], "k string, l int")
    right = spark.createDataFrame([("a", 7), (None, 8)], "k string, r int")
    assert as_set(joins.join_inner(left, right, "k")) == {("a", 1, 7)}
    assert as_set(joins.join_left(left, right, "k")) == {("a", 1, 7), (None, 2, None), ("b", 3, None)}


def test_projection(spark):
    df = spark.createDataFrame([("1", "2")], "b string, a string")
    assert projection.keep_available(df, ["a", "z", "b"]).columns == ["a", "b"]
    filled = projection.with_defaults(df, {"a": F.lit("no"), "n": F.lit(None).cast("bigint")})
    assert filled.dtypes == [("b", "string"), ("a", "string"), ("n", "bigint")]
    assert tuple(filled.first()) == ("1", "2", None)
    assert projection.with_defaults(df, {"a": F.lit("no")}).columns == ["b", "a"]
    assert projection.find_column(df, ["z", "A"], 0) == "a"
    assert projection.find_column(df, ["z"], -1) == "a"


def test_midpoint_needs_neither_column(spark):
    df = spark.createDataFrame([("от 10", "20 руб")], "salary_from string, salary_to string")
    assert projection.with_midpoint(df).first().salary_mid == 15.0
    assert projection.with_midpoint(df.drop("salary_to")).first().salary_mid == 10.0
    assert projection.with_midpoint(df.select(F.lit(1).alias("x"))).first().salary_mid is None


def test_split_ignores_partitioning(spark):
    df = spark.range(20_000).select(F.col("id").cast("string").alias("id"))
    parts = []
    for n in (1, 5):
        train, test = split.split_rows(df.repartition(n), ["id"])
        assert train.count() + test.count() == 20_000
        parts.append({r.id for r in train.collect()})
    assert parts[0] == parts[1]
    assert 0.78 < len(parts[0]) / 20_000 < 0.82
    other, _ = split.split_rows(df, ["id"], seed=7)
    assert {r.id for r in other.collect()} != parts[0]


def test_split_keeps_null_keys(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), ("a", 3)], "id string, n int")
    train, test = split.split_rows(df, ["id"])
    assert train.count() + test.count() == 3


def test_category_index_is_that_of_the_model(spark):
    values = ["RUR"] * 5 + ["USD"] * 3 + ["EUR"] * 3 + ["NA"] + [None] * 9
    df = spark.createDataFrame([(v,) for v in values], "code string")
    found = {r.code: r.idx for r in ranking.category_index(df, "code").collect()}
    fitted = StringIndexer(inputCol="code", outputCol="i", handleInvalid="keep").fit(df)
    assert found == {r.code: r.i for r in fitted.transform(df).distinct().collect()}
    assert found == {"RUR": 0.0, "EUR": 1.0, "USD": 2.0, "NA": 3.0, None: 4.0}


def test_auc_by_hand_and_by_mllib(spark):
    rng = random.Random(3)
    pairs = [(y, rng.choice([0.5, round(rng.random() + y / 3, 2)])) for y in (0, 1) * 400]
    df = spark.createDataFrame(pairs, "label int, score double").repartition(6)
    found = ranking.rank_auc(df, "label", "score").first().auc
    assert found == pytest.approx(auc_rule(pairs), abs=1e-12)
    mllib = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0).evaluate(df)
    assert found == pytest.approx(mllib, abs=1e-12)


def test_auc_of_one_class_is_unknown(spark):
    df = spark.createDataFrame([(1, 0.5), (1, 0.6)], "label int, score double")
    assert ranking.rank_auc(df, "label", "score").first().auc is None
