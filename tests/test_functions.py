from __future__ import annotations

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sievemart import functions as fx
from tests.helpers import column, lenient_rule, strict_rule, values

# text, strict, lenient
NUMBERS = [
    ("150000", 150000.0, 150000.0),
    ("1500,5", 1500.5, 1500.5),
    ("от 100 000 руб.", None, 100000.0),
    ("100-200", None, 100.0),
    ("1.234,50", None, 1.234),
    ("-5", -5.0, -5.0),
    (",5", None, 5.0),
    ("", None, None),
    ("n/a", None, None),
    ("-", None, None),
    (None, None, None),
    ("12\n", 12.0, 12.0),
    (" 7 ", 7.0, 7.0),
]


def test_numbers_in_text(spark):
    df = column(spark, [n[0] for n in NUMBERS])
    assert values(df, fx.strict_number(df, "x")) == [n[1] for n in NUMBERS]
    assert values(df, fx.lenient_number(df, "x")) == [n[2] for n in NUMBERS]


@pytest.mark.parametrize("type_name, value", [("double", 1.0e7), ("long", 10**12), ("int", -3)])
def test_numeric_columns_pass_through(spark, type_name, value):
    df = column(spark, [value, None], type_name)
    for fn in (fx.strict_number, fx.lenient_number, fx.coerce_number):
        assert values(df, fn(df, "x")) == [float(value), None]
    assert values(df, fx.guarded_id(df, "x")) == [float(value), 0.0]


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.one_of(st.none(), st.text("0123456789.,- абeE\t€", max_size=12)), min_size=300, max_size=300))
def test_numbers_follow_the_plain_rules(spark, texts):
    df = column(spark, texts)
    rows = (
        df.coalesce(1)
        .select(fx.strict_number(df, "x").alias("s"), fx.lenient_number(df, "x").alias("l"))
        .collect()
    )
    assert [r.s for r in rows] == [strict_rule(t) for t in texts]
    assert [r.l for r in rows] == [lenient_rule(t) for t in texts]
    # whatever the strict rule accepts, the lenient one reads alike
    assert all(r.s == r.l for r in rows if r.s is not None)


def test_coerce_number(spark):
    cases = [
        ("12", 12.0), (" 12.5 ", 12.5), ("1e3", 1000.0), (".5", 0.5), ("5.", 5.0), ("-2", -2.0),
        ("12 руб", None), ("1,5", None), ("", None), ("1.5d", None), ("2f", None), ("nan", None),
        ("inf", float("inf")), (None, None),
    ]
    df = column(spark, [c[0] for c in cases])
    assert values(df, fx.coerce_number(df, "x")) == [c[1] for c in cases]
    nan = column(spark, [float("nan"), 1.0], "double")
    assert values(nan, fx.coerce_number(nan, "x")) == [None, 1.0]


FLAG_TEXTS = ["True", "FALSE", "yes", "да", "ДА", "нет", "n", "Y", " 1 ", "0", "00", "2",
              "99999999999", "Полный день", "", None, "tRuE", " true "]


def test_true_flag(spark):
    df = column(spark, FLAG_TEXTS)
    expected = [int(t is not None and t.lower() == "true") for t in FLAG_TEXTS]
    assert values(df, fx.true_flag("x")) == expected
    booleans = column(spark, [True, False, None], "boolean")
    assert values(booleans, fx.true_flag("x")) == [1, 0, 0]


def test_any_flag(spark):
    df = column(spark, FLAG_TEXTS)
    expected = [1, 0, 1, 1, 1, 0, 0, 1, 1, 0, 0, 1, 1, 0, 0, 0, 1, 1]
    assert values(df, fx.any_flag(df, ["x"])) == expected
    for type_name, data, flags in [
        ("boolean", [True, False, None], [1, 0, 0]),
        ("int", [0, 1, 2, None], [0, 1, 1, 0]),
    ]:
        typed = column(spark, data, type_name)
        assert values(typed, fx.any_flag(typed, ["x"])) == flags


def test_any_flag_source_order(spark):
    df = spark.createDataFrame([("0", "1")], "has_test string, test_required string")
    assert values(df, fx.any_flag(df)) == [1]
    assert values(df, fx.any_flag(df.drop("test_required"))) == [0]
    other = df.select(F.lit(1).alias("other"))
    assert values(other, fx.any_flag(other)) == [0]


def test_gross_flag(spark):
    df = column(spark, FLAG_TEXTS)
    expected = [1, 0, 1, 1, 1, 0, 0, 0, 1, 0, 0, 0, 0, 0, 0, 0, 1, 1]
    assert values(df, fx.gross_flag("x")) == expected


def test_three_state_flag(spark):
    texts = ["1", "true", "True", "TRUE", "0", "false", "False", "FALSE", "tRUE", " 1 ", "yes", None]
    df = column(spark, texts)
    assert values(df, fx.three_state_flag(df, "x")) == [1.0] * 4 + [0.0] * 4 + [None] * 4
    for type_name, data in [("boolean", [True, False, None]), ("int", [1, 0, 2]), ("double", [1.0, 0.0, 0.5])]:
        typed = column(spark, data, type_name)
        assert values(typed, fx.three_state_flag(typed, "x")) == [1.0, 0.0, None]


def test_guarded_id(spark):
    df = column(spark, ["12", " 7 ", "a1", "1.5", "-3", "", None])
    assert values(df, fx.guarded_id(df, "x")) == [12.0, 7.0, 0.0, 0.0, 0.0, 0.0, 0.0]


def test_norm_code(spark):
    df = column(spark, ["rur", " USD ", "", "   ", None, "руб"])
    assert values(df, fx.norm_code("x")) == ["RUR", "USD", "NA", "NA", None, "РУБ"]


def test_two_way_label(spark):
    df = column(spark, ["TRUE", "true", "no", None])
    assert values(df, fx.two_way_label("x", "A", "B")) == ["A", "A", "B", "B"]


def test_midpoint(spark):
    df = spark.createDataFrame(
        [(1.0, 4.0), (1.0, None), (None, 4.0), (None, None), (0.0, 0.0)], "a double, b double"
    )
    assert values(df, fx.midpoint(F.col("a"), F.col("b"))) == [2.5, 1.0, 4.0, None, 0.0]


def test_zero_if_null(spark):
    df = column(spark, [1.5, None], "double")
    assert values(df, fx.zero_if_null(F.col("x"))) == [1.5, 0.0]
