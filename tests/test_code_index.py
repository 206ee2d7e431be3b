"""The code index as a stage, merged bitmaps, and the gradient of the fit."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from sievemart.operators import bitmaps
from sievemart.plans import model
from sievemart.plans.code_index import CodeIndexer, CodeIndexModel

CODES = [("b",), ("b",), ("c",), ("a",), ("c",), ("c",), (None,)]


def test_index_goes_by_frequency_then_value(spark):
    fitted = CodeIndexer("code", "n").fit(spark.createDataFrame([*CODES, ("d",)], "code string"))
    assert fitted.size == 4
    asked = spark.createDataFrame([("a",), ("b",), ("c",), ("d",), ("new",), (None,)], "code string")
    found = {r["code"]: r["n"] for r in fitted.transform(asked).collect()}
    assert found == {"c": 0.0, "b": 1.0, "a": 2.0, "d": 3.0, "new": 4.0, None: 4.0}
    hot = fitted.transform(asked).select(vector_to_array(fitted.one_hot()).alias("v"), "n").collect()
    assert all(r["v"] == [float(i == r["n"]) for i in range(5)] for r in hot)


def test_saved_index_is_the_same(spark, tmp_path):
    rows = spark.createDataFrame(CODES, "code string")
    fitted = CodeIndexer("code", "n").fit(rows)
    fitted.save(str(tmp_path / "index"))
    loaded = CodeIndexModel.load(str(tmp_path / "index"))
    assert (loaded.uid, loaded.size) == (fitted.uid, fitted.size)
    assert sorted(loaded.transform(rows).collect(), key=str) == sorted(fitted.transform(rows).collect(), key=str)


def test_index_of_no_codes(spark):
    fitted = CodeIndexer("code", "n").fit(spark.createDataFrame([(None,)], "code string"))
    assert fitted.size == 0
    assert [r["n"] for r in fitted.transform(spark.createDataFrame([("x",)], "code string")).collect()] == [0.0]


def test_bitmaps_merge_as_if_made_at_once(spark):
    rows = spark.range(200_000).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 1000 == 1, None).otherwise((F.col("id") % 7).cast("string")).alias("k"),
        F.when(F.col("id") % 11 > 0, F.col("id") * 31 % 70_000).alias("item"),
    )
    numbered = rows.join(bitmaps.number_items(rows, "item"), "item", "left")
    parts = [bitmaps.item_bitmaps(numbered.filter(F.col("item") % 2 == n), "k") for n in (0, 1)]
    parts.append(bitmaps.item_bitmaps(numbered, "k"))
    found = bitmaps.count_bitmaps(bitmaps.merge_bitmaps(*parts), "k", "n").collect()
    exact = rows.groupBy("k").agg(F.count_distinct("item").alias("n")).collect()
    assert {tuple(r) for r in found} == {tuple(r) for r in exact}
    nothing = spark.createDataFrame([("a", None)], "k string, number long")
    assert [tuple(r) for r in bitmaps.count_bitmaps(bitmaps.item_bitmaps(nothing, "k"), "k", "n").collect()] == [("a", 0)]


def test_gradient_tells_a_fit_from_a_half_one(spark):
    rows = spark.range(3000).select(
        (F.pmod(F.xxhash64("id"), F.lit(10)) < 3 + F.col("id") % 4).cast("int").alias("label"),
        *[(F.pmod(F.xxhash64("id", F.lit(c)), F.lit(100)) * 7.0).alias(c) for c in model.NUMERIC_FEATURES],
        F.element_at(F.array(F.lit("A"), F.lit("B"), F.lit(None)), (F.col("id") % 3 + 1).cast("int")).alias(model.CODE_FEATURE),
    ).withColumn("salary_to", F.col("salary_to") + 400 * F.col("label"))
    largest = F.max(F.abs("gradient"))
    for width in (None, 16):
        pipeline = model.classifier(width)
        full = model.loss_gradient(pipeline.fit(rows), rows).agg(largest).first()[0]
        pipeline.getStages()[-1].setMaxIter(1)
        half = model.loss_gradient(pipeline.fit(rows), rows).agg(largest).first()[0]
        assert full < 1e-3 < half
