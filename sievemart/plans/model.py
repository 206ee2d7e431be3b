"""A classifier for the test flag."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import FeatureHasher, OneHotEncoder, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.functions import gross_flag, guarded_id, norm_code, zero_if_null
from sievemart.operators.ranking import rank_auc
from sievemart.operators.split import split_rows
from sievemart.plans.code_index import CodeIndexer
from sievemart.sources.files import write_metrics

# The model's inputs and settings.
AMOUNTS = ("salary_from", "salary_to", "address_lat")
NUMERIC_FEATURES = ("salary_from", "salary_to", "salary_gross_bin", "address_lat", "area_id_num")
CODE_FEATURE = "salary_currency_norm"
FEATURES = (*NUMERIC_FEATURES, CODE_FEATURE)
MAX_ITER = 30
REG_PARAM = 0.01


def model_input(df: DataFrame) -> DataFrame:
    """Features of a leniently cleaned frame; a missing column is a constant."""
    have = set(df.columns)
    features = {
        c: zero_if_null(F.col(c).cast("double")) if c in have else F.lit(0.0) for c in AMOUNTS
    }
    features["salary_gross_bin"] = gross_flag("salary_gross") if "salary_gross" in have else F.lit(0)
    features["area_id_num"] = guarded_id(df, "area_id") if "area_id" in have else F.lit(0.0)
    features[CODE_FEATURE] = (
        norm_code("salary_currency") if "salary_currency" in have else F.lit("NA")
    )
    return df.withColumns(features)


def labelled_features(df: DataFrame, *carry: str) -> DataFrame:
    """Label and features only, with any columns named in ``carry`` in front."""
    label = F.col("test_flag").cast("int").alias("label")
    return model_input(df).select(*carry, label, *FEATURES)


def classifier(hashed_width: int | None = None) -> Pipeline:
    """Code to index, index to one-hot, all to one vector, logistic regression.

    With a ``hashed_width`` codes are hashed into that many places instead: for open
    domains, whose one-hot width and coefficients would grow with the data.
    """
    if hashed_width:
        encoded = [FeatureHasher(inputCols=[CODE_FEATURE], outputCol="code_onehot", numFeatures=hashed_width)]
    else:
        encoded = [
            CodeIndexer(inputCol=CODE_FEATURE, outputCol="code_index"),
            OneHotEncoder(inputCols=["code_index"], outputCols=["code_onehot"], handleInvalid="keep"),
        ]
    return Pipeline(
        stages=[
            *encoded,
            VectorAssembler(inputCols=[*NUMERIC_FEATURES, "code_onehot"], outputCol="features"),
            LogisticRegression(maxIter=MAX_ITER, regParam=REG_PARAM),
        ]
    )


def loss_gradient(model: PipelineModel, rows: DataFrame) -> DataFrame:
    """The gradient of the penalised loss on ``rows``: one row per coefficient.

    ``place`` is the coefficient's number, -1 the intercept.  The fit scales features
    to unit deviation and penalises the scaled coefficients, so ``gradient`` is per
    scaled coefficient; at the optimum all are zero.  One aggregate over the
    features that are not zero: its state is a few sums per coefficient.
    """
    fit = model.stages[-1]
    scored = model.transform(rows)
    error = (vector_to_array("probability")[1] - F.col("label")).alias("_error")
    entries = scored.select(error, F.posexplode(F.array_insert(vector_to_array("features"), 1, F.lit(1.0))))
    sums = entries.groupBy((F.col("pos") - 1).alias("place")).agg(
        F.avg(F.col("_error") * F.col("col")).alias("_slope"), F.stddev_samp("col").alias("_scale")
    )
    weights = F.array(F.lit(0.0), *[F.lit(float(x)) for x in fit.coefficients])
    scaled = F.try_divide("_slope", "_scale") + fit.getRegParam() * F.col("_scale") * weights[F.col("place") + 1]
    at_zero = F.col("_scale") > 0
    gradient = F.when(F.col("place") < 0, F.col("_slope")).when(at_zero, scaled).otherwise(0.0)
    return sums.select("place", gradient.alias("gradient"))


def split_data(df: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Split by id; rows without one, and tables without ids, by the feature row."""
    row = ["label", *FEATURES]
    return split_rows(df, ["id"], instead=row) if "id" in df.columns else split_rows(df, row)


def fit_and_score(df: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fit on the training rows; returns the model and the scored test rows."""
    data = labelled_features(df, *(["id"] if "id" in df.columns else []))
    train, test = split_data(data)
    model = classifier().fit(train)
    scored = model.transform(test).withColumn("score", vector_to_array("probability")[1])
    return model, scored


def run_model(cleaned: DataFrame, out: str) -> None:
    """Fit, score, and write the area under the curve with the feature list."""
    _, scored = fit_and_score(cleaned)
    report = rank_auc(scored, "label", "score").select(
        F.lit("predict test_required (test_flag)").alias("task"),
        "auc",
        F.lit(", ".join(FEATURES)).alias("features"),
    )
    write_metrics(report, out)
