"""The index of a code column as a model stage that is a table, not a list on the driver.

``CodeIndexer`` fits the same order as ``category_index``: the most frequent code is
0, equal frequencies go by value.  Codes that the fit has not seen, and NULL, get the
index after the last.  The fitted index is a stored table that ``transform`` joins:
Spark broadcasts a small one and shuffles a large one, and splits hot codes.
"""

from __future__ import annotations

from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemart.operators.ranking import category_index
from sievemart.session import cut_lineage

_CODE, _INDEX = "_code_of_index", "_index_of_code"


class CodeIndexer(Estimator, HasInputCol, HasOutputCol, DefaultParamsReadable, DefaultParamsWritable):
    def __init__(self, inputCol: str = "code", outputCol: str = "code_index") -> None:
        super().__init__()
        self._set(inputCol=inputCol, outputCol=outputCol)

    def _fit(self, dataset: DataFrame) -> CodeIndexModel:
        column = self.getInputCol()
        index = category_index(dataset.filter(F.col(column).isNotNull()), column)
        stored = cut_lineage(index.select(F.col(column).alias(_CODE), F.col("idx").alias(_INDEX)))
        return self._copyValues(CodeIndexModel(stored, stored.count()))


class CodeIndexModel(Model, HasInputCol, HasOutputCol, MLWritable, MLReadable):
    """``index`` has each code and its number; ``size`` is how many there are."""

    def __init__(self, index: DataFrame, size: int) -> None:
        super().__init__()
        self.index, self.size = index, size

    def _transform(self, dataset: DataFrame) -> DataFrame:
        joined = dataset.join(self.index, F.col(self.getInputCol()) == F.col(_CODE), "left")
        found = F.coalesce(_INDEX, F.lit(float(self.size)))
        return joined.withColumn(self.getOutputCol(), found).drop(_CODE, _INDEX)

    def one_hot(self) -> Column:
        """The index as a vector with a place for each code and one for all others."""
        places = F.sequence(F.lit(0), F.lit(self.size))
        here = F.col(self.getOutputCol())
        return array_to_vector(F.transform(places, lambda i: (i == here).cast("double")))

    def write(self) -> MLWriter:
        return _IndexWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _IndexReader()


class _IndexWriter(MLWriter):
    def __init__(self, model: CodeIndexModel) -> None:
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        model, spark = self.model, self.model.index.sparkSession
        model.index.write.parquet(f"{path}/index")
        facts = [(model.uid, model.getInputCol(), model.getOutputCol(), model.size)]
        names = "uid string, inputCol string, outputCol string, size long"
        spark.createDataFrame(facts, names).coalesce(1).write.json(f"{path}/facts")


class _IndexReader(MLReader):
    def load(self, path: str) -> CodeIndexModel:
        spark = SparkSession.active()
        facts = spark.read.json(f"{path}/facts").first()
        model = CodeIndexModel(spark.read.parquet(f"{path}/index"), facts["size"])
        model._resetUid(facts["uid"])
        return model._set(inputCol=facts["inputCol"], outputCol=facts["outputCol"])
