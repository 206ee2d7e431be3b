"""Reading and writing CSV, Parquet and JSON."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    StringType,
    StructField,
    StructType,
)

from sievemart.session import cut_lineage

CORRUPT = "_corrupt_record"
NO_TEXT = "\0"  # a null marker that no field holds
BOM = "\ufeff"

STAGE_SCHEMA = StructType(
    [
        StructField("id", StringType()),
        StructField("area_name", StringType()),
        StructField("name", StringType()),
        StructField("salary_from", DoubleType()),
        StructField("salary_to", DoubleType()),
        StructField("salary_currency", StringType()),
        StructField("experience", StringType()),
        StructField("employment", StringType()),
        StructField("schedule", StringType()),
        StructField("has_test", IntegerType()),
        StructField("premium", IntegerType()),
        StructField("archived", IntegerType()),
        StructField("count_key_skills", DoubleType()),
        StructField("published_at", StringType()),
        StructField("test_required", StringType()),
        StructField("salary_gross", StringType()),
        StructField("area_id", StringType()),
        StructField("address_lat", StringType()),
    ]
)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    infer: bool = False,
    multi_line: bool = True,
    keep_empty: bool = False,
    mixed_headers: bool = False,
) -> DataFrame:
    """A CSV with a header, quoted line breaks and doubled quotes.

    All columns are text unless a schema is given or types are inferred, which
    costs a pass over the data.  A file that may hold quoted line breaks cannot
    be split: Spark reads one file per task, so large inputs should come as many
    files.  With ``multi_line=False`` files are split, for data known to have
    one record per line.  An empty field is NULL, quoted or not; with
    ``keep_empty`` a quoted one is an empty text.  A missing path raises
    ``AnalysisException``.

    All files must have the first file's header, else reading them raises an
    error.  With ``mixed_headers`` each file goes by its own: columns are matched
    by name, and a column that a file lacks is NULL there.
    """

    def reader() -> DataFrameReader:
        made = (
            spark.read.option("header", True)
            .option("multiLine", multi_line)
            .option("quote", '"')
            .option("escape", '"')
        )
        return made.option("nullValue", NO_TEXT) if keep_empty else made

    def one_header(files: str | list[str]) -> DataFrame:
        """Files with one header; Spark compares it with that of each file."""
        named = reader().option("inferSchema", infer).csv(files).schema
        df = reader().option("enforceSchema", False).schema(named).csv(files)
        return df.withColumnRenamed(named[0].name, named[0].name.lstrip(BOM))

    if schema is not None:
        # Columns go by position; this makes Spark compare them with the header.
        return reader().option("enforceSchema", False).schema(schema).csv(path)
    if not mixed_headers:
        return one_header(path)
    by_header: dict[tuple[str, ...], list[str]] = {}
    for file in reader().csv(path).inputFiles():
        by_header.setdefault(tuple(reader().csv(file).columns), []).append(file)
    parts = [one_header(files) for files in by_header.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def split_bad_records(
    spark: SparkSession,
    path: str,
    schema: StructType | None = None,
    multi_line: bool = True,
    header: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The records of a CSV that fit its schema, and those that do not.

    Without a schema all columns are text, named by the header.  A record with another
    number of fields, or with a value that is not of its column's type, does not fit;
    the second frame has it as it stands in the file, ``record``, and its ``file``.
    The CSV is parsed once, into a stored table that both frames read.
    """
    reader = spark.read.option("multiLine", multi_line).option("quote", '"').option("escape", '"')
    if schema is None:
        schema = reader.option("header", header).csv(path).schema
    marked = StructType([*schema.fields, StructField(CORRUPT, StringType())])
    # With fewer columns read, Spark would not see how many fields a record has.
    parsed = (
        reader.option("header", header)
        .option("enforceSchema", False)
        .option("columnPruning", False)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", CORRUPT)
        .schema(marked)
        .csv(path)
    )
    stored = cut_lineage(parsed.withColumn("_file", F.col("_metadata.file_path")))
    good = stored.filter(F.col(CORRUPT).isNull()).drop(CORRUPT, "_file")
    good = good.withColumnRenamed(schema[0].name, schema[0].name.lstrip(BOM))
    bad = stored.filter(F.col(CORRUPT).isNotNull())
    return good, bad.select(F.col(CORRUPT).alias("record"), F.col("_file").alias("file"))


def read_stage(spark: SparkSession, path: str) -> DataFrame:
    """The stage table; Parquet keeps its types, so nothing is inferred."""
    return spark.read.parquet(path)


def write_stage(df: DataFrame, path: str) -> None:
    """The whole table, written by the executors."""
    df.write.mode("overwrite").parquet(path)


def write_csv(df: DataFrame, path: str) -> None:
    """A whole table as CSV files; ``read_csv`` with ``keep_empty`` gives it back."""
    (
        df.write.mode("overwrite")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )


def write_report(df: DataFrame, path: str) -> None:
    """All rows of a finished report as a single CSV file with a header."""
    write_csv(df.coalesce(1), path)


def read_report(spark: SparkSession, path: str) -> DataFrame:
    """A finished report, with its types inferred from its few rows."""
    return read_csv(spark, path, infer=True)


def write_metrics(df: DataFrame, path: str) -> None:
    """A one-row frame of measures as a JSON file."""
    df.coalesce(1).write.mode("overwrite").json(path)
