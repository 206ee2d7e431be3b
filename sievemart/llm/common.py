"""What the operators share: words, table reading, code shipping."""

from __future__ import annotations

import tempfile
import zipfile
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, StructField, StructType

# What separates words, as characters and as a pattern.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[ \x09-\x0D]+"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def words_of(text: Column) -> Column:
    """The words of a text; none for NULL and for blank texts."""
    bare = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def ship_code(spark: SparkSession) -> None:
    """Sends this package to the executors once per application, for Python tasks."""
    context = spark.sparkContext
    if getattr(ship_code, "sent_to", None) == context.applicationId:
        return
    package = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="code-")) / f"{package.name}.zip"
    with zipfile.ZipFile(target, "w") as archive:
        for file in sorted(package.rglob("*.py")):
            archive.write(file, file.relative_to(package.parent))
    context.addPyFile(str(target))
    ship_code.sent_to = context.applicationId


def schema_of(known: dict[str, DataType], added: StructType | None = None) -> StructType:
    """The schema of a Python task's output: columns of known types, then added ones."""
    fields = [StructField(name, kind) for name, kind in known.items()]
    return StructType(fields + (added.fields if added else []))
