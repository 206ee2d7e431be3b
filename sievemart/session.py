"""Session helpers: intermediates in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

_own_folders: dict[str, str] = {}
_scope: ContextVar[list[str] | None] = ContextVar("intermediates", default=None)


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder that the session names.

    Where none is named, executors of a cluster have no folder in common, so this
    raises.  In a single process (``local[...]``), as in tests, it is a temporary
    folder.  The context's own checkpoint folder is left as it is.
    """
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get(CHECKPOINT_DIR, None)
    if named:
        return named
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors share")
    if context.applicationId not in _own_folders:
        _own_folders[context.applicationId] = tempfile.mkdtemp(prefix="sievemart-")
    return _own_folders[context.applicationId]


def cut_lineage(df: DataFrame) -> DataFrame:
    """``df`` written once to the checkpoint folder, and read back from there.

    This runs ``df`` at once.  Later steps read the files and never recompute what
    led to them, also after the loss of an executor.  A Parquet table rather than
    ``checkpoint()``: each later step reads only the columns it needs.  Inside
    ``intermediates`` the files are removed at its end; otherwise the cluster's
    retention of the folder removes them, as it does for checkpoints.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark)}/cut-{uuid.uuid4().hex}"
    written = _scope.get()
    if written is not None:
        written.append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def intermediates(spark: SparkSession) -> Iterator[list[str]]:
    """Removes at its end what ``cut_lineage`` writes inside it.

    Results that read such files must be written or collected before the end.
    """
    written: list[str] = []
    token = _scope.set(written)
    try:
        yield written
    finally:
        _scope.reset(token)
        jvm = spark.sparkContext._jvm
        hadoop = spark.sparkContext._jsc.hadoopConfiguration()
        for name in written:
            path = jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(hadoop).delete(path, True)
