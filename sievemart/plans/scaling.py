"""The group profile at growing data volumes."""

from __future__ import annotations

import time
from collections.abc import Iterable
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.operators.grouping import group_profile
from sievemart.operators.projection import with_midpoint
from sievemart.operators.replicate import replicate_rows
from sievemart.session import cut_lineage

# The sweep.
MULTIPLIERS = (1, 2, 4, 8, 16)
REPEATS = 3

# What the profile reads of the stage table.
PROFILED = ("id", "area_name", "salary_from", "salary_to", "test_required")

RUN_SCHEMA = "multiplier int, rows long, seconds double"


def run_once(df: DataFrame) -> float:
    """Seconds to compute every column of ``df``.

    The no-op sink needs all of them; a ``count()`` would let Spark leave out
    the very aggregates that are to be timed.
    """
    start = time.perf_counter()
    df.write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def scaling_runs(
    stage: DataFrame,
    multipliers: Iterable[int] = MULTIPLIERS,
    repeats: int = REPEATS,
    partitions: int | None = None,
) -> DataFrame:
    """One row per timed run.  Each volume gets a warm-up run that is not kept."""
    used = [c for c in PROFILED if c in stage.columns]
    base = with_midpoint(stage.select(used)).select(
        "salary_mid", *[c for c in used if c not in ("salary_from", "salary_to")]
    )
    if partitions:
        base = base.repartition(partitions)
    # Held once, as columns of the profile only: parsing is not what is timed.
    base = cut_lineage(base)
    # Counted once, from the file footers.  An Observation on the warm-up run would do
    # without, but after it Spark 4.1 cannot send the session's MLlib stages to tasks.
    rows = base.count()
    runs = []
    for m in multipliers:
        volume = replicate_rows(base, m)
        run_once(group_profile(volume))
        runs += [(m, m * rows, run_once(group_profile(volume))) for _ in range(repeats)]
    return stage.sparkSession.createDataFrame(runs, RUN_SCHEMA)


def summarise_runs(runs: DataFrame) -> DataFrame:
    """Rows and least, greatest and mean seconds per multiplier."""
    return (
        runs.groupBy("multiplier")
        .agg(
            F.max("rows").alias("rows"),
            F.min("seconds").alias("min_time_s"),
            F.max("seconds").alias("max_time_s"),
            F.avg("seconds").alias("avg_time_s"),
        )
        .orderBy("multiplier")
    )


def volume_shapes(stage: DataFrame, multipliers: Iterable[int] = MULTIPLIERS) -> DataFrame:
    """What the sweep yields apart from times: rows and profiled rows per multiplier."""
    base = with_midpoint(stage)
    shapes = [
        replicate_rows(base, m).agg(
            F.lit(m).alias("multiplier"),
            F.count("*").alias("rows"),
            F.count(F.when(F.col("area_name").isNotNull(), F.col("salary_mid"))).alias("profiled"),
        )
        for m in multipliers
    ]
    return reduce(DataFrame.unionByName, shapes)


def profile_sweep(base: DataFrame, multipliers: Iterable[int] = MULTIPLIERS) -> DataFrame:
    """The profile itself at every multiplier: what the sweep computes, without its times.

    ``base`` has the midpoint and should be stored, as each multiplier scans it.
    """
    profiles = [
        group_profile(replicate_rows(base, m), exact_median=True).withColumn("multiplier", F.lit(m)) for m in multipliers
    ]
    return reduce(DataFrame.unionByName, profiles)
