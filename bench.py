"""Times the headline queries and prints one JSON line.

Each query is written to the no-op sink, so that all of its columns are
computed; one warm-up, then the median of three runs.  The profile sweep follows
the published protocol (multipliers 1 to 16, three repeats) on the stage table
as Parquet, for our profile and for the same result as three rollups and two
joins, which is the plan to beat.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent))

from checks.profile_forms import joined_profile  # noqa: E402
from checks.spark_queries import all_queries  # noqa: E402
from sievemart.operators.grouping import group_profile  # noqa: E402
from sievemart.operators.projection import with_midpoint  # noqa: E402
from sievemart.operators.replicate import replicate_rows  # noqa: E402
from sievemart.plans.scaling import MULTIPLIERS, REPEATS, run_once  # noqa: E402
from checks.postings import postings  # noqa: E402

HEADLINE = (
    "strict_number",
    "lenient_number",
    "multi_flag",
    "stage_rows",
    "dedup_by_key",
    "top_groups",
    "salary_by_group",
    "report_salary_by_city",
    "salary_mart_rates",
    "avg_median",
    "count_distinct",
    "group_profile",
    "group_profile_exact",
    "median_exact_many_groups",
    "sql_top_cities",
    "sql_test_share",
    "feed_salary",
    "category_index_many",
    "rank_auc_ties",
    "ml_features",
    "logreg_predictions",
)


def session(cpus: str, home: str) -> SparkSession:
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", f"{home}/checkpoints")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def timed(make) -> float:
    """Median seconds of three runs, plan building and eager steps included."""
    seconds = []
    for turn in range(REPEATS + 1):
        start = time.perf_counter()
        run_once(make())
        if turn:
            seconds.append(time.perf_counter() - start)
    return round(statistics.median(seconds), 4)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count()))
    home = tempfile.mkdtemp(prefix="bench-")
    spark = session(cpus, home)
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE

    found = all_queries()
    times = {name: timed(lambda n=name: found[n](spark, sf_dir)) for name in names}

    sweep: dict[str, dict[str, float]] = {}
    if not chosen:
        kept = ["id", "area_name", "salary_mid", "test_required"]
        with_midpoint(postings(spark, sf_dir)).select(kept).repartition(int(cpus)).write.parquet(
            f"{home}/stage"
        )

        def volume(m: int) -> DataFrame:
            return replicate_rows(spark.read.parquet(f"{home}/stage"), m)

        for m in MULTIPLIERS:
            sweep[f"x{m}"] = {
                "profile": timed(lambda m=m: group_profile(volume(m))),
                "three_rollups_two_joins": timed(lambda m=m: joined_profile(volume(m))),
            }
            times[f"profile_x{m}"] = sweep[f"x{m}"]["profile"]

    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": Path(sf_dir).name.removeprefix("sf"),
                "cpus": int(cpus),
                "sweep": sweep,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
