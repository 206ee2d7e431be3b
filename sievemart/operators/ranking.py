"""Ranking over whole tables: category index and area under the ROC curve."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.operators.ordering import running_totals


def category_index(df: DataFrame, column: str, name: str = "idx") -> DataFrame:
    """Every category with its rows and index; 0.0 is the most frequent one.

    Equal frequencies go by value.  NULL, if there is any, gets the index after
    the last category, which is where the model puts unknown values too.
    """
    counted = df.groupBy(column).agg(F.count("*").alias("rows"), F.lit(1).alias("_one"))
    order = [F.col(column).isNull().asc(), F.desc("rows"), F.asc(column)]
    return running_totals(counted, order, {"_rank": "_one"}).select(
        column, "rows", (F.col("_rank") - 1).cast("double").alias(name)
    )


def rank_auc(df: DataFrame, label: str, score: str, name: str = "auc") -> DataFrame:
    """Exact area under the ROC curve as one row; ties count one half.

    Rows are counted per score before anything is ordered, so one score shared
    by a third of all rows is a single row in the running total.
    """
    counted = df.groupBy(F.col(score).alias("_score")).agg(
        F.sum(F.col(label).cast("long")).alias("_pos"),
        F.sum(1 - F.col(label).cast("long")).alias("_neg"),
    )
    ordered = running_totals(counted, [F.asc("_score")], {"_neg_upto": "_neg"})
    # Whole numbers of 38 digits up to the one division: positives times negatives
    # overflow a long at scale, and sums of doubles depend on their order.
    whole = "decimal(19,0)"
    pos = F.col("_pos").cast(whole)
    twice_below = (2 * F.col("_neg_upto") - F.col("_neg")).cast(whole)
    sums = ordered.agg(
        F.sum(pos * twice_below).alias("_wins"), F.sum("_pos").alias("_p"), F.sum("_neg").alias("_n")
    )
    pairs = F.col("_p").cast(whole) * F.col("_n").cast(whole)
    return sums.select(
        F.try_divide(F.col("_wins").cast("double"), 2 * pairs.cast("double")).alias(name)
    )
