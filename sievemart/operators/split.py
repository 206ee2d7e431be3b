"""A train/test split that does not depend on how the data is partitioned."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Share of training rows and seed.
TRAIN_SHARE = 0.8
SEED = 42

_BUCKETS = 10_000


def split_bucket(
    keys: Sequence[str], seed: int = SEED, instead: Sequence[str] = ()
) -> Column:
    """A number below 10,000 from an MD5 of the seed and the key columns.

    Rows whose keys are all NULL go by the columns ``instead``, so that they do not
    all end up on one side.  MD5 rather than Spark's own hash, so that other
    engines give the same split.
    """

    def text(columns: Sequence[str]) -> Column:
        parts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]
        return F.concat_ws("|", F.lit(str(seed)), *parts)

    hashed = text(keys)
    if instead:
        hashed = F.when(F.coalesce(*keys).isNull(), text(instead)).otherwise(hashed)
    return F.conv(F.substring(F.md5(hashed), 1, 8), 16, 10).cast("long") % _BUCKETS


def is_train(
    keys: Sequence[str],
    share: float = TRAIN_SHARE,
    seed: int = SEED,
    instead: Sequence[str] = (),
) -> Column:
    return split_bucket(keys, seed, instead) < round(share * _BUCKETS)


def split_rows(
    df: DataFrame,
    keys: Sequence[str],
    share: float = TRAIN_SHARE,
    seed: int = SEED,
    instead: Sequence[str] = (),
) -> tuple[DataFrame, DataFrame]:
    """Train and test rows; rows with equal keys stay together."""
    train = is_train(keys, share, seed, instead)
    return df.filter(train), df.filter(~train)
