"""Sharding by vector bin packing: bytes, tokens and rows balanced together.

Documents with equal texts form a group, which goes to a shard as a whole.  Only a
group that exceeds a shard's share of the bytes, tokens or rows is cut, into pieces of
one ``PIECES_PER_SHARE``-th of a share.  What is placed are the totals of groups and
pieces, never their rows.  Those above one ``BIG_PER_SHARE``-th of a share are at most
3 x 40 x ``BIG_PER_SHARE``, whatever the input; they are placed first, largest first,
where the dot product of the size vector with a shard's residual capacity is highest
among the shards that it fits.  The others are dealt by hash into buckets of about
``BUCKET_ROWS``, and each bucket places its own likewise.  One bucket in
``RESERVE_EVERY`` is kept back until the others are placed; its shards' capacities make
up for what those left uneven, which is 40 rows of totals.  Rows find their group's
shard by hash and a part of the group, so that a hot group meets it in many tasks.

Defined results: a NULL text has no bytes and the checksum of the empty text;
repeated rows form a group like other equal texts and are placed each; ties in
size go by the hash of the group or piece and then the bucket's order of shards; a NULL id stays NULL;
other columns are ignored; an empty table gives no rows.  Slots count from 0 in
each shard without gaps.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sievemart.llm.common import ship_code, words_of
from sievemart.session import cut_lineage

SHARDS = 40
BUCKET_ROWS = 8192
RESERVE_EVERY = 8
PIECES_PER_SHARE = 8
BIG_PER_SHARE = 64
PARTS = 4096  # of a group, in which its rows meet its shard
NUMBERED_ROWS = 1 << 16
ROW_BYTES = 16

DIMENSIONS = ("size", "tokens", "rows")

UNIT_SCHEMA = "_unit long, size long, tokens long, rows long, shard int"

#: What each dimension counts for in the dot product; bytes are the law to hold.
WEIGHTS = (1.0, 0.3, 0.05)


def place_groups(sizes: np.ndarray, capacity: np.ndarray) -> np.ndarray:
    """The shard of each group, in the given order.

    ``sizes`` is groups x dimensions, ``capacity`` shards x dimensions, in the
    same units.  If a group fits nowhere, the dot product
    alone decides.
    """
    total = np.maximum(capacity.sum(axis=0), 1e-9)
    wants, room = sizes / total, capacity / total
    shards = np.empty(len(wants), dtype=np.int64)
    for group, want in enumerate(wants):
        fits = (room >= want).all(axis=1)
        score = room @ (want * WEIGHTS)
        if fits.any():
            score = np.where(fits, score, -np.inf)
        shards[group] = best = int(np.argmax(score))
        room[best] -= want
    return shards


def measured_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Per row: id, size, checksum, tokens (words) and the hash of the text."""
    text = F.coalesce(text_col, F.lit(""))
    return docs.select(
        F.col(id_col).alias("_id"),
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.size(words_of(F.col(text_col))).cast("long").alias("tokens"),
        F.xxhash64(text, F.octet_length(text)).alias("_text_hash"),
    )


def _placed(dealt: DataFrame, shards: int, owed: np.ndarray, sharing: int) -> DataFrame:
    """Every unit of ``dealt``, totals of a group or piece, with its shard.

    ``owed`` holds per shard what it has more or less than an even share, in each
    dimension; ``sharing`` buckets make up for it in equal parts.
    """
    lacks = -owed / max(sharing, 1)

    def place(key: tuple, units: pa.Table) -> pa.Table:
        units = units.sort_by("_unit")
        sizes = np.stack([units[name].to_numpy().astype(float) for name in DIMENSIONS], axis=1)
        capacity = sizes.sum(axis=0) / shards + lacks
        order = _largest_first(sizes)
        # Each bucket numbers the shards in its own order, so that what buckets
        # leave uneven does not always fall on the same shards.
        own = np.random.default_rng(key[0].as_py()).permutation(shards)
        shard = np.empty(len(sizes), dtype=np.int64)
        shard[order] = own[place_groups(sizes[order], capacity[own])]
        out = units.select(["_unit", *DIMENSIONS])
        return out.append_column("shard", pa.array(shard, pa.int32()))

    return dealt.groupBy("_bucket").applyInArrow(place, UNIT_SCHEMA)


def _largest_first(sizes: np.ndarray) -> np.ndarray:
    weight = (sizes / np.maximum(sizes.sum(axis=0), 1e-9)).max(axis=1)
    return np.argsort(-weight, kind="stable")


def _held(placed: DataFrame, shards: int) -> np.ndarray:
    """What each shard holds, in each dimension."""
    held = np.zeros((shards, len(DIMENSIONS)))
    for row in placed.groupBy("shard").agg(*_sums()).collect():  # one row per shard
        held[row["shard"]] = [row[name] for name in DIMENSIONS]
    return held


def _sums() -> list[Column]:
    return [F.sum(name).alias(name) for name in DIMENSIONS]


def place_units(units: DataFrame, total: np.ndarray, shards: int, bucket_rows: int) -> DataFrame:
    """The shard of every unit: its key ``_unit``, its totals and ``shard``."""
    spark = units.sparkSession
    share = np.maximum(total / shards, 1e-9)
    is_big = F.greatest(*[F.col(c) / F.lit(float(s)) for c, s in zip(DIMENSIONS, share, strict=True)]) > 1 / BIG_PER_SHARE
    # At most as many rows as the docstring says: each holds that part of one total.
    listed = units.filter(is_big).orderBy("_unit").collect()
    sizes = np.array([[row[c] for c in DIMENSIONS] for row in listed], dtype=float).reshape(-1, len(DIMENSIONS))
    order = _largest_first(sizes)
    shard_of = np.empty(len(listed), dtype=np.int64)
    shard_of[order] = place_groups(sizes[order], np.tile(total / shards, (shards, 1)))
    big = [(row["_unit"], *[row[c] for c in DIMENSIONS], int(n)) for row, n in zip(listed, shard_of, strict=True)]
    placed = spark.createDataFrame(big, UNIT_SCHEMA)

    buckets = max(1, -(-units.count() // bucket_rows))
    reserved = -(-buckets // RESERVE_EVERY)
    bucket = F.pmod(F.xxhash64("_unit"), F.lit(buckets))
    dealt = units.filter(~is_big).withColumn("_bucket", bucket)
    for part, sharing in ((F.col("_bucket") >= reserved, buckets), (F.col("_bucket") < reserved, reserved)):
        held = _held(placed, shards)
        done = cut_lineage(_placed(dealt.filter(part), shards, held - held.mean(axis=0), sharing))
        placed = placed.unionByName(done)
    return placed


def shard_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shards: int = SHARDS,
    bucket_rows: int = BUCKET_ROWS,
) -> DataFrame:
    """Per row: id, size, checksum, tokens, shard and slot."""
    ship_code(docs.sparkSession)
    part = F.pmod(F.xxhash64("_row"), F.lit(PARTS)).cast("int")
    measured = measured_rows(docs, id_col, text_col)
    rows = cut_lineage(measured.withColumn("_row", F.monotonically_increasing_id()).withColumn("_part", part))
    sized = rows.withColumn("rows", F.lit(1).cast("long"))
    parts = cut_lineage(sized.groupBy("_text_hash", "_part").agg(*_sums()))
    found = parts.agg(*_sums()).first()
    total = np.array([found[name] or 0 for name in DIMENSIONS], dtype=float)

    # Equal texts in shares of a shard; the pieces of a group follow from its parts.
    shares = [F.col(c) * shards / F.lit(max(float(t), 1e-9)) for c, t in zip(DIMENSIONS, total, strict=True)]
    most = F.greatest(*shares)
    groups = parts.groupBy("_text_hash").agg(*_sums())
    pieces = groups.select("_text_hash", F.when(most > 1, F.ceil(most * PIECES_PER_SHARE)).otherwise(1).alias("_pieces"))
    unit = F.xxhash64("_text_hash", F.pmod(F.col("_part"), F.col("_pieces")))
    parts = cut_lineage(parts.join(pieces, "_text_hash").withColumn("_unit", unit).drop("_pieces"))
    units = cut_lineage(parts.groupBy("_unit").agg(*_sums()))
    shard_of = place_units(units, total, shards, bucket_rows).select("_unit", "shard")
    part_shards = parts.select("_text_hash", "_part", "_unit").join(shard_of, "_unit").drop("_unit")
    chunk = F.pmod(F.xxhash64("_row", F.lit(1)), F.lit(1 + int(total[-1]) // (shards * NUMBERED_ROWS)))
    placed = cut_lineage(rows.join(part_shards, ["_text_hash", "_part"]).withColumn("_chunk", chunk).drop("_text_hash"))

    # Slots: a row's number in its chunk of the shard, and the chunks before it.
    before = Window.partitionBy("shard").orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy("shard", "_chunk")
        .agg(F.count("*").alias("_rows"))
        .select("shard", "_chunk", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    )
    number = F.row_number().over(Window.partitionBy("shard", "_chunk").orderBy("_row")).cast("long")
    return (
        placed.withColumn("_number", number)
        .join(starts, ["shard", "_chunk"])
        .select(
            F.col("_id").alias(id_col),
            "size",
            "text_crc32",
            "tokens",
            "shard",
            (F.col("_start") + F.col("_number") - 1).alias("slot"),
        )
    )
