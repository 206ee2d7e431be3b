"""Packing documents into token sequences: best-two-fit.

Documents become pieces of at most one sequence; pieces are dealt by row number
into buckets of about ``BUCKET_PIECES`` and each bucket is packed by itself, so
no task sees all pieces and a bucket wastes one part-filled sequence at most.  A
sequence is filled greedily, each time with the longest piece that fits; then its
shortest piece gives way to the two unpacked pieces that together fill the gap it
leaves more tightly than it did, if there are any.

Defined results: a NULL text is an empty one, which packs as the end mark alone;
repeated rows and NULL ids are packed as rows of their own; ties in length go by
the order of the rows; other columns are ignored; an empty table packs to no
rows; a text of any length is cut into pieces, all full but the first.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.llm.common import ship_code
from sievemart.llm.tokens import RankEncoder, default_ranks
from sievemart.session import cut_lineage

CAPACITY = 2048
END_ID = 0
BUCKET_PIECES = 8192


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str | None = None,
    capacity: int = CAPACITY,
    with_ids: bool = False,
) -> DataFrame:
    """The pieces of each document: id, piece, start, length, checksum, ids on demand."""
    ship_code(docs.sparkSession)
    ranks = ranks or default_ranks()
    end = END_ID.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = RankEncoder.load(ranks)
        for batch in batches:
            made: list[tuple] = []
            texts = batch.column("text").to_pylist()
            for row, text in enumerate(texts):
                ids = encoder.ids(text) + end
                start, width = 0, (len(ids) // 4) % capacity or capacity
                for piece in range(-(-len(ids) // 4 // capacity)):
                    part = ids[4 * start : 4 * (start + width)]
                    made.append((row, piece, start, width, zlib.crc32(part), part))
                    start, width = start + width, capacity
            row, piece, start, length, crc, part = zip(*made, strict=True) if made else [()] * 6
            arrays = [
                batch.column("id").take(pa.array(row, pa.int64())),
                pa.array(piece, pa.int32()),
                pa.array(start, pa.int64()),
                pa.array(length, pa.int64()),
                pa.array(crc, pa.int64()),
            ]
            names = ["id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                arrays.append(pa.array(part, pa.binary()))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names=names)

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(text_col, F.lit("")).alias("text"))
    kind = rows.schema["id"].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, ids_crc32 long"
    schema += ", ids binary" * with_ids
    return rows.mapInArrow(cut, schema).withColumnRenamed("id", id_col)


def best_two_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length; every length is from 1 to ``capacity``."""
    left = np.bincount(lengths, minlength=capacity + 1)
    there = np.flatnonzero(left).tolist()  # lengths of which there are unpacked pieces
    order: list[int] = []
    ends: list[int] = []

    def take(length: int) -> None:
        left[length] -= 1
        if not left[length]:
            del there[bisect_right(there, length) - 1]

    while there:
        filled, gap = [], capacity
        while (at := bisect_right(there, gap)) > 0:
            filled.append(there[at - 1])
            gap -= there[at - 1]
            take(there[at - 1])
        if gap and len(there) and there[0] <= (gap + filled[-1]) // 2:
            pair = _tighter_pair(there, left, gap + filled[-1], filled[-1])
            if pair:
                back = filled.pop()
                for length in pair:
                    take(length)
                    filled.append(length)
                if not left[back]:
                    there.insert(bisect_right(there, back), back)
                left[back] += 1
        order += filled
        ends.append(len(order))
    packed = np.array(order, dtype=np.int64)
    bins = np.repeat(np.arange(len(ends)), np.diff([0, *ends]))
    before = np.cumsum(packed) - packed
    offsets = before - before[np.r_[0, ends[:-1]].astype(int)][bins]
    # The k-th use of a length stands for the k-th row that has it.
    rows, uses = np.argsort(lengths, kind="stable"), np.argsort(packed, kind="stable")
    bin_of, offset_of = np.empty_like(packed), np.empty_like(packed)
    bin_of[rows], offset_of[rows] = bins[uses], offsets[uses]
    return bin_of, offset_of


def _tighter_pair(there: list[int], left: np.ndarray, room: int, than: int) -> list[int]:
    """Two unpacked lengths that sum to at most ``room`` and to more than ``than``."""
    sizes = np.array(there[: bisect_right(there, room - there[0])])
    partner = np.searchsorted(sizes, room - sizes, side="right") - 1
    alone = (partner == np.arange(len(sizes))) & (left[sizes] < 2)
    partner = partner - alone
    sums = np.where(partner >= 0, sizes + sizes[partner], 0)
    best = int(np.argmax(sums))
    return [int(sizes[best]), int(sizes[partner[best]])] if sums[best] > than else []


def pack_pieces(
    pieces: DataFrame, capacity: int = CAPACITY, bucket_pieces: int = BUCKET_PIECES
) -> DataFrame:
    """``pieces`` plus the sequence that holds each and its offset there.

    ``pieces`` is stored first, so that later steps see the same row numbers
    also after the loss of an executor.
    """
    ship_code(pieces.sparkSession)
    columns = pieces.columns
    stored = cut_lineage(pieces.withColumn("_row", F.monotonically_increasing_id()))
    buckets = max(1, -(-stored.filter(F.col("length") < capacity).count() // bucket_pieces))
    dealt = stored.withColumn("_bucket", F.pmod(F.xxhash64("_row"), F.lit(buckets)))

    def pack(key: tuple, rows: pa.Table) -> pa.Table:
        rows = rows.sort_by("_row")
        bins, offsets = best_two_fit(rows["length"].to_numpy(), capacity)
        rows = rows.select(columns)
        rows = rows.append_column("sequence_id", pa.array((key[0].as_py() << 32) + bins))
        return rows.append_column("offset", pa.array(offsets))

    kinds = ", ".join(f"`{n}` {pieces.schema[n].dataType.simpleString()}" for n in columns)
    packed = (
        dealt.filter(F.col("length") < capacity)
        .groupBy("_bucket")
        .applyInArrow(pack, f"{kinds}, sequence_id long, offset long")
    )
    # A full piece is a sequence by itself; numbers below zero keep them apart.
    full = stored.filter(F.col("length") >= capacity).select(
        *columns, (-1 - F.col("_row")).alias("sequence_id"), F.lit(0).cast("long").alias("offset")
    )
    return packed.unionByName(full)


def pack_documents(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str | None = None,
    capacity: int = CAPACITY,
) -> DataFrame:
    """Documents cut into pieces of token ids, and the pieces packed."""
    return pack_pieces(token_pieces(docs, id_col, text_col, ranks, capacity), capacity)
