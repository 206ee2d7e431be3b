"""Near-duplicate documents by SimHash and an inverted index of positional bytes.

Two 64-bit fingerprints that differ in at most ``RADIUS`` = 4 bits differ in at
most 4 of their 8 bytes, so they share at least 4 bytes in place.  The index
lists each distinct fingerprint under every combination of 4 positional bytes,
so that a pair which reaches the guaranteed minimum meets in some list; its
shared bytes are then tallied and its differing bits counted.

Lists of two are settled where they are counted.  In longer lists every
fingerprint is first compared with three of the list's own: the least, the
greatest and the most frequent.  After the components of these links are known,
only pairs that are still in different components are compared within a list, so
a dense group of near copies costs a few rows per member, not one per pair, and
no component is missed: every pair within the radius is either compared or
already connected.

Defined results: a NULL, empty or blank text has fingerprint zero, like any
other; repeated rows share a component; texts of any length are read whole; a
component's number is its least id that is not NULL, or NULL if it has none;
other columns are ignored by ``near_duplicates`` and kept by ``keep_one``; an
empty table gives no rows.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievemart.llm.common import schema_of, ship_code
from sievemart.llm.components import components
from sievemart.session import cut_lineage

WORDS = 4
SEED = 42
RADIUS = 4
BYTES = 8
SHARED = BYTES - RADIUS  # bytes that a pair within the radius has in common, at least
BLOCK = 1 << 15

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def fingerprint(text: str | None, words: int = WORDS) -> int:
    """SimHash of the text's shingles, as a signed 64-bit number."""
    found = (text or "").encode().translate(LOWER).split()
    if not found:
        return 0
    count = max(len(found) - words + 1, 1)
    ones = np.zeros(64, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, count, BLOCK):
        hashes = np.array(
            [
                digest(b" ".join(found[i : i + words]), SEED)
                for i in range(start, min(start + BLOCK, count))
            ],
            dtype=">u8",
        )
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def with_fingerprint(rows: DataFrame, text: str, words: int = WORDS, drop_text: bool = True) -> DataFrame:
    """``rows`` plus ``_fp``; the column ``text`` is left out unless kept."""
    ship_code(rows.sparkSession)
    kept = [c for c in rows.columns if not (drop_text and c == text)]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [fingerprint(x, words) for x in batch.column(text).to_pylist()]
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.int64())], names=[*kept, "_fp"])

    schema = schema_of({c: rows.schema[c].dataType for c in kept}, StructType.fromDDL("_fp long"))
    return rows.mapInArrow(add, schema)


def _differ(a: str, b: str) -> Column:
    return F.bit_count(F.col(a).bitwiseXOR(F.col(b)))


def _shared_bytes(a: str, b: str) -> Column:
    """How many of the 8 positional bytes two fingerprints have in common."""
    other = F.col(a).bitwiseXOR(F.col(b))
    same = [(F.shiftrightunsigned(other, 8 * i).bitwiseAND(F.lit(255)) == 0).cast("int") for i in range(BYTES)]
    return sum(same[1:], same[0])


def _linked(a: str, b: str) -> Column:
    return (_shared_bytes(a, b) >= SHARED) & (_differ(a, b) <= RADIUS) & (F.col(a) != F.col(b))


def _listed(prints: DataFrame, *columns: str) -> DataFrame:
    """A row per fingerprint and combination of ``SHARED`` of its bytes."""
    keys = []
    for number, places in enumerate(itertools.combinations(range(BYTES), SHARED)):
        key = F.lit(number).cast("long")
        for place in places:
            byte = F.shiftrightunsigned(F.col("_fp"), 8 * place).bitwiseAND(F.lit(255))
            key = F.shiftleft(key, 8).bitwiseOR(byte)
        keys.append(key)
    return prints.select("_fp", *columns, F.explode(F.array(*keys)).alias("_key"))


def link_fingerprints(prints: DataFrame) -> DataFrame:
    """Component of each linked fingerprint: ``node`` and ``root``.

    ``prints`` has distinct ``_fp`` and how many rows have it, ``_rows``.
    """
    listed = _listed(prints, "_rows")
    lists = cut_lineage(
        listed.groupBy("_key")
        .agg(F.count("*").alias("_size"), F.min("_fp").alias("_low"), F.max("_fp").alias("_high"))
        .filter(F.col("_size") > 1)
    )
    long_lists = lists.filter(F.col("_size") > 2).select("_key", "_low", "_high")
    members = cut_lineage(listed.join(long_lists, "_key"))
    frequent = members.groupBy("_key").agg(
        F.max_by("_fp", F.struct("_rows", "_fp")).alias("_often")
    )
    ends = lists.filter(_linked("_low", "_high")).select(F.col("_low").alias("a"), F.col("_high").alias("b"))
    hubs = members.join(frequent, "_key").select(
        F.col("_fp").alias("a"), F.explode(F.array("_low", "_high", "_often")).alias("b")
    )
    first = cut_lineage(ends.union(hubs.filter(_linked("a", "b"))).distinct())
    roots = cut_lineage(components(first, "a", "b"))
    labelled = members.join(roots, F.col("_fp") == F.col("node"), "left").select(
        "_key", "_fp", F.coalesce("root", "_fp").alias("_root")
    )
    mixed = (
        labelled.groupBy("_key")
        .agg(F.min("_root").alias("_least"), F.max("_root").alias("_most"))
        .filter(F.col("_least") != F.col("_most"))
        .select("_key")
    )
    open_ = cut_lineage(labelled.join(mixed, "_key", "left_semi"))
    left = open_.select("_key", F.col("_fp").alias("a"), F.col("_root").alias("_root_a"))
    right = open_.select("_key", F.col("_fp").alias("b"), F.col("_root").alias("_root_b"))
    across = left.join(
        right,
        (left["_key"] == right["_key"]) & (F.col("_root_a") < F.col("_root_b")) & _linked("a", "b"),
    ).select("a", "b")
    # The first links again as stars, which are fewer.
    stars = roots.select(F.col("node").alias("a"), F.col("root").alias("b"))
    return components(stars.union(across), "a", "b")


def _with_component(rows: DataFrame, keep_root: bool = False) -> DataFrame:
    """``rows`` with ``_id`` and ``_fp``, plus ``_component``; ``rows`` must be stored.

    ``keep_root`` gives ``_root``, which also tells components without ids apart.
    """
    prints = cut_lineage(rows.groupBy("_fp").agg(F.count("*").alias("_rows"), F.min("_id").alias("_least")))
    roots = link_fingerprints(prints.select("_fp", "_rows"))
    rooted = prints.join(roots, F.col("_fp") == F.col("node"), "left").select(
        "_fp", "_least", F.coalesce("root", "_fp").alias("_root")
    )
    rooted = cut_lineage(rooted)
    if keep_root:
        return rows.join(rooted.select("_fp", "_root"), "_fp")
    of_root = rooted.groupBy("_root").agg(F.min("_least").alias("_component"))
    of_print = rooted.join(of_root, "_root").select("_fp", "_component")
    return rows.join(of_print, "_fp")


def near_duplicates(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """Per row: id, fingerprint in hexadecimal and component."""
    rows = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text"))
    stored = cut_lineage(with_fingerprint(rows, "_text", words))
    return _with_component(stored).select(
        F.col("_id").alias(id_col),
        F.lower(F.lpad(F.hex("_fp"), 16, "0")).alias("fingerprint"),
        F.col("_component").alias("component_id"),
    )


def keep_one(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS
) -> DataFrame:
    """One row of ``docs``, unchanged, per component of fingerprints: that of its least id.

    Of several rows with the least id the least text hash's stays, and of equal ones
    any.  A component without ids keeps one row.
    """
    row_id, text = F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    # Two hashes and the length stand for the text, so that it need not travel.
    known = F.coalesce(text_col, F.lit(""))
    node = F.struct(
        F.xxhash64(known).alias("hash"), F.xxhash64(F.lit(SEED), known).alias("again"), F.length(known).alias("length")
    ).alias("_node")
    stored = cut_lineage(with_fingerprint(docs.select(row_id, node, text), "_text", words))
    at = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_node").alias("node"))
    placed = _with_component(stored, keep_root=True)
    wanted = placed.groupBy("_root").agg(F.min(at).alias("_at"))
    wanted = cut_lineage(
        wanted.select(F.col("_at.id").alias("_want_id"), F.col("_at.node").alias("_want_node"))
    )
    same = F.col("_id").eqNullSafe(F.col("_want_id")) & (F.col("_node") == F.col("_want_node"))
    whole = docs.select(row_id, node, F.struct("*").alias("_row"))
    # The rows of a wanted id and text are copies but for other columns.
    one = whole.join(wanted, same, "left_semi").dropDuplicates(["_id", "_node"])
    return one.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
