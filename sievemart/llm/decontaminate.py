"""Benchmark decontamination with DataFrame functions only.

Texts and benchmark items are lower-cased and split into words of letters and
digits.  A document's window is compared with items of its own size:

1. Windows lie where a document's 5-word shingle is also an item's: the window of
   the item's size that puts both shingles at the same place.  A window without a
   common shingle has a similarity of zero.
2. Each window and item gets a SimHash of its shingles, repeats included.
3. Multi-index search: fingerprints are cut into 8 blocks of a byte.  Two that
   differ in at most ``RADIUS`` = 23 bits have a block in which they differ in at
   most 2, so the items are listed under every value within 2 bits of each block
   and windows find, by equality of size, block and value, all items in the radius.
4. Pairs are verified by the exact similarity of their shingles, weighted by how
   often each occurs: common weight over joint weight, 0.8 at least.

An item shorter than five words is one shingle of its own length.

Defined results: NULL, empty and blank texts and items match nothing; windows at
a text's edges may be cut short by it; repeated rows give the same hits; of a
document's windows the most similar one is reported, the earliest of equal ones;
NULL ids are reported as such; other columns are ignored by ``find_leaks`` and
kept by ``remove_leaks``; an empty table or benchmark gives no hits.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemart.session import cut_lineage

SHINGLE = 5
SIMILARITY_PERCENT = 80
BLOCKS = 8
RADIUS = 23
BLOCK_RADIUS = RADIUS // BLOCKS

#: Rows of the items' shingle table up to which it is broadcast; beyond, Spark joins by shuffle.
BROADCAST_ROWS = 500_000

#: Differences of a byte in at most ``BLOCK_RADIUS`` bits, as numbers.
MASKS = [
    sum(1 << bit for bit in bits)
    for count in range(BLOCK_RADIUS + 1)
    for bits in itertools.combinations(range(8), count)
]


def words_of(text: Column) -> Column:
    plain = F.lower(F.coalesce(text, F.lit("")))
    return F.array_remove(F.split(plain, r"[^\p{L}\p{N}]+"), "")


def with_shingles(rows: DataFrame, words: str, size: int, name: str = "_shingles") -> DataFrame:
    """``rows`` plus the hashes of all ``size``-word shingles, in order, repeats included."""
    kept = rows.columns
    rows = rows.withColumn("_n", F.size(words)).withColumn(
        "_w1", F.transform(words, lambda w: F.xxhash64(w))
    )
    have = 1
    while have < size:
        step = min(have, size - have)
        longer = have + step
        part = f"slice(_w{have}, {{}}, greatest(size(_w{have}) - {step}, 0))"
        other = f"slice(_w{step}, {have + 1}, greatest(_n - {longer - 1}, 0))"
        rows = rows.withColumn(
            f"_w{longer}",
            F.expr(f"zip_with({part.format(1)}, {other}, (a, b) -> xxhash64(a, b))")
            if longer > 1
            else F.col("_w1"),
        ).withColumn(f"_w{longer}", F.expr(f"slice(_w{longer}, 1, greatest(_n - {longer - 1}, 0))"))
        have = longer
    return rows.select(*kept, F.col(f"_w{size}").alias(name))


def simhash(shingles: str) -> Column:
    """A bit is set if it is set in more than half of the hashes."""
    return F.expr(
        f"aggregate(sequence(0, 63), 0L, (all, bit) -> all | CASE WHEN 2 * aggregate({shingles}, 0,"
        f" (ones, h) -> ones + CAST(shiftrightunsigned(h, bit) & 1L AS INT)) > size({shingles})"
        " THEN shiftleft(1L, bit) ELSE 0L END)"
    )


def _block(fingerprint: str, number: Column) -> Column:
    return F.expr(f"CAST(shiftrightunsigned({fingerprint}, 8 * {number}) & 255L AS INT)")


def similarity(left: str, right: str) -> Column:
    """Common over joint weight of two lists of shingle hashes, in millionths rounded down."""
    common = (
        f"aggregate(array_intersect({left}, {right}), 0L, (t, h) -> t + least("
        f"size(filter({left}, x -> x = h)), size(filter({right}, x -> x = h))))"
    )
    return F.expr(f"{common} * 1000000 div (size({left}) + size({right}) - {common})")


def find_leaks(
    docs: DataFrame,
    items: DataFrame,
    keys: list[str],
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    percent: int = SIMILARITY_PERCENT,
) -> DataFrame:
    """A row per document key and item that it holds: start, similarity, differing bits.

    ``keys`` are the columns of ``docs`` that tell documents apart; documents with
    equal keys count as one.
    """
    items = items.select(F.col(item_id).alias("_item"), words_of(F.col(item_text)).alias("_words"))
    sized = items.select("*", F.size("_words").alias("_size")).filter(F.col("_size") > 0)
    sizes = [r[0] for r in sized.select(F.least("_size", F.lit(SHINGLE))).distinct().collect()]
    texts = docs.select(
        *[F.col(k).alias(f"_key{i}") for i, k in enumerate(keys)],
        words_of(F.col(text_col)).alias("_words"),
    )
    found = [
        _leaks_of(texts, sized.filter(F.least("_size", F.lit(SHINGLE)) == k), k, percent)
        for k in sorted(sizes) or [SHINGLE]
    ]
    every = found[0]
    for more in found[1:]:
        every = every.unionByName(more)
    best = F.struct("_similarity", -F.col("_start"), -F.col("_bits"))
    group = [f"_key{i}" for i in range(len(keys))]
    return (
        every.groupBy(*group, "_item")
        .agg(F.max(best).alias("_best"))
        .select(
            *[F.col(g).alias(k) for g, k in zip(group, keys, strict=True)],
            F.col("_item").alias("item_id"),
            (-F.col("_best")["col2"]).alias("first_word"),
            F.col("_best")["_similarity"].alias("similarity_ppm"),
            (-F.col("_best")["col3"]).alias("bits"),
        )
    )


def _leaks_of(texts: DataFrame, items: DataFrame, size: int, percent: int) -> DataFrame:
    """Leaks of the items whose shingles have ``size`` words."""
    group = [c for c in texts.columns if c.startswith("_key")]
    listed = with_shingles(items, "_words", size).select("_item", "_size", "_shingles")
    # Stored, as the windows are below, so that each fingerprint is computed once.
    listed = cut_lineage(listed.withColumn("_item_print", simhash("_shingles")))
    places = listed.select("_size", F.posexplode("_shingles").alias("_at", "_hash")).distinct()
    if places.count() <= BROADCAST_ROWS:
        places = F.broadcast(places)
    shingled = with_shingles(texts, "_words", size).select(*group, "_shingles")
    # The outer form: for the inner one Spark adds a filter on the array's size and,
    # pushing it below, computes the array several times more.
    hits = shingled.select(
        "*", F.posexplode_outer("_shingles").alias("_place", "_hash")
    ).join(places, "_hash")
    start = F.col("_place") - F.col("_at")
    length = F.col("_size") - (size - 1)
    windows = cut_lineage(
        hits.select(
            *group,
            "_size",
            start.alias("_start"),
            F.slice(
                "_shingles",
                F.greatest(start, F.lit(0)) + 1,
                length + F.least(start, F.lit(0)),
            ).alias("_window"),
        )
        .distinct()
        .withColumn("_print", simhash("_window"))
    )
    blocks = F.explode(F.sequence(F.lit(0), F.lit(BLOCKS - 1))).alias("_block")
    asked = windows.select("*", blocks).withColumn("_value", _block("_print", "_block"))
    masks = F.explode(F.array(*[F.lit(m) for m in MASKS])).alias("_mask")
    index = (
        listed.select("*", blocks)
        .select("*", masks)
        .withColumn("_value", F.expr("CAST(_mask AS INT)").bitwiseXOR(_block("_item_print", "_block")))
        .select("_item", "_size", "_block", "_value", "_item_print", F.col("_shingles").alias("_listed"))
    )
    bits = F.bit_count(F.col("_print").bitwiseXOR(F.col("_item_print")))
    # A pair may meet in several blocks; it is taken in the first.
    other = F.expr(
        f"filter(sequence(0, {BLOCKS - 1}), b -> bit_count(shiftrightunsigned(_print ^ _item_print,"
        f" 8 * b) & 255L) <= {BLOCK_RADIUS})[0]"
    )
    near = (
        asked.join(index, ["_size", "_block", "_value"])
        .filter((bits <= RADIUS) & (F.col("_block") == other))
        .withColumn("_similarity", similarity("_window", "_listed"))
    )
    return near.filter(F.col("_similarity") >= percent * 10_000).select(
        *group, "_item", "_start", "_similarity", bits.alias("_bits")
    )


def remove_leaks(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
    percent: int = SIMILARITY_PERCENT,
) -> DataFrame:
    """The rows of ``docs``, unchanged, whose text holds no benchmark item."""
    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(
        F.struct("*").alias("_row"),
        text.alias("_text"),
        F.xxhash64(text).alias("_hash"),
        F.octet_length(text).alias("_bytes"),
    )
    leaks = find_leaks(rows, items, ["_hash", "_bytes"], "_text", item_id, item_text, percent)
    clean = rows.join(leaks.select("_hash", "_bytes").distinct(), ["_hash", "_bytes"], "left_anti")
    return clean.select(*[F.col("_row")[c].alias(c) for c in docs.columns])
