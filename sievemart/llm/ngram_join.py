"""N-gram Jaccard join: a size-aware join of light and heavy sets.

Each text is the set of its distinct shingles; equal sets are one node.  Two sets
whose Jaccard similarity is at least ``percent`` / 100 share a number of shingles
that their sizes alone fix.  So sets below a size boundary are listed under every
subset of that number of their shingles, and two of them meet in a list exactly
where they are similar.  The subsets soon outnumber the shingles; sets above the
boundary are therefore found by scanning inverted lists of shingles, and only of
each set's rarest ones, of which two similar sets share at least one.  The boundary
is where the rows written as subsets plus the rows met in lists are fewest, counted
over all small sets.

In a list every set is first compared with the list's least one; once the components
of these links are known, all sets of a list that are still apart are.  A long list
is first split by a second shared shingle, of which similar sets have one too, and in
such a list those still apart are first compared with a few hubs, others in every list,
so that a family of near copies is connected before all that are apart are compared.
Sets pass five tests of rising cost, none of which loses a similar pair: sizes and
places, the parity of their counts in buckets, the difference of coarse counts, that of
counts as fine as the set is large, and the whole sets.  Where all that are apart are
compared, a pair becomes a row only if it has passed the first two.  Only the texts of
sets that reach the last test travel, one per set.

Which shingles are rare is read from a bounded sample; it decides the cost only.

Defined results: a NULL, empty or blank text has no shingles, and is its own
component; a text with fewer words than a shingle is one shingle; repeated rows share
a component; a component's number is its least id that is not NULL, or NULL if it has
none; texts of any length are read whole; other columns are ignored; an empty table
gives no rows.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, LongType

from sievemart.llm.common import schema_of, ship_code
from sievemart.llm.components import components
from sievemart.session import cut_lineage

WORDS = 3
PERCENT = 90
#: Sets with more subsets than this are heavy at any boundary.
MOST_SUBSETS = 512
#: Open lists longer than this are split by a second shingle.
SPLIT_LIST = 64
#: Members of a split list with which all others are compared first.
HUBS = 8
# Texts sampled for the order of shingles, and shingles kept of it.
ORDER_TEXTS = 16384
ORDER_MOST = 1 << 19
#: Coarse counts per set, and most of its fine ones.
BUCKETS = 64
MOST_BUCKETS = 1 << 16
#: Buckets of the parity sketch; a multiple of 64.
SKETCH_BITS = 512
#: Ranges of text hashes, of which those wanted are broadcast: no more rows than this.
HASH_RANGES = 1 << 20
#: Word hashes that a worker keeps.
KEPT_WORDS = 1 << 20

LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_ODD = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def _mix(x: np.ndarray) -> np.ndarray:
    """A bijection that spreads every bit of 64-bit numbers."""
    x = (x ^ (x >> np.uint64(30))) * _ODD[1]
    x = (x ^ (x >> np.uint64(27))) * _ODD[2]
    return x ^ (x >> np.uint64(31))


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= KEPT_WORDS:
            self.clear()
        self[word] = found = xxhash.xxh3_64_intdigest(word)
        return found


_hashes = _WordHashes()


def shingle_set(text: str | None, words: int = WORDS) -> np.ndarray:
    """The distinct hashes of the text's shingles, ascending."""
    found = (text or "").encode().translate(LOWER).split()
    if not found:
        return np.empty(0, dtype=np.uint64)
    of_word = np.fromiter(map(_hashes.__getitem__, found), dtype=np.uint64, count=len(found))
    count = max(len(found) - words + 1, 1)
    rolled = np.zeros(count, dtype=np.uint64)
    for place in range(min(words, len(found))):
        rolled = _mix(rolled * _ODD[0] + of_word[place : place + count] + np.uint64(place + 1))
    return np.unique(rolled)


def least_overlap(a: int, b: int, percent: int = PERCENT) -> int:
    """Shingles that sets of these sizes share if they are similar."""
    return -(-percent * (a + b) // (100 + percent))


def partner_sizes(n: int, percent: int = PERCENT) -> range:
    return range(-(-percent * n // 100), 100 * n // percent + 1)


def subset_sizes(n: int, percent: int = PERCENT) -> list[int]:
    """The sizes of subsets under which a light set of ``n`` shingles is listed."""
    return sorted({c for m in partner_sizes(n, percent) if (c := least_overlap(n, m, percent)) <= min(n, m)})


def subset_count(n: int, percent: int = PERCENT) -> int:
    return sum(comb(n, c) for c in subset_sizes(n, percent))


def light_sizes(percent: int = PERCENT) -> list[int]:
    """Sizes, from one on, whose sets may be light."""
    return list(itertools.takewhile(lambda n: subset_count(n, percent) <= MOST_SUBSETS, range(1, 100)))


def subset_keys(shingles: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """A hash of every subset of the wanted sizes: the sum without the left-out shingles."""
    n, keys = len(shingles), []
    for c in subset_sizes(n, percent):
        left_out = np.array(list(itertools.combinations(range(n), n - c)), dtype=np.int64).reshape(comb(n, c), n - c)
        sums = shingles.sum(dtype=np.uint64) - shingles[left_out].sum(axis=1, dtype=np.uint64)
        keys.append(_mix(sums + _mix(np.array([c], dtype=np.uint64))))
    return np.concatenate(keys)


def rarest(shingles: np.ndarray, common: np.ndarray, times: np.ndarray, percent: int = PERCENT) -> np.ndarray:
    """The shingles of which two similar sets share one, rarest first, and the next of them.

    All sets are in one order: by how often ``common`` (ascending) has a shingle,
    then by hash.  Without the last, the result is the set's prefix.
    """
    seen = np.zeros(len(shingles), dtype=np.int64)
    if len(common) and len(shingles):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        seen = np.where(common[at] == shingles, times[at], 0)
    size = len(shingles) + percent * -len(shingles) // 100 + 2
    return shingles[np.lexsort((shingles, seen))][:size]


def bucket_counts(shingles: np.ndarray, buckets: int) -> np.ndarray:
    """How many shingles fall in each of ``buckets`` (a power of two) ranges, 255 at most."""
    at = (shingles >> np.uint64(65 - buckets.bit_length())).astype(np.int64)
    return np.minimum(np.bincount(at, minlength=buckets), 255).astype(np.uint8)


def parity_sketch(shingles: np.ndarray) -> np.ndarray:
    """A bit per range of shingles: whether it holds an odd number of them.

    The bits in which two sets' sketches differ are no more than the shingles in which
    the sets do.
    """
    at = (shingles >> np.uint64(65 - SKETCH_BITS.bit_length())).astype(np.int64)
    odd = (np.bincount(at, minlength=SKETCH_BITS) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def fine_buckets(size: int) -> int:
    """A power of two of a quarter of the set's size or more, within the bounds."""
    return min(max(1 << (size // 4).bit_length(), BUCKETS), MOST_BUCKETS)


def counts_differ(a: bytes, b: bytes) -> int:
    """How far two sets' counts are apart: no more than the sets themselves are.

    The longer counts are folded to the shorter; counts cut at 255 stay so.
    """
    counts = [np.frombuffer(x, dtype=np.uint8).astype(np.int64) for x in (a, b)]
    buckets = min(map(len, counts))
    a, b = (np.minimum(x.reshape(buckets, -1).sum(axis=1), 255) for x in counts)
    return int(np.abs(a - b).sum())


def _listed_sizes(percent: int) -> Column:
    """The length of a set's prefix."""
    return F.col("_size") - F.ceil(F.col("_size") * percent / F.lit(100)) + 1


def _common_shingles(texts: DataFrame, words: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that several sampled texts have, ascending, and how many have each."""
    one_in = max(texts.count() // ORDER_TEXTS, 1)
    sampled = texts.filter(F.pmod(F.xxhash64("_text"), F.lit(one_in)) == 0)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [shingle_set(x, words) for x in batch.column("_text").to_pylist()]
            shingle, count = np.unique(np.concatenate(found), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(shingle.view(np.int64)), pa.array(count)], names=["_key", "_times"])

    counts = sampled.mapInArrow(keys, "_key long, _times long").groupBy("_key").agg(F.sum("_times").alias("_times"))
    top = counts.filter("_times > 1").orderBy(F.desc("_times"), "_key").limit(ORDER_MOST).toArrow()
    key, times = (top.column(x).to_numpy().astype(np.int64) for x in ("_key", "_times"))
    order = np.argsort(key.view(np.uint64))
    return key.view(np.uint64)[order], times[order]


_OF_SET = {"_digest": BinaryType(), "_size": LongType(), "_rare": ArrayType(LongType()),
           "_small": ArrayType(LongType()), "_odd": ArrayType(LongType()), "_profile": BinaryType(), "_fine": BinaryType()}


# Two hashes stand for a text, so that a wanted one is found without Python.
_TEXT_KEY = ("_hash", "_again")


def _describe(words: int, percent: int, shared):
    small = light_sizes(percent)[-1]

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, times = shared.value
        for batch in batches:
            sets = [shingle_set(x, words) for x in batch.column("_text").to_pylist()]
            longs = pa.list_(pa.int64())
            yield pa.RecordBatch.from_arrays(
                [
                    *[batch.column(x) for x in ("_id", *_TEXT_KEY)],
                    pa.array([xxhash.xxh3_128_digest(s.tobytes()) for s in sets], pa.binary()),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([rarest(s, common, times, percent).view(np.int64) for s in sets], longs),
                    pa.array([s.view(np.int64) if len(s) <= small else None for s in sets], longs),
                    pa.array([parity_sketch(s) for s in sets], longs),
                    pa.array([bucket_counts(s, BUCKETS).tobytes() for s in sets], pa.binary()),
                    pa.array([bucket_counts(s, fine_buckets(len(s))).tobytes() for s in sets], pa.binary()),
                ],
                names=["_id", *_TEXT_KEY, *_OF_SET],
            )

    return add


def _sets_of(words: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingle_set(x, words).view(np.int64) for x in batch.column("_text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("_node"), pa.array(sets, pa.list_(pa.int64()))], names=["_node", "_set"]
            )

    return add


def size_boundary(nodes: DataFrame, percent: int = PERCENT) -> int:
    """The size below which sets are light: the least cost over all small sets.

    A light set costs its subsets, a heavy one what it meets in its lists.
    """
    sizes = light_sizes(percent)
    small = nodes.filter(F.col("_size") <= sizes[-1])
    listed = small.select("_size", F.explode(F.expr("slice(_rare, 1, cast(_prefix as int))")).alias("_key"))
    by_key = listed.groupBy("_key", "_size").agg(F.count("*").alias("_rows"))
    length = by_key.groupBy("_key").agg(F.sum("_rows").alias("_length"))
    heavy = by_key.join(length, "_key").groupBy("_size").agg(F.sum(F.col("_rows") * (1 + F.col("_length"))).alias("_cost"))
    rows = {r["_size"]: r["count"] for r in small.groupBy("_size").count().collect()}
    met = {r["_size"]: r["_cost"] for r in heavy.collect()}
    costs = [
        sum(rows.get(n, 0) * subset_count(n, percent) if n < bound else met.get(n, 0) for n in sizes)
        for bound in range(1, sizes[-1] + 2)
    ]
    return 1 + costs.index(min(costs))


def _list_light(nodes: DataFrame, percent: int) -> DataFrame:
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [np.array(x, dtype=np.int64).view(np.uint64) for x in batch.column("_small").to_pylist()]
            keys = [np.unique(subset_keys(s, percent)) for s in sets]
            row = np.repeat(np.arange(len(sets)), [len(k) for k in keys])
            flat = np.concatenate(keys).view(np.int64) if keys else np.empty(0, dtype=np.int64)
            picked = [batch.column(x).take(pa.array(row)) for x in ("_node", "_size")]
            yield pa.RecordBatch.from_arrays([pa.array(flat), *picked], names=["_key", "_node", "_size"])

    return nodes.select("_node", "_size", "_small").mapInArrow(add, "_key long, _node long, _size long")


def list_sets(nodes: DataFrame, bound: int, percent: int = PERCENT) -> DataFrame:
    """Every set under its keys: ``_key``, ``_node``, ``_place``, and whether it is a list of subsets.

    A place is a set's size times 2**32 plus the shingle's number in the order.
    """
    reach = partner_sizes(bound, percent)[0]
    heavy = nodes.filter(F.col("_size") >= reach)
    heavy = heavy.select("_node", "_size", F.posexplode(F.expr("slice(_rare, 1, cast(_prefix as int))")).alias("_at", "_key"))
    place = F.shiftleft("_size", 32)
    listed = heavy.select("_key", "_node", place.bitwiseOR(F.col("_at").cast("long")).alias("_place"), F.lit(False).alias("_light"))
    light = _list_light(nodes.filter(F.col("_size") < bound), percent)
    return listed.union(light.select("_key", "_node", place.alias("_place"), F.lit(True)))


def _may_be_similar(a: str, b: str, percent: int) -> Column:
    """Whether sets that first meet at these places can be similar: the smaller rest is all they share."""
    sizes = [F.shiftright(x, 32) for x in (a, b)]
    rests = [F.shiftright(x, 32) - F.col(x).bitwiseAND(F.lit((1 << 32) - 1)) for x in (a, b)]
    return F.least(*rests) * (100 + percent) >= (sizes[0] + sizes[1]) * percent


def _sketches_near(a: str, b: str, sizes: Column, percent: int) -> Column:
    """Whether sets of these sketches, which have ``sizes`` shingles together, can be similar."""
    apart = [F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(SKETCH_BITS // 64)]
    return functools.reduce(Column.__add__, apart) * (100 + percent) <= sizes * (100 - percent)


def _pairs_of_lists(first: DataFrame, second: DataFrame, apart: Column, percent: int) -> DataFrame:
    """Distinct pairs, of one list and ``apart``, that sizes, places and sketches do not rule out."""
    sides = [
        rows.select("_key", "_light", *[F.col(c).alias(f"{c}_{x}") for c in ("_node", "_place", "_root", "_odd")])
        for rows, x in ((first, "a"), (second, "b"))
    ]
    sizes = F.shiftright("_place_a", 32) + F.shiftright("_place_b", 32)
    near = _may_be_similar("_place_a", "_place_b", percent) & _sketches_near("_odd_a", "_odd_b", sizes, percent)
    return (
        sides[0]
        .join(sides[1], ["_key", "_light"])
        .filter(apart & near)
        .select(F.least("_node_a", "_node_b").alias("a"), F.greatest("_node_a", "_node_b").alias("b"))
        .distinct()
    )


class _Verifier:
    """Tells which pairs of nodes are similar."""

    def __init__(self, docs: DataFrame, nodes: DataFrame, words: int, percent: int) -> None:
        self.docs, self.nodes, self.words, self.percent = docs, nodes, words, percent

    def __call__(self, pairs: DataFrame) -> DataFrame:
        """Of distinct pairs ``a``, ``b`` the similar ones; stored."""
        close = cut_lineage(self._close(pairs))
        about = cut_lineage(self._of_ends(close, self.nodes.select("_node", "_size", "_fine", "_text_key.*")))
        close = cut_lineage(self._closer(close, about))
        # Stored, so that its size is known: few wanted sets are broadcast.
        wanted = cut_lineage(self._of_ends(close, about.select("_node", "_id", *_TEXT_KEY)))
        if wanted.isEmpty():
            return close
        sets = cut_lineage(self._texts(wanted).mapInArrow(_sets_of(self.words), "_node long, _set array<bigint>"))
        sides = [sets.select(F.col("_node").alias(x), F.col("_set").alias(f"_of_{x}")) for x in "ab"]
        shared = F.size(F.array_intersect("_of_a", "_of_b"))
        similar = shared * (100 + self.percent) >= (F.size("_of_a") + F.size("_of_b")) * self.percent
        return cut_lineage(close.join(sides[0], "a").join(sides[1], "b").filter(similar).select("a", "b"))

    def _of_ends(self, pairs: DataFrame, nodes: DataFrame) -> DataFrame:
        """The rows of ``nodes`` that are in some pair."""
        return nodes.join(pairs.select(F.explode(F.array("a", "b")).alias("_node")).distinct(), "_node")

    def _texts(self, wanted: DataFrame) -> DataFrame:
        """Node and text of every wanted set.

        Before the join, documents whose hash is in no wanted one's range are left out by a
        broadcast of at most ``HASH_RANGES`` numbers, so that texts not wanted stay where they
        are.  Of copies only the row that the node names is taken.
        """
        in_range = F.pmod("_hash", F.lit(HASH_RANGES))
        ranges = wanted.select(in_range.alias("_in_range")).distinct()
        near = self.docs.withColumn("_in_range", in_range).join(F.broadcast(ranges), "_in_range", "left_semi")
        named = wanted.withColumnRenamed("_id", "_named")
        found = near.join(named, list(_TEXT_KEY)).filter(F.col("_id").eqNullSafe(F.col("_named")))
        return found.select("_node", "_text").dropDuplicates(["_node"])

    def _closer(self, pairs: DataFrame, about: DataFrame) -> DataFrame:
        """Pairs whose fine counts differ by no more than similar sets' can."""
        percent = self.percent
        sides = [
            about.select(F.col("_node").alias(x), F.col("_fine").alias(f"_of_{x}"), F.col("_size").alias(f"_size_{x}"))
            for x in "ab"
        ]

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                counts = zip(*[batch.column(f"_of_{x}").to_pylist() for x in "ab"], strict=True)
                apart = np.array([counts_differ(a, b) for a, b in counts], dtype=np.int64)
                sizes = sum(batch.column(f"_size_{x}").to_numpy() for x in "ab")
                near = pa.array(apart * (100 + percent) <= sizes * (100 - percent))
                yield batch.select(["a", "b"]).filter(near)

        return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(keep, "a long, b long")

    def _close(self, pairs: DataFrame) -> DataFrame:
        """Pairs whose coarse counts differ by no more than similar sets' can."""
        percent = self.percent
        sides = [
            self.nodes.select(F.col("_node").alias(x), F.col("_profile").alias(f"_of_{x}"), F.col("_size").alias(f"_size_{x}"))
            for x in "ab"
        ]

        def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                coarse = [
                    np.frombuffer(b"".join(batch.column(f"_of_{x}").to_pylist()), np.uint8).reshape(-1, BUCKETS).astype(np.int64)
                    for x in "ab"
                ]
                sizes = sum(batch.column(f"_size_{x}").to_numpy() for x in "ab")
                apart = np.abs(coarse[0] - coarse[1]).sum(axis=1)
                near = pa.array(apart * (100 + percent) <= sizes * (100 - percent))
                yield batch.select(["a", "b"]).filter(near)

        return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(keep, "a long, b long")


def _still_apart(members: DataFrame, links: DataFrame, sketches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Every linked node with its root, as links, and the members, with their sketches, of lists that have several roots."""
    roots = cut_lineage(components(links, "a", "b"))
    labelled = cut_lineage(
        members.select("_key", "_light", "_node", "_place")
        .join(roots, F.col("_node") == F.col("node"), "left")
        .select("_key", "_light", "_node", "_place", F.coalesce("root", "_node").alias("_root"))
    )
    open_lists = (
        labelled.groupBy("_key", "_light")
        .agg(F.count("*").alias("_length"), F.min("_root").alias("_least"), F.max("_root").alias("_most"))
        .filter(F.col("_least") != F.col("_most"))
        .select("_key", "_light", "_length")
    )
    open_ = cut_lineage(labelled.join(open_lists, ["_key", "_light"]).join(sketches, "_node"))
    return roots.select(F.col("node").alias("a"), F.col("root").alias("b")), open_


def _connect(listed: DataFrame, known: DataFrame, nodes: DataFrame, similar: _Verifier, split: bool) -> DataFrame:
    """Links that, with those of ``known``, connect all similar sets which meet in a list."""
    percent = similar.percent
    lists = (
        listed.groupBy("_key", "_light")
        .agg(
            F.min("_node").alias("_low"),
            F.max("_node").alias("_high"),
            F.min_by("_place", "_node").alias("_low_place"),
        )
        .filter(F.col("_low") != F.col("_high"))
        .drop("_high")
    )
    members = cut_lineage(listed.join(cut_lineage(lists), ["_key", "_light"]))
    hubs = members.filter((F.col("_node") != F.col("_low")) & _may_be_similar("_place", "_low_place", percent))
    pairs = hubs.select(F.col("_low").alias("a"), F.col("_node").alias("b")).distinct()
    sketches = nodes.select("_node", "_odd")
    links, open_ = _still_apart(members, known.union(similar(pairs)), sketches)
    if not split:
        rank = F.row_number().over(Window.partitionBy("_key", "_light").orderBy(F.xxhash64("_key", "_node"), "_node"))
        hubs = open_.withColumn("_rank", rank).filter(F.col("_rank") <= HUBS)
        pairs = _pairs_of_lists(open_, hubs, F.col("_root_a") != F.col("_root_b"), percent)
        links, open_ = _still_apart(open_, links.union(similar(pairs)), sketches)
    is_long = (F.col("_length") > SPLIT_LIST) & ~F.col("_light") if split else F.lit(False)
    short = open_.filter(~is_long)
    across = _pairs_of_lists(short, short, F.col("_root_a") < F.col("_root_b"), percent)
    links = links.union(similar(across))
    long_ = open_.filter(is_long)
    if not split or long_.isEmpty():
        return links
    # Similar sets share two of these: one of the prefix, and a later one.
    at = F.col("_place").bitwiseAND(F.lit((1 << 32) - 1)).cast("int")
    later = long_.join(nodes.select("_node", "_rare"), "_node").select(
        "_key", "_node", "_place", F.explode(F.slice("_rare", at + 2, F.size("_rare"))).alias("_next")
    )
    twice = later.select(F.xxhash64("_key", "_next").alias("_key"), "_node", "_place", F.lit(False).alias("_light"))
    return _connect(cut_lineage(twice), links, nodes, similar, split=False)


def similar_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, percent: int = PERCENT
) -> DataFrame:
    """Per row: the id, how many shingles its set has, and its component."""
    ship_code(docs.sparkSession)
    text = F.coalesce(text_col, F.lit(""))
    hashes = [F.xxhash64(text).alias("_hash"), F.xxhash64(F.lit(1), text).alias("_again")]
    rows = docs.select(F.col(id_col).alias("_id"), *hashes, text.alias("_text"))
    shared = docs.sparkSession.sparkContext.broadcast(_common_shingles(rows.select("_text"), words))
    kept = {x: rows.schema[x].dataType for x in ("_id", *_TEXT_KEY)}
    schema = schema_of(kept | _OF_SET)
    stored = cut_lineage(rows.mapInArrow(_describe(words, percent, shared), schema))
    whole = ("_size", "_rare", "_small", "_odd", "_profile", "_fine")
    nodes = (
        stored.filter("_size > 0")
        .groupBy("_digest")
        .agg(F.min("_id").alias("_least"), F.min(F.struct(*_TEXT_KEY, "_id")).alias("_text_key"), *[F.first(x).alias(x) for x in whole])
        .withColumns({"_node": F.monotonically_increasing_id(), "_prefix": _listed_sizes(percent)})
    )
    nodes = cut_lineage(nodes)
    listed = list_sets(nodes, size_boundary(nodes, percent), percent)
    nothing = docs.sparkSession.createDataFrame([], "a long, b long")
    similar = _Verifier(rows, nodes, words, percent)
    links = _connect(listed, nothing, nodes, similar, split=True)
    rooted = nodes.join(components(links, "a", "b"), F.col("_node") == F.col("node"), "left").select(
        "_digest", "_least", F.coalesce("root", "_node").alias("_root")
    )
    rooted = cut_lineage(rooted)
    of_root = rooted.groupBy("_root").agg(F.min("_least").alias("_component"))
    of_set = cut_lineage(rooted.join(of_root, "_root").select("_digest", "_component"))
    counted = stored.select("_id", "_digest", "_size").join(of_set, "_digest", "left")
    return counted.select(
        F.col("_id").alias(id_col),
        F.col("_size").alias("n_shingles"),
        F.when(F.col("_size") > 0, F.col("_component")).otherwise(F.col("_id")).alias("component_id"),
    )
