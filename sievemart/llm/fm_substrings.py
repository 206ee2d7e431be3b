"""Repeated passages of documents by FM-indexes over shards.

A window is ``window`` consecutive words of one document; it is repeated if its
words start at another place too, in the same document or elsewhere.

1. Every window gets a key: the least hash among the word 8-grams inside it.
   Equal windows have equal keys, and neighbouring windows mostly share one; a
   run of windows with one key is a segment.  Keys are counted over all
   documents, combined before the shuffle.  A window whose key occurs once
   cannot be repeated and goes no further.
2. The other segments are cut from their texts and dealt to shards by key, each
   distinct text of a segment once per task, with a weight that counts copies.
   Segments of a very frequent key are dealt window by window, by the window's
   own hash, so that no key makes a shard grow with the data.
3. Each shard builds a compressed FM-index over its segments and takes, by
   backward search over the wavelet tree, the matching statistics of the
   segments streamed against it.  Windows matched in full by a weight of two or
   more are marked.  Words are compared as they are, not by hash.
4. Marks go back to the documents, by a hash of the segment's words, and every
   word that a marked window covers is reported and removed.

Defined results: a NULL or blank text has no words; a text with fewer words than
a window keeps them all; repeated rows make each other's windows repeated;
removal is judged on the input; texts of any length are read whole; a NULL id
stays NULL; other columns are passed on by ``remove_repeats``; an empty table
gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from sievemart.llm.common import schema_of, ship_code
from sievemart.llm.fm_index import FmIndex
from sievemart.session import cut_lineage

WINDOW = 35
GRAM = 8
SHARD_WORDS = 400_000
HOT_SEGMENTS = 1000  # a key with more is dealt window by window

BLOCK = 1 << 20
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_BYTE = np.random.default_rng(7).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_BASE = 0x9E3779B97F4A7C15
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class _Powers:
    """Powers of the base and of its inverse modulo 2**64, as far as needed."""

    up = np.ones(1, dtype=np.uint64)
    down = np.ones(1, dtype=np.uint64)

    @classmethod
    def reach(cls, size: int) -> None:
        if len(cls.up) >= size:
            return
        size = max(size, BLOCK + 1)
        up = np.full(size, _BASE, dtype=np.uint64)
        down = np.full(size, pow(_BASE, -1, 1 << 64), dtype=np.uint64)
        up[0] = down[0] = 1
        cls.up, cls.down = np.cumprod(up), np.cumprod(down)


def _mixed(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    h = (a * np.uint64(_BASE)) ^ (b + (a >> np.uint64(29)))
    h *= _MIX
    return h ^ (h >> np.uint64(32))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the words of UTF-8 bytes start and end."""
    word = np.zeros(len(data) + 2, dtype=np.int8)
    word[1:-1] = ~_SPACE[data]
    edges = np.diff(word)
    return np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash per word; equal words have equal hashes."""
    hashes = np.empty(len(starts), dtype=np.uint64)
    at = 0
    while at < len(starts):
        origin = int(starts[at])
        upto = max(int(np.searchsorted(ends, origin + BLOCK, side="right")), at + 1)
        size = int(ends[upto - 1]) - origin
        _Powers.reach(size + 1)
        sums = np.zeros(size + 1, dtype=np.uint64)
        np.cumsum(_BYTE[data[origin : origin + size]] * _Powers.up[:size], out=sums[1:])
        s, e = starts[at:upto] - origin, ends[at:upto] - origin
        hashes[at:upto] = (sums[e] - sums[s]) * _Powers.down[s]
        at = upto
    return _mixed(hashes, (ends - starts).astype(np.uint64))


def segments_of(texts: list[bytes], window: int, gram: int) -> dict[str, np.ndarray]:
    """Segments of some texts: text number, first window, windows, key and weight."""
    sizes = np.array([len(t) + 1 for t in texts])
    bounds = np.cumsum(sizes) - sizes
    data = np.frombuffer(b"\n".join(texts), dtype=np.uint8)
    starts, ends = word_spans(data)
    nothing = np.zeros(0, dtype=np.int64)
    if len(starts) < window:
        return dict.fromkeys(("text", "start", "windows", "key", "weight"), nothing)
    grams, width = word_hashes(data, starts, ends), 1
    while width < gram:
        step = min(width, gram - width)
        grams, width = _mixed(grams[:-step], grams[step:]), width + step
    keys, width, wide = grams, 1, window - gram + 1
    while width < wide:
        step = min(width, wide - width)
        keys, width = np.minimum(keys[:-step], keys[step:]), width + step
    text = np.searchsorted(bounds, starts, side="right") - 1
    first_word = np.searchsorted(starts, bounds)
    inside = np.flatnonzero(text[: len(keys)] == text[window - 1 : window - 1 + len(keys)])
    if not len(inside):
        return dict.fromkeys(("text", "start", "windows", "key", "weight"), nothing)
    key = keys[inside]
    fresh = np.r_[True, (key[1:] != key[:-1]) | (np.diff(inside) != 1)]
    run = np.flatnonzero(fresh)
    place = np.arange(len(inside)) - np.repeat(run, np.diff(np.r_[run, len(inside)]))
    cut = np.flatnonzero(place % wide == 0)
    chosen = key[cut]
    ordered = np.sort(grams)
    times = np.searchsorted(ordered, chosen, side="right") - np.searchsorted(ordered, chosen)
    number = text[inside[cut]]
    return {
        "text": number,
        "start": inside[cut] - first_word[number],
        "windows": np.diff(np.r_[cut, len(inside)]),
        "key": chosen.view(np.int64),
        # A gram that occurs twice may belong to two equal windows of one run.
        "weight": np.minimum(times, 2).astype(np.int64),
    }


def _blocks(texts: list[bytes]) -> Iterator[tuple[int, list[bytes]]]:
    """Consecutive texts of about ``BLOCK`` bytes, and the number of the first."""
    first, size = 0, 0
    for at, text in enumerate(texts):
        if size and size + len(text) > BLOCK:
            yield first, texts[first:at]
            first, size = at, 0
        size += len(text)
    if first < len(texts):
        yield first, texts[first:]


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _digest(content: bytes) -> int:
    return _signed(xxhash.xxh64_intdigest(content, 1))


def _units(words: list[bytes], segment: dict, window: int) -> Iterator[tuple[int, int, bytes]]:
    """What a segment sends to a shard: first word, route and words."""
    start, count, key = segment["start"], segment["windows"], segment["key"]
    if not segment["hot"]:
        yield start, key, b" ".join(words[start : start + count + window - 1])
        return
    for at in range(start, start + count):
        content = b" ".join(words[at : at + window])
        yield at, _signed(xxhash.xxh64_intdigest(content)), content


def mark_windows(contents: list[bytes], weights: np.ndarray, window: int) -> list[int]:
    """Per content a bit for each of its windows that occurs with a weight of two or more."""
    numbers: dict[bytes, int] = {}
    segments = []
    for content in contents:
        words = content.split(b" ")
        segments.append(
            np.fromiter((numbers.setdefault(w, len(numbers) + 1) for w in words), np.int64, len(words))
        )
    index = FmIndex(segments, weights, window)
    counts = np.array([len(s) - window + 1 for s in segments])
    owner = np.repeat(np.arange(len(segments)), counts)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(counts) - counts, counts)
    found = index.matching_statistics(index.starts[owner] + place + window, window, 2) >= window
    masks = [0] * len(contents)
    for at in np.flatnonzero(found).tolist():
        masks[owner[at]] |= 1 << int(place[at])
    return masks


def covered_words(count: int, marks: list[dict], window: int) -> np.ndarray:
    """Which of a text's words a marked window covers."""
    change = np.zeros(count + 1, dtype=np.int64)
    for mark in marks:
        bits, at = mark["mask"], mark["start"]
        while bits:
            if bits & 1:
                change[at] += 1
                change[at + window] -= 1
            bits, at = bits >> 1, at + 1
    return np.cumsum(change[:-1]) > 0


def _spans(covered: np.ndarray) -> list[dict]:
    edges = np.diff(np.r_[0, covered.astype(np.int8), 0])
    return [
        {"first": int(a), "last": int(b) - 1}
        for a, b in zip(np.flatnonzero(edges == 1), np.flatnonzero(edges == -1), strict=True)
    ]


TEXT_ID = ["_hash", "_bytes"]


def _marks(texts: DataFrame, window: int, gram: int) -> DataFrame:
    """``texts`` (with ``_text``, ``_hash``, ``_bytes``) plus ``_marks``: marked windows."""
    spark = texts.sparkSession

    def segment(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, some in _blocks(batch.column("_text").to_pylist()):
                found = segments_of(some, window, gram)
                rows = pa.array(found["text"] + first)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(found["key"]),
                        batch.column("_hash").take(rows),
                        batch.column("_bytes").take(rows),
                        pa.array(found["start"], pa.int32()),
                        pa.array(found["windows"], pa.int32()),
                        pa.array(found["weight"]),
                    ],
                    names=["key", "_hash", "_bytes", "start", "windows", "weight"],
                )

    schema = "key long, _hash long, _bytes int, start int, windows int, weight long"
    segments = texts.select(*TEXT_ID, "_text").mapInArrow(segment, schema)
    repeated = (
        segments.groupBy("key")
        .agg(F.sum("weight").alias("total"))
        .filter(F.col("total") > 1)
        .select("key", (F.col("total") > HOT_SEGMENTS).alias("hot"))
    )
    candidates = (
        segments.drop("weight")
        .join(repeated, "key")
        .groupBy(*TEXT_ID)
        .agg(F.collect_set(F.struct("start", "windows", "key", "hot")).alias("_segments"))
    )
    copies = texts.groupBy(*TEXT_ID).agg(F.least(F.count("*"), F.lit(2)).alias("_copies"))
    placed = cut_lineage(texts.join(candidates.join(copies, TEXT_ID), TEXT_ID, "left"))
    open_ = placed.filter(F.col("_segments").isNotNull())
    words = F.aggregate(
        "_segments",
        F.lit(0).cast("long"),
        lambda t, s: t
        + F.when(s["hot"], s["windows"] * window).otherwise(s["windows"] + (window - 1)),
    )
    total = open_.agg(F.sum(words)).first()[0] or 0
    shards = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // SHARD_WORDS))

    def fresh_rows(batch: pa.RecordBatch, last: list) -> Iterator[dict]:
        """Rows of a batch, without those whose text came just before."""
        for row in batch.to_pylist():
            if (row["_hash"], row["_bytes"]) != last[0]:
                last[0] = (row["_hash"], row["_bytes"])
                yield row

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[tuple[int, bytes], int] = {}
        size, last = 0, [None]

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_pydict(
                {
                    "shard": pa.array([r % shards for r, _ in seen], pa.int64()),
                    "route": pa.array([r for r, _ in seen], pa.int64()),
                    "content": pa.array([c for _, c in seen], pa.binary()),
                    "weight": pa.array(list(seen.values()), pa.int64()),
                }
            )

        for batch in batches:
            for row in fresh_rows(batch, last):
                split = row["_text"].split()
                for piece in row["_segments"]:
                    for _, route, content in _units(split, piece, window):
                        if (route, content) not in seen:
                            size += len(content) + 100
                        seen[route, content] = seen.get((route, content), 0) + row["_copies"]
                if size > 16 * BLOCK:
                    yield out()
                    seen, size = {}, 0
        yield out()

    def mark(key: tuple, rows: pa.Table) -> pa.Table:
        seen: dict[tuple[int, bytes], int] = {}
        parts = (rows[c].to_pylist() for c in ("route", "content", "weight"))
        for route, content, weight in zip(*parts, strict=True):
            seen[route, content] = seen.get((route, content), 0) + weight
        contents = [c for _, c in seen]
        masks = mark_windows(contents, np.array(list(seen.values())), window)
        found = [(r, _digest(c), m) for (r, c), m in zip(seen, masks, strict=True) if m]
        return pa.table(
            {
                "route": pa.array([r for r, _, _ in found], pa.int64()),
                "content_hash": pa.array([h for _, h, _ in found], pa.int64()),
                "mask": pa.array([m for _, _, m in found], pa.int64()),
            }
        )

    def occurrences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = [None]
        for batch in batches:
            made = []
            for row in fresh_rows(batch, last):
                split = row["_text"].split()
                for piece in row["_segments"]:
                    made += [
                        (row["_hash"], row["_bytes"], start, route, _digest(content))
                        for start, route, content in _units(split, piece, window)
                    ]
            columns = list(zip(*made, strict=True)) if made else [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)],
                names=[*TEXT_ID, "start", "route", "content_hash"],
            )

    marked = (
        open_.select("_text", "_segments", "_copies", *TEXT_ID)
        .mapInArrow(send, "shard long, route long, content binary, weight long")
        .groupBy("shard")
        .applyInArrow(mark, "route long, content_hash long, mask long")
    )
    marks = (
        open_.select("_text", "_segments", *TEXT_ID)
        .mapInArrow(occurrences, "_hash long, _bytes int, start int, route long, content_hash long")
        .join(marked, ["route", "content_hash"])
        .groupBy(*TEXT_ID)
        .agg(F.collect_set(F.struct("start", "mask")).alias("_marks"))
    )
    nothing = F.lit(None).cast(marks.schema["_marks"].dataType)
    rest = placed.filter(F.col("_segments").isNull()).withColumn("_marks", nothing)
    done = open_.join(marks, TEXT_ID, "left")
    return done.unionByName(rest).drop("_segments", "_copies")


def repeated_passages(
    docs: DataFrame, text_col: str = "text", window: int = WINDOW, gram: int = GRAM, as_is: bool = False
) -> DataFrame:
    """Per row of ``docs``: its other columns in ``row``, words, repeated spans, kept text.

    ``row`` has the columns but the text as ``c0``, ``c1``, ... and ``no_text``,
    which tells a NULL text.  ``spans`` lists the first and last word of each
    stretch covered by repeated windows; ``kept`` joins the other words by one
    space, or with ``as_is`` is the text itself if nothing is removed.
    """
    if not 0 < window - gram + 1 <= 63 or gram < 1:
        raise ValueError("a window must be at least as long as a gram and at most 62 words longer")
    ship_code(docs.sparkSession)
    text = F.coalesce(text_col, F.lit("")).cast("binary")
    others = [c for c in docs.columns if c != text_col]
    # The text travels once, not in the row as well.
    row = F.struct(
        *[F.col(c).alias(f"c{i}") for i, c in enumerate(others)], F.col(text_col).isNull().alias("no_text")
    )
    texts = docs.select(
        row.alias("_row"),
        text.alias("_text"),
        F.xxhash64(text).alias("_hash"),
        F.octet_length(text).alias("_bytes"),
    )

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            counts, removed, spans, kept = [], [], [], []
            for data, marks in zip(*(batch.column(c).to_pylist() for c in ("_text", "_marks")), strict=True):
                words = data.split()
                counts.append(len(words))
                if marks:
                    covered = covered_words(len(words), marks, window)
                    removed.append(int(covered.sum()))
                    spans.append(_spans(covered))
                    words = [w for w, gone in zip(words, covered.tolist(), strict=True) if not gone]
                else:
                    removed.append(0)
                    spans.append([])
                kept.append((data if as_is and not marks else b" ".join(words)).decode())
            span = pa.list_(pa.struct([("first", pa.int32()), ("last", pa.int32())]))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("_row"),
                    pa.array(counts, pa.int64()),
                    pa.array(removed, pa.int64()),
                    pa.array(spans, span),
                    pa.array(kept, pa.string()),
                ],
                names=["row", "n_words", "n_removed", "spans", "kept"],
            )

    added = "n_words long, n_removed long, spans array<struct<first:int,last:int>>, kept string"
    schema = schema_of({"row": texts.schema["_row"].dataType}, StructType.fromDDL(added))
    return _marks(texts, window, gram).select("_row", "_text", "_marks").mapInArrow(finish, schema)


def removal_report(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW
) -> DataFrame:
    """Per row: id, words, removed words, their spans and the text that is left."""
    found = repeated_passages(docs.select(id_col, text_col), text_col, window)
    return found.select(F.col("row")["c0"].alias(id_col), "n_words", "n_removed", "spans", "kept")


def remove_repeats(
    docs: DataFrame, text_col: str = "text", window: int = WINDOW, length_col: str | None = None
) -> DataFrame:
    """The rows of ``docs`` with repeated passages taken out of the text.

    A text without any keeps its own white space, and a NULL stays NULL.  If
    ``docs`` has a column ``length_col``, it gets a changed text's characters.
    """
    found = repeated_passages(docs, text_col, window, as_is=True)
    others = [c for c in docs.columns if c != text_col]
    columns = []
    for field in docs.schema:
        if field.name == text_col:
            value = F.when(~F.col("row")["no_text"], F.col("kept"))
        else:
            value = F.col("row")[f"c{others.index(field.name)}"]
        if field.name == length_col:
            length = F.char_length("kept").cast(field.dataType)
            value = F.when(F.col("n_removed") > 0, length).otherwise(value)
        columns.append(value.alias(field.name))
    return found.select(*columns)
