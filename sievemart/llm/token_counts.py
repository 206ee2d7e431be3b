"""Token counts of whole texts by a two-tier lookup in the tasks.

First pass: every task counts the chunks of all its texts (see ``tokens``) and hands
its counts on, whenever it holds ``TASK_CHUNKS`` chunks and at its end; they are summed
per chunk, so the totals are exact.  The most frequent chunks of all texts,
``TABLE_CHUNKS`` at most (ties as they come), are broadcast with their lengths in tokens.  Second pass:
each text's length is the sum over its chunks, from the broadcast table, else from the
worker's cache, else from the tokenizer.  Texts are never shuffled, only the counts.
Counts of tokens are exact whatever the table holds; it only saves work.

Defined results: a NULL or empty text has no tokens and no bytes; repeated rows
are counted alike; a NULL id stays NULL; other columns are ignored; an empty
table gives an empty result; texts of any length are counted whole.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sievemart.llm.common import ship_code
from sievemart.llm.tokens import LONG_CHUNK, KEPT_CHUNKS, Encoder, chunks, default_vocabulary
from sievemart.session import cut_lineage, intermediates

#: Entries of the broadcast table, and chunks that a task counts before it hands them on.
TABLE_CHUNKS = 32_768
TASK_CHUNKS = 200_000

LIMIT = 1024


def _handed_on(seen: Counter[str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_pydict(
        {"chunk": pa.array(list(seen), pa.string()), "seen": pa.array(list(seen.values()), pa.int64())}
    )


def _count_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How often each chunk is in a task's texts; a chunk may come in several parts."""
    seen: Counter[str] = Counter()
    for batch in batches:
        for text in batch.column(0).to_pylist():
            seen.update(c for c in chunks(text or "")[1:] if len(c) <= LONG_CHUNK)
            if len(seen) >= TASK_CHUNKS:
                yield _handed_on(seen)
                seen.clear()
    yield _handed_on(seen)


def frequent_chunks(docs: DataFrame, text_col: str = "text", size: int = TABLE_CHUNKS) -> list[str]:
    """At most ``size`` chunks, those most frequent over all texts."""
    ship_code(docs.sparkSession)
    parts = docs.select(F.col(text_col).alias("text")).mapInArrow(_count_chunks, "chunk string, seen long")
    with intermediates(docs.sparkSession):
        total = cut_lineage(parts.groupBy("chunk").agg(F.sum("seen").alias("seen")))
        # By counts first, so that no task sends more to the driver than the table holds.
        by_count = total.groupBy("seen").agg(F.count("*").alias("rows")).orderBy(F.desc("seen")).limit(size)
        least, found = None, 0
        for row in by_count.collect():
            if found + row["rows"] > size:
                break
            least, found = row["seen"], found + row["rows"]
        top = total.filter(F.col("seen") >= least).collect() if found else []
        tied = total if least is None else total.filter(F.col("seen") < least)
        most = tied.agg(F.max("seen")).first()[0] if found < size else None
        if most is not None:
            top += total.filter(F.col("seen") == most).limit(size - found).collect()
    return [row["chunk"] for row in sorted(top, key=lambda row: (-row["seen"], row["chunk"]))]


class _Counts:
    """Lengths of chunks in one worker: the broadcast table, then its own cache."""

    _cache: dict[str, dict[str, int]] = {}

    def __init__(self, vocabulary: str, table: dict[str, int]) -> None:
        self.encoder = Encoder.load(vocabulary)
        self.table = table
        self.cache = self._cache.setdefault(vocabulary, {})

    def of(self, text: str) -> int:
        encoder = self.encoder
        if not text:
            return 0
        if encoder.whole_only(text):
            return len(encoder.encode_all([text])[0]) // 4
        first, *rest = chunks(text)
        total = len(encoder.encode_all([first])[0]) // 4 if first else 0
        found = list(map(self.table.get, rest))
        missed = [c for c, n in zip(rest, found, strict=True) if n is None]
        if missed:
            total += sum(n for n in found if n is not None) + self._missed(missed)
        else:
            total += sum(found)
        return total

    def _missed(self, missed: list[str]) -> int:
        found = list(map(self.cache.get, missed))
        new = list({c for c, n in zip(missed, found, strict=True) if n is None})
        if not new:
            return sum(found)
        lengths = {
            c: len(ids) // 4
            for c, ids in zip(new, self.encoder.encode_all([" " + c for c in new]), strict=True)
        }
        total = sum(lengths[c] if n is None else n for c, n in zip(missed, found, strict=True))
        if len(self.cache) + len(lengths) > KEPT_CHUNKS:
            self.cache.clear()
        self.cache.update((c, n) for c, n in lengths.items() if len(c) <= LONG_CHUNK)
        return total


def count_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    vocabulary: str | None = None,
    limit: int = LIMIT,
) -> DataFrame:
    """Per row: the id, bytes, tokens, and whether the tokens exceed ``limit``."""
    spark = docs.sparkSession
    vocabulary = vocabulary or default_vocabulary()
    frequent = frequent_chunks(docs, text_col)
    encoded = Encoder.load(vocabulary).encode_all([" " + c for c in frequent])
    table = {c: len(ids) // 4 for c, ids in zip(frequent, encoded, strict=True)}
    shared = spark.sparkContext.broadcast(table)

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = _Counts(vocabulary, shared.value)
        for batch in batches:
            found = [counts.of(text) for text in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("n_bytes"), pa.array(found, pa.int64())],
                names=["id", "n_bytes", "n_tokens"],
            )

    text = F.coalesce(text_col, F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), F.octet_length(text).cast("long").alias("n_bytes"), text.alias("text")
    )
    id_type = rows.schema["id"].dataType.simpleString()
    counted = rows.mapInArrow(lengths, f"id {id_type}, n_bytes long, n_tokens long")
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )
