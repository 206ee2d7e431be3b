"""Alignment of two tokenizers' tokens over the same bytes, by merge-path pieces.

Both token lists of a text are sequences of byte ends.  Merging them is cut into
pieces of equal work: a binary search on each diagonal of the merge finds how many
tokens of either list precede it, with equal ends kept in one piece.  Each piece
finds its shared ends by itself, emits the token pairs that end there as links, and
gives its tokens before the first shared end and after the last as open ends, which
are stitched with those of the neighbouring pieces into groups.  Texts of one piece
are done where they are encoded; pieces of longer ones are dealt over all tasks.

How often a pair of ids is linked is counted over the whole corpus.  The most
frequent pairs are a broadcast table of at most ``TABLE_PAIRS`` entries; the pairs
of a text that are not in it meet their counts in a join, in which no key is hot,
as the hot ones are in the table.

Defined results: NULL and empty texts, and those whose joined token bytes of either
side are not the text after a space, have no tokens, zeros and an empty digest;
repeated rows each count; a NULL id stays NULL; texts of any length are aligned
whole; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from sievemart.llm.common import schema_of, ship_code
from sievemart.llm.tokens import RankEncoder, default_ranks
from sievemart.session import cut_lineage

#: Tokens of both sides in one piece of the merge.
PIECE_WORK = 1 << 16
#: Id pairs in the broadcast table; 24 bytes each.
TABLE_PAIRS = 1 << 18
#: Links that a counting task holds before it hands on their sums.
HELD_LINKS = 1 << 22

_LONG, _TEXT, _LONGS, _INTS = LongType(), StringType(), ArrayType(LongType()), ArrayType(IntegerType())
_ALIGNED = schema_of(
    {"n_a": _LONG, "n_b": _LONG, "n_groups": _LONG, "n_links": _LONG, "groups_sha256": _TEXT}
    | {"_pairs": _LONGS, "_times": _LONGS}
)
_PIECE = schema_of({"_piece": IntegerType(), "_a": _INTS, "_b": _INTS, "_a_start": _LONG, "_b_start": _LONG})
_MERGED = schema_of(
    {"_piece": IntegerType(), "_n_a": _LONG, "_n_b": _LONG, "_shared": _LONG, "_body": _TEXT}
    | {name: _TEXT for name in ("_head_a", "_head_b", "_tail_a", "_tail_b")}
    | {"_pairs": _LONGS, "_times": _LONGS}
)


def default_pieces() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class PieceEncoder:
    """Ids and bytes of the tokens of a vocabulary with byte fallback."""

    _loaded: dict[str, PieceEncoder] = {}

    def __init__(self, model: str) -> None:
        from sentencepiece import SentencePieceProcessor

        self.model = SentencePieceProcessor(model_file=model)
        self.bytes_of = [self._bytes(i) for i in range(self.model.get_piece_size())]

    def _bytes(self, number: int) -> bytes:
        piece = self.model.id_to_piece(number)
        if self.model.is_byte(number):
            return bytes([int(piece[3:5], 16)])
        return piece.replace("▁", " ").encode()

    @classmethod
    def load(cls, model: str) -> PieceEncoder:
        if model not in cls._loaded:
            cls._loaded[model] = cls(model)
        return cls._loaded[model]


class _Aligner:
    """Both encoders of a worker and the texts of their ids."""

    _loaded: dict[tuple[str, str], _Aligner] = {}

    def __init__(self, ranks: str, model: str) -> None:
        self.a = RankEncoder.load(ranks).encoding
        self.b = PieceEncoder.load(model)
        a_bytes = [b""] * self.a.n_vocab
        for token in self.a.token_byte_values():
            a_bytes[self.a.encode_single_token(token)] = token
        self.a_bytes, self.b_bytes = a_bytes, self.b.bytes_of
        self.a_sizes = np.array([len(x) for x in a_bytes], dtype=np.int64)
        self.b_sizes = np.array([len(x) for x in self.b_bytes], dtype=np.int64)

    @classmethod
    def load(cls, ranks: str, model: str) -> _Aligner:
        if (ranks, model) not in cls._loaded:
            cls._loaded[ranks, model] = cls(ranks, model)
        return cls._loaded[ranks, model]

    def encode(self, text: str | None) -> tuple[np.ndarray, np.ndarray] | None:
        """Ids of both sides, or None where the text counts as having no tokens."""
        if not text:
            return None
        spaced = " " + text
        a = self.a.encode_to_numpy(spaced, disallowed_special=()).astype(np.int64)
        b = self.b.model.encode(text)
        whole = spaced.encode()
        if b"".join([self.b_bytes[i] for i in b]) != whole:
            return None
        if b"".join([self.a_bytes[i] for i in a.tolist()]) != whole:
            return None
        return a, np.array(b, dtype=np.int64)

    def ends(self, a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return np.cumsum(self.a_sizes[a]), np.cumsum(self.b_sizes[b])


def merge_cuts(a_ends: np.ndarray, b_ends: np.ndarray, work: int = PIECE_WORK) -> tuple[np.ndarray, np.ndarray]:
    """Where every ``work`` tokens of the merge end: places in ``a`` and in ``b``.

    All diagonals are searched at once.  On equal ends ``a`` comes first; a cut
    between two equal ends moves behind both.
    """
    n, m = len(a_ends), len(b_ends)
    diagonal = np.append(np.arange(work, n + m, work), n + m)
    low, high = np.maximum(diagonal - m, 0), np.minimum(diagonal, n)
    while (searching := low < high).any():
        middle = (low + high) // 2
        before = a_ends[np.minimum(middle, n - 1)] <= b_ends[np.clip(diagonal - 1 - middle, 0, m - 1)]
        low = np.where(searching & before, middle + 1, low)
        high = np.where(searching & ~before, middle, high)
    at_a, at_b = low, diagonal - low
    tied = (at_a > 0) & (at_b < m)
    tied[tied] = a_ends[at_a[tied] - 1] == b_ends[at_b[tied]]
    return np.insert(at_a, 0, 0), np.insert(at_b + tied, 0, 0)


def shared_ends(a_ends: np.ndarray, b_ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places in ``a`` and in ``b`` of the tokens that end together."""
    if not len(a_ends) or not len(b_ends):
        return np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
    at = np.minimum(np.searchsorted(b_ends, a_ends), len(b_ends) - 1)
    in_a = np.flatnonzero(b_ends[at] == a_ends)
    return in_a, at[in_a]


def _decimal(ids: np.ndarray) -> str:
    return ",".join(map(str, ids.tolist()))


class _Texts:
    """Ids as text, each with what may follow it: ``,``, ``|`` or ``;``."""

    _size = 0
    _table = np.empty(0, dtype=object)

    @classmethod
    def upto(cls, size: int) -> tuple[np.ndarray, int]:
        if size > cls._size:
            cls._size = max(size, 2 * cls._size)
            cls._table = np.array([f"{i}{mark}" for mark in ",|;" for i in range(cls._size)], dtype=object)
        return cls._table, cls._size


def group_text(a: np.ndarray, b: np.ndarray, in_a: np.ndarray, in_b: np.ndarray) -> str:
    """``a1,a2|b1;a3|b2`` for whole groups, which end at the places ``in_a``, ``in_b``."""
    if not len(in_a):
        return ""
    table, size = _Texts.upto(int(max(a.max(), b.max())) + 1)
    a, b = a.copy(), b.copy()
    a[in_a] += size
    b[in_b] += 2 * size
    # A token comes after those before it on its side and the other side's of earlier
    # groups, for ``b`` also of its own group.
    out = np.empty(len(a) + len(b), dtype=np.int64)
    out[np.arange(len(a)) + np.repeat(np.append(0, in_b[:-1] + 1), np.diff(in_a, prepend=-1))] = a
    out[np.arange(len(b)) + np.repeat(in_a + 1, np.diff(in_b, prepend=-1))] = b
    return "".join(table[out].tolist())[:-1]


def _links(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct linked id pairs as single numbers, and how often each is linked."""
    return np.unique((a << 32) | b, return_counts=True)


def _encoded(ranks: str, model: str, work: int):
    fields = ["_row", "_id", *_ALIGNED.names, *_PIECE.names]

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner.load(ranks, model)
        for batch in batches:
            out: list[list] = [[] for _ in fields]
            at: list[int] = []

            def put(place: int, aligned: tuple, piece: tuple = (None,) * 5) -> None:
                at.append(place)
                for column, value in zip(out[2:], (*aligned, *piece), strict=True):
                    column.append(value)

            for place, text in enumerate(batch.column("_text").to_pylist()):
                found = aligner.encode(text)
                if found is None:
                    put(place, (0, 0, 0, 0, "", [], []))
                    continue
                a, b = found
                a_ends, b_ends = aligner.ends(a, b)
                if len(a) + len(b) > work:
                    cut_a, cut_b = merge_cuts(a_ends, b_ends, work)
                    for n in range(len(cut_a) - 1):
                        of_a, of_b = slice(cut_a[n], cut_a[n + 1]), slice(cut_b[n], cut_b[n + 1])
                        starts = (int(e[c[n] - 1]) if c[n] else 0 for e, c in ((a_ends, cut_a), (b_ends, cut_b)))
                        put(place, (None,) * 7, (n, a[of_a], b[of_b], *starts))
                    continue
                in_a, in_b = shared_ends(a_ends, b_ends)
                digest = hashlib.sha256(group_text(a, b, in_a, in_b).encode()).hexdigest()
                pairs, times = _links(a[in_a], b[in_b])
                put(place, (len(a), len(b), len(in_a), len(in_a), digest, pairs, times))
            kept = pa.array(at, pa.int64())
            columns = [batch.column("_row").take(kept), batch.column("_id").take(kept)]
            kinds = [pa.int64()] * 4 + [pa.string()] + [pa.list_(pa.int64())] * 2
            kinds += [pa.int32(), *[pa.list_(pa.int32())] * 2, *[pa.int64()] * 2]
            columns += [pa.array(x, kind) for x, kind in zip(out[2:], kinds, strict=True)]
            yield pa.RecordBatch.from_arrays(columns, names=fields)

    return encode


def _merged(ranks: str, model: str):
    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _Aligner.load(ranks, model)
        for batch in batches:
            yield _merge_pieces(batch, aligner)

    return merge


def _merge_pieces(batch: pa.RecordBatch, aligner: _Aligner) -> pa.RecordBatch:
    """Each piece's links, whole groups, and open ends."""
    out: dict[str, list] = {name: [] for name in _MERGED.names[1:]}
    sides, starts = ([batch.column(x) for x in names] for names in (("_a", "_b"), ("_a_start", "_b_start")))
    for row in range(batch.num_rows):
        a, b = (x[row].values.to_numpy().astype(np.int64) for x in sides)
        a_ends, b_ends = (e + x[row].as_py() for e, x in zip(aligner.ends(a, b), starts, strict=True))
        in_a, in_b = shared_ends(a_ends, b_ends)
        pairs, times = _links(a[in_a], b[in_b])
        first_a, first_b = (in_a[0] + 1, in_b[0] + 1) if len(in_a) else (len(a), len(b))
        last_a, last_b = (in_a[-1] + 1, in_b[-1] + 1) if len(in_a) else (len(a), len(b))
        body = group_text(
            a[first_a:last_a], b[first_b:last_b], in_a[1:] - first_a, in_b[1:] - first_b
        )
        made = (len(a), len(b), len(in_a), body, _decimal(a[:first_a]), _decimal(b[:first_b]),
                _decimal(a[last_a:]), _decimal(b[last_b:]), pairs, times)
        for column, value in zip(out.values(), made, strict=True):
            column.append(value)
    kinds = [pa.int64()] * 3 + [pa.string()] * 5 + [pa.list_(pa.int64())] * 2
    columns = [batch.column(x) for x in ("_row", "_id", "_piece")]
    columns += [pa.array(x, kind) for x, kind in zip(out.values(), kinds, strict=True)]
    return pa.RecordBatch.from_arrays(columns, names=["_row", "_id", *_MERGED.names])


def _stitch(pieces: pa.Table) -> pa.Table:
    """One text's pieces, which together are as long as the text, as one row."""
    pieces = pieces.sort_by("_piece")
    pairs, times = (
        pieces.column(x).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.int64)
        for x in ("_pairs", "_times")
    )
    rows = pieces.drop_columns(["_pairs", "_times"]).to_pylist()
    digest, started = hashlib.sha256(), False
    open_a: list[str] = []
    open_b: list[str] = []
    for row in rows:
        open_a += [row["_head_a"]] if row["_head_a"] else []
        open_b += [row["_head_b"]] if row["_head_b"] else []
        if not row["_shared"]:
            continue  # the whole piece is inside one group
        group = ",".join(open_a) + "|" + ",".join(open_b)
        parts = [group, row["_body"]] if row["_shared"] > 1 else [group]
        digest.update(((";" if started else "") + ";".join(parts)).encode())
        started = True
        open_a = [row["_tail_a"]] if row["_tail_a"] else []
        open_b = [row["_tail_b"]] if row["_tail_b"] else []
    distinct, place = np.unique(pairs, return_inverse=True)
    shared = sum(row["_shared"] for row in rows)
    columns = [pieces.column("_row").slice(0, 1), pieces.column("_id").slice(0, 1)]
    columns += [
        pa.array([sum(row["_n_a"] for row in rows)], pa.int64()),
        pa.array([sum(row["_n_b"] for row in rows)], pa.int64()),
        pa.array([shared], pa.int64()),
        pa.array([shared], pa.int64()),
        pa.array([digest.hexdigest()], pa.string()),
        pa.array([distinct], pa.list_(pa.int64())),
        pa.array([np.bincount(place, times, len(distinct)).astype(np.int64)], pa.list_(pa.int64())),
    ]
    return pa.Table.from_arrays(columns, names=["_row", "_id", *_ALIGNED.names])


def _count_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums per id pair over many texts."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def sums() -> tuple[np.ndarray, np.ndarray]:
        pairs, place = np.unique(np.concatenate([p for p, _ in held]), return_inverse=True)
        return pairs, np.bincount(place, np.concatenate([t for _, t in held]), len(pairs)).astype(np.int64)

    def rows(found: tuple[np.ndarray, np.ndarray]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], names=["_pair", "_times"])

    for batch in batches:
        pairs, times = (batch.column(x).flatten().to_numpy(zero_copy_only=False) for x in ("_pairs", "_times"))
        held.append((pairs.astype(np.int64), times.astype(np.int64)))
        size += len(pairs)
        if size > HELD_LINKS:
            held = [sums()]
            size = len(held[0][0])
            if size > HELD_LINKS // 2:
                yield rows(held[0])
                held, size = [], 0
    if held:
        yield rows(sums())


def align_texts(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str | None = None,
    model: str | None = None,
    work: int = PIECE_WORK,
) -> DataFrame:
    """Each text's alignment: ``_row``, ``_id``, counts, digest, its linked pairs and their times.

    The result is stored.  ``_row`` numbers the rows.
    """
    ship_code(docs.sparkSession)
    rows = docs.select(
        F.monotonically_increasing_id().alias("_row"),
        F.col(id_col).alias("_id"),
        F.col(text_col).cast("string").alias("_text"),
    )
    keys = {c: rows.schema[c].dataType for c in ("_row", "_id")}
    schema = schema_of(keys, StructType(_ALIGNED.fields + _PIECE.fields))
    files = ranks or default_ranks(), model or default_pieces()
    stored = cut_lineage(rows.mapInArrow(_encoded(*files, work), schema))
    whole = stored.filter(F.col("_piece").isNull()).select("_row", "_id", *_ALIGNED.names)
    pieces = stored.filter(F.col("_piece").isNotNull()).select("_row", "_id", *_PIECE.names)
    merged = pieces.repartition("_row", "_piece").mapInArrow(_merged(*files), schema_of(keys, _MERGED))
    stitched = merged.groupBy("_row").applyInArrow(_stitch, schema_of(keys, _ALIGNED))
    return whole.unionByName(cut_lineage(stitched))


def pair_counts(aligned: DataFrame) -> DataFrame:
    """Per linked id pair ``_pair``: links in all texts, ``_count``, and whether that is its B id's most."""
    sums = aligned.select("_pairs", "_times").mapInArrow(_count_links, "_pair long, _times long")
    counts = cut_lineage(sums.groupBy("_pair").agg(F.sum("_times").alias("_count")))
    b_id = F.col("_pair").bitwiseAND(F.lit((1 << 32) - 1))
    # One row per id of the vocabulary.
    most = counts.groupBy(b_id.alias("_b_id")).agg(F.max("_count").alias("_most"))
    joined = counts.join(F.broadcast(most), b_id == F.col("_b_id"))
    return cut_lineage(joined.select("_pair", "_count", (F.col("_count") == F.col("_most")).alias("_best")))


def _looked_up(shared, fields: list[str]):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, counts, best = shared.value
        for batch in batches:
            pairs, times = (batch.column(x) for x in ("_pairs", "_times"))
            sizes = pairs.value_lengths().to_numpy(zero_copy_only=False)
            row = np.repeat(np.arange(batch.num_rows), sizes)
            pair, time = (x.flatten().to_numpy(zero_copy_only=False).astype(np.int64) for x in (pairs, times))
            place = np.minimum(np.searchsorted(known, pair), max(len(known) - 1, 0))
            hit = known[place] == pair if len(known) else np.zeros(len(pair), dtype=bool)
            n_best, total = (np.zeros(batch.num_rows, dtype=np.int64) for _ in "bt")
            np.add.at(total, row[hit], time[hit] * counts[place[hit]])
            np.add.at(n_best, row[hit], time[hit] * best[place[hit]])
            ends = np.append(0, np.cumsum(np.bincount(row[~hit], minlength=batch.num_rows))).astype(np.int32)
            missed = [pa.ListArray.from_arrays(pa.array(ends), pa.array(x[~hit])) for x in (pair, time)]
            columns = [batch.column(x) for x in fields]
            columns += [pa.array(n_best), pa.array(total), *missed]
            yield pa.RecordBatch.from_arrays(columns, names=[*fields, "_n_best", "_sum", "_pairs", "_times"])

    return add


def align_tokens(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    ranks: str | None = None,
    model: str | None = None,
    work: int = PIECE_WORK,
    table_pairs: int = TABLE_PAIRS,
) -> DataFrame:
    """Per row: id, tokens of both sides, groups, links, and what the corpus says of the links."""
    spark = docs.sparkSession
    aligned = align_texts(docs, id_col, text_col, ranks, model, work)
    counts = pair_counts(aligned)
    top = counts.orderBy(F.desc("_count"), "_pair").limit(table_pairs).toArrow().sort_by("_pair")
    table = tuple(
        top.column(x).to_numpy().astype(kind)
        for x, kind in (("_pair", np.int64), ("_count", np.int64), ("_best", np.int64))
    )
    fields = ["_row", "_id", *_ALIGNED.names[:5]]
    added = StructType.fromDDL("_n_best long, _sum long, _pairs array<bigint>, _times array<bigint>")
    schema = schema_of({c: aligned.schema[c].dataType for c in fields}, added)
    found = cut_lineage(aligned.mapInArrow(_looked_up(spark.sparkContext.broadcast(table), fields), schema))
    missed = (
        found.select("_row", F.explode(F.arrays_zip("_pairs", "_times")).alias("_at"))
        .select("_row", F.col("_at._pairs").alias("_pair"), F.col("_at._times").alias("_times"))
        .join(counts, "_pair")
        .groupBy("_row")
        .agg(
            F.sum(F.when(F.col("_best"), F.col("_times")).otherwise(0)).alias("_more_best"),
            F.sum(F.col("_times") * F.col("_count")).alias("_more_sum"),
        )
    )
    return found.join(missed, "_row", "left").select(
        F.col("_id").alias(id_col),
        *_ALIGNED.names[:4],
        (F.col("_n_best") + F.coalesce("_more_best", F.lit(0))).alias("n_best"),
        (F.col("_sum") + F.coalesce("_more_sum", F.lit(0))).alias("count_sum"),
        "groups_sha256",
    )
