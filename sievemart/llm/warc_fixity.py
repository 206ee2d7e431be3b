"""Fixity audit of WARC replicas by Merkle trees.

Records lie in archives at known offsets.  Each record is hashed, together with
its offset.  The hashes of the records that start in one range of ``LEAF_BYTES``
make a leaf of the archive's tree, and ``FANOUT`` neighbouring nodes make a node of
the next level, in the order of their ranges.  A leaf is the hash of its records'
number and of sums over their hashes, so its state has a fixed width, is combined
before the shuffle, and holds the order by the offsets in the hashes.  Two replicas
are compared by their roots; only below nodes that differ are the next level's
nodes compared, and records only in leaves that differ.  Records without archive or
offset have a tree of their own per archive, in which a range of digests stands for
a range of offsets.  So neither a node's children nor a leaf grow with the data.

Defined results: records are compared by place and digest, with their number of
copies.  Where a place has one record too many and one too few, it is ``changed``;
else what the second replica lacks is ``missing`` and what it has beyond the first
``extra``, one row per digest with the number of ``copies``.  A NULL payload is a
record of its own kind, with length 0, and differs from an empty one; records without
an archive or offset raise no error and have a place of their own, with NULLs; other
columns are ignored; two empty replicas differ nowhere.
"""

from __future__ import annotations

import datetime
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sievemart.llm.common import ship_code
from sievemart.session import cut_lineage

LEAF_BYTES = 1 << 16
FANOUT = 16
LEVELS = 5  # 64 KB ranges to 4 GB ranges; larger archives have several roots
ARCHIVE_BYTES = 1 << 28
SALTS = 64  # parts in which the differing records of one place meet it

#: A record's hash is summed in pieces of so many hex digits: 2 ** 35 of them fit a long.
PIECE_DIGITS = 7
PIECES = 8

# Fixed value: the date written into records, so that archives are reproducible.
WARC_DATE = datetime.datetime(2024, 1, 1, tzinfo=datetime.UTC).strftime("%Y-%m-%dT%H:%M:%SZ")


def warc_records(
    pages: DataFrame,
    id_col: str = "page_id",
    url_col: str = "url",
    body_col: str = "html",
    extra: Sequence[str] = (),
) -> DataFrame:
    """WARC records of pages: id, archive, offset, the record's bytes, ``extra`` columns.

    Each task writes its pages one after another into archives of about
    ``ARCHIVE_BYTES``.  The result must be stored before it is used twice.
    """
    ship_code(pages.sparkSession)
    rows = pages.select(
        F.col(id_col).alias("id"),
        F.coalesce(url_col, F.lit("")).alias("url"),
        F.coalesce(body_col, F.lit("")).cast("binary").alias("body"),
        F.spark_partition_id().alias("part"),
        *extra,
    )

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, offset = 0, 0
        for batch in batches:
            archive, start, records = [], [], []
            for id_, url, body, part in zip(*(batch.column(i).to_pylist() for i in range(4)), strict=True):
                head = (
                    "WARC/1.0\r\nWARC-Type: resource\r\n"
                    f"WARC-Record-ID: <urn:page:{id_}>\r\nWARC-Date: {WARC_DATE}\r\n"
                    f"WARC-Target-URI: {' '.join(url.split())}\r\nContent-Type: text/html\r\n"
                    f"Content-Length: {len(body)}\r\n\r\n"
                )
                record = head.encode() + body + b"\r\n\r\n"
                if offset and offset + len(record) > ARCHIVE_BYTES:
                    number, offset = number + 1, 0
                archive.append(f"pages-{part:06d}-{number:05d}.warc")
                start.append(offset)
                records.append(record)
                offset += len(record)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("id"),
                    pa.array(archive, pa.string()),
                    pa.array(start, pa.int64()),
                    pa.array(records, pa.binary()),
                    *[batch.column(name) for name in extra],
                ],
                names=["id", "archive", "offset", "record", *extra],
            )

    kinds = {f.name: f.dataType.simpleString() for f in rows.schema}
    schema = f"id {kinds['id']}, archive string, offset long, record binary"
    schema += "".join(f", `{name}` {kinds[name]}" for name in extra)
    return rows.mapInArrow(write, schema).withColumnRenamed("id", id_col)


def record_digests(replica: DataFrame, archive: str, offset: str, record: str) -> DataFrame:
    """Per record its place, length and digest: what a storage node can tell of itself."""
    digest = F.coalesce(F.unhex(F.sha2(record, 256)), F.lit(b""))
    return replica.select(
        F.col(archive).alias("archive"),
        F.col(offset).alias("offset"),
        F.coalesce(F.octet_length(record), F.lit(0)).cast("long").alias("length"),
        digest.alias("digest"),
    )


def _number(digits: Column) -> Column:
    """The number that hex digits stand for, zero for none."""
    return F.conv(F.coalesce(F.nullif(digits, F.lit("")), F.lit("0")), 16, 10).cast("long")


def _leaf() -> list[Column]:
    """Of a record: its archive, whether its place is known, and its leaf's number."""
    known = F.col("archive").isNotNull() & F.col("offset").isNotNull()
    instead = _number(F.substring(F.hex("digest"), 1, 10))
    at = F.when(known, F.col("offset")).otherwise(instead)
    return [F.col("archive"), known.alias("known"), F.floor(at / F.lit(LEAF_BYTES)).alias("node")]


def _leaves(digests: DataFrame) -> DataFrame:
    """The leaves' digests, from the sums over their records' hashes."""
    told = F.concat_ws(":", F.col("offset").cast("string"), F.col("length").cast("string"), F.hex("digest"))
    hashed = digests.select(*_leaf(), F.sha2(told, 256).alias("hash"))
    pieces = [_number(F.substring("hash", 1 + PIECE_DIGITS * n, PIECE_DIGITS)) for n in range(PIECES)]
    sums = [F.sum(piece).alias(f"sum{n}") for n, piece in enumerate(pieces)]
    summed = hashed.groupBy("archive", "known", "node").agg(F.count("*").alias("rows"), *sums)
    joined = F.concat_ws(":", *[F.col(c).cast("string") for c in ("rows", *[f"sum{n}" for n in range(PIECES)])])
    return summed.select(
        "archive", "known", F.lit(0).alias("level"), "node", F.unhex(F.sha2(joined, 256)).alias("digest")
    )


def _folded(children: DataFrame, level: int) -> DataFrame:
    """Nodes of a level, from the digests of their children in order."""
    listed = F.array_sort(F.collect_list(F.struct("node", "digest")))
    joined = F.array_join(
        F.transform(listed, lambda x: F.concat_ws(":", x["node"].cast("string"), F.hex(x["digest"]))), ";"
    )
    return (
        children.groupBy("archive", "known", F.expr(f"node div {FANOUT}").alias("above"))
        .agg(F.unhex(F.sha2(joined, 256)).alias("digest"))
        .select("archive", "known", F.lit(level).alias("level"), F.col("above").alias("node"), "digest")
    )


def merkle_tree(digests: DataFrame) -> DataFrame:
    """All nodes of all archives: archive, known place, level (0: leaves), node and digest."""
    level = _leaves(digests)
    nodes = level
    for number in range(1, LEVELS):
        level = _folded(level, number)
        nodes = nodes.unionByName(level)
    return nodes


def _differing(left: DataFrame, right: DataFrame) -> DataFrame:
    """Nodes of either tree that have another digest, or none, in the other."""
    keys = ["archive", "known", "node"]
    pair = left.select([F.col(c).alias(f"l_{c}") for c in (*keys, "digest")]).join(
        right.select([F.col(c).alias(f"r_{c}") for c in (*keys, "digest")]),
        [F.col(f"l_{k}").eqNullSafe(F.col(f"r_{k}")) for k in keys],
        "full",
    )
    differ = ~F.col("l_digest").eqNullSafe(F.col("r_digest"))
    there = [F.when(F.col("l_node").isNull(), F.col(f"r_{k}")).otherwise(F.col(f"l_{k}")).alias(k) for k in keys]
    return pair.filter(differ).select(*there)


def _below(nodes: DataFrame, parents: DataFrame, place: Column) -> DataFrame:
    """The rows of ``nodes`` whose parent is among the differing ``parents``."""
    wanted = parents.select(*[F.col(c).alias(f"_{c}") for c in ("archive", "known", "node")])
    same = F.col("archive").eqNullSafe(F.col("_archive")) & (F.col("known") == F.col("_known"))
    return nodes.join(wanted, same & (place == F.col("_node")), "left_semi")


def _faults(left: DataFrame, right: DataFrame) -> DataFrame:
    """The faults among the records of differing leaves."""
    place, record = ["archive", "offset"], ["length", "digest"]
    sides = [x.withColumn("copies", F.lit(n)) for x, n in ((left, 1), (right, -1))]
    surplus = (
        sides[0].unionByName(sides[1])
        .groupBy(*place, *record)
        .agg(F.sum("copies").alias("copies"))
        .filter(F.col("copies") != 0)
        .withColumn("digest", F.lower(F.hex("digest")))
    )
    surplus = cut_lineage(surplus)
    lacking, beyond = F.col("copies") > 0, F.col("copies") < 0
    places = surplus.groupBy(*place).agg(
        F.sum(F.when(lacking, F.col("copies")).otherwise(0)).alias("lacking"),
        F.sum(F.when(beyond, -F.col("copies")).otherwise(0)).alias("beyond"),
        *[F.max(F.when(lacking, F.col(c))).alias(c) for c in record],
        *[F.max(F.when(beyond, F.col(c))).alias(f"found_{c}") for c in record],
    )
    paired = (F.col("lacking") == 1) & (F.col("beyond") == 1)
    names = [*place, "length", "found_length", "digest", "found_digest"]
    changed = places.filter(paired).select(
        *names, F.lit("changed").alias("kind"), F.lit(1).cast("long").alias("copies")
    )
    salts = F.sequence(F.lit(0), F.lit(SALTS - 1))
    others = places.filter(~paired).select(
        *[F.col(c).alias(f"_{c}") for c in place], F.explode(salts).alias("_salt")
    )
    same = [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in place]
    salt = F.pmod(F.xxhash64("digest"), F.lit(SALTS)) == F.col("_salt")
    single = surplus.join(others, [*same, salt], "left_semi").select(
        *place,
        F.when(lacking, F.col("length")).alias("length"),
        F.when(beyond, F.col("length")).alias("found_length"),
        F.when(lacking, F.col("digest")).alias("digest"),
        F.when(beyond, F.col("digest")).alias("found_digest"),
        F.when(lacking, "missing").otherwise("extra").alias("kind"),
        F.abs("copies").alias("copies"),
    )
    return changed.unionByName(single)


def merkle_audit(
    left: DataFrame,
    right: DataFrame,
    archive: str = "archive",
    offset: str = "offset",
    record: str = "record",
) -> DataFrame:
    """The records in which two replicas differ: place, lengths, digests, kind and copies.

    Each replica's digests and tree are computed once and stored.
    """
    sides = [cut_lineage(record_digests(x, archive, offset, record)) for x in (left, right)]
    trees = [cut_lineage(merkle_tree(x)) for x in sides]
    at_level = [[t.filter(F.col("level") == n).drop("level") for t in trees] for n in range(LEVELS)]
    differing = _differing(*at_level[LEVELS - 1])
    for number in range(LEVELS - 2, -1, -1):
        children = [_below(t, differing, F.expr(f"node div {FANOUT}")) for t in at_level[number]]
        # A few rows per fault: stored, so that no level is walked twice.
        differing = cut_lineage(_differing(*children))
    leaf = _leaf()
    placed = [x.select(*leaf, "offset", "length", "digest") for x in sides]
    return _faults(*[_below(x, differing, F.col("node")) for x in placed])
