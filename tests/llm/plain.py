"""The operators' rules in plain Python, and awkward inputs."""

from __future__ import annotations

import re
from collections import Counter

import regex
import xxhash
from pyspark.sql.types import LongType, StringType, StructField, StructType

LONG = " ".join(f"w{i % 977}x{i}" for i in range(60_000)) + " " + "y" * 200_000
PASSAGE = " ".join(f"shared{i}" for i in range(60))
PROSE = " ".join(f"the word{i} of" for i in range(40))

AWKWARD = [
    (1, None),
    (2, ""),
    (3, " \n\t\r\x0b\x0c "),
    (4, "word"),
    (5, "Three Short words"),
    (6, LONG),
    (7, PROSE + " " + PASSAGE),
    (7, PROSE + " " + PASSAGE),  # a repeated row
    (8, PASSAGE + "\nIts own few words"),
    (9, "Der " * 300),
    (10, "a  b \n c d é <|endoftext|> ж  " * 3),
    (None, "no id " + PASSAGE),
    (None, None),
]

# Columns whose names the operators use inside or return themselves.
CLASHING = ["_row", "_text", "_id", "row", "kept", "n_words", "shard", "offset", "_fp", "n_tokens"]

DOCS = StructType(
    [StructField("doc_id", LongType()), StructField("text", StringType())]
    + [StructField(name, StringType()) for name in CLASHING]
)


def documents(spark, rows=AWKWARD):
    return spark.createDataFrame([(*r, *[None] * len(CLASHING)) for r in rows], DOCS)


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def quality_counts(text):
    found = words(text)
    text = text or ""
    windows = [tuple(found[i : i + 8]) for i in range(len(found) - 7)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(8)}
    seen, again = set(), 0
    for line in text.split("\n"):
        if words(line):
            again += line in seen
            seen.add(line)
    symbols = len(re.findall(r"[#*$%&|<>]", text))
    failed = len(found) < 20 or 100 * len(covered) > 30 * len(found)
    return (len(found), sum(map(len, found)), symbols, again, len(covered), failed)


def simhash(text, size=4):
    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    found = words(lower)
    if not found:
        return 0
    shingles = [" ".join(found[i : i + size]) for i in range(max(len(found) - size + 1, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=4):
    """For each print the least position in its component."""
    parent = list(range(len(prints)))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return [top(i) for i in range(len(prints))]


def kept_words(texts, window=35):
    """Per text its words, and those that no repeated window covers."""
    split = [words(t) for t in texts]
    times = Counter(
        tuple(w[i : i + window]) for w in split for i in range(len(w) - window + 1)
    )
    out = []
    for w in split:
        gone = set()
        for i in range(len(w) - window + 1):
            if times[tuple(w[i : i + window])] > 1:
                gone.update(range(i, i + window))
        out.append((w, [x for i, x in enumerate(w) if i not in gone]))
    return out


def letters(text):
    return [w for w in regex.split(r"[^\p{L}\p{N}]+", (text or "").lower()) if w]


def leaks(docs, items, least=800_000):
    """(doc, item) pairs with a window of similarity ``least`` or more.

    All windows of the item's size are tried, and those cut short by the text's
    edges at which some shingle is in its place.
    """
    found = set()
    for item, item_text in items:
        want = letters(item_text)
        if not want:
            continue
        size = min(5, len(want))
        shingle = lambda w, n=size: [tuple(w[i : i + n]) for i in range(len(w) - n + 1)]
        listed, span = Counter(shingle(want)), len(want) - size + 1
        for doc, text in docs:
            has = shingle(letters(text))
            if listed.keys().isdisjoint(has):
                continue
            places = {i: [] for i in listed}
            for at, x in enumerate(shingle(want)):
                places[x].append(at)
            aligned = {p - q for p, x in enumerate(has) for q in places.get(x, ())}
            for start in aligned | set(range(len(has) - span + 1)):
                there = Counter(has[max(start, 0) : start + span])
                if sum((there & listed).values()) * 1_000_000 // sum((there | listed).values()) >= least:
                    found.add((doc, item))
                    break
    return found


def check_packing(rows, ids_of, capacity=2048):
    """Pieces restore their documents, sequences have no gaps and do not overflow."""
    import array
    import zlib

    by_doc, by_sequence = {}, {}
    for r in rows:
        by_doc.setdefault(r["doc_id"], []).append(r)
        by_sequence.setdefault(r["sequence_id"], []).append(r)
    assert by_doc.keys() == ids_of.keys()
    for doc, copies in ids_of.items():
        expected = Counter()
        for ids in copies:
            start, width = 0, len(ids) % capacity or capacity
            piece = 0
            while start < len(ids):
                part = ids[start : start + width]
                expected[piece, start, len(part), zlib.crc32(array.array("I", part).tobytes())] += 1
                start, width, piece = start + len(part), capacity, piece + 1
        assert expected == Counter(
            (r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in by_doc[doc]
        )
    for members in by_sequence.values():
        at = 0
        for r in sorted(members, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
    return len(by_sequence)


def _components(count, linked):
    parent = list(range(count))

    def top(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(count):
        for j in range(i):
            if linked(i, j):
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return [top(i) for i in range(count)]


def check_one_of_each_group(rows, kept, size=4):
    """``kept`` has one row of each component of fingerprints: that of the least id."""
    group = _components(len(rows), _within_radius([simhash(t, size) for _, t in rows]))
    order = lambda i: (rows[i][0] is None, rows[i][0] or 0)
    left = Counter(kept)
    for g in set(group):
        members = [i for i in range(len(rows)) if group[i] == g]
        least = order(min(members, key=order))
        found = [rows[i] for i in members if order(i) == least and left[rows[i]]]
        assert found, g
        left[found[0]] -= 1
    assert not +left


def _within_radius(prints, radius=4):
    return lambda i, j: (prints[i] ^ prints[j]).bit_count() <= radius
