"""The set join against all pairs of exact sets."""

from __future__ import annotations

from collections import Counter

import numpy as np
import pytest

from sievemart.llm import ngram_join
from tests.llm import plain

SF = "/root/testdata/sf0.001"


def shingles(text, size):
    found = plain.words("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    return frozenset(tuple(found[i : i + size]) for i in range(max(len(found) - size + 1, 1))) if found else frozenset()


def expected(rows, size, percent):
    sets = [shingles(t, size) for _, t in rows]

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return both and 100 * both >= percent * len(sets[i] | sets[j])

    group = plain._components(len(rows), linked)
    least = {}
    for g, (i, _) in zip(group, rows):
        least[g] = min((x for x in (least.get(g), i) if x is not None), default=None)
    return Counter((i, len(s), least[g]) for (i, _), s, g in zip(rows, sets, group, strict=True))


def check(spark, rows, size=3, percent=90):
    found = ngram_join.similar_groups(plain.documents(spark, rows), words=size, percent=percent)
    assert found.columns == ["doc_id", "n_shingles", "component_id"]
    wanted = expected(rows, size, percent)
    assert Counter(tuple(r) for r in found.collect()) == wanted
    return len({c for _, _, c in wanted})


def edited(rng, text, places):
    text = list(text)
    for at in places:
        text[at] = f"e{rng.integers(1 << 40)}"
    return text


def test_given_and_awkward_texts(spark):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = plain.AWKWARD + [(1000 + d, t) for d, t in given]
    assert check(spark, rows) < len(rows) - 5


def test_small_sets_of_every_size(spark):
    """Pairs of 3 to 45 words that lack or add a word at an end, and chains of them."""
    rng = np.random.default_rng(31)
    rows = []
    for n in range(3, 46):
        text = [f"s{n}x{i}" for i in range(n)]
        for k in range(4):
            rows.append((len(rows), " ".join(text[k:] + [f"t{n}x{i}" for i in range(int(rng.integers(0, 3)))])))
    groups = check(spark, rows)
    assert 43 < groups < len(rows)


def test_light_and_heavy_meet_at_any_boundary(spark, monkeypatch):
    rows = []
    for n in range(14, 26):
        text = [f"s{n}x{i}" for i in range(n)]
        rows += [(len(rows), " ".join(text)), (len(rows) + 1, " ".join(text[:-1]))]
    for bound in (1, 18, ngram_join.light_sizes()[-1] + 1):
        monkeypatch.setattr(ngram_join, "size_boundary", lambda *_, b=bound: b)
        check(spark, rows)


def test_long_lists_are_split(spark, monkeypatch):
    """Texts of one template, so all lists are long, with pairs at the similarity."""
    monkeypatch.setattr(ngram_join, "SPLIT_LIST", 5)
    monkeypatch.setattr(ngram_join, "ORDER_MOST", 0)
    rng = np.random.default_rng(32)
    template = [f"t{x}" for x in range(170)]
    rows = []
    for n in range(40):
        text = template + [f"own{n}x{i}" for i in range(80)]
        rows += [(2 * n, " ".join(text)), (2 * n + 1, " ".join(edited(rng, text, [175, 249])))]
    assert check(spark, rows) == 40


def test_a_family_of_near_copies_costs_few_pairs(spark, monkeypatch):
    """Texts of one template with own edits: few are similar, all meet in its lists."""
    monkeypatch.setattr(ngram_join, "SPLIT_LIST", 5)
    monkeypatch.setattr(ngram_join, "ORDER_MOST", 0)
    tested = []
    close = ngram_join._Verifier._close
    monkeypatch.setattr(ngram_join._Verifier, "_close", lambda self, p: tested.append(p.count()) or close(self, p))
    rng = np.random.default_rng(35)
    template = [f"t{x}" for x in range(200)]
    rows = [(0, " ".join(template))]
    for n in range(1, 140):
        edits = 1 if n % 20 == 0 else 12
        rows.append((n, " ".join(edited(rng, template, 1 + 3 * rng.choice(65, edits, replace=False)))))
    assert check(spark, rows) > 100
    assert sum(tested) < 10 * len(rows)  # all pairs are 70 times the rows


@pytest.mark.parametrize("percent", [80, 90])
def test_pairs_at_the_similarity_all_meet(spark, percent):
    rng = np.random.default_rng(33)
    rows = []
    for n in range(120):
        size = int(rng.integers(94, 300))
        text = [f"v{n}x{i}" for i in range(size)]
        cut = size - (size - 4) * (100 - percent + n % 2) // 100
        rows += [(2 * n, " ".join(text)), (2 * n + 1, " ".join(text[:cut]))]
    assert 120 < check(spark, rows, 5, percent) < 240


def test_no_texts(spark):
    assert ngram_join.similar_groups(plain.documents(spark, [])).collect() == []


def test_subsets_and_prefixes_of_similar_sets_meet():
    rng = np.random.default_rng(34)
    for _ in range(400):
        whole = np.unique(rng.integers(0, 1 << 63, 40).astype(np.uint64))
        a, b = (np.sort(rng.choice(whole, int(rng.integers(34, 41)), replace=False)) for _ in "ab")
        common = np.unique(rng.choice(whole, 10))
        times = rng.integers(2, 9, len(common))
        for percent in (80, 90):
            shared = len(np.intersect1d(a, b))
            if 100 * shared >= percent * (len(a) + len(b) - shared):
                first, second = (ngram_join.rarest(x, common, times, percent) for x in (a, b))
                assert len(np.intersect1d(first[:-1], second[:-1])) > 0
                assert len(np.intersect1d(first, second)) > 1
    small = ngram_join.light_sizes()
    for n in small:
        text = np.sort(rng.integers(0, 1 << 63, n).astype(np.uint64))
        for m in (x for x in ngram_join.partner_sizes(n) if x <= n):
            keys = [ngram_join.subset_keys(x) for x in (text, text[:m])]
            assert len(np.intersect1d(*keys)) > 0


def test_counts_never_differ_more_than_sets():
    rng = np.random.default_rng(7)
    for size in (1, 40, 300, 2500, 70_000):
        for changed in (0, 1, size // 20, size // 2, size):
            for more in (0, size // 10, 3 * size):
                a = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
                b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 64, changed + more, dtype=np.uint64)]))
                counts = [ngram_join.bucket_counts(s, ngram_join.fine_buckets(len(s))).tobytes() for s in (a, b)]
                apart = ngram_join.counts_differ(*counts)
                assert apart <= len(np.setxor1d(a, b))
                assert len(a) < 40 or changed < len(a) // 2 or 2 * apart > min(changed, len(a))


def test_parity_sketches_never_differ_more_than_sets():
    rng = np.random.default_rng(36)
    for size in (0, 1, 40, 300, 2500, 20_000):
        for changed in (0, 1, size // 20, size // 2, size):
            a = np.unique(rng.integers(0, 1 << 64, size, dtype=np.uint64))
            b = np.unique(np.concatenate([a[changed:], rng.integers(0, 1 << 64, changed + 3, dtype=np.uint64)]))
            sketches = [ngram_join.parity_sketch(s) for s in (a, b)]
            assert [len(x) for x in sketches] == [ngram_join.SKETCH_BITS // 64] * 2
            apart = sum(int(x).bit_count() for x in (sketches[0] ^ sketches[1]).view(np.uint64))
            assert apart <= len(np.setxor1d(a, b))
            assert changed > 20 or 2 * apart > changed


def test_counts_beyond_one_byte_stay_bounds():
    a = np.arange(1000, dtype=np.uint64)
    b = np.arange(900, 3000, dtype=np.uint64) + (np.arange(2100, dtype=np.uint64) << np.uint64(50))
    counts = [ngram_join.bucket_counts(s, ngram_join.fine_buckets(len(s))).tobytes() for s in (a, b)]
    assert ngram_join.counts_differ(*counts) <= len(np.setxor1d(a, b))
