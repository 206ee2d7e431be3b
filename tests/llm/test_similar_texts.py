"""Links of a similarity of 0.8 on five words by the set join, against exact ones."""

from __future__ import annotations

import numpy as np

from sievemart.llm import ngram_join
from tests.llm import plain

SIZE = 5


def shingles(text):
    found = plain.words(text.lower())
    return frozenset(tuple(found[i : i + SIZE]) for i in range(max(len(found) - SIZE + 1, 1)))


def kept_exactly(rows):
    """The least id of each component of the exact links."""
    sets = [shingles(t) for _, t in rows]

    def linked(i, j):
        both = len(sets[i] & sets[j])
        return 10 * both >= 8 * (len(sets[i]) + len(sets[j]) - both)

    return {rows[i][0] for i in set(plain._components(len(rows), linked))}


def check(spark, rows):
    found = ngram_join.similar_groups(plain.documents(spark, rows), words=SIZE, percent=80).collect()
    assert {r["component_id"] for r in found} == kept_exactly(rows)


def edited(rng, text, places):
    text = list(text)
    for at in places:
        text[at] = f"e{rng.integers(1 << 40)}"
    return text


def test_pairs_of_one_template_are_all_compared(spark):
    """Half of every text is the template's, so lists are long; the pairs are at 0.85."""
    rng = np.random.default_rng(21)
    template = [f"t{x}" for x in range(170)]
    rows = []
    for n in range(60):
        text = template + [f"own{n}x{i}" for i in range(80)]
        rows += [(2 * n, " ".join(text)), (2 * n + 1, " ".join(edited(rng, text, [175, 200, 225, 240])))]
    check(spark, rows)
    assert kept_exactly(rows) == {2 * n for n in range(60)}


def test_pairs_below_the_similarity_both_stay(spark):
    """From 0.74 to 0.79: what an estimate of the similarity would link."""
    rng = np.random.default_rng(22)
    rows = []
    for n in range(60):
        text = [f"w{n}x{i}" for i in range(250)]
        rows += [(2 * n, " ".join(text)), (2 * n + 1, " ".join(edited(rng, text, range(10, 60 + 10 * (n % 2), 9))))]
    check(spark, rows)
    assert len(kept_exactly(rows)) == 120


def test_pairs_at_the_similarity_all_meet(spark):
    """At 0.80 to 0.82, of short and long texts, and of other lengths."""
    rng = np.random.default_rng(23)
    rows = []
    for n in range(300):
        size = int(rng.integers(94, 400))
        text = [f"v{n}x{i}" for i in range(size)]
        other = text[: (size - 4) * 4 // 5 + 5] if n % 3 == 0 else edited(rng, text, range(10, 10 + 7 * ((size - 4) // 45), 7))
        rows += [(2 * n, " ".join(text)), (2 * n + 1, " ".join(other))]
    check(spark, rows)
    assert len(kept_exactly(rows)) == 300


def test_edited_copies_are_linked(spark):
    """Three words of 250 changed: at a similarity of about 0.87."""
    rng = np.random.default_rng(9)
    rows, edited = [], []
    for n in range(60):
        text = [f"w{x}" for x in rng.integers(0, 5000, 250)]
        rows.append((n, " ".join(text)))
        for at in rng.choice(250, 3, replace=False):
            text[at] = "other"
        edited.append((1000 + n, " ".join(text)))
    check(spark, rows + edited)
    assert kept_exactly(rows + edited) == set(range(60))
