"""Alignment of two tokenizers against plain Python."""

from __future__ import annotations

import hashlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from sievemart.llm import token_alignment
from tests.llm import plain

SF = "/root/testdata/sf0.001"


def byte_letters():
    """The characters that stand for bytes in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in shown}
    hidden = [b for b in range(256) if b not in shown]
    return table | {chr(256 + n): b for n, b in enumerate(hidden)}


def expected(rows):
    first = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    letters = byte_letters()
    docs = []
    for doc, text in rows:
        spaced = " " + (text or "")
        a = first.encode(spaced, add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        a_bytes = [bytes(letters[c] for c in first.id_to_token(i)) for i in a]
        b_bytes = [
            bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i)
            else second.id_to_piece(i).replace("▁", " ").encode()
            for i in b
        ]
        if not text or b"".join(a_bytes) != spaced.encode() or b"".join(b_bytes) != spaced.encode():
            docs.append((doc, [], [], [], []))
            continue
        a_ends, b_ends = np.cumsum([len(x) for x in a_bytes]), np.cumsum([len(x) for x in b_bytes])
        groups, links, i, j = [], [], 0, 0
        upto_a, upto_b = ({e: n + 1 for n, e in enumerate(ends.tolist())} for ends in (a_ends, b_ends))
        for end in sorted(upto_a.keys() & upto_b.keys()):
            up_a, up_b = upto_a[end], upto_b[end]
            groups.append(f"{','.join(map(str, a[i:up_a]))}|{','.join(map(str, b[j:up_b]))}")
            links.append((a[up_a - 1], b[up_b - 1]))
            i, j = up_a, up_b
        docs.append((doc, a, b, groups, links))
    count = Counter(x for d in docs for x in d[4])
    most = defaultdict(int)
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return Counter(
        (doc, len(a), len(b), len(g), len(k), sum(count[x] == most[x[1]] for x in k), sum(count[x] for x in k),
         hashlib.sha256(";".join(g).encode()).hexdigest() if g else "")
        for doc, a, b, g, k in docs
    )


COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


@pytest.mark.parametrize("work, table_pairs", [(1 << 14, 1 << 18), (50, 50)])
def test_alignment_is_the_plain_one(spark, work, table_pairs):
    given = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    rows = plain.AWKWARD + [(1000 + d, t) for d, t in given] + [(3000, "café  two  spaces"), (3001, "▁ mark <s> <0x41>")]
    found = token_alignment.align_tokens(plain.documents(spark, rows), work=work, table_pairs=table_pairs)
    assert found.columns == COLUMNS
    assert Counter(tuple(r) for r in found.collect()) == expected(rows)


def test_alignment_of_nothing(spark):
    assert token_alignment.align_tokens(plain.documents(spark, [])).collect() == []
    rows = token_alignment.align_tokens(plain.documents(spark, [(1, None), (1, ""), (None, None)])).collect()
    assert all(tuple(r)[1:] == (0, 0, 0, 0, 0, 0, "") for r in rows) and len(rows) == 3


def test_cuts_part_the_merge_evenly():
    rng = np.random.default_rng(3)
    for _ in range(300):
        a, b = (np.unique(rng.integers(1, 400, rng.integers(1, 120))) for _ in "ab")
        work = int(rng.integers(1, 30))
        at_a, at_b = token_alignment.merge_cuts(a, b, work)
        assert (at_a[0], at_b[0], at_a[-1], at_b[-1]) == (0, 0, len(a), len(b))
        assert (np.diff(at_a + at_b) <= work + 1).all()
        shared = 0
        for n in range(len(at_a) - 1):
            of_a, of_b = a[at_a[n] : at_a[n + 1]], b[at_b[n] : at_b[n + 1]]
            shared += len(token_alignment.shared_ends(of_a, of_b)[0])
            if len(of_a) and at_b[n + 1] < len(b):
                assert of_a[-1] < b[at_b[n + 1]]
            if len(of_b) and at_a[n + 1] < len(a):
                assert of_b[-1] < a[at_a[n + 1]]
        assert shared == len(np.intersect1d(a, b))
