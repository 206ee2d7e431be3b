"""The operators on documents against their rules in plain Python."""

from __future__ import annotations

import importlib
import zlib
from collections import Counter

import numpy as np
import pytest
from tokenizers import Tokenizer

from sievemart.llm import (
    decontaminate,
    fm_substrings,
    packing,
    quality,
    sharding,
    simhash_dedup,
    token_counts,
)
from sievemart.llm.components import components
from sievemart.llm.fm_index import FmIndex
from sievemart.llm.tokens import RankEncoder, chunks, default_ranks, default_vocabulary
from tests.llm import plain

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def given(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    return rows


@pytest.fixture(scope="module")
def tokenizer():
    return Tokenizer.from_file(default_vocabulary())


def both(spark, given):
    """Awkward rows, then given rows under other ids."""
    return plain.AWKWARD + [(1000 + d, t) for d, t in given]


def test_quality_counts_and_verdict(spark, given):
    rows = both(spark, given)
    found = quality.quality_report(plain.documents(spark, rows)).collect()
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    assert Counter((r["doc_id"], *[r[n] for n in names]) for r in found) == Counter(
        (d, *plain.quality_counts(t)) for d, t in rows
    )
    assert all(r["kept"] == (not r["base_failed"] and not r["failed_rules"]) for r in found)
    kept = quality.keep_good(plain.documents(spark, rows))
    assert kept.schema == plain.DOCS
    assert Counter(r["doc_id"] for r in kept.collect()) == Counter(r["doc_id"] for r in found if r["kept"])


def test_quality_agrees_with_labels(spark):
    report = quality.quality_report(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"))
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
    rows = report.filter("n_words >= 20").join(labels, "doc_id").collect()
    good = [r["kept"] for r in rows if r["quality"] == 1]
    bad = [r["kept"] for r in rows if r["quality"] == 0]
    assert sum(good) >= 0.98 * len(good)
    assert sum(bad) <= 0.1 * len(bad)


def test_threshold_table_is_a_parameter(spark):
    rule = quality.Threshold("few", "n_words", "at_most", 100, "n_lines")
    text = [(1, "\n".join(f"w{i}" for i in range(30))), (2, " ".join(f"w{i}" for i in range(30)))]
    found = quality.quality_report(plain.documents(spark, text), thresholds=[rule]).collect()
    assert {r["doc_id"]: r["kept"] for r in found} == {1: True, 2: False}


def test_chunks_are_whole_pre_tokens(tokenizer):
    encode = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    for text in ["a  b", " a", "a ", "a \n b", "\n\n a\tb  ", "it's  don't", "", " ", "1 2,3 é  x  y"]:
        first, *rest = chunks(text)
        assert encode(first) + [i for c in rest for i in encode(" " + c)] == encode(text), repr(text)


def test_rank_encoder_gives_the_same_ids(tokenizer, given):
    encoder = RankEncoder.load(default_ranks())
    odd = [f" {chr(c)}a1{chr(c)} \n{chr(c)}!" for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    texts = odd + [t or "" for _, t in plain.AWKWARD + given] + ["x<|endoftext|> y <|endoftext|>", "<|endoftext|>"]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == ids


def test_token_counts(spark, given, tokenizer):
    rows = both(spark, given)
    found = token_counts.count_tokens(plain.documents(spark, rows)).collect()
    expected = Counter()
    for d, t in rows:
        n = len(tokenizer.encode(t or "", add_special_tokens=False).ids)
        expected[d, len((t or "").encode()), n, n > 1024] += 1
    assert Counter(tuple(r) for r in found) == expected


def test_token_counts_with_a_small_table(spark, given, tokenizer, monkeypatch):
    monkeypatch.setattr(token_counts, "TASK_CHUNKS", 5)
    docs = plain.documents(spark, given[:40])
    assert len(token_counts.frequent_chunks(docs, size=7)) == 7
    found = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs).collect()}
    assert found == {d: len(tokenizer.encode(t, add_special_tokens=False).ids) for d, t in given[:40]}


@pytest.mark.parametrize("held", [3, 100_000])
def test_frequent_chunks_are_counted_over_all_texts(spark, monkeypatch, held):
    """Chunks that are frequent only behind the first rows and partitions, and spread over tasks."""
    monkeypatch.setattr(token_counts, "TASK_CHUNKS", held)
    first = [(i, " ".join(f"a{i}x{k}" for k in range(3))) for i in range(600)]
    late = [(i, "x late later" if i % 2 else "x late") for i in range(600, 700)]
    one_task = spark.createDataFrame(first + late, "doc_id long, text string").coalesce(1)
    assert token_counts.frequent_chunks(one_task, size=2) == ["late", "later"]
    many_tasks = spark.createDataFrame(late + first + late, "doc_id long, text string").repartition(90, "doc_id")
    assert token_counts.frequent_chunks(many_tasks, size=2) == ["late", "later"]
    found = token_counts.frequent_chunks(many_tasks, size=10_000)
    assert Counter(found) == Counter({c for _, t in first + late for c in t.split(" ")[1:]})


def test_token_counts_shuffle_nothing(spark, given, capsys):
    token_counts.count_tokens(spark.createDataFrame(given, "doc_id long, text string")).explain()
    assert "Exchange" not in capsys.readouterr().out


def test_packing(spark, given, tokenizer):
    rows = both(spark, given)
    ids = {}
    for d, t in rows:
        ids.setdefault(d, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])
    found = packing.pack_documents(plain.documents(spark, rows)).collect()
    used = plain.check_packing(found, ids)
    total = sum(len(i) for copies in ids.values() for i in copies)
    assert used <= -(-total // 2048) + 2


def test_packing_in_many_buckets(spark):
    pieces = spark.createDataFrame(
        [(i, 1 + i * 37 % 100) for i in range(2000)], "doc_id long, length long"
    )
    found = packing.pack_pieces(pieces, capacity=100, bucket_pieces=150).collect()
    assert Counter(r["doc_id"] for r in found) == Counter(range(2000))
    ends = Counter()
    for r in found:
        ends[r["sequence_id"]] = max(ends[r["sequence_id"]], r["offset"] + r["length"])
    assert max(ends.values()) <= 100
    assert len(ends) <= 1.05 * sum(r["length"] for r in found) / 100


def test_two_documents_replace_the_smallest():
    # Greedy takes 6 + 3 and leaves a gap of 1; 2 + 2 fill the place of the 3.
    bins, offsets = packing.best_two_fit(np.array([6, 3, 2, 2]), 10)
    assert bins.tolist() == [0, 1, 0, 0]
    assert sorted(offsets[[0, 2, 3]].tolist()) == [0, 6, 8]


def test_sharding(spark, given):
    rows = both(spark, given)
    found = sharding.shard_documents(plain.documents(spark, rows)).collect()
    size = lambda t: len((t or "").encode())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == Counter(
        (d, size(t) + 16, zlib.crc32((t or "").encode())) for d, t in rows
    )
    slots = {}
    for r in found:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert set(slots) <= set(range(40))


def test_sharding_splits_hot_groups_and_balances(spark):
    rows = [(i, "same text of all") for i in range(3000)] + [
        (3000 + i, f"group{i // 3} " + "word " * (1 + i // 3 * 7919 % 400)) for i in range(6000)
    ]
    found = sharding.shard_documents(plain.documents(spark, rows), bucket_rows=1500).collect()
    total, count = Counter(), Counter()
    for r in found:
        total[r["shard"]] += r["size"]
        count[r["shard"]] += 1
    assert max(total.values()) <= 1.03 * min(total.values())
    assert max(count.values()) <= 1.3 * min(count.values())
    where = {}
    for r in found:
        if r["doc_id"] >= 3000:
            where.setdefault(r["text_crc32"], set()).add(r["shard"])
    assert all(len(s) == 1 for s in where.values())  # small groups stay whole


def test_sharding_keeps_groups_below_a_share_whole(spark):
    # 60,000 rows, so a shard's share is 1,500: 1,000 equal rows stay whole, 20,000 cannot.
    rows = [(i, "word " * 40 + "hot") for i in range(20_000)] + [
        (20_000 + i, f"copied {i // 1000} " + "word " * 40) for i in range(12_000)
    ] + [(32_000 + i, f"single {i} " + "word " * (i * 7919 % 80)) for i in range(28_000)]
    found = sharding.shard_documents(plain.documents(spark, rows)).collect()
    assert len(found) == len(rows)
    total, where = Counter(), {}
    for r in found:
        total[r["shard"]] += r["size"]
        where.setdefault(rows[r["doc_id"]][1], set()).add(r["shard"])
    assert max(total.values()) <= 1.03 * min(total.values())
    assert [t for t, s in where.items() if len(s) > 1] == [rows[0][1]]


def test_near_duplicates(spark, given):
    rows = both(spark, given)
    near = [(5000 + i, t + f" tail{i}") for i, (_, t) in enumerate(given[:30]) if t]
    rows = rows + near + [(6000, given[0][1]), (6001, given[0][1].upper())]
    prints = [plain.simhash(t) for _, t in rows]
    least = {}
    of = plain.groups(prints)
    for (d, _), g in zip(rows, of, strict=True):
        if d is not None:
            least[g] = min(d, least.get(g, d))
    expected = Counter((d, f"{p:016x}", least.get(g)) for (d, _), p, g in zip(rows, prints, of, strict=True))
    docs = plain.documents(spark, rows)
    assert Counter(tuple(r) for r in simhash_dedup.near_duplicates(docs).collect()) == expected
    kept = simhash_dedup.keep_one(docs)
    assert kept.schema == plain.DOCS
    plain.check_one_of_each_group(rows, [(r["doc_id"], r["text"]) for r in kept.collect()], 4)


def test_no_link_is_missed_in_dense_groups(spark):
    rng = np.random.default_rng(3)
    centres = rng.integers(0, 1 << 62, 6)
    prints = set()
    for c in centres:
        for _ in range(250):
            x = int(c)
            for bit in rng.choice(64, rng.integers(0, 6), replace=False):
                x ^= 1 << int(bit)
            prints.add(x)
    chain = int(rng.integers(0, 1 << 62))
    for bit in range(0, 60, 4):
        prints.add(chain)
        chain ^= 15 << bit
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p, 1) for p in signed], "_fp long, _rows long")
    root = {r["node"]: r["root"] for r in simhash_dedup.link_fingerprints(frame).collect()}
    of = plain.groups(prints)
    pairs = {(g, root.get(p, p)) for p, g in zip(signed, of, strict=True)}
    assert len(pairs) == len({g for g, _ in pairs}) == len({r for _, r in pairs})


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901), (5, 5)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(links, "a", "b").collect()}
    assert found == {**dict.fromkeys(range(301), 0), 900: 900, 901: 900}


def test_components_of_few_links_and_of_many(spark, monkeypatch):
    """A round in one task and one dealt over tasks give what joining link by link gives."""
    rng = np.random.default_rng(4)
    pairs = [tuple(map(int, rng.integers(0, 60, 2))) for _ in range(35)] + [(100, 200 + i) for i in range(20)]
    least = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in least:
        for a, b in pairs:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    links = spark.createDataFrame(pairs, "a long, b long")
    module = importlib.import_module("sievemart.llm.components")
    for most in (module.TASK_LINKS, 16):
        monkeypatch.setattr(module, "TASK_LINKS", most)
        found = [tuple(r) for r in components(links, "a", "b").select("node", "root").collect()]
        assert sorted(found) == sorted(least.items())
    assert components(links.limit(0), "a", "b").isEmpty()


@pytest.mark.parametrize("hot", [1000, 2])
def test_repeated_passages(spark, given, monkeypatch, hot):
    monkeypatch.setattr(fm_substrings, "HOT_SEGMENTS", hot)
    rows = both(spark, given)
    expected = Counter()
    for (d, _), (found, kept) in zip(rows, plain.kept_words([t for _, t in rows]), strict=True):
        expected[d, len(found), len(found) - len(kept), " ".join(kept)] += 1
    report = fm_substrings.removal_report(plain.documents(spark, rows)).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_removed"], r["kept"]) for r in report) == expected
    for r in report:
        assert sum(s["last"] - s["first"] + 1 for s in r["spans"]) == r["n_removed"]


def test_remove_repeats_keeps_columns_and_clean_texts(spark):
    cleaned = fm_substrings.remove_repeats(plain.documents(spark))
    assert cleaned.schema == plain.DOCS
    texts = {(r["doc_id"], r["text"]) for r in cleaned.collect()}
    assert {(1, None), (2, ""), (3, plain.AWKWARD[2][1]), (4, "word"), (6, plain.LONG)} <= texts
    assert (8, "Its own few words") in texts


def test_fm_index_counts_weighted_occurrences():
    rng = np.random.default_rng(1)
    segments = [rng.integers(1, 6, rng.integers(9, 30)).astype(np.int64) for _ in range(200)]
    weights = rng.integers(1, 4, len(segments))
    times = Counter()
    for s, w in zip(segments, weights, strict=True):
        for n in range(8, 10):
            for i in range(len(s) - n + 1):
                times[tuple(s[i : i + n])] += int(w)
    index = FmIndex(segments, weights, 9)
    assert index.seed_words == 8
    for least in (2, 5):
        ends = np.concatenate([index.starts[j] + np.arange(9, len(s) + 1) for j, s in enumerate(segments)])
        expected = []
        for s in segments:
            for e in range(9, len(s) + 1):
                fits = [n for n in (8, 9) if times[tuple(s[e - n : e])] >= least]
                expected.append(max(fits, default=0))
        assert index.matching_statistics(ends, 9, least).tolist() == expected


def test_leaks(spark):
    items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    items += [(100, None), (101, "  "), (102, "Three short words"), (102, "Three short words"), (None, plain.PASSAGE)]
    given = spark.read.parquet(f"{SF}/documents.parquet").collect()
    docs = [(1000 + r["doc_id"], r["text"]) for r in given]
    rng = np.random.default_rng(5)
    for n, (_, text) in enumerate(items[:40]):
        w = text.split()
        for edits in (0, 1, 2, 4):
            changed = list(w)
            for _ in range(edits):
                at = int(rng.integers(0, len(changed)))
                kind = rng.integers(0, 3)
                changed[at : at + (kind > 0)] = ["other"] if kind < 2 else []
            docs.append((10_000 + 10 * n + edits, f"Before it {' '.join(changed).upper()} and after."))
    docs = docs + plain.AWKWARD
    frame = plain.documents(spark, docs)
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.find_leaks(frame, bench, ["doc_id"]).collect()
    expected = plain.leaks(docs, items)
    got = {(r["doc_id"], r["item_id"]) for r in found}
    assert got == expected
    assert len(found) == len(got) > 50
    clean = decontaminate.remove_leaks(frame, bench)
    assert clean.schema == plain.DOCS
    ids = {d for d, _ in got}
    assert Counter(r["text"] for r in clean.collect()) == Counter(
        t for d, t in docs if d not in ids or d is None and t is None
    )


def test_no_broadcast_gives_the_same_leaks(spark, monkeypatch):
    docs, bench = (spark.read.parquet(f"{SF}/{n}.parquet") for n in ("documents", "benchmark"))
    found = sorted(map(tuple, decontaminate.find_leaks(docs, bench, ["doc_id"]).collect()))
    monkeypatch.setattr(decontaminate, "BROADCAST_ROWS", 0)
    assert found and found == sorted(map(tuple, decontaminate.find_leaks(docs, bench, ["doc_id"]).collect()))


def test_empty_tables(spark):
    docs = plain.documents(spark, [])
    bench = spark.createDataFrame([], "item_id long, text string")
    assert quality.quality_report(docs).count() == 0
    assert quality.keep_good(docs).count() == 0
    assert token_counts.count_tokens(docs).count() == 0
    assert packing.pack_documents(docs).count() == 0
    assert sharding.shard_documents(docs).count() == 0
    assert simhash_dedup.near_duplicates(docs).count() == 0
    assert simhash_dedup.keep_one(docs).count() == 0
    assert fm_substrings.removal_report(docs).count() == 0
    assert fm_substrings.remove_repeats(docs).count() == 0
    assert decontaminate.find_leaks(docs, bench, ["doc_id"]).count() == 0
    assert decontaminate.find_leaks(plain.documents(spark), bench, ["doc_id"]).count() == 0
    assert decontaminate.remove_leaks(plain.documents(spark), bench).count() == len(plain.AWKWARD)
