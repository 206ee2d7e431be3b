"""The pipeline, stage by stage, against the rules in plain Python."""

from __future__ import annotations

import pytest
from tokenizers import Tokenizer

import __spark_entry__ as contract
import corpus_pipeline
from sievemart.llm import quality
from sievemart.llm.queries import QUERIES
from sievemart.llm.tokens import default_vocabulary
from tests.llm import plain

SF = "/root/testdata/sf0.001"


def test_all_operators_and_the_pipeline_are_registered():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= set(contract.queries())
    assert [n for n, _ in corpus_pipeline.STAGES] == [
        "quality_rules", "near_dedup", "substring_dedup", "decontamination", "best_fit_packing",
    ]


@pytest.mark.parametrize("awkward", [False, True])
def test_stages(spark, tmp_path, awkward):
    given = spark.read.parquet(f"{SF}/documents.parquet")
    docs = plain.documents(spark) if awkward else given
    schema = docs.schema
    bench = [tuple(r) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    tokenizer = Tokenizer.from_file(default_vocabulary())
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    for number, (name, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(number)))
        docs = spark.read.parquet(str(tmp_path / str(number)))
        if name == "best_fit_packing":
            break
        assert docs.columns == schema.names
        found = sorted(((r["doc_id"], r["text"]) for r in docs.collect()), key=repr)
        if name == "quality_rules":
            fine = {r["doc_id"] for r in quality.quality_report(spark.createDataFrame(rows, "doc_id long, text string")).collect() if r["kept"]}
            expected = [r for r in rows if r[0] in fine]
            assert all(not plain.quality_counts(t)[5] for _, t in expected)
        elif name == "near_dedup":
            plain.check_one_of_each_group(rows, found)
            expected = found
        elif name == "substring_dedup":
            expected = [
                (d, t if len(w) == len(k) else " ".join(k))
                for (d, t), (w, k) in zip(rows, plain.kept_words([t for _, t in rows]), strict=True)
            ]
        else:
            leaky = {d for d, _ in plain.leaks(rows, bench)}
            expected = [r for r in rows if r[0] not in leaky]
        assert found == sorted(expected, key=repr), name
        rows = found
        if not awkward and name == "substring_dedup":
            assert all(r["n_chars"] == len(r["text"]) for r in docs.collect())
    ids = {}
    for d, t in rows:
        ids.setdefault(d, []).append(tokenizer.encode(t or "", add_special_tokens=False).ids + [0])
    plain.check_packing(docs.collect(), ids)


def test_run_is_its_stages(spark):
    packed = corpus_pipeline.run(spark, SF)
    assert packed.count() > 0
    assert packed.columns[:2] == ["doc_id", "piece"]


def test_stages_on_empty_documents(spark):
    docs = plain.documents(spark, [])
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0
