"""The registered query of each operator: whole tables, production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sievemart.llm import (
    decontaminate,
    fm_substrings,
    hard_negatives,
    html_text,
    ngram_join,
    packing,
    quality,
    sharding,
    simhash_dedup,
    token_alignment,
    token_counts,
    url_rules,
    warc_fixity,
)
from sievemart.llm.common import table
from sievemart.session import cut_lineage


def op1_best_two_fit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(table(spark, sf_dir, "documents"))


def op2_vector_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, benchmark = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return decontaminate.find_leaks(documents, benchmark, ["doc_id"]).drop("bits")


def op4_merkle_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faults between an archive of all pages and a replica damaged by a stated rule.

    The first byte of a page's MD5 decides: 0 to 3 the record's first byte is
    other, 4 to 7 the record is missing, 8 to 11 its last byte is.
    """
    pages = table(spark, sf_dir, "pages")
    fault = F.conv(F.substring(F.md5(F.coalesce("html", F.lit(""))), 1, 2), 16, 10).cast("int")
    whole = cut_lineage(warc_fixity.warc_records(pages.withColumn("fault", fault), extra=["fault"]))
    damaged = whole.filter(~F.col("fault").between(4, 7)).withColumn(
        "record",
        F.when(F.col("fault") < 4, F.expr("concat(X'58', substring(record, 2))"))
        .when(F.col("fault").between(8, 11), F.expr("substring(record, 1, length(record) - 1)"))
        .otherwise(F.col("record")),
    )
    faults = warc_fixity.merkle_audit(whole, damaged)
    return faults.join(whole.select("archive", "offset", "page_id"), ["archive", "offset"]).select(
        "page_id", "kind", "length", "found_length", "digest", "found_digest"
    )


def op5_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract_text(table(spark, sf_dir, "pages"))


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = quality.quality_report(table(spark, sf_dir, "documents"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return report.select("doc_id", *counts, "base_failed", "kept")


def op9_fm_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    report = fm_substrings.removal_report(table(spark, sf_dir, "documents"))
    kept = F.sha2("kept", 256).alias("kept_sha256")
    return report.select("doc_id", "n_words", "n_removed", kept)


def op10_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(list(url_rules.RULES), url_rules.RULE_SCHEMA)
    return url_rules.judge_urls(table(spark, sf_dir, "pages"), rules)


def op11_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_groups(table(spark, sf_dir, "documents"))


def op12_angular_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    shifted = (F.col("label") + 1) % 10
    label = F.when(F.col("vec_id") % 7 == 0, shifted).otherwise(F.col("label"))
    one_in = hard_negatives.ANCHOR_ONE_IN
    return hard_negatives.mine_negatives(vectors.withColumn("label", label), F.col("vec_id") % one_in == 0)


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align_tokens(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_best_two_fit": op1_best_two_fit,
    "op2_vector_sharding": op2_vector_sharding,
    "op3_decontamination": op3_decontamination,
    "op4_merkle_fixity": op4_merkle_fixity,
    "op5_simhash_dedup": op5_simhash_dedup,
    "op6_token_counts": op6_token_counts,
    "op7_html_text": op7_html_text,
    "op8_quality_rules": op8_quality_rules,
    "op9_fm_substrings": op9_fm_substrings,
    "op10_url_rules": op10_url_rules,
    "op11_ngram_join": op11_ngram_join,
    "op12_angular_negatives": op12_angular_negatives,
    "op13_token_alignment": op13_token_alignment,
}
