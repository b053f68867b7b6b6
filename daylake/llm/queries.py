"""The registered queries of the training-data operators and their DuckDB oracles."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daylake.llm import (
    bpe,
    filter_audit,
    license_scan,
    mixing,
    ngram_join,
    ordinal_quality,
    quality_rules,
    secret_ledger,
    sharding,
    spelling,
    spotsigs,
    url_filter,
    window_dedup,
)


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    path = public_tokenizers.path("byte_bpe_50k.json")
    coded = bpe.encode(docs, path, packed=True, decoded_col="decoded")
    return coded.select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")
    )


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality_rules.judge(_table(spark, sf_dir, "documents").select("doc_id", "text", "lang"))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    return judged.select("row.doc_id", *counts, "base_failed", "kept")


def op3_spotsigs(spark: SparkSession, sf_dir: str) -> DataFrame:
    compared = spotsigs.compare_with_next(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return compared.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint", "near_edited", "near_next"
    )


def spot_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The search over the fingerprints: near copies by spot signatures, partitioned by set length."""
    return spotsigs.near_duplicates(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op4_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.link(_table(spark, sf_dir, "documents").select("doc_id", "text"))


def op5_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.judge(_table(spark, sf_dir, "pages").select("page_id", "url"))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.place(_table(spark, sf_dir, "documents").select("doc_id"))
    return placed.select("row.doc_id", "slot", "shard")


def rated(spark: SparkSession, sf_dir: str) -> DataFrame:
    grade = ordinal_quality.grade_of(F.col("quality"), F.col("toxic")).alias("grade")
    return _table(spark, sf_dir, "labels").select("doc_id", grade)


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = ordinal_quality.train(docs, rated(spark, sf_dir))
    scored = ordinal_quality.score(docs, model)
    return scored.select("doc_id", "expected_grade", "p_top", "kept")


def op8_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secret_ledger.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    base = tuple(r.kind for r in secret_ledger.BASE_RULES)
    counts = [secret_ledger.count_of(F.col("spans"), k).alias(f"n_{k}") for k in base]
    return found.select(
        "row.doc_id",
        *counts,
        F.sha2(secret_ledger.joined(F.col("spans"), base), 256).alias("base_sha256"),
        secret_ledger.joined(F.col("spans")).alias("spans"),
    )


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))


def op10_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = license_scan.scan(_table(spark, sf_dir, "documents").select("doc_id", "text"), templates=license_scan.production())
    spans = F.transform("licenses", lambda x: F.concat_ws(":", x["license"], x["start"], x["end"]))
    return found.select("doc_id", "license", "dice", F.array_join(spans, ",").alias("spans"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return filter_audit.audit(docs, _table(spark, sf_dir, "labels").select("doc_id", "quality", "toxic"))


def op12_window_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = window_dedup.cut_repeats(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return cut.select(F.col("id").alias("doc_id"), "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_spelling(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(_table(spark, sf_dir, "documents").select("doc_id", "text"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bpe": op1_bpe,
    "op2_quality_rules": op2_quality_rules,
    "op3_spotsigs": op3_spotsigs,
    "spot_groups": spot_groups,
    "op4_ngram_join": op4_ngram_join,
    "op5_urls": op5_urls,
    "op6_sharding": op6_sharding,
    "op7_quality": op7_quality,
    "op8_secrets": op8_secrets,
    "op9_mixing": op9_mixing,
    "op10_licenses": op10_licenses,
    "op11_filter_audit": op11_filter_audit,
    "op12_window_dedup": op12_window_dedup,
    "op13_spelling": op13_spelling,
}

ORACLES: dict[str, str] = {
    "op2_quality_rules": quality_rules.ORACLE,
    "op4_ngram_join": ngram_join.ORACLE,
    "op5_urls": url_filter.ORACLE,
    "op6_sharding": sharding.ORACLE,
    "op8_secrets": secret_ledger.ORACLE,
    "op9_mixing": mixing.ORACLE,
    "op11_filter_audit": filter_audit.ORACLE,
    "op12_window_dedup": window_dedup.ORACLE,
}
