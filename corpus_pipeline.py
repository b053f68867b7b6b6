"""Corpus pipeline: rated quality, near copies, secrets, source mix, tokens.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; :func:`run` writes it to
the shared folder as Parquet and reads it again as the next stage's documents.  All stages but the
last return the columns of the documents they got.

1. quality   documents whose probability of the top grade is under one half go
2. copies    of documents whose sets of five-word shingles link at 0.8, directly or through others, the one with the smallest id stays
3. secrets   each secret found is replaced by the name of its kind; ``n_chars`` follows
4. mix       documents are drawn to the sources' target weights; what a source lacks is repeated
5. tokens    adds ``ids`` (array<int>) and ``n_tokens`` of every whole text

Defined cases
  null text       scored as the empty text, linked with nothing, no secrets, of size 0: goes through once if its score lets it; no ids
  null id         a document like others; of a group of copies the smallest id that is not null stays
  null source     a source of its own
  repeated rows   copies of each other: one stays
  ties            as the stages tell
  very long text  read whole by each stage
  empty table     no rows; with no rating of two grades every document passes the first stage
  extra columns   kept up to the last stage
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from daylake.llm import bpe, mixing, ngram_join, ordinal_quality, secret_ledger
from daylake.llm.common import keep_table
from daylake.llm.queries import rated


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ordinal_quality.select(docs, ordinal_quality.train(docs, rated(spark, sf_dir)))


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return ngram_join.without_copies(docs)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return secret_ledger.redact(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed_documents(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return bpe.encode(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [("quality", quality), ("copies", copies), ("secrets", secrets), ("mix", mix), ("tokens", tokens)]

# The fitted classifier can't be expressed in SQL; tests/llm/test_pipeline_run.py compares all rows of a run with a plain Python version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = keep_table(spark, stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
