"""Corpus pipeline: quality rules, exact dedup, near dedup, secrets, packing.

Each stage is ``(spark, docs, sf_dir) -> DataFrame``; its result is written as
Parquet and read again as the next stage's ``docs``.  All but the last return
the columns of ``documents``, whatever other columns there are.

In every stage a row is its doc_id and text: null ids and texts are values of
their own (a null text has the content of an empty one), and an empty table
passes through.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import digest_index, host_rules, lexical_packing, order_minhash, secret_scan
from quarry.llm.common import documents, drop_path
from quarry.session import scratch_path

#: SQL can't express the near-duplicate stage; tests hold the stages against brute force.
ORACLE_SQL = None


def _key(doc_id: str, text_hash) -> object:
    """One non-null join key, so that null ids meet as well."""
    return F.struct(F.col(doc_id).cast("bigint").alias("i"), text_hash.alias("h"))


def _keep(docs: DataFrame, kept: DataFrame, once: bool = False) -> DataFrame:
    """Rows of ``docs`` that ``kept`` names by (doc_id, text_hash), with the
    columns of ``docs``; ``once`` returns one of identical repeated rows."""
    names = docs.columns
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("_row"),
                       _key("doc_id", F.xxhash64(F.coalesce("text", F.lit("")))).alias("_key"))
    keys = kept.select(_key("doc_id", F.col("text_hash")).alias("_key")).distinct()
    rows = rows.join(keys.hint("shuffle_hash"), "_key", "left_semi")
    if once:
        rows = rows.dropDuplicates(["_key"])  # combined before the shuffle
    return rows.select("_row.*")


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base rules, or their host's habits, fail go."""
    return _keep(docs, host_rules.judge(docs).filter("kept"))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts that are equal but for blanks, one row stays."""
    index = digest_index.DigestIndex(spark, scratch_path(spark, "pipeline-index"))
    return _keep(docs, index.ingest(docs).filter("kept"), once=True)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class stays."""
    return _keep(docs, order_minhash.classes(docs).filter("kept"), once=True)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked; every document stays, with its new length."""
    return secret_scan.redact(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of sequences of 2048."""
    return lexical_packing.pack(docs, public_tokenizers.path("word_bpe_49k.json"))


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secrets),
    ("packing", packing),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage wrote goes once the next
    has been written."""
    docs, before = documents(spark, sf_dir), None
    last = len(STAGES) - 1
    for k, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < last:
            path = scratch_path(spark, f"pipeline-{name}")
            docs.write.parquet(path)
            docs = spark.read.parquet(path)
            if before:
                drop_path(spark, before)
            before = path
    return docs
