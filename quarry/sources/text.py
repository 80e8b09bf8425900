"""Text tables derived from ``documents`` / ``labels`` / ``pages``.

* reviews  — ``(id, text, label)``: documents left-joined to their quality
  label (null when unlabelled), the shape of the review table.
* sentences — ``(split, id, tokens, ner_tags)``: one tokenised document per
  row.  The test data ships no entity tags, so tags come from a fixed,
  transparent rule (token length mod 9 indexes the tag dictionary); the split
  is a fixed function of the id.  Both are reproducible in SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions.text import tokens
from quarry.sources.tables import table

# The public CoNLL-2003 tag dictionary (index = tag id) and the
# B- ids counted by the reference's statistics.
TAG_NAMES = ["O", "B-PER", "I-PER", "B-ORG", "I-ORG", "B-LOC", "I-LOC", "B-MISC", "I-MISC"]
ENTITY_B_IDS = {"PER": 1, "ORG": 3, "LOC": 5, "MISC": 7}
SPLITS = ("train", "validation", "test")


def split_of(id_col) -> F.Column:
    """train (ids ending 0-7), validation (8), test (9)."""
    d = F.pmod(F.col(id_col) if isinstance(id_col, str) else id_col, F.lit(10))
    return F.when(d < 8, "train").when(d == 8, "validation").otherwise("test")


def reviews(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    labels = table(spark, sf_dir, "labels", "doc_id", "quality")
    return (docs.join(labels, "doc_id", "left")
            .select(F.col("doc_id").alias("id"), "text", F.col("quality").alias("label")))


def sentences(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    tok = tokens("text")
    return docs.select(
        split_of("doc_id").alias("split"),
        F.col("doc_id").alias("id"),
        tok.alias("tokens"),
    ).withColumn("ner_tags", F.transform("tokens", lambda t: F.pmod(F.length(t), F.lit(9))))
