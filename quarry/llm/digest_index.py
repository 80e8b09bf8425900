"""Exact deduplication against a persistent digest index (native).

The index is a Parquet table, bucketed and sorted by digest.  A batch is
reduced to one row per digest, sort-merge anti-joined with the index (whose
side needs no shuffle) and the new digests are appended.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import cut, id_text, known_groups, salted

#: Characters that equality ignores: fixed values.
BLANKS = " \t\n\x0b\x0c\r"


def digest_of(text: Column) -> Column:
    """SHA-256 (32 bytes) of the text without its blanks, in UTF-8."""
    return F.unhex(F.sha2(F.translate(text, BLANKS, "").cast("binary"), 256))


class DigestIndex:
    """Digests seen so far at ``path``, in ``buckets`` buckets.

    ``path`` must be in storage that all executors share.  Opening a folder
    that an earlier session filled continues it; ``buckets`` must then be the
    same as before.  One writer at a time may append.
    """

    def __init__(self, spark: SparkSession, path: str, buckets: int = 64):
        self.spark, self.path, self.buckets = spark, path, buckets
        self.name = f"digest_index_{uuid.uuid4().hex[:12]}"
        spark.sql(f"CREATE TABLE {self.name} (digest BINARY, keep_id BIGINT, n_chars BIGINT, batch STRING) USING parquet "
                  f"CLUSTERED BY (digest) SORTED BY (digest) INTO {buckets} BUCKETS LOCATION '{path}'")

    def rows(self) -> DataFrame:
        return self.spark.table(self.name)

    def close(self) -> None:
        """Forget the table's name; its files stay and can be opened again."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")

    def missing(self, digests: DataFrame, batch_id: str | None = None) -> DataFrame:
        """Rows of ``digests`` whose digest the index doesn't hold from
        another batch than ``batch_id``."""
        held = self.rows() if batch_id is None else self.rows().filter(F.col("batch") != batch_id)
        return digests.hint("merge").join(held, "digest", "left_anti")

    def append(self, entries: DataFrame) -> None:
        """Add entries; each bucket gets one sorted file per append."""
        self.spark.sql(f"REFRESH TABLE {self.name}")
        (entries.select("digest", "keep_id", "n_chars", "batch").repartition(self.buckets, "digest")
         .write.insertInto(self.name))
        self.spark.sql(f"REFRESH TABLE {self.name}")

    def compact(self, path: str) -> DigestIndex:
        """A copy at ``path`` with one file per bucket, so that reads are
        sorted again after many appends."""
        new = DigestIndex(self.spark, path, self.buckets)
        new.append(self.rows())
        return new

    def ingest(self, batch: DataFrame, id_col: str = "doc_id", text_col: str = "text", batch_id: str | None = None) -> DataFrame:
        """Deduplicate ``batch`` against the index and itself, then append.

        The index remembers which batch each digest came with.  A batch is
        compared with the digests of all other batches, and only digests that
        it has not appended yet are appended; so one that is ingested again
        after a failure gives the same rows as the first time, however far
        that came.  ``batch_id`` names the batch; without it the batch is
        known by its rows (ids and digests).

        One row per input row: ``doc_id, keep_id, group_size, kept, known,
        text_sha256, text_hash`` (XXH64 of the whole text).  Of equal new texts the one with the most code points
        stays, then the smallest doc_id; a text that the index knows is
        dropped (``known``) in favour of the index's ``keep_id``.
        ``group_size`` counts the batch's rows with that text.

        Null texts count as empty and equal each other.  A null doc_id sorts
        after all others.  Identical rows are each returned; one of them can
        be kept.  An empty batch gives an empty result and appends nothing.
        Only the two named columns are read, so others never clash; texts of
        any length are digested whole.
        """
        src = id_text(batch, id_col, text_col)
        docs = cut(src.select("doc_id", digest_of(F.col("text")).alias("digest"),
                              F.length("text").cast("bigint").alias("n_chars"), F.xxhash64("text").alias("text_hash")))
        if batch_id is None:
            mark = docs.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("doc_id", "digest")), F.sum(F.xxhash64("digest", "doc_id") % (1 << 30))).first()
            batch_id = ":".join(map(str, mark))
        docs = (docs.groupBy("digest", "doc_id", "n_chars", "text_hash").agg(F.count(F.lit(1)).alias("n"))
                .withColumn("_salt", salted("doc_id", "text_hash")))
        order = F.struct((-F.col("n_chars")).alias("c"), F.col("doc_id").isNull().alias("z"), F.col("doc_id").alias("i"),
                         F.col("text_hash").alias("h"))
        groups = known_groups(docs, ["digest"], {"best": F.min(order), "n": F.sum("n")},
                              {"best": F.min("best"), "group_size": F.sum("n")})
        groups = cut(groups)
        entries = (groups.groupBy("digest").agg(F.first("best").alias("best"))
                   .select("digest", F.col("best.i").alias("keep_id"), (-F.col("best.c")).alias("n_chars"), F.lit(batch_id).alias("batch")))
        new = self.missing(entries, batch_id)
        mine = self.rows().filter(F.col("batch") == batch_id).select("digest")  # appended before a failure
        new = cut(new.hint("merge").join(mine, "digest", "left_anti"))
        held = (entries.select("digest").hint("merge")
                .join(self.rows().filter(F.col("batch") != batch_id).select("digest", F.col("keep_id").alias("held_id")), "digest"))
        held = cut(held)
        self.append(new)
        groups = groups.join(held.withColumn("known", F.lit(True)), "digest", "left")
        known = F.coalesce("known", F.lit(False))
        first = F.col("best").eqNullSafe(order) & ~known
        return (docs.join(groups.drop("n"), ["digest", "_salt"])
                .select("doc_id", F.when(known, F.col("held_id")).otherwise(F.col("best.i")).alias("keep_id"),
                        "group_size", first.alias("first"), known.alias("known"),
                        F.lower(F.hex("digest")).alias("text_sha256"), "text_hash",
                        F.explode(F.sequence(F.lit(1).cast("bigint"), F.col("n"))).alias("copy"))
                .select("doc_id", "keep_id", "group_size", (F.col("first") & (F.col("copy") == 1)).alias("kept"),
                        "known", "text_sha256", "text_hash"))
