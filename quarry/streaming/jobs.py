"""Structured Streaming jobs over file sources.

* ``score_stream`` — typed input files are validated; good rows are scored
  and appended to the output table, malformed rows go to a quarantine table
  with their text, where it could not be parsed, in ``_corrupt_record``
  (the request/response service of the reference, as a stream).
* ``upsert_stream`` — micro-batches of keyed rows replace-or-insert into a
  hash-bucketed target table; each batch rewrites only the buckets it
  touches, and the keyed upsert makes a replayed batch harmless.

Both run with ``trigger(availableNow=True)`` and a checkpoint in the shared
folder, so a restarted job resumes where it stopped.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.operators.dml import upsert_replace

CORRUPT = "_corrupt_record"


def score_stream(spark: SparkSession, source: str, schema: T.StructType, is_valid: Callable[[], F.Column],
                 score: Callable[[DataFrame], DataFrame], out: str, quarantine: str, checkpoint: str,
                 fmt: str = "json") -> None:
    full = T.StructType([*schema.fields, T.StructField(CORRUPT, T.StringType())])
    stream = (spark.readStream.schema(full).format(fmt).option("columnNameOfCorruptRecord", CORRUPT)
              .option("maxFilesPerTrigger", 16).load(source))

    def handle(batch: DataFrame, epoch_id: int) -> None:
        ok = is_valid() & F.col(CORRUPT).isNull()
        flagged = batch.withColumn("_ok", F.coalesce(ok, F.lit(False)))
        # rows are written with the epoch id so a replayed epoch overwrites, not duplicates
        (score(flagged.filter("_ok").drop("_ok", CORRUPT)).withColumn("epoch", F.lit(epoch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(out))
        (flagged.filter(~F.col("_ok")).drop("_ok").withColumn("epoch", F.lit(epoch_id))
         .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("epoch").parquet(quarantine))

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()


def upsert_stream(spark: SparkSession, source: str, schema: T.StructType, target: str, keys: Sequence[str],
                  checkpoint: str, n_buckets: int, order: str | None = None, fmt: str = "parquet") -> str:
    """Apply every micro-batch to a hash-bucketed target table.

    Only the buckets that hold a key of the batch are read, upserted and
    replaced (dynamic partition overwrite), so a batch costs the size of its
    buckets, not of the table.  The upsert is idempotent, so a replayed
    epoch — or one that failed half-way through its commit — converges to
    the same table.
    """
    from quarry.sources import layout_store as store
    key = keys[0]
    stream = spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", 1).load(source)

    def handle(batch: DataFrame, epoch_id: int) -> None:
        sess = batch.sparkSession
        cols = [c for c in sess.read.parquet(target).columns if c != "bucket"]
        src = batch.select(*cols)
        store.rewrite_buckets(sess, target, key, src.select(key), n_buckets,
                              lambda part: upsert_replace(part, src, keys, order))

    q = (stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return target
