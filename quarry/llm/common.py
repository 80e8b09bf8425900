"""Helpers shared by the training-data operators."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.session import checkpoint_dir, scratch_path, ship_package
from quarry.sources.tables import table

__all__ = ["by_size", "cut", "documents", "drop_path", "id_text", "known_groups", "salted", "ship_package", "table", "texts", "slices", "written"]

#: Sub-groups that one key is dealt into before its rows meet.
SALTS = 256


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "documents")


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator reads: ``doc_id`` (bigint, may be
    null) and ``text`` (a null text is empty).  Other columns, whatever their
    names, are left out, so none can clash with a result column."""
    return df.select(F.col(id_col).cast("bigint").alias("doc_id"),
                     F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))


def cut(df: DataFrame) -> DataFrame:
    """Cut the lineage: a reliable checkpoint in the shared folder, so later
    jobs neither recompute the input nor depend on one executor's disk."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def written(df: DataFrame, name: str, old: list[str] | None = None) -> DataFrame:
    """Cut the lineage by a written table in the shared folder, for loops:
    unlike a checkpoint the new plan knows its size and nothing of the old
    plan.  The path is added to ``old``, for ``drop_path``."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    if old is not None:
        old.append(path)
    return spark.read.schema(df.schema).parquet(path)


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a scratch folder, in whatever file system it is."""
    jvm = spark.sparkContext._jvm
    at = jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def salted(*row: str | Column, salts: int = SALTS) -> Column:
    """Sub-group of a row, from columns that differ inside a hot group."""
    return F.pmod(F.xxhash64(*row), F.lit(salts)).cast("int")


def known_groups(rows: DataFrame, key: list[str], partial: dict[str, Column], total: dict[str, Column]) -> DataFrame:
    """Aggregate ``rows`` (which carry ``_salt``) by ``key`` in two steps and
    return one row for each (key, _salt) that occurs, with the key's totals.

    The result joins back to ``rows`` on ``key + ["_salt"]``: a key that holds
    a third of all rows is spread over its salts on both sides, and no more
    rows are made than there are (key, salt) pairs in the input.
    ``partial`` aggregates rows, ``total`` the partial columns.
    """
    first = rows.groupBy(*key, "_salt").agg(*[c.alias(n) for n, c in partial.items()])
    whole = first.groupBy(*key).agg(*[c.alias(n) for n, c in total.items()], F.collect_list("_salt").alias("_salts"))
    return whole.withColumn("_salt", F.explode("_salts")).drop("_salts")


def texts(column: pa.Array | pa.ChunkedArray) -> list[str]:
    return ["" if x is None else x for x in column.to_pylist()]


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Smaller batches, so that what a batch's results take stays bounded."""
    for b in batches:
        for at in range(0, b.num_rows, rows):
            yield b.slice(at, rows)


def by_size(batches: Iterator[pa.RecordBatch], column: int, most: int = 1 << 21, rows: int = 1024) -> Iterator[pa.RecordBatch]:
    """Smaller batches of at most ``rows`` rows and about ``most`` bytes in a
    string or binary column; a longer value is a batch of its own."""
    for b in batches:
        size = np.cumsum(pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64))
        at = 0
        while at < b.num_rows:
            before = size[at - 1] if at else 0
            end = min(max(int(np.searchsorted(size, before + most, "right")), at + 1), at + rows)
            yield b.slice(at, min(end, b.num_rows) - at)
            at = end
