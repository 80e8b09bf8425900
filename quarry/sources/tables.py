"""Readers for the parquet tables of a scale-factor folder."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def table(spark: SparkSession, sf_dir: str, name: str, *columns: str) -> DataFrame:
    """Read one table; naming ``columns`` prunes the parquet scan."""
    if name not in TABLES:
        raise ValueError(f"unknown table {name!r}")
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def is_bounded(df: DataFrame, max_rows: int) -> bool:
    """True when ``df`` has at most ``max_rows`` rows.

    Runs ``limit(max_rows + 1).count()``, which stops reading once the bound is
    passed, so the check itself stays cheap on a large input.
    """
    return df.limit(max_rows + 1).count() <= max_rows


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = 100_000) -> DataFrame:
    """Join with a broadcast of ``small`` only after its row count is checked.

    Above the bound the join is left to Catalyst / AQE (sort-merge or a
    runtime broadcast when the measured shuffle output is small).
    """
    if is_bounded(small, max_rows):
        return big.join(F.broadcast(small), on, how)
    return big.join(small, on, how)


def with_scalars(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Attach the columns of a global aggregate (exactly one row) to every row.

    ``one_row`` must be an ungrouped ``agg(...)`` result, so the join
    broadcasts a single row; no pairs are generated.
    """
    return df.crossJoin(F.broadcast(one_row))


def null_safe_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join on the columns ``on`` in which null equals null; the result
    has the left side's columns and the right side's others.  The strategy is
    left to Catalyst and AQE."""
    marked = right.select(*[F.col(c).alias(f"_right_{c}") for c in on], *[F.col(c) for c in right.columns if c not in on])
    same = reduce(and_, [F.col(c).eqNullSafe(F.col(f"_right_{c}")) for c in on])
    return left.join(marked, same, how).drop(*[f"_right_{c}" for c in on])
