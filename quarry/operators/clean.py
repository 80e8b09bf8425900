"""Cleaning and 2NF projection of the flat retail table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

KEY_COLUMNS = ("InvoiceNo", "StockCode", "CustomerID", "InvoiceDate")
DATETIME_FORMAT = "yyyy-MM-dd HH:mm:ss"


def drop_null_keys(df: DataFrame, subset: Sequence[str] = KEY_COLUMNS) -> DataFrame:
    """Drop rows with a null in any key column."""
    return df.dropna(how="any", subset=list(subset))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row duplicate removal (a partial + final aggregate on all columns)."""
    return df.distinct()


def cast_int(df: DataFrame, column: str = "CustomerID") -> DataFrame:
    """Float id to int, truncating as ``astype(int)`` does."""
    return df.withColumn(column, F.col(column).cast("int"))


def parse_datetime(df: DataFrame, column: str = "InvoiceDate") -> DataFrame:
    """Parse text to a timestamp; unparseable values become null and are dropped."""
    parsed = F.col(column).cast("string").try_cast("timestamp_ntz")
    return df.withColumn(column, parsed).filter(F.col(column).isNotNull())


def clean_pipeline(df: DataFrame) -> DataFrame:
    """The four cleaning steps in the reference's order."""
    return (df.transform(drop_null_keys)
              .transform(distinct_rows)
              .transform(cast_int)
              .transform(parse_datetime))


def keep_first(df: DataFrame, keys: Sequence[str], order: Column | str, columns: Sequence[str]) -> DataFrame:
    """Keep the first row per key in the given order.

    Written as ``min_by`` in an aggregate rather than ``row_number`` over a
    window: the aggregate runs partially before the shuffle, so a key that
    holds a large share of the rows is reduced on the map side instead of
    being sorted whole in one task.  ``order`` must be a total order (ties are
    broken by the struct of the kept values, so the result is deterministic).
    """
    order_col = F.col(order) if isinstance(order, str) else order
    kept = F.min_by(F.struct(*columns), F.struct(order_col, F.struct(*columns))).alias("_first")
    return df.groupBy(*keys).agg(kept).select(*keys, *[F.col(f"_first.{c}").alias(c) for c in columns])


# ------------------------------------------------------------ 2NF projections

def products_2nf(retail: DataFrame, order: str = "RowKey") -> DataFrame:
    """Products(StockCode, Description): first row per stock code."""
    return keep_first(retail, ["StockCode"], order, ["Description"])


def invoices_2nf(retail: DataFrame, order: str = "RowKey") -> DataFrame:
    """Invoices(InvoiceNo, InvoiceDate, CustomerID, Country): first row per invoice."""
    return keep_first(retail, ["InvoiceNo"], order, ["InvoiceDate", "CustomerID", "Country"])


def invoice_items_2nf(retail: DataFrame) -> DataFrame:
    """InvoiceItems: projection only, no de-duplication (as in the reference)."""
    return retail.select("InvoiceNo", "StockCode", "Quantity", "UnitPrice")


# ------------------------------------------------------------ key checks

def pk_violations(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once (composite keys allowed)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
              .filter(F.col("n_rows") > 1))


def fk_orphans(child: DataFrame, parent: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Child rows whose key has no parent row (``left_anti``; duplicate parent
    keys do not change an anti join, so no distinct pass is needed)."""
    return child.join(parent.select(*keys), list(keys), "left_anti")
