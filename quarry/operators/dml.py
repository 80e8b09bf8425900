"""Document writes re-expressed as table → table transforms.

A Spark user does not update a Parquet table in place; each write below
returns the new version of the table, to be written over the old one (or
appended), and ``upsert_replace`` is the keyed replace-or-insert used by the
batch and streaming ingest.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.sources.tables import join_small, with_scalars


def insert_rows(table: DataFrame, new: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Add documents (``insert_one`` / ``create_new_customer``).  With
    ``keys`` (the unique index) a document whose key exists already is
    rejected, and of equal keys in ``new`` one is added."""
    return bulk_insert(table, new, keys) if keys else table.unionByName(new)


def one_per_key(batch: DataFrame, keys: Sequence[str], order: str | None = None, last: bool = False) -> DataFrame:
    """One row per key: the first (or last) by ``order``, then by all other
    columns; without ``order`` by those alone.  Chunks of one document
    (column ``Chunk``) are told apart."""
    keys = [*keys, *(["Chunk"] if "Chunk" in batch.columns and "Chunk" not in keys else [])]
    cols = [c for c in batch.columns if c not in keys]
    if not cols:
        return batch.distinct()
    value = F.struct(*cols)
    pick = (F.max_by if last else F.min_by)(value, F.struct(*([F.col(order)] if order else []), *cols))
    return batch.groupBy(*keys).agg(pick.alias("_row")).select(*keys, "_row.*").select(*batch.columns)


def push_invoice(customers: DataFrame, customer_id: int, invoice: Column) -> DataFrame:
    """Append an invoice entry to a customer's document (``$push``).

    The entry goes into the customer's lowest-numbered chunk; other
    customers' documents pass through untouched (no shuffle: the target
    chunk is a one-row global aggregate, broadcast by construction).
    """
    is_customer = F.col("CustomerID") == F.lit(customer_id)
    target = customers.filter(is_customer).agg(F.min("Chunk").alias("_target"))
    hit = is_customer & (F.col("Chunk") == F.col("_target"))
    return (with_scalars(customers, target)
            .withColumn("Invoices", F.when(hit, F.array_append("Invoices", invoice))
                        .otherwise(F.col("Invoices")))
            .drop("_target"))


def first_match_position(items: Column, pred) -> Column:
    """1-based position of the first element satisfying ``pred`` (0 if none)."""
    return F.array_position(F.transform(items, pred), F.lit(True))


def update_item_qty(tx: DataFrame, invoice_no: str, stock_code: str, quantity: int) -> DataFrame:
    """Set Quantity of the **first** item with ``stock_code`` in the invoice
    (positional ``Items.$`` semantics)."""
    code = F.lit(stock_code)
    pos = first_match_position(F.col("Items"), lambda i: i["StockCode"] == code)
    new_items = F.transform("Items", lambda x, i: F.when(
        i + 1 == pos, x.withField("Quantity", F.lit(quantity).cast("long"))).otherwise(x))
    return tx.withColumn("Items", F.when(
        (F.col("InvoiceNo") == F.lit(invoice_no)) & (pos > 0), new_items).otherwise(F.col("Items")))


def update_item_qty_nested(customers: DataFrame, customer_id: int, invoice_no: str,
                           stock_code: str, quantity: int) -> DataFrame:
    """Set Quantity of **all** matching items in matching invoices of a customer
    (``$[inv].Items.$[itm]`` array filters)."""
    q = F.lit(quantity).cast("long")
    new_invoices = F.transform("Invoices", lambda inv: F.when(
        inv["InvoiceNo"] == F.lit(invoice_no),
        inv.withField("Items", F.transform(inv["Items"], lambda it: F.when(
            it["StockCode"] == F.lit(stock_code), it.withField("Quantity", q)).otherwise(it))))
        .otherwise(inv))
    return customers.withColumn("Invoices", F.when(
        F.col("CustomerID") == F.lit(customer_id), new_invoices).otherwise(F.col("Invoices")))


def delete_invoice(tx: DataFrame, invoice_no: str) -> DataFrame:
    """Remove one invoice document (null-safe key comparison)."""
    return tx.filter(~F.col("InvoiceNo").eqNullSafe(F.lit(invoice_no)))


def pull_invoice(customers: DataFrame, invoice_no: str) -> DataFrame:
    """Remove an invoice entry from its customer's array; the customer stays."""
    return customers.withColumn(
        "Invoices", F.filter("Invoices", lambda i: ~i["InvoiceNo"].eqNullSafe(F.lit(invoice_no))))


def bulk_insert(table: DataFrame, new: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Insert many; keys that exist already (or repeat in the batch) are
    rejected, the rest kept — an unordered insert against a unique index."""
    fresh = one_per_key(new, keys, order).join(table.select(*keys), list(keys), "left_anti")
    return table.unionByName(fresh)


def bulk_update_qty(tx: DataFrame, updates: DataFrame) -> DataFrame:
    """Many single-item quantity updates ``(invoice_no, stock_code, new_quantity)``.

    Updates are folded to one map per invoice (``stock_code → quantity``;
    the largest quantity wins when a pair repeats) and left-joined on the
    invoice; for each document only the first item of each listed code
    changes.  The update table is broadcast only when its size is checked.
    """
    per_invoice = (updates.groupBy(F.col("invoice_no").alias("InvoiceNo"), "stock_code")
                   .agg(F.max("new_quantity").cast("long").alias("q"))
                   .groupBy("InvoiceNo")
                   .agg(F.map_from_entries(F.collect_list(F.struct("stock_code", "q"))).alias("_upd")))
    joined = join_small(tx, per_invoice, "InvoiceNo", "left")
    codes = F.transform("Items", lambda x: x["StockCode"])
    new_items = F.transform("Items", lambda x, i: F.when(
        (F.array_position(codes, x["StockCode"]) == i + 1) & F.element_at("_upd", x["StockCode"]).isNotNull(),
        x.withField("Quantity", F.element_at("_upd", x["StockCode"]))).otherwise(x))
    return (joined.withColumn("Items", F.when(F.col("_upd").isNotNull(), new_items).otherwise(F.col("Items")))
            .drop("_upd").select(*tx.columns))


def bulk_delete(table: DataFrame, keys_df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Remove many documents by key list (``$in`` → anti join)."""
    return join_small(table, keys_df.select(*keys), list(keys), "left_anti")


def upsert_replace(target: DataFrame, source: DataFrame, keys: Sequence[str], order: str | None = None) -> DataFrame:
    """Keyed replace-or-insert: every source row replaces the target rows
    with its key; within the source the last row per key (by ``order``, then
    by all other columns) wins.

    ``target ⋉̸ source ∪ source`` — idempotent: running it twice with the
    same source gives the same table.
    """
    src = one_per_key(source, keys, order, last=True)
    kept = target.join(src.select(*keys), list(keys), "left_anti")
    return kept.unionByName(src.select(*target.columns))


def synthetic_invoices(customer_ids: DataFrame, base: int = 800_000, when: str = "2011-12-09 12:00:00") -> DataFrame:
    """One deterministic test invoice per input id ``i`` (reference:
    ``generate_test_transactions``): invoice ``base+i``, code ``TEST%04d``,
    quantity ``i % 10 + 1``, price ``round(5.99 + i % 20, 2)``."""
    i = F.col("CustomerID").cast("long")
    item = F.struct(
        F.format_string("TEST%04d", i).alias("StockCode"),
        F.concat(F.lit("Test Product "), i.cast("string")).alias("Description"),
        (F.pmod(i, F.lit(10)) + 1).cast("long").alias("Quantity"),
        F.round(F.lit(5.99) + F.pmod(i, F.lit(20)), 2).cast("decimal(18,2)").alias("UnitPrice"),
    )
    return customer_ids.select(
        (F.lit(base) + i).cast("string").alias("InvoiceNo"),
        F.lit(0).alias("Chunk"),
        F.lit(when).cast("timestamp_ntz").alias("InvoiceDate"),
        F.col("CustomerID").cast("int").alias("CustomerID"),
        F.array(item).alias("Items"),
    )


def synthetic_updates(customer_ids: DataFrame, base: int = 800_000) -> DataFrame:
    """Matching quantity updates: ``(i % 15) + 5`` (reference: ``generate_bulk_updates``)."""
    i = F.col("CustomerID").cast("long")
    return customer_ids.select(
        (F.lit(base) + i).cast("string").alias("invoice_no"),
        F.format_string("TEST%04d", i).alias("stock_code"),
        (F.pmod(i, F.lit(15)) + 5).cast("int").alias("new_quantity"),
    )
