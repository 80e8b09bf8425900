"""Retail documents in a versioned store: indexed reads and atomic writes.

Beside the two document layouts the store keeps

* ``customer_invoices``  customer -> its invoices (with their dates),
* ``invoice_customers``  invoice -> the customer documents that hold it,
* ``tx_words``, ``customer_words``  item description -> invoices, customers,
* ``trigrams``  three letters -> descriptions that hold them.

Each is bucketed by the part before the arrow.  Reads go from an index to the
buckets of the documents it names; a list of keys is sent to the driver only up
to ``MOST_KEYS``, beyond that the index is joined.  Every write changes the
documents and all their indexes in one commit.
"""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import dml
from quarry.operators.retail import month_range, ntz
from quarry.sources.layout_store import literal_bucket
from quarry.sources.versioned_store import Conflict, VersionedStore

MOST_KEYS = 10_000
ROWS_PER_PART = 1_000_000   # index rows that one task of the build sorts
_LITERAL = re.compile(r"[A-Za-z0-9 ]+")


# ------------------------------------------------------------ index contents

def customer_invoices(tx: DataFrame) -> DataFrame:
    return _customer_invoices(tx).distinct()


def invoice_customers(customers: DataFrame) -> DataFrame:
    return _invoice_customers(customers).distinct()


def tx_words(tx: DataFrame) -> DataFrame:
    return _tx_words(tx).distinct()


def customer_words(customers: DataFrame) -> DataFrame:
    return _customer_words(customers).distinct()


# the rows of each index as they come; equal ones may repeat

def _customer_invoices(tx: DataFrame) -> DataFrame:
    return tx.select("CustomerID", "InvoiceNo", "InvoiceDate")


def _invoice_customers(customers: DataFrame) -> DataFrame:
    return customers.select(F.explode("Invoices.InvoiceNo").alias("InvoiceNo"), "CustomerID")


def _tx_words(tx: DataFrame) -> DataFrame:
    return tx.select(F.explode(F.array_distinct("Items.Description")).alias("Description"), "InvoiceNo").filter("Description IS NOT NULL")


def _customer_words(customers: DataFrame) -> DataFrame:
    items = F.array_distinct(F.flatten("Invoices.Items")["Description"])
    return customers.select(F.explode(items).alias("Description"), "CustomerID").filter("Description IS NOT NULL")


def trigrams(descriptions: DataFrame) -> DataFrame:
    """``Trigram, Description`` of the distinct ``Description`` values, in lower case."""
    low = F.lower("Description")
    three = F.transform(F.sequence(F.lit(1), F.length(low) - 2), lambda i: F.substring(low, i, F.lit(3)))
    return (descriptions.select("Description").distinct().filter(F.length(low) >= 3)
            .select(F.explode(F.array_distinct(three)).alias("Trigram"), "Description"))


def build_store(spark: SparkSession, base: str, folders: dict[str, str], n_buckets: int) -> VersionedStore:
    """The store over written layout tables (``transactions``, ``customers``,
    ``customer_refs``), which it takes over as they are, with its indexes.  Of
    several drivers that build it the first stays."""
    store = VersionedStore.create(spark, base)
    for name, key in (("transactions", "InvoiceNo"), ("customers", "CustomerID"), ("customer_refs", "CustomerID")):
        store.define(name, key, n_buckets, spark.read.parquet(folders[name]).schema, folders[name])
    tx, customers = store.table("transactions"), store.table("customers")
    made = {"customer_invoices": ("CustomerID", _customer_invoices(tx)), "invoice_customers": ("InvoiceNo", _invoice_customers(customers)),
            "tx_words": ("Description", _tx_words(tx)), "customer_words": ("Description", _customer_words(customers))}
    n_items = tx.agg(F.sum(F.size("Items.StockCode"))).first()[0] or 0
    parts = max(1, -(-n_items // (n_buckets * ROWS_PER_PART)))
    changes = []
    for name, (key, rows) in made.items():
        store.define(name, key, n_buckets, rows.schema)
        changes.append(store.stage(name, rows, distinct=parts))   # the one shuffle by bucket also drops repeats
    words = store.staged(changes[2]).select("Description").unionByName(store.staged(changes[3]).select("Description"))
    store.define("trigrams", "Trigram", n_buckets, trigrams(words).schema)
    changes.append(store.stage("trigrams", trigrams(words)))
    try:
        return store.commit(changes)
    except Conflict:
        return store.refresh()


# ------------------------------------------------------------ reads

def by_keys(store: VersionedStore, name: str, keys: DataFrame) -> DataFrame:
    """The documents of ``name`` that ``keys`` (one column, the table's key)
    names: by their buckets if they are few, else by a join."""
    key = store.key(name)
    few = [r[0] for r in keys.select(key).distinct().limit(MOST_KEYS + 1).collect()]
    if len(few) <= MOST_KEYS:
        return store.lookup(name, few) if few else store.table(name).limit(0)
    return store.table(name).join(keys.select(key).distinct(), key, "left_semi")


def invoices_by_customer(store: VersionedStore, customer_id: int) -> DataFrame:
    return by_keys(store, "transactions", store.lookup("customer_invoices", [customer_id]))


def invoices_by_month(store: VersionedStore, customer_id: int, year: int, month: int) -> DataFrame:
    start, end = month_range(year, month)
    dated = store.lookup("customer_invoices", [customer_id]).filter((F.col("InvoiceDate") >= ntz(start)) & (F.col("InvoiceDate") < ntz(end)))
    return by_keys(store, "transactions", dated)


def find_invoice_nested(store: VersionedStore, invoice_no: str) -> DataFrame:
    """The whole customer documents that hold the invoice."""
    return by_keys(store, "customers", store.lookup("invoice_customers", [invoice_no]))


def matching_descriptions(store: VersionedStore, term: str, words: str) -> DataFrame:
    """Distinct descriptions that match ``term`` in any case.

    A plain term of three letters or more is looked up by its trigrams; the
    descriptions that have all of them are then held against the pattern.  Any
    other term (shorter, or a pattern) scans the narrow index ``words``."""
    if _LITERAL.fullmatch(term) and len(term) >= 3:
        low = term.lower()
        parts = sorted({low[k:k + 3] for k in range(len(low) - 2)})
        found = store.lookup("trigrams", parts)
        if len(parts) > 1:
            found = found.groupBy("Description").agg(F.count_distinct("Trigram").alias("n")).filter(F.col("n") == len(parts))
    else:
        found = store.table(words)
    return found.select("Description").filter(F.col("Description").rlike("(?i)" + term)).distinct()


def _search(store: VersionedStore, term: str, limit: int, words: str, key: str, name: str) -> DataFrame:
    """Documents of the first ``limit`` keys that have a matching item."""
    hits = by_keys(store, words, matching_descriptions(store, term, words))
    keys = [r[0] for r in hits.select(key).distinct().orderBy(key).limit(limit).collect()]
    return store.lookup(name, keys) if keys else store.table(name).limit(0)


def product_search(store: VersionedStore, term: str, limit: int = 20) -> DataFrame:
    """``InvoiceNo, Items`` of the first ``limit`` invoices with a matching
    item; the chunks of an invoice are put together."""
    found = _search(store, term, limit, "tx_words", "InvoiceNo", "transactions")
    return found.groupBy("InvoiceNo").agg(F.array_sort(F.flatten(F.collect_list("Items"))).alias("Items"))


def product_search_nested(store: VersionedStore, term: str, limit: int = 20) -> DataFrame:
    """``CustomerID, Items`` (an array for each invoice) of the first ``limit``
    customers with a matching item."""
    found = _search(store, term, limit, "customer_words", "CustomerID", "customers")
    inv = (found.select("CustomerID", F.explode_outer("Invoices").alias("i")).groupBy("CustomerID", "i.InvoiceNo")
           .agg(F.array_sort(F.flatten(F.collect_list("i.Items"))).alias("Items")))
    return inv.groupBy("CustomerID").agg(F.transform(F.array_sort(F.collect_list(F.struct("InvoiceNo", "Items"))), lambda x: x["Items"]).alias("Items"))


# ------------------------------------------------------------ writes

def _together(store: VersionedStore, *makers) -> list[dict]:
    """Stage independent changes at the same time."""
    with ThreadPoolExecutor(max_workers=len(makers)) as pool:
        return [f.result() for f in [pool.submit(inheritable_thread_target(store.spark)(m)) for m in makers]]


def _without(store: VersionedStore, name: str, gone: DataFrame) -> dict:
    """Stage an index without the rows ``gone`` (all its columns)."""
    buckets = store.buckets_of(name, gone)
    return store.stage(name, store.table(name, buckets).join(gone, gone.columns, "left_anti"), replace=buckets)


def _new_trigrams(store: VersionedStore, words: DataFrame) -> dict:
    rows = trigrams(words)
    held = store.table("trigrams", store.buckets_of("trigrams", rows))
    return store.stage("trigrams", rows.join(held, ["Trigram", "Description"], "left_anti"), few=True)


def insert_invoices(store: VersionedStore, docs: DataFrame) -> VersionedStore:
    """Add transaction documents whose invoice is new; of repeated keys in
    ``docs`` one is added."""
    buckets = store.buckets_of("transactions", docs)
    fresh = dml.one_per_key(docs, ["InvoiceNo"]).join(store.table("transactions", buckets).select("InvoiceNo"), "InvoiceNo", "left_anti")
    first = store.stage("transactions", fresh)
    added = store.staged(first)
    return store.commit([first, *_together(store, lambda: store.stage("customer_invoices", customer_invoices(added)),
                                           lambda: store.stage("tx_words", tx_words(added)), lambda: _new_trigrams(store, tx_words(added)))])


def delete_invoices(store: VersionedStore, keys: DataFrame) -> VersionedStore:
    """Remove the transaction documents of the invoices in ``keys``.
    Descriptions stay in ``trigrams``; without postings they lead nowhere."""
    buckets = store.buckets_of("transactions", keys)
    part = store.table("transactions", buckets)
    gone = part.join(keys.select("InvoiceNo"), "InvoiceNo", "left_semi")
    rest = part.join(keys.select("InvoiceNo"), "InvoiceNo", "left_anti")
    return store.commit(_together(store, lambda: store.stage("transactions", rest, replace=buckets),
                                  lambda: _without(store, "customer_invoices", customer_invoices(gone)),
                                  lambda: _without(store, "tx_words", tx_words(gone))))


def update_item_qty(store: VersionedStore, invoice_no: str, stock_code: str, quantity: int) -> VersionedStore:
    """Set the quantity of the invoice's first item of that code."""
    return _changed(store, "transactions", [invoice_no], lambda d: dml.update_item_qty(d, invoice_no, stock_code, quantity))


def bulk_update_qty(store: VersionedStore, updates: DataFrame) -> VersionedStore:
    """Many updates ``(invoice_no, stock_code, new_quantity)``."""
    buckets = store.buckets_of("transactions", updates.select(F.col("invoice_no").alias("InvoiceNo")))
    new = dml.bulk_update_qty(store.table("transactions", buckets), updates)
    return store.commit([store.stage("transactions", new, replace=buckets)])


def update_item_qty_nested(store: VersionedStore, customer_id: int, invoice_no: str, stock_code: str, quantity: int) -> VersionedStore:
    """Set the quantity of all items of that code in the customer's invoice."""
    return _changed(store, "customers", [customer_id], lambda d: dml.update_item_qty_nested(d, customer_id, invoice_no, stock_code, quantity))


def _changed(store: VersionedStore, name: str, keys: list, change) -> VersionedStore:
    """Commit ``change`` of the buckets that hold ``keys``."""
    kind = store.schema(name)[store.key(name)].dataType.simpleString()
    buckets = {literal_bucket(k, kind, store.n_buckets(name)) for k in keys}
    return store.commit([store.stage(name, change(store.table(name, buckets)), replace=buckets)])


def push_invoice(store: VersionedStore, customer_id: int, entry: Column) -> VersionedStore:
    """Add an invoice entry to a customer, as one more chunk of the document;
    an unknown customer stays unknown."""
    head = store.lookup("customers", [customer_id]).agg(F.max("Chunk").alias("c"), F.first("Country").alias("country")).first()
    if head["c"] is None:
        return store
    schema = store.schema("customers")
    doc = store.spark.range(1).select(F.lit(customer_id).cast(schema["CustomerID"].dataType).alias("CustomerID"),
                                      F.lit(head["c"] + 1).cast("int").alias("Chunk"), F.lit(head["country"]).alias("Country"),
                                      F.array(entry).cast(schema["Invoices"].dataType).alias("Invoices"))
    first = store.stage("customers", doc, few=True)
    added = store.staged(first)
    known = store.lookup("invoice_customers", [r[0] for r in invoice_customers(added).select("InvoiceNo").collect()])  # one entry
    words = customer_words(added)
    held = store.table("customer_words", store.buckets_of("customer_words", words))
    return store.commit([first, *_together(
        store, lambda: store.stage("invoice_customers", invoice_customers(added).join(known, ["InvoiceNo", "CustomerID"], "left_anti"), few=True),
        lambda: store.stage("customer_words", words.join(held, ["Description", "CustomerID"], "left_anti"), few=True), lambda: _new_trigrams(store, words))])


def pull_invoice(store: VersionedStore, invoice_no: str) -> VersionedStore:
    """Remove an invoice from the customer documents that hold it."""
    holders = store.lookup("invoice_customers", [invoice_no])
    buckets = store.buckets_of("customers", holders)
    part = store.table("customers", buckets)
    rest = store.stage("customers", dml.pull_invoice(part, invoice_no), replace=buckets)
    touched = part.join(holders.select("CustomerID"), "CustomerID", "left_semi")
    after = store.staged(rest).join(holders.select("CustomerID"), "CustomerID", "left_semi")
    words = customer_words(touched).join(customer_words(after), ["Description", "CustomerID"], "left_anti")
    return store.commit([rest, *_together(store, lambda: _without(store, "invoice_customers", holders), lambda: _without(store, "customer_words", words))])
