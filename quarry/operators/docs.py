"""Document layouts built from the flat retail table.

Two layouts, as in the reference's store:

* ``transactions`` — one document per invoice
  ``{InvoiceNo, Chunk, InvoiceDate, CustomerID, Items[]}``, with a separate
  ``customer_refs`` table ``{CustomerID, Country}``;
* ``customers`` — one document per customer
  ``{CustomerID, Chunk, Country, Invoices[{InvoiceNo, InvoiceDate, Items[]}]}``.

Arrays are bounded.  A group with more than ``max_items`` items (or
``max_invoices`` invoice entries) is split into ``ceil(n / max)`` documents
that share the key and differ in ``Chunk``; elements are assigned by a hash
of their own key, so each chunk holds ``max`` elements in expectation (a
balls-in-bins load: the fullest chunk exceeds it by a few standard
deviations, never by a factor of the group size).  A hot invoice or customer therefore never turns
into one giant row or one task-sized group.  For ordinary groups ``Chunk`` is
0 and there is exactly one document per key.  Flattening the documents gives
back the same rows whatever the chunking.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.sources.layout_store import bucket_of
from quarry.sources.tables import join_small, with_scalars

ITEM_FIELDS = ["StockCode", "Description", "Quantity", "UnitPrice"]
MAX_ITEMS = 2048
MAX_INVOICES = 512


def item_rollup(retail: DataFrame, order: str = "RowKey") -> DataFrame:
    """Per (invoice, stock code): first non-null description, Σqty, max price.

    Also carries the first row's header values (date, customer, country) and
    its order key, so the invoice and customer headers can be derived from
    this much smaller table with keep-first semantics intact.
    """
    desc_order = F.when(F.col("Description").isNotNull(), F.col(order))
    header = F.struct("InvoiceDate", "CustomerID", "Country")
    return retail.groupBy("InvoiceNo", "StockCode").agg(
        F.min_by("Description", desc_order).alias("Description"),
        F.sum("Quantity").alias("Quantity"),
        F.max("UnitPrice").alias("UnitPrice"),
        F.min_by(header, F.col(order)).alias("_header"),
        F.min(order).alias("_first"),
    )


def invoice_headers(rollup: DataFrame) -> DataFrame:
    """Invoice header = values of the invoice's first row; plus its item count."""
    return rollup.groupBy("InvoiceNo").agg(
        F.min_by("_header", "_first").alias("_header"),
        F.min("_first").alias("_first"),
        F.count(F.lit(1)).alias("_n_items"),
    ).select(
        "InvoiceNo",
        F.col("_header.InvoiceDate").alias("InvoiceDate"),
        F.col("_header.CustomerID").alias("CustomerID"),
        F.col("_header.Country").alias("Country"),
        "_first", "_n_items",
    )


def customer_refs(headers: DataFrame) -> DataFrame:
    """Customer reference rows {CustomerID, Country}: first row per customer."""
    return headers.groupBy("CustomerID").agg(
        F.min_by("Country", "_first").alias("Country"))


def chunk_of(element_key: Sequence[str], n_elements: Column, max_elements: int) -> Column:
    """Chunk number of an element: hash of its key modulo ceil(n / max)."""
    return F.pmod(F.xxhash64(*element_key), _n_chunks(n_elements, max_elements)).cast("int")


def _cells(key: str, n_buckets: int, n_cells: int) -> dict[str, Column]:
    """Columns that deal documents to writers: the storage bucket of ``key`` and
    one of ``n_cells`` parts of it (chunks of one key may be in different parts)."""
    return {"bucket": bucket_of(F.col(key), n_buckets),
            "_cell": F.pmod(F.xxhash64(F.lit("cell"), key, "Chunk"), F.lit(n_cells))}


def _grouped(rows: DataFrame, key: str, place: tuple[int, int] | None):
    """``rows`` grouped by (key, Chunk) after one shuffle; with ``place`` (buckets,
    cells of a bucket) that shuffle also brings a bucket's documents together."""
    if place is None:
        return rows.repartition(key, "Chunk").groupBy(key, "Chunk")
    cells = _cells(key, *place)
    return rows.withColumns(cells).repartition(place[0] * place[1], *cells).groupBy(*cells, key, "Chunk")


def _n_chunks(n_elements: Column, max_elements: int) -> Column:
    return F.greatest(F.lit(1), F.ceil(n_elements / F.lit(max_elements)).cast("long"))


def _chunked(rows: DataFrame, sizes: DataFrame, key: str, n: str, element: Sequence[str], max_elements: int) -> DataFrame:
    """``rows`` with their ``Chunk``.  ``sizes`` has the element count ``n`` of
    each key; only the few keys that are split are joined to the rows."""
    split = sizes.filter(F.col(n) > max_elements).select(key, n)
    return (join_small(rows.filter(F.col(key).isNotNull()), split, key, "left")
            .withColumn("_chunk", chunk_of(element, F.coalesce(n, F.lit(1)), max_elements))
            .drop("Chunk", n).withColumnRenamed("_chunk", "Chunk"))


def _per_chunk(heads: DataFrame, key: str, n: str, max_elements: int) -> DataFrame:
    """A copy of each key's header row for every chunk of the key."""
    last = (_n_chunks(F.col(n), max_elements) - 1).cast("int")
    return heads.filter(F.col(key).isNotNull()).withColumn("Chunk", F.explode(F.sequence(F.lit(0), last))).drop(n)


def nest_items(rollup: DataFrame, headers: DataFrame, max_items: int = MAX_ITEMS,
               place: tuple[int, int] | None = None) -> DataFrame:
    """Transaction documents: items grouped per invoice, sorted by stock code.

    ``headers`` (one row per invoice) supplies date, customer and item count.
    Header rows and item rows go through one shuffle together and meet in the
    group, so items are not first moved by a join.  The group step is keyed by
    (invoice, chunk) so a very large invoice is spread over tasks.  ``place``
    deals the documents to storage buckets in that shuffle.
    """
    h = headers.select("InvoiceNo", "_n_items", F.struct("InvoiceDate", "CustomerID").alias("_head"))
    items = (_chunked(rollup.select("InvoiceNo", *ITEM_FIELDS), h, "InvoiceNo", "_n_items", ["StockCode"], max_items)
             .select("InvoiceNo", "Chunk", F.struct(*ITEM_FIELDS).alias("_item")))
    both = items.unionByName(_per_chunk(h, "InvoiceNo", "_n_items", max_items), allowMissingColumns=True)
    return _grouped(both, "InvoiceNo", place).agg(
        F.first("_head", ignorenulls=True).alias("_head"), F.array_sort(F.collect_list("_item")).alias("Items"),
    ).filter("_head IS NOT NULL AND size(Items) > 0").select(
        *(["bucket"] if place else []), "InvoiceNo", "Chunk", "_head.InvoiceDate", "_head.CustomerID", "Items")


def nested_items(rollup: DataFrame, headers: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """Items of each invoice as arrays ``{InvoiceNo, Chunk, Items[]}``, sorted by
    stock code; ``headers`` tells which invoices are split into chunks."""
    items = (_chunked(rollup.select("InvoiceNo", *ITEM_FIELDS), headers.select("InvoiceNo", "_n_items"), "InvoiceNo", "_n_items",
                      ["StockCode"], max_items)
             .select("InvoiceNo", "Chunk", F.struct(*ITEM_FIELDS).alias("_item")))
    return _grouped(items, "InvoiceNo", None).agg(F.array_sort(F.collect_list("_item")).alias("Items"))


def join_invoice_items(headers: DataFrame, nested: DataFrame, max_items: int = MAX_ITEMS) -> DataFrame:
    """Invoice documents by the inner equi-join of header and nested items.

    Every chunk meets its copy of the header, so the nested side stays where
    its group step put it and a split invoice stays spread over tasks.
    """
    heads = _per_chunk(headers.select("InvoiceNo", "InvoiceDate", "CustomerID", "_n_items"), "InvoiceNo", "_n_items", max_items)
    return heads.join(nested, ["InvoiceNo", "Chunk"], "inner").select("InvoiceNo", "Chunk", "InvoiceDate", "CustomerID", "Items")


def nest_invoices(transactions: DataFrame, refs: DataFrame, max_invoices: int = MAX_INVOICES,
                  place: tuple[int, int] | None = None) -> DataFrame:
    """Customer documents: invoice entries grouped per customer, sorted by invoice.

    Each transaction document becomes one entry ``{InvoiceNo, InvoiceDate,
    Items}``; entries are chunked per customer like items per invoice, and meet
    the country in the group's one shuffle.
    """
    sizes = transactions.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("_n_docs"))
    heads = refs.join(sizes, "CustomerID").select("CustomerID", "_n_docs", F.struct("Country").alias("_head"))
    entries = (_chunked(transactions, sizes, "CustomerID", "_n_docs", ["InvoiceNo", "Chunk"], max_invoices)
               .select("CustomerID", "Chunk", F.struct("InvoiceNo", "InvoiceDate", "Items").alias("_inv")))
    both = entries.unionByName(_per_chunk(heads, "CustomerID", "_n_docs", max_invoices), allowMissingColumns=True)
    return _grouped(both, "CustomerID", place).agg(
        F.first("_head", ignorenulls=True).alias("_head"), F.array_sort(F.collect_list("_inv")).alias("Invoices"),
    ).filter("_head IS NOT NULL AND size(Invoices) > 0").select(
        *(["bucket"] if place else []), "CustomerID", "Chunk", "_head.Country", "Invoices")


def build_layouts(retail: DataFrame, order: str = "RowKey", max_items: int = MAX_ITEMS,
                  max_invoices: int = MAX_INVOICES) -> dict[str, DataFrame]:
    """All document tables from one flat table (reference: ``build_docs``)."""
    rollup = item_rollup(retail, order)
    headers = invoice_headers(rollup)
    refs = customer_refs(headers)
    tx = nest_items(rollup, headers, max_items)
    cust = nest_invoices(tx, refs, max_invoices)
    return {"transactions": tx, "customer_refs": refs, "customers": cust,
            "rollup": rollup, "headers": headers}


def embed_country(transactions: DataFrame, refs: DataFrame) -> DataFrame:
    """Legacy layout: Country copied into every transaction document."""
    return transactions.join(refs, "CustomerID", "left")


# ---------------------------------------------------------------- whole documents

def whole_transactions(tx: DataFrame) -> DataFrame:
    """One document per invoice, whatever its chunks: the chunks of a split
    invoice are put together again, with items sorted by stock code.  Invoices
    of one chunk pass through."""
    split = tx.groupBy("InvoiceNo").agg(F.count(F.lit(1)).alias("_chunks")).filter("_chunks > 1").select("InvoiceNo")
    merged = tx.join(split, "InvoiceNo", "left_semi").groupBy("InvoiceNo").agg(
        F.first("InvoiceDate").alias("InvoiceDate"), F.first("CustomerID").alias("CustomerID"),
        F.array_sort(F.flatten(F.collect_list("Items"))).alias("Items"))
    one = tx.join(split, "InvoiceNo", "left_anti").select("InvoiceNo", "InvoiceDate", "CustomerID", "Items")
    return one.unionByName(merged)


def whole_customers(customers: DataFrame) -> DataFrame:
    """One document per customer and one entry per invoice, whatever the
    chunks of either.  A customer's entries are put together only if it has
    several chunks or an invoice in several entries."""
    sizes = customers.groupBy("CustomerID").agg(
        F.count(F.lit(1)).alias("_chunks"),
        F.max((F.size(F.array_distinct("Invoices.InvoiceNo")) < F.size("Invoices")).cast("int")).alias("_parts"))
    split = sizes.filter("_chunks > 1 OR _parts = 1").select("CustomerID")
    entries = (customers.join(split, "CustomerID", "left_semi")
               .select("CustomerID", "Country", F.explode_outer("Invoices").alias("_inv"))
               .groupBy("CustomerID", "Country", "_inv.InvoiceNo").agg(
                   F.first("_inv.InvoiceDate").alias("InvoiceDate"), F.array_sort(F.flatten(F.collect_list("_inv.Items"))).alias("Items")))
    merged = entries.groupBy("CustomerID", "Country").agg(F.array_sort(F.collect_list(
        F.when(F.col("InvoiceNo").isNotNull(), F.struct("InvoiceNo", "InvoiceDate", "Items")))).alias("Invoices"))
    one = customers.join(split, "CustomerID", "left_anti").select("CustomerID", "Country", "Invoices")
    return one.unionByName(merged)


def invoice_counts(customers: DataFrame) -> DataFrame:
    """Distinct invoices of each customer, over all its chunks."""
    return (customers.select("CustomerID", F.explode_outer("Invoices.InvoiceNo").alias("InvoiceNo"))
            .groupBy("CustomerID").agg(F.count_distinct("InvoiceNo").alias("n_invoices")))


# ---------------------------------------------------------------- unwinding

def unwind_items(transactions: DataFrame, outer: bool = False) -> DataFrame:
    """One row per item; documents with empty arrays vanish unless ``outer``."""
    gen = F.explode_outer if outer else F.explode
    return (transactions.select("InvoiceNo", "InvoiceDate", "CustomerID", gen("Items").alias("_it"))
            .select("InvoiceNo", "InvoiceDate", "CustomerID",
                    *[F.col(f"_it.{c}").alias(c) for c in ITEM_FIELDS]))


def item_fields(tx: DataFrame, fields: Sequence[str],
                keep: Sequence[str] = ("InvoiceNo", "InvoiceDate", "CustomerID")) -> DataFrame:
    """One row per item carrying only ``fields``.

    The unwind starts from the field arrays (``Items.Quantity``, ...), zipped
    back together, so the parquet scan reads just those leaves of the nested
    column (exploding whole item structs would read every field).
    """
    z = F.arrays_zip(*[F.col(f"Items.{f}").alias(f) for f in fields])
    return (tx.select(*keep, F.explode(z).alias("_it"))
            .select(*keep, *[F.col(f"_it.{f}").alias(f) for f in fields]))


def customer_item_fields(customers: DataFrame, fields: Sequence[str],
                         keep: Sequence[str] = ("CustomerID", "Country")) -> DataFrame:
    """Item rows of the customer layout built from per-field arrays of the
    flattened items (the scan skips the invoice-level fields; Spark does not
    prune leaves below two array levels)."""
    items = F.flatten(F.col("Invoices.Items"))
    z = F.arrays_zip(*[items[f].alias(f) for f in fields])
    return (customers.select(*keep, F.explode(z).alias("_it"))
            .select(*keep, *[F.col(f"_it.{f}").alias(f) for f in fields]))


def customer_invoice_item_fields(customers: DataFrame, fields: Sequence[str],
                                 keep: Sequence[str] = ("CustomerID", "Country")) -> DataFrame:
    """Item rows of the customer layout that also carry their InvoiceNo."""
    inv = (customers.select(*keep, F.explode("Invoices").alias("_inv"))
           .select(*keep, "_inv.InvoiceNo", *[F.col("_inv.Items")[f].alias(f"_a_{f}") for f in fields]))
    z = F.arrays_zip(*[F.col(f"_a_{f}").alias(f) for f in fields])
    return (inv.select(*keep, "InvoiceNo", F.explode(z).alias("_it"))
            .select(*keep, "InvoiceNo", *[F.col(f"_it.{f}").alias(f) for f in fields]))


def unwind_invoices(customers: DataFrame) -> DataFrame:
    """One row per invoice entry of a customer document."""
    return (customers.select("CustomerID", "Country", F.explode("Invoices").alias("_inv"))
            .select("CustomerID", "Country", "_inv.InvoiceNo", "_inv.InvoiceDate", "_inv.Items"))


def unwind_two_level(customers: DataFrame) -> DataFrame:
    """Two unwinds: customer → invoice → item rows."""
    inv = unwind_invoices(customers)
    return (inv.select("CustomerID", "Country", "InvoiceNo", "InvoiceDate", F.explode("Items").alias("_it"))
            .select("CustomerID", "Country", "InvoiceNo", "InvoiceDate",
                    *[F.col(f"_it.{c}").alias(c) for c in ITEM_FIELDS]))


def customer_items(customers: DataFrame) -> DataFrame:
    """Item rows of the customer layout when the invoice is not needed.

    ``flatten(Invoices.Items)`` is one generator instead of two.
    """
    return (customers.select("CustomerID", "Country", F.explode(F.flatten("Invoices.Items")).alias("_it"))
            .select("CustomerID", "Country", *[F.col(f"_it.{c}").alias(c) for c in ITEM_FIELDS]))


def doc_count_check(retail: DataFrame, layouts: dict[str, DataFrame]) -> DataFrame:
    """Document counts against distinct key counts, one row per check."""
    keys = retail.agg(F.count_distinct("InvoiceNo").alias("invoices"),
                      F.count_distinct("CustomerID").alias("customers"))
    tx = layouts["transactions"].agg(F.count_distinct("InvoiceNo").alias("tx_docs"))
    refs = layouts["customer_refs"].agg(F.count(F.lit(1)).alias("ref_docs"))
    cust = layouts["customers"].agg(F.count_distinct("CustomerID").alias("cust_docs"))
    row = with_scalars(with_scalars(with_scalars(keys, tx), refs), cust)
    return row.select(F.explode(F.array(
        F.struct(F.lit("transactions").alias("check_name"), F.col("tx_docs").alias("documents"), F.col("invoices").alias("expected")),
        F.struct(F.lit("customer_refs").alias("check_name"), F.col("ref_docs").alias("documents"), F.col("customers").alias("expected")),
        F.struct(F.lit("customers").alias("check_name"), F.col("cust_docs").alias("documents"), F.col("customers").alias("expected")),
    )).alias("c")).select("c.check_name", "c.documents", "c.expected",
                          (F.col("c.documents") == F.col("c.expected")).alias("ok"))
