"""Lookups, rollups and top-k over the two document layouts.

Each question exists for both layouts (``*_nested`` = customer layout); the
two answers agree after flattening.  Filters are written before the
``explode`` (as an ``exists`` on the array) so whole documents are skipped
before any row is generated; equality filters on top-level keys reach the
parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.operators.docs import (ITEM_FIELDS, customer_invoice_item_fields, customer_item_fields,
                                   item_fields)
from quarry.operators.docs import whole_customers, whole_transactions
from quarry.sources.tables import join_small


def month_range(year: int, month: int) -> tuple[dt.datetime, dt.datetime]:
    """Half-open month ``[first day, first day of next month)``; December rolls over."""
    start = dt.datetime(year, month, 1)
    end = dt.datetime(year + 1, 1, 1) if month == 12 else dt.datetime(year, month + 1, 1)
    return start, end


def ntz(ts: dt.datetime) -> Column:
    """A timestamp_ntz literal built from text, so no session or OS time zone
    can shift it (a Python datetime literal goes through local time)."""
    return F.lit(ts.strftime("%Y-%m-%d %H:%M:%S")).cast("timestamp_ntz")


def revenue(qty: Column | str = "Quantity", price: Column | str = "UnitPrice") -> Column:
    q = F.col(qty) if isinstance(qty, str) else qty
    p = F.col(price) if isinstance(price, str) else price
    return q * p


# ------------------------------------------------------------ point lookups

def find_invoice(tx: DataFrame, invoice_no: str) -> DataFrame:
    """The transaction document(s) of one invoice (all chunks)."""
    return tx.filter(F.col("InvoiceNo") == F.lit(invoice_no))


def find_invoice_with_customer(tx: DataFrame, refs: DataFrame, invoice_no: str,
                               max_rows: int = 10_000) -> DataFrame:
    """Invoice plus its customer reference (left outer: kept when unmatched).

    The reference table is first cut to the customers of the found
    document(s) with a semi join, so a point lookup does not shuffle the
    whole reference table.
    """
    found = find_invoice(tx, invoice_no)
    refs_needed = join_small(refs, found.select("CustomerID"), "CustomerID", "left_semi", max_rows)
    return found.join(refs_needed, "CustomerID", "left")


def find_invoice_nested(customers: DataFrame, invoice_no: str) -> DataFrame:
    """Customer document(s) holding the invoice.  ``array_contains`` on the
    ``Invoices.InvoiceNo`` field array lets the scan read only that leaf to
    decide, instead of whole invoice structs."""
    return customers.filter(F.array_contains(F.col("Invoices.InvoiceNo"), F.lit(invoice_no)))


def customer_info(refs: DataFrame, customer_id: int) -> DataFrame:
    return refs.filter(F.col("CustomerID") == F.lit(customer_id))


def invoices_by_customer(tx: DataFrame, customer_id: int) -> DataFrame:
    return tx.filter(F.col("CustomerID") == F.lit(customer_id))


def invoices_by_customer_nested(customers: DataFrame, customer_id: int) -> DataFrame:
    return customers.filter(F.col("CustomerID") == F.lit(customer_id))


def invoices_by_month(tx: DataFrame, customer_id: int, year: int, month: int) -> DataFrame:
    start, end = month_range(year, month)
    return tx.filter((F.col("CustomerID") == F.lit(customer_id))
                     & (F.col("InvoiceDate") >= ntz(start))
                     & (F.col("InvoiceDate") < ntz(end)))


def invoices_by_month_nested(customers: DataFrame, customer_id: int, year: int, month: int) -> DataFrame:
    """Invoice entries of one customer in one month; missing customer → no rows."""
    start, end = month_range(year, month)
    lo, hi = ntz(start), ntz(end)
    kept = F.filter("Invoices", lambda i: (i["InvoiceDate"] >= lo) & (i["InvoiceDate"] < hi))
    return (customers.filter(F.col("CustomerID") == F.lit(customer_id))
            .select(F.inline(kept)))


def _ci_pattern(term: str) -> str:
    return "(?i)" + term


def product_search(tx: DataFrame, term: str, limit: int = 20) -> DataFrame:
    """Whole documents with an item description matching ``term``
    (case-insensitive).

    The reference's ``limit`` has no order; here the first ``limit`` invoices
    by key are returned: a top-k of the distinct keys, then all chunks of
    those (a broadcast of at most ``limit`` keys).
    """
    pat = _ci_pattern(term)
    hit = tx.filter(F.exists("Items", lambda i: i["Description"].rlike(pat)))
    keys = hit.select("InvoiceNo").distinct().orderBy("InvoiceNo").limit(limit)
    return whole_transactions(tx.join(F.broadcast(keys), "InvoiceNo", "left_semi")).select("InvoiceNo", "Items")


def product_search_nested(customers: DataFrame, term: str, limit: int = 20) -> DataFrame:
    """The first ``limit`` whole customer documents with a matching item."""
    pat = _ci_pattern(term)
    hit = customers.filter(F.exists("Invoices", lambda inv: F.exists(
        inv["Items"], lambda i: i["Description"].rlike(pat))))
    keys = hit.select("CustomerID").distinct().orderBy("CustomerID").limit(limit)
    found = whole_customers(customers.join(F.broadcast(keys), "CustomerID", "left_semi"))
    return found.select("CustomerID", F.col("Invoices.Items").alias("Items"))


# ------------------------------------------------------------ aggregations

def product_sales(tx: DataFrame, stock_code: str) -> DataFrame:
    """Σqty and Σqty·price of one stock code (unwind → match → group)."""
    code = F.lit(stock_code)
    docs_hit = tx.filter(F.exists(F.col("Items.StockCode"), lambda c: c == code))
    rows = item_fields(docs_hit, ["StockCode", "Quantity", "UnitPrice"], keep=[])
    return (rows.filter(F.col("StockCode") == code).groupBy("StockCode")
            .agg(F.sum("Quantity").alias("totalQuantity"),
                 F.sum(revenue()).alias("totalRevenue")))


def product_sales_nested(customers: DataFrame, stock_code: str) -> DataFrame:
    code = F.lit(stock_code)
    docs = customers.filter(F.exists(F.flatten(F.col("Invoices.Items"))["StockCode"], lambda c: c == code))
    rows = customer_item_fields(docs, ["StockCode", "Quantity", "UnitPrice"], keep=[])
    return (rows.filter(F.col("StockCode") == code).groupBy("StockCode")
            .agg(F.sum("Quantity").alias("totalQuantity"),
                 F.sum(revenue()).alias("totalRevenue")))


def _customer_totals(items: DataFrame) -> DataFrame:
    return items.groupBy("CustomerID").agg(
        F.sum(revenue()).alias("totalRevenue"),
        F.count(F.lit(1)).alias("line_count"),
        F.count_distinct("InvoiceNo").alias("order_count"),
    )


def top_customers(tx: DataFrame, limit: int = 10) -> DataFrame:
    """Customers by revenue, top ``limit``; ``line_count`` counts item lines
    (the reference's ``totalOrders``), ``order_count`` distinct invoices."""
    rows = item_fields(tx, ["Quantity", "UnitPrice"], keep=["InvoiceNo", "CustomerID"])
    return (_customer_totals(rows)
            .orderBy(F.desc("totalRevenue"), F.asc("CustomerID")).limit(limit))


def top_customers_nested(customers: DataFrame, limit: int = 10) -> DataFrame:
    rows = customer_invoice_item_fields(customers, ["Quantity", "UnitPrice"], keep=["CustomerID"])
    return (_customer_totals(rows)
            .orderBy(F.desc("totalRevenue"), F.asc("CustomerID")).limit(limit))


def _country_rollup(per_customer: DataFrame) -> DataFrame:
    return (per_customer.groupBy("Country").agg(
        F.sum("rev").alias("totalRevenue"),
        F.sum("qty").alias("totalQuantity"),
        F.count(F.lit(1)).alias("uniqueCustomers"))
        .orderBy(F.desc("totalRevenue"), F.asc("Country")))


def sales_by_country(tx: DataFrame, refs: DataFrame) -> DataFrame:
    """Revenue, quantity and distinct customers per country (transaction layout).

    Items are first reduced to one row per customer (partial aggregation
    before the shuffle), then joined to the customer reference table on the
    same key, and only then grouped by country.  This replaces a distinct
    count per country with a plain count over already-unique customers, and
    the join moves one row per customer instead of one per item.
    """
    per_customer = (item_fields(tx, ["Quantity", "UnitPrice"], keep=["CustomerID"]).groupBy("CustomerID")
                    .agg(F.sum(revenue()).alias("rev"), F.sum("Quantity").alias("qty")))
    joined = per_customer.join(refs, "CustomerID", "inner")
    return _country_rollup(joined)


def sales_by_country_nested(customers: DataFrame) -> DataFrame:
    """Same question on the customer layout: no join, Country is in the document."""
    per_customer = (customer_item_fields(customers, ["Quantity", "UnitPrice"]).groupBy("CustomerID", "Country")
                    .agg(F.sum(revenue()).alias("rev"), F.sum("Quantity").alias("qty")))
    return _country_rollup(per_customer)


def sales_by_country_embedded(tx_with_country: DataFrame) -> DataFrame:
    """Variant where Country is embedded in every transaction document."""
    rows = item_fields(tx_with_country, ["Quantity", "UnitPrice"], keep=["CustomerID", "Country"])
    per_customer = (rows.groupBy("Country", "CustomerID")
                    .agg(F.sum(revenue()).alias("rev"), F.sum("Quantity").alias("qty")))
    return _country_rollup(per_customer)


def distinct_set_size(df: DataFrame, group: str, value: str, name: str = "n_distinct") -> DataFrame:
    """``$addToSet`` + ``$size`` = distinct count per group."""
    return df.groupBy(group).agg(F.count_distinct(value).alias(name))


def lookup_array(left: DataFrame, right: DataFrame, key: str, as_: str) -> DataFrame:
    """Left join that delivers all matches as one array (empty when none),
    sorted by their fields; each left row stays one row."""
    payload = [c for c in right.columns if c != key]
    r = right.groupBy(key).agg(F.array_sort(F.collect_list(F.struct(*[F.col(c) for c in [key, *payload]]))).alias("_m"))
    return (left.join(r, key, "left")
            .withColumn(as_, F.coalesce("_m", F.array().cast(r.schema["_m"].dataType.simpleString())))
            .drop("_m"))


def flatten_search(found: DataFrame, key: str) -> DataFrame:
    """Item rows of a search result (for comparing the two layouts)."""
    items = F.flatten("Items") if dict(found.dtypes)["Items"].startswith("array<array") else F.col("Items")
    return (found.select(key, F.explode(items).alias("_it"))
            .select(key, *[F.col(f"_it.{c}").alias(c) for c in ITEM_FIELDS]))
