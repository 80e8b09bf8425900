"""Document writes as table transforms."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import dml, stored
from quarry.operators.docs import invoice_counts
from quarry.plans.registry import query
from quarry.plans.retail_queries import CUSTOMER, INVOICE, layouts, open_store
from quarry.plans.sqlviews import register_view, with_views
from quarry.session import scratch_path
from quarry.sources.tables import table
from quarry.sources.versioned_store import VersionedStore

UPDATE_CODE = "646"
NEW_QTY = 99
NEW_INVOICE = "999999"
NEW_CUSTOMER = 999999

register_view("tx_docs", """
SELECT InvoiceNo, CustomerID, count(*) AS n_items FROM tx_items GROUP BY InvoiceNo, CustomerID""", ["tx_items"])
register_view("synth", """
SELECT CAST(800000 + CustomerID AS VARCHAR) AS InvoiceNo, CAST(TIMESTAMP '2011-12-09 12:00:00' AS TIMESTAMP) AS InvoiceDate,
       CustomerID, printf('TEST%04d', CustomerID) AS StockCode, 'Test Product ' || CAST(CustomerID AS VARCHAR) AS Description,
       CAST(CustomerID % 10 + 1 AS BIGINT) AS Quantity, CAST(round(5.99 + CustomerID % 20, 2) AS DECIMAL(18,2)) AS UnitPrice
FROM refs""", ["refs"])
register_view("tx_bulk", """
SELECT InvoiceNo, InvoiceDate, CustomerID, StockCode, Description, Quantity, UnitPrice FROM tx_items
UNION ALL
SELECT * FROM synth s WHERE NOT EXISTS (SELECT 1 FROM headers h WHERE h.InvoiceNo = s.InvoiceNo)""", ["tx_items", "synth", "headers"])


def _fork(spark: SparkSession, sf: str) -> VersionedStore:
    """A store of the query's own over the same files, to write to."""
    return open_store(spark, sf).fork(scratch_path(spark, "store"))


def _entry(quantity: int):
    item = F.struct(F.lit("P01").alias("StockCode"), F.lit("Test Item").alias("Description"),
                    F.lit(quantity).cast("long").alias("Quantity"), F.lit(10.99).cast("decimal(18,2)").alias("UnitPrice"))
    return F.struct(F.lit(NEW_INVOICE).alias("InvoiceNo"), F.lit("2011-12-09 12:00:00").cast("timestamp_ntz").alias("InvoiceDate"),
                    F.array(item).alias("Items"))


def _per_doc(tx: DataFrame) -> DataFrame:
    return (tx.select("InvoiceNo", "CustomerID", F.size("Items").alias("n"))
            .groupBy("InvoiceNo", "CustomerID").agg(F.sum("n").cast("long").alias("n_items")))


def _flat_qty(tx: DataFrame) -> DataFrame:
    return (tx.select("InvoiceNo", F.explode("Items").alias("_it"))
            .select("InvoiceNo", "_it.StockCode", "_it.Quantity"))


def _one_invoice(spark: SparkSession) -> DataFrame:
    item = F.struct(F.lit("P01").alias("StockCode"), F.lit("Test Item").alias("Description"),
                    F.lit(1).cast("long").alias("Quantity"), F.lit(10.99).cast("decimal(18,2)").alias("UnitPrice"))
    return spark.range(1).select(
        F.lit(NEW_INVOICE).alias("InvoiceNo"), F.lit(0).alias("Chunk"),
        F.lit("2011-12-09 12:00:00").cast("timestamp_ntz").alias("InvoiceDate"),
        F.lit(CUSTOMER).cast("int").alias("CustomerID"), F.array(item).alias("Items"))


@query("insert_invoice", with_views(f"""
SELECT * FROM tx_docs UNION ALL SELECT '{NEW_INVOICE}', {CUSTOMER}, 1""", "tx_docs"))
def q_insert_invoice(spark: SparkSession, sf: str) -> DataFrame:
    store = stored.insert_invoices(_fork(spark, sf), _one_invoice(spark))
    return _per_doc(store.table("transactions"))


@query("insert_customer", with_views(f"""
SELECT CustomerID, Country FROM refs UNION ALL SELECT {NEW_CUSTOMER}, 'ATLANTIS'""", "refs"))
def q_insert_customer(spark: SparkSession, sf: str) -> DataFrame:
    refs = layouts(spark, sf)["customer_refs"]
    new = spark.range(1).select(F.lit(NEW_CUSTOMER).cast("int").alias("CustomerID"), F.lit("ATLANTIS").alias("Country"))
    return dml.insert_rows(refs, new, ["CustomerID"])


@query("push_invoice", with_views(f"""
SELECT CustomerID, count(DISTINCT InvoiceNo) + CASE WHEN CustomerID = {CUSTOMER} THEN 1 ELSE 0 END AS n_invoices
FROM cust_items GROUP BY CustomerID""", "cust_items"))
def q_push_invoice(spark: SparkSession, sf: str) -> DataFrame:
    store = stored.push_invoice(_fork(spark, sf), CUSTOMER, _entry(2))
    return invoice_counts(store.table("customers"))


@query("update_item_qty", with_views(f"""
SELECT InvoiceNo, StockCode,
       CASE WHEN InvoiceNo = '{INVOICE}' AND StockCode = '{UPDATE_CODE}' THEN {NEW_QTY} ELSE Quantity END AS Quantity
FROM tx_items""", "tx_items"))
def q_update_item_qty(spark: SparkSession, sf: str) -> DataFrame:
    store = stored.update_item_qty(_fork(spark, sf), INVOICE, UPDATE_CODE, NEW_QTY)
    return _flat_qty(store.table("transactions"))


@query("fn_array_update_where", with_views(f"""
SELECT InvoiceNo, StockCode,
       CASE WHEN InvoiceNo = '{INVOICE}' AND StockCode = '{UPDATE_CODE}' THEN {NEW_QTY} ELSE Quantity END AS Quantity
FROM tx_items""", "tx_items"))
def q_fn_array_update_where(spark: SparkSession, sf: str) -> DataFrame:
    """The array transform alone, over all documents."""
    return _flat_qty(dml.update_item_qty(layouts(spark, sf)["transactions"], INVOICE, UPDATE_CODE, NEW_QTY))


@query("update_item_qty_nested", with_views(f"""
SELECT CustomerID, InvoiceNo, StockCode,
       CASE WHEN CustomerID = {CUSTOMER} AND InvoiceNo = '{INVOICE}' AND StockCode = '{UPDATE_CODE}' THEN {NEW_QTY} ELSE Quantity END AS Quantity
FROM cust_items""", "cust_items"))
def q_update_item_qty_nested(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.operators.docs import unwind_two_level
    store = stored.update_item_qty_nested(_fork(spark, sf), CUSTOMER, INVOICE, UPDATE_CODE, NEW_QTY)
    return unwind_two_level(store.table("customers")).select("CustomerID", "InvoiceNo", "StockCode", "Quantity")


@query("delete_invoice", with_views(f"SELECT * FROM tx_docs WHERE InvoiceNo <> '{INVOICE}'", "tx_docs"))
def q_delete_invoice(spark: SparkSession, sf: str) -> DataFrame:
    store = stored.delete_invoices(_fork(spark, sf), spark.range(1).select(F.lit(INVOICE).alias("InvoiceNo")))
    return _per_doc(store.table("transactions"))


@query("pull_invoice", with_views(f"""
SELECT CustomerID, count(DISTINCT InvoiceNo) FILTER (WHERE InvoiceNo <> '{INVOICE}') AS n_invoices
FROM cust_items GROUP BY CustomerID""", "cust_items"))
def q_pull_invoice(spark: SparkSession, sf: str) -> DataFrame:
    store = stored.pull_invoice(_fork(spark, sf), INVOICE)
    return invoice_counts(store.table("customers"))


@query("fn_array_remove_where", with_views(f"""
SELECT CustomerID, count(DISTINCT InvoiceNo) FILTER (WHERE InvoiceNo <> '{INVOICE}') AS n_invoices
FROM cust_items GROUP BY CustomerID""", "cust_items"))
def q_fn_array_remove_where(spark: SparkSession, sf: str) -> DataFrame:
    """The array filter alone, over all documents."""
    return invoice_counts(dml.pull_invoice(layouts(spark, sf)["customers"], INVOICE))


@query("fn_array_append", with_views(f"""
SELECT CustomerID, count(DISTINCT InvoiceNo) + CASE WHEN CustomerID = {CUSTOMER} THEN 1 ELSE 0 END AS n_invoices
FROM cust_items GROUP BY CustomerID""", "cust_items"))
def q_fn_array_append(spark: SparkSession, sf: str) -> DataFrame:
    """The array append alone, over all documents."""
    return invoice_counts(dml.push_invoice(layouts(spark, sf)["customers"], CUSTOMER, _entry(2)))


@query("synthetic_invoices", with_views("""
SELECT InvoiceNo, InvoiceDate, CustomerID, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice FROM synth""", "synth"))
def q_synthetic_invoices(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.operators.docs import unwind_items
    refs = layouts(spark, sf)["customer_refs"]
    return unwind_items(dml.synthetic_invoices(refs)).withColumn("UnitPrice", F.col("UnitPrice").cast("double"))


@query("synthetic_updates", with_views("""
SELECT CAST(800000 + CustomerID AS VARCHAR) AS invoice_no, printf('TEST%04d', CustomerID) AS stock_code,
       CAST(CustomerID % 15 + 5 AS INTEGER) AS new_quantity FROM refs""", "refs"))
def q_synthetic_updates(spark: SparkSession, sf: str) -> DataFrame:
    return dml.synthetic_updates(layouts(spark, sf)["customer_refs"])


@query("bulk_insert", with_views("""
SELECT InvoiceNo, CustomerID, count(*) AS n_items FROM tx_bulk GROUP BY InvoiceNo, CustomerID""", "tx_bulk"))
def q_bulk_insert(spark: SparkSession, sf: str) -> DataFrame:
    new = dml.synthetic_invoices(layouts(spark, sf)["customer_refs"])
    store = stored.insert_invoices(_fork(spark, sf), new.unionByName(new))  # every key repeats
    return _per_doc(store.table("transactions"))


@query("bulk_update_qty", with_views("""
SELECT t.InvoiceNo, t.StockCode, COALESCE(CAST(u.new_quantity AS BIGINT), t.Quantity) AS Quantity
FROM tx_bulk t LEFT JOIN (SELECT CAST(800000 + CustomerID AS VARCHAR) AS invoice_no, printf('TEST%04d', CustomerID) AS stock_code,
                                 CustomerID % 15 + 5 AS new_quantity FROM refs) u
  ON t.InvoiceNo = u.invoice_no AND t.StockCode = u.stock_code""", "tx_bulk", "refs"))
def q_bulk_update_qty(spark: SparkSession, sf: str) -> DataFrame:
    refs = layouts(spark, sf)["customer_refs"]
    store = stored.insert_invoices(_fork(spark, sf), dml.synthetic_invoices(refs))
    return _flat_qty(stored.bulk_update_qty(store, dml.synthetic_updates(refs)).table("transactions"))


@query("bulk_delete", with_views("""
SELECT * FROM tx_docs WHERE InvoiceNo NOT IN (
  SELECT CAST(o_orderkey AS VARCHAR) FROM orders WHERE o_orderpriority = '1-URGENT')""", "tx_docs"))
def q_bulk_delete(spark: SparkSession, sf: str) -> DataFrame:
    urgent = (table(spark, sf, "orders", "o_orderkey", "o_orderpriority")
              .filter(F.col("o_orderpriority") == "1-URGENT")
              .select(F.col("o_orderkey").cast("string").alias("InvoiceNo")))
    return _per_doc(stored.delete_invoices(_fork(spark, sf), urgent).table("transactions"))


_UPSERT_SRC_SQL = """
SELECT CAST(c.c_custkey AS INTEGER) AS CustomerID, n.n_name || ' (' || c.c_mktsegment || ')' AS Country
FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey WHERE c.c_mktsegment = 'BUILDING'"""


def _upsert_source(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment").filter(F.col("c_mktsegment") == "BUILDING")
    n = table(spark, sf, "nation", "n_nationkey", "n_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey)
            .select(F.col("c_custkey").cast("int").alias("CustomerID"),
                    F.concat("n_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("Country")))


@query("upsert_replace", with_views(f"""
SELECT * FROM refs WHERE CustomerID NOT IN (SELECT CustomerID FROM ({_UPSERT_SRC_SQL}))
UNION ALL {_UPSERT_SRC_SQL}""", "refs"))
def q_upsert_replace(spark: SparkSession, sf: str) -> DataFrame:
    refs = layouts(spark, sf)["customer_refs"]
    src = _upsert_source(spark, sf)
    older = src.withColumn("Country", F.lit(""))  # every key repeats; the last by value wins
    return dml.upsert_replace(refs, src.unionByName(older), ["CustomerID"])
