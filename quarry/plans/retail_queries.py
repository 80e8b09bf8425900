"""Retail family: cleaning, 2NF, layouts, lookups, rollups."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import clean, docs, retail, stored
from quarry.plans.registry import query
from quarry.plans.sqlviews import with_views
from quarry.sources.retail import raw_retail_view, retail_view
from quarry.sources.versioned_store import VersionedStore

# Fixed query parameters (present in every scale-factor folder).
INVOICE = "42"
CUSTOMER = 42
YEAR, MONTH = 2001, 3
STOCK = "85"
TERM = "WIDGET"
TOP_K = 10
SEARCH_LIMIT = 20
IN_LIST = ["7", "42", "100", "1000", "9999"]


def layouts(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """Document tables of ``sf``: built once into the shared folder, then read
    (see ``layout_store.stored_layouts``)."""
    from quarry.sources.layout_store import stored_layouts
    tables, n_buckets = stored_layouts(spark, sf)
    tables["_n_buckets"] = n_buckets
    return tables


def open_store(spark: SparkSession, sf: str) -> VersionedStore:
    """The versioned store over the layouts of ``sf``, with its indexes; built
    by the first query that needs it."""
    lay = layouts(spark, sf)
    base = f"{lay['_base']}-store"
    names = ("transactions", "customers", "customer_refs")
    return VersionedStore.open(spark, base) or stored.build_store(spark, base, {n: f"{lay['_base']}/{n}" for n in names}, lay["_n_buckets"])


def _dbl(c: str) -> F.Column:
    return F.col(c).cast("double").alias(c)


def _items_flat(tx: DataFrame) -> DataFrame:
    return (tx.select("InvoiceNo", "InvoiceDate", "CustomerID", F.posexplode("Items").alias("pos", "_it"))
            .select("InvoiceNo", "InvoiceDate", "CustomerID", "pos",
                    *[F.col(f"_it.{c}").alias(c) for c in docs.ITEM_FIELDS])
            .withColumn("UnitPrice", F.col("UnitPrice").cast("double")))


ITEM_COLS_SQL = "InvoiceNo, InvoiceDate, CustomerID, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice"


# ------------------------------------------------------------------ cleaning

@query("clean_dropna_keys", with_views("""
SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country
FROM raw_retail WHERE InvoiceNo IS NOT NULL AND StockCode IS NOT NULL AND CustomerID IS NOT NULL AND InvoiceDate IS NOT NULL""", "raw_retail"))
def q_clean_dropna_keys(spark: SparkSession, sf: str) -> DataFrame:
    return clean.drop_null_keys(raw_retail_view(spark, sf)).withColumn("UnitPrice", _dbl("UnitPrice"))


@query("clean_distinct_rows", with_views("""
SELECT Country, count(*) AS n_rows, count(DISTINCT InvoiceNo) AS n_invoices, CAST(sum(Quantity) AS BIGINT) AS qty
FROM (SELECT DISTINCT * FROM raw_retail) GROUP BY Country""", "raw_retail"))
def q_clean_distinct_rows(spark: SparkSession, sf: str) -> DataFrame:
    d = clean.distinct_rows(raw_retail_view(spark, sf))
    return d.groupBy("Country").agg(F.count(F.lit(1)).alias("n_rows"),
                                    F.count_distinct("InvoiceNo").alias("n_invoices"),
                                    F.sum("Quantity").alias("qty"))


@query("clean_cast_int", with_views("""
SELECT CustomerID, count(*) AS n_rows FROM (
  SELECT CAST(CustomerID AS INTEGER) AS CustomerID FROM raw_retail WHERE CustomerID IS NOT NULL)
GROUP BY CustomerID""", "raw_retail"))
def q_clean_cast_int(spark: SparkSession, sf: str) -> DataFrame:
    r = clean.cast_int(raw_retail_view(spark, sf).filter(F.col("CustomerID").isNotNull()))
    return r.groupBy("CustomerID").agg(F.count(F.lit(1)).alias("n_rows"))


@query("clean_parse_datetime", with_views("""
SELECT InvoiceNo, min(CAST(InvoiceDate AS TIMESTAMP)) AS InvoiceDate, count(*) AS n_rows
FROM raw_retail WHERE TRY_CAST(InvoiceDate AS TIMESTAMP) IS NOT NULL GROUP BY InvoiceNo""", "raw_retail"))
def q_clean_parse_datetime(spark: SparkSession, sf: str) -> DataFrame:
    r = clean.parse_datetime(raw_retail_view(spark, sf))
    return r.groupBy("InvoiceNo").agg(F.min("InvoiceDate").alias("InvoiceDate"), F.count(F.lit(1)).alias("n_rows"))


@query("clean_pipeline", with_views("""
SELECT InvoiceNo, StockCode, Description, Quantity, InvoiceDate, CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country
FROM clean""", "clean"))
def q_clean_pipeline(spark: SparkSession, sf: str) -> DataFrame:
    return clean.clean_pipeline(raw_retail_view(spark, sf)).withColumn("UnitPrice", _dbl("UnitPrice"))


# ------------------------------------------------------------------ 2NF

@query("project_2nf_products", with_views("""
SELECT StockCode, arg_min(Description, RowKey) AS Description FROM retail GROUP BY StockCode""", "retail"))
def q_products(spark: SparkSession, sf: str) -> DataFrame:
    return clean.products_2nf(retail_view(spark, sf))


@query("project_2nf_invoices", with_views("""
SELECT InvoiceNo, arg_min(InvoiceDate, RowKey) AS InvoiceDate, arg_min(CustomerID, RowKey) AS CustomerID,
       arg_min(Country, RowKey) AS Country
FROM retail GROUP BY InvoiceNo""", "retail"))
def q_invoices(spark: SparkSession, sf: str) -> DataFrame:
    return clean.invoices_2nf(retail_view(spark, sf))


@query("project_2nf_items", with_views("""
SELECT InvoiceNo, StockCode, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice FROM retail""", "retail"))
def q_items(spark: SparkSession, sf: str) -> DataFrame:
    return clean.invoice_items_2nf(retail_view(spark, sf)).withColumn("UnitPrice", _dbl("UnitPrice"))


@query("dedup_keep_first", with_views("""
SELECT CustomerID, arg_min(Country, RowKey) AS Country FROM retail GROUP BY CustomerID""", "retail"))
def q_keep_first(spark: SparkSession, sf: str) -> DataFrame:
    return clean.keep_first(retail_view(spark, sf), ["CustomerID"], "RowKey", ["Country"])


@query("keep_first", with_views("""
SELECT StockCode, arg_min(InvoiceNo, RowKey) AS InvoiceNo, arg_min(Quantity, RowKey) AS Quantity
FROM retail GROUP BY StockCode""", "retail"))
def q_keep_first_window(spark: SparkSession, sf: str) -> DataFrame:
    return clean.keep_first(retail_view(spark, sf), ["StockCode"], "RowKey", ["InvoiceNo", "Quantity"])


@query("pk_violations", with_views("""
SELECT InvoiceNo, StockCode, count(*) AS n_rows FROM retail GROUP BY InvoiceNo, StockCode HAVING count(*) > 1""", "retail"))
def q_pk(spark: SparkSession, sf: str) -> DataFrame:
    return clean.pk_violations(clean.invoice_items_2nf(retail_view(spark, sf)), ["InvoiceNo", "StockCode"])


@query("fk_orphans", """
SELECT 'items_to_invoices' AS fk, count(*) AS n_orphans FROM lineitem l
 WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE o.o_orderkey = l.l_orderkey)
UNION ALL
SELECT 'items_to_products' AS fk, count(*) AS n_orphans FROM lineitem l
 WHERE NOT EXISTS (SELECT 1 FROM part p WHERE p.p_partkey = l.l_partkey)
UNION ALL
SELECT 'invoices_to_customers' AS fk, count(*) AS n_orphans FROM orders o
 WHERE NOT EXISTS (SELECT 1 FROM customer c WHERE c.c_custkey = o.o_custkey)""")
def q_fk(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.sources.tables import table
    li = table(spark, sf, "lineitem", "l_orderkey", "l_partkey")
    o = table(spark, sf, "orders", "o_orderkey", "o_custkey")
    p = table(spark, sf, "part", "p_partkey")
    c = table(spark, sf, "customer", "c_custkey")
    checks = [
        ("items_to_invoices", clean.fk_orphans(li.withColumnRenamed("l_orderkey", "k"), o.select(F.col("o_orderkey").alias("k")), ["k"])),
        ("items_to_products", clean.fk_orphans(li.withColumnRenamed("l_partkey", "k"), p.select(F.col("p_partkey").alias("k")), ["k"])),
        ("invoices_to_customers", clean.fk_orphans(o.withColumnRenamed("o_custkey", "k"), c.select(F.col("c_custkey").alias("k")), ["k"])),
    ]
    out = None
    for name, df in checks:
        one = df.agg(F.count(F.lit(1)).alias("n_orphans")).select(F.lit(name).alias("fk"), "n_orphans")
        out = one if out is None else out.unionByName(one)
    return out


# ------------------------------------------------------------------ layouts

@query("item_rollup", with_views("""
SELECT InvoiceNo, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice FROM rollup""", "rollup"))
def q_item_rollup(spark: SparkSession, sf: str) -> DataFrame:
    r = docs.item_rollup(retail_view(spark, sf))
    return r.select("InvoiceNo", "StockCode", "Description", "Quantity", _dbl("UnitPrice"))


@query("nest_items", with_views("""
SELECT InvoiceNo, InvoiceDate, CustomerID,
       CAST(row_number() OVER (PARTITION BY InvoiceNo ORDER BY StockCode) - 1 AS INTEGER) AS pos,
       StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice
FROM tx_items""", "tx_items"))
def q_nest_items(spark: SparkSession, sf: str) -> DataFrame:
    return _items_flat(docs.whole_transactions(layouts(spark, sf)["transactions"]))


@query("nest_invoices", with_views("""
SELECT CustomerID, Country, InvoiceNo, InvoiceDate,
       CAST(row_number() OVER (PARTITION BY CustomerID ORDER BY InvoiceNo) - 1 AS INTEGER) AS pos, n_items
FROM (SELECT CustomerID, Country, InvoiceNo, InvoiceDate, count(*) AS n_items FROM cust_items
      GROUP BY CustomerID, Country, InvoiceNo, InvoiceDate)""", "cust_items"))
def q_nest_invoices(spark: SparkSession, sf: str) -> DataFrame:
    c = docs.whole_customers(layouts(spark, sf)["customers"])
    return (c.select("CustomerID", "Country", F.posexplode("Invoices").alias("pos", "_inv"))
            .select("CustomerID", "Country", "_inv.InvoiceNo", "_inv.InvoiceDate", "pos",
                    F.size("_inv.Items").cast("long").alias("n_items")))


@query("build_transaction_docs", with_views("""
SELECT InvoiceNo, InvoiceDate, CustomerID, count(*) AS n_items, CAST(sum(Quantity) AS BIGINT) AS qty
FROM tx_items GROUP BY InvoiceNo, InvoiceDate, CustomerID""", "tx_items"))
def q_build_tx(spark: SparkSession, sf: str) -> DataFrame:
    tx = layouts(spark, sf)["transactions"]
    per_chunk = tx.select("InvoiceNo", "InvoiceDate", "CustomerID", F.size("Items").cast("long").alias("n"),
                          F.aggregate("Items", F.lit(0).cast("long"), lambda a, x: a + x["Quantity"]).alias("q"))
    return per_chunk.groupBy("InvoiceNo", "InvoiceDate", "CustomerID").agg(F.sum("n").alias("n_items"), F.sum("q").alias("qty"))


@query("build_customer_refs", with_views("SELECT CustomerID, Country FROM refs", "refs"))
def q_build_refs(spark: SparkSession, sf: str) -> DataFrame:
    return layouts(spark, sf)["customer_refs"]


@query("build_customer_docs", with_views("""
SELECT CustomerID, Country, count(DISTINCT InvoiceNo) AS n_invoices, count(*) AS n_items
FROM cust_items GROUP BY CustomerID, Country""", "cust_items"))
def q_build_cust(spark: SparkSession, sf: str) -> DataFrame:
    c = layouts(spark, sf)["customers"]
    per_doc = c.select("CustomerID", "Country", F.explode(F.transform("Invoices", lambda i: F.struct(
        i["InvoiceNo"].alias("no"), F.size(i["Items"]).cast("long").alias("n")))).alias("i"))
    return per_doc.groupBy("CustomerID", "Country").agg(
        F.count_distinct("i.no").alias("n_invoices"), F.sum("i.n").alias("n_items"))


@query("doc_count_check", with_views("""
SELECT check_name, documents, expected, documents = expected AS ok FROM (
  SELECT 'transactions' AS check_name, (SELECT count(DISTINCT InvoiceNo) FROM headers) AS documents,
         (SELECT count(DISTINCT InvoiceNo) FROM retail) AS expected
  UNION ALL SELECT 'customer_refs', (SELECT count(*) FROM refs), (SELECT count(DISTINCT CustomerID) FROM retail)
  UNION ALL SELECT 'customers', (SELECT count(DISTINCT CustomerID) FROM cust_items), (SELECT count(DISTINCT CustomerID) FROM retail))""",
    "retail", "headers", "refs", "cust_items"))
def q_doc_count(spark: SparkSession, sf: str) -> DataFrame:
    return docs.doc_count_check(retail_view(spark, sf), layouts(spark, sf))


# ------------------------------------------------------------------ unwinding

@query("unwind_items", with_views(f"SELECT {ITEM_COLS_SQL} FROM tx_items", "tx_items"))
def q_unwind_items(spark: SparkSession, sf: str) -> DataFrame:
    return docs.unwind_items(layouts(spark, sf)["transactions"]).withColumn("UnitPrice", _dbl("UnitPrice"))


@query("unwind_two_level", with_views("""
SELECT CustomerID, Country, InvoiceNo, InvoiceDate, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice
FROM cust_items""", "cust_items"))
def q_unwind_two(spark: SparkSession, sf: str) -> DataFrame:
    return docs.unwind_two_level(layouts(spark, sf)["customers"]).withColumn("UnitPrice", _dbl("UnitPrice"))


@query("unwind_outer", with_views("""
SELECT o.InvoiceNo, t.StockCode, t.Quantity
FROM (SELECT DISTINCT CAST(o_orderkey AS VARCHAR) AS InvoiceNo FROM orders) o
LEFT JOIN tx_items t ON o.InvoiceNo = t.InvoiceNo""", "tx_items"))
def q_unwind_outer(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.sources.tables import table
    tx = layouts(spark, sf)["transactions"]
    all_orders = table(spark, sf, "orders", "o_orderkey").select(F.col("o_orderkey").cast("string").alias("InvoiceNo")).distinct()
    docs_all = all_orders.join(tx.select("InvoiceNo", "Items"), "InvoiceNo", "left")
    return (docs_all.select("InvoiceNo", F.explode_outer("Items").alias("_it"))
            .select("InvoiceNo", "_it.StockCode", "_it.Quantity"))


@query("project_stage", with_views("""
SELECT InvoiceNo, CustomerID, count(*) AS n_items, CAST(sum(Quantity * UnitPrice) AS DOUBLE) AS invoice_total
FROM tx_items GROUP BY InvoiceNo, CustomerID""", "tx_items"))
def q_project_stage(spark: SparkSession, sf: str) -> DataFrame:
    tx = layouts(spark, sf)["transactions"]
    total = F.aggregate("Items", F.lit(0).cast("decimal(38,2)"),
                        lambda a, x: a + (x["Quantity"] * x["UnitPrice"]).cast("decimal(38,2)"))
    per_doc = tx.select("InvoiceNo", "CustomerID", F.size("Items").cast("long").alias("n"), total.alias("t"))
    return per_doc.groupBy("InvoiceNo", "CustomerID").agg(
        F.sum("n").alias("n_items"), F.sum("t").cast("double").alias("invoice_total"))


@query("match_after_unwind", with_views(f"SELECT {ITEM_COLS_SQL} FROM tx_items WHERE StockCode = '{STOCK}'", "tx_items"))
def q_match_after_unwind(spark: SparkSession, sf: str) -> DataFrame:
    tx = layouts(spark, sf)["transactions"]
    code = F.lit(STOCK)
    pre = tx.filter(F.exists("Items", lambda i: i["StockCode"] == code))
    return (docs.unwind_items(pre).filter(F.col("StockCode") == code)
            .withColumn("UnitPrice", _dbl("UnitPrice")))


# ------------------------------------------------------------------ lookups

@query("find_invoice", with_views(f"SELECT {ITEM_COLS_SQL} FROM tx_items WHERE InvoiceNo = '{INVOICE}'", "tx_items"))
def q_find_invoice(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.sources.layout_store import lookup
    lay = layouts(spark, sf)
    found = lookup(lay["_bucketed"]["transactions"], "InvoiceNo", INVOICE, lay["_n_buckets"]).drop("bucket")
    return docs.unwind_items(found).withColumn("UnitPrice", _dbl("UnitPrice"))


@query("find_invoice_nested", with_views(f"""
SELECT CustomerID, Country, InvoiceNo, InvoiceDate, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice
FROM cust_items WHERE CustomerID = (SELECT min(o_custkey) FROM orders WHERE o_orderkey = {INVOICE})""", "cust_items"))
def q_find_invoice_nested(spark: SparkSession, sf: str) -> DataFrame:
    found = stored.find_invoice_nested(open_store(spark, sf), INVOICE)
    return docs.unwind_two_level(found).withColumn("UnitPrice", _dbl("UnitPrice"))


@query("find_customer_info", with_views(f"SELECT CustomerID, Country FROM refs WHERE CustomerID = {CUSTOMER}", "refs"))
def q_customer_info(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.sources.layout_store import lookup
    lay = layouts(spark, sf)
    return lookup(lay["_bucketed"]["customer_refs"], "CustomerID", CUSTOMER, lay["_n_buckets"]).drop("bucket")


@query("invoices_by_customer", with_views(f"SELECT {ITEM_COLS_SQL} FROM tx_items WHERE CustomerID = {CUSTOMER}", "tx_items"))
def q_inv_by_cust(spark: SparkSession, sf: str) -> DataFrame:
    tx = stored.invoices_by_customer(open_store(spark, sf), CUSTOMER)
    return docs.unwind_items(tx).withColumn("UnitPrice", _dbl("UnitPrice"))


@query("invoices_by_customer_nested", with_views(f"""
SELECT CustomerID, Country, InvoiceNo, InvoiceDate, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice
FROM cust_items WHERE CustomerID = {CUSTOMER}""", "cust_items"))
def q_inv_by_cust_nested(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.sources.layout_store import lookup
    lay = layouts(spark, sf)
    c = lookup(lay["_bucketed"]["customers"], "CustomerID", CUSTOMER, lay["_n_buckets"]).drop("bucket")
    return docs.unwind_two_level(c).withColumn("UnitPrice", _dbl("UnitPrice"))


_MONTH_SQL = (f"InvoiceDate >= make_timestamp({YEAR}, {MONTH}, 1, 0, 0, 0) AND "
              f"InvoiceDate < make_timestamp({YEAR + (MONTH == 12)}, {MONTH % 12 + 1}, 1, 0, 0, 0)")


@query("invoices_by_month", with_views(f"SELECT {ITEM_COLS_SQL} FROM tx_items WHERE CustomerID = {CUSTOMER} AND {_MONTH_SQL}", "tx_items"))
def q_inv_by_month(spark: SparkSession, sf: str) -> DataFrame:
    tx = stored.invoices_by_month(open_store(spark, sf), CUSTOMER, YEAR, MONTH)
    return docs.unwind_items(tx).withColumn("UnitPrice", _dbl("UnitPrice"))


@query("invoices_by_month_nested", with_views(f"""
SELECT InvoiceNo, InvoiceDate, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice
FROM cust_items WHERE CustomerID = {CUSTOMER} AND {_MONTH_SQL}""", "cust_items"))
def q_inv_by_month_nested(spark: SparkSession, sf: str) -> DataFrame:
    inv = retail.invoices_by_month_nested(open_store(spark, sf).lookup("customers", [CUSTOMER]), CUSTOMER, YEAR, MONTH)
    return (inv.select("InvoiceNo", "InvoiceDate", F.explode("Items").alias("_it"))
            .select("InvoiceNo", "InvoiceDate", *[F.col(f"_it.{c}").alias(c) for c in docs.ITEM_FIELDS])
            .withColumn("UnitPrice", _dbl("UnitPrice")))


@query("product_search", with_views(f"""
SELECT InvoiceNo, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice FROM tx_items
WHERE InvoiceNo IN (SELECT InvoiceNo FROM tx_items WHERE regexp_matches(Description, '(?i){TERM}')
                    GROUP BY InvoiceNo ORDER BY InvoiceNo LIMIT {SEARCH_LIMIT})""", "tx_items"))
def q_product_search(spark: SparkSession, sf: str) -> DataFrame:
    found = stored.product_search(open_store(spark, sf), TERM, SEARCH_LIMIT)
    return retail.flatten_search(found, "InvoiceNo").withColumn("UnitPrice", _dbl("UnitPrice"))


@query("product_search_nested", with_views(f"""
SELECT CustomerID, StockCode, Description, Quantity, CAST(UnitPrice AS DOUBLE) AS UnitPrice FROM cust_items
WHERE CustomerID IN (SELECT CustomerID FROM cust_items WHERE regexp_matches(Description, '(?i){TERM}')
                     GROUP BY CustomerID ORDER BY CustomerID LIMIT {SEARCH_LIMIT})""", "cust_items"))
def q_product_search_nested(spark: SparkSession, sf: str) -> DataFrame:
    found = stored.product_search_nested(open_store(spark, sf), TERM, SEARCH_LIMIT)
    return retail.flatten_search(found, "CustomerID").withColumn("UnitPrice", _dbl("UnitPrice"))


@query("fn_regex_ci", with_views(f"""
SELECT StockCode, count(*) AS n_rows FROM tx_items WHERE regexp_matches(Description, '(?i){TERM}') GROUP BY StockCode""", "tx_items"))
def q_fn_regex_ci(spark: SparkSession, sf: str) -> DataFrame:
    rows = docs.item_fields(layouts(spark, sf)["transactions"], ["StockCode", "Description"], keep=[])
    return rows.filter(F.col("Description").rlike("(?i)" + TERM)).groupBy("StockCode").agg(F.count(F.lit(1)).alias("n_rows"))


# ------------------------------------------------------------------ joins

@query("join_invoice_items", with_views("""
SELECT h.InvoiceNo, h.InvoiceDate, h.CustomerID, count(*) AS n_items
FROM headers h JOIN rollup r ON h.InvoiceNo = r.InvoiceNo GROUP BY h.InvoiceNo, h.InvoiceDate, h.CustomerID""", "headers", "rollup"))
def q_join_invoice_items(spark: SparkSession, sf: str) -> DataFrame:
    lay = layouts(spark, sf)
    joined = docs.join_invoice_items(lay["headers"], docs.nested_items(lay["rollup"], lay["headers"]))
    return joined.groupBy("InvoiceNo", "InvoiceDate", "CustomerID").agg(F.sum(F.size("Items")).cast("long").alias("n_items"))


@query("join_customer_invoices", with_views("""
SELECT f.CustomerID, f.Country, count(*) AS n_invoices FROM refs f JOIN headers h ON f.CustomerID = h.CustomerID
GROUP BY f.CustomerID, f.Country""", "refs", "headers"))
def q_join_customer_invoices(spark: SparkSession, sf: str) -> DataFrame:
    lay = layouts(spark, sf)
    n = lay["headers"].groupBy("CustomerID").agg(F.count(F.lit(1)).alias("n_invoices"))
    return lay["customer_refs"].join(n, "CustomerID", "inner")


@query("lookup_left_unwind", with_views(f"""
SELECT t.InvoiceNo, t.CustomerID, f.Country, t.StockCode FROM tx_items t LEFT JOIN refs f ON t.CustomerID = f.CustomerID
WHERE t.InvoiceNo = '{INVOICE}'""", "tx_items", "refs"))
def q_lookup_left_unwind(spark: SparkSession, sf: str) -> DataFrame:
    store = open_store(spark, sf)
    tx = store.lookup("transactions", [INVOICE])
    found = tx.join(stored.by_keys(store, "customer_refs", tx), "CustomerID", "left")
    return (found.select("InvoiceNo", "CustomerID", "Country", F.explode("Items").alias("_it"))
            .select("InvoiceNo", "CustomerID", "Country", "_it.StockCode"))


@query("lookup_array", with_views("""
SELECT h.InvoiceNo, h.CustomerID, CAST(CASE WHEN f.CustomerID IS NULL THEN 0 ELSE 1 END AS INTEGER) AS n_matches, f.Country
FROM headers h LEFT JOIN refs f ON h.CustomerID = f.CustomerID""", "headers", "refs"))
def q_lookup_array(spark: SparkSession, sf: str) -> DataFrame:
    lay = layouts(spark, sf)
    tx = lay["transactions"].select("InvoiceNo", "CustomerID").distinct()  # an invoice's chunks are one document
    out = retail.lookup_array(tx, lay["customer_refs"], "CustomerID", "customer_info")
    return out.select("InvoiceNo", "CustomerID", F.size("customer_info").alias("n_matches"),
                      F.col("customer_info")[0]["Country"].alias("Country"))


@query("lookup_inner_unwind", with_views("""
SELECT t.InvoiceNo, t.CustomerID, f.Country, count(*) AS n_items FROM tx_items t JOIN refs f ON t.CustomerID = f.CustomerID
GROUP BY t.InvoiceNo, t.CustomerID, f.Country""", "tx_items", "refs"))
def q_lookup_inner(spark: SparkSession, sf: str) -> DataFrame:
    lay = layouts(spark, sf)
    j = lay["transactions"].join(lay["customer_refs"], "CustomerID", "inner")
    return (j.select("InvoiceNo", "CustomerID", "Country", F.size("Items").alias("n"))
            .groupBy("InvoiceNo", "CustomerID", "Country").agg(F.sum("n").cast("long").alias("n_items")))


@query("semi_in_list", with_views(f"""
SELECT InvoiceNo, count(*) AS n_items FROM tx_items WHERE InvoiceNo IN ({", ".join(repr(x) for x in IN_LIST)}) GROUP BY InvoiceNo""", "tx_items"))
def q_semi_in_list(spark: SparkSession, sf: str) -> DataFrame:
    tx = open_store(spark, sf).lookup("transactions", IN_LIST)
    return tx.groupBy("InvoiceNo").agg(F.sum(F.size("Items")).cast("long").alias("n_items"))


# ------------------------------------------------------------------ aggregations

@query("product_sales", with_views(f"""
SELECT StockCode, CAST(sum(Quantity) AS BIGINT) AS totalQuantity, CAST(sum(Quantity * UnitPrice) AS DOUBLE) AS totalRevenue
FROM tx_items WHERE StockCode = '{STOCK}' GROUP BY StockCode""", "tx_items"))
def q_product_sales(spark: SparkSession, sf: str) -> DataFrame:
    return retail.product_sales(layouts(spark, sf)["transactions"], STOCK).withColumn("totalRevenue", _dbl("totalRevenue"))


@query("product_sales_nested", with_views(f"""
SELECT StockCode, CAST(sum(Quantity) AS BIGINT) AS totalQuantity, CAST(sum(Quantity * UnitPrice) AS DOUBLE) AS totalRevenue
FROM cust_items WHERE StockCode = '{STOCK}' GROUP BY StockCode""", "cust_items"))
def q_product_sales_nested(spark: SparkSession, sf: str) -> DataFrame:
    return retail.product_sales_nested(layouts(spark, sf)["customers"], STOCK).withColumn("totalRevenue", _dbl("totalRevenue"))


_TOP_SQL = """
SELECT CustomerID, CAST(sum(Quantity * UnitPrice) AS DOUBLE) AS totalRevenue, count(*) AS line_count,
       count(DISTINCT InvoiceNo) AS order_count
FROM {src} GROUP BY CustomerID ORDER BY sum(Quantity * UnitPrice) DESC, CustomerID LIMIT {k}"""


@query("top_customers", with_views(_TOP_SQL.format(src="tx_items", k=TOP_K), "tx_items"))
def q_top_customers(spark: SparkSession, sf: str) -> DataFrame:
    return retail.top_customers(layouts(spark, sf)["transactions"], TOP_K).withColumn("totalRevenue", _dbl("totalRevenue"))


@query("top_customers_nested", with_views(_TOP_SQL.format(src="cust_items", k=TOP_K), "cust_items"))
def q_top_customers_nested(spark: SparkSession, sf: str) -> DataFrame:
    return retail.top_customers_nested(layouts(spark, sf)["customers"], TOP_K).withColumn("totalRevenue", _dbl("totalRevenue"))


@query("sort_limit_topk", with_views(f"""
SELECT *, row_number() OVER (ORDER BY totalRevenue DESC, CustomerID) AS position FROM ({_TOP_SQL.format(src="tx_items", k=25)})""", "tx_items"))
def q_sort_limit_topk(spark: SparkSession, sf: str) -> DataFrame:
    """The order is part of the result: ``position`` counts rows as they come."""
    top = retail.top_customers(layouts(spark, sf)["transactions"], 25).withColumn("totalRevenue", _dbl("totalRevenue"))
    return _positions(top)


def _positions(ordered: DataFrame) -> DataFrame:
    """Number the rows of a small sorted result in the order they come
    (``coalesce`` of range partitions keeps it)."""
    return ordered.coalesce(1).withColumn("position", F.monotonically_increasing_id() + 1)


_COUNTRY_SQL = """
SELECT Country, CAST(sum(Quantity * UnitPrice) AS DOUBLE) AS totalRevenue, CAST(sum(Quantity) AS BIGINT) AS totalQuantity,
       count(DISTINCT CustomerID) AS uniqueCustomers
FROM cust_items GROUP BY Country ORDER BY sum(Quantity * UnitPrice) DESC, Country"""


@query("sales_by_country", with_views(_COUNTRY_SQL, "cust_items"))
def q_sales_by_country(spark: SparkSession, sf: str) -> DataFrame:
    lay = layouts(spark, sf)
    return retail.sales_by_country(lay["transactions"], lay["customer_refs"]).withColumn("totalRevenue", _dbl("totalRevenue"))


@query("sales_by_country_nested", with_views(_COUNTRY_SQL, "cust_items"))
def q_sales_by_country_nested(spark: SparkSession, sf: str) -> DataFrame:
    return retail.sales_by_country_nested(layouts(spark, sf)["customers"]).withColumn("totalRevenue", _dbl("totalRevenue"))


@query("sales_by_country_embedded", with_views(_COUNTRY_SQL, "cust_items"))
def q_sales_by_country_embedded(spark: SparkSession, sf: str) -> DataFrame:
    lay = layouts(spark, sf)
    emb = docs.embed_country(lay["transactions"], lay["customer_refs"])
    return retail.sales_by_country_embedded(emb).withColumn("totalRevenue", _dbl("totalRevenue"))


@query("sort_desc", with_views(f"""
SELECT *, row_number() OVER (ORDER BY totalRevenue DESC, Country) AS position FROM ({_COUNTRY_SQL})""", "cust_items"))
def q_sort_desc(spark: SparkSession, sf: str) -> DataFrame:
    return _positions(q_sales_by_country(spark, sf))  # one row per country


@query("distinct_set_size", with_views("""
SELECT Country, count(DISTINCT CustomerID) AS n_customers FROM cust_items GROUP BY Country""", "cust_items"))
def q_distinct_set_size(spark: SparkSession, sf: str) -> DataFrame:
    # customers that own at least one item, no item fields needed
    c = layouts(spark, sf)["customers"].filter(F.exists("Invoices", lambda i: F.size(i["Items"]) > 0))
    return retail.distinct_set_size(c, "Country", "CustomerID", "n_customers")


@query("fn_multiply_sum", with_views("""
SELECT InvoiceNo, CAST(sum(Quantity * UnitPrice) AS DOUBLE) AS revenue FROM tx_items GROUP BY InvoiceNo""", "tx_items"))
def q_fn_multiply_sum(spark: SparkSession, sf: str) -> DataFrame:
    rows = docs.item_fields(layouts(spark, sf)["transactions"], ["Quantity", "UnitPrice"], keep=["InvoiceNo"])
    return rows.groupBy("InvoiceNo").agg(F.sum(retail.revenue()).cast("double").alias("revenue"))


@query("fn_array_size", with_views("""
SELECT InvoiceNo, count(*) AS n_items FROM tx_items GROUP BY InvoiceNo""", "tx_items"))
def q_fn_array_size(spark: SparkSession, sf: str) -> DataFrame:
    tx = layouts(spark, sf)["transactions"]
    return tx.groupBy("InvoiceNo").agg(F.sum(F.size("Items")).cast("long").alias("n_items"))


@query("fn_month_range", with_views("""
SELECT InvoiceNo, CAST(date_trunc('month', InvoiceDate) AS DATE) AS month_start,
       CAST(date_trunc('month', InvoiceDate) + INTERVAL 1 MONTH AS DATE) AS next_month
FROM headers""", "headers"))
def q_fn_month_range(spark: SparkSession, sf: str) -> DataFrame:
    from quarry.functions.scalars import month_start, next_month_start
    h = layouts(spark, sf)["headers"]
    return h.select("InvoiceNo", month_start("InvoiceDate").alias("month_start"),
                    next_month_start("InvoiceDate").alias("next_month"))


@query("limit_unordered", with_views(f"""
SELECT InvoiceNo, CustomerID FROM headers ORDER BY InvoiceNo LIMIT {SEARCH_LIMIT}""", "headers"))
def q_limit_unordered(spark: SparkSession, sf: str) -> DataFrame:
    tx = layouts(spark, sf)["transactions"]
    return tx.select("InvoiceNo", "CustomerID").distinct().orderBy("InvoiceNo").limit(SEARCH_LIMIT)


@query("head_n", with_views("""
SELECT InvoiceNo, StockCode, Quantity FROM retail ORDER BY RowKey LIMIT 5""", "retail"))
def q_head_n(spark: SparkSession, sf: str) -> DataFrame:
    r = retail_view(spark, sf)
    return r.orderBy("RowKey").limit(5).select("InvoiceNo", "StockCode", "Quantity")


@query("udaf_group_apply", with_views("""
SELECT CustomerID, Country, InvoiceNo, InvoiceDate,
       CAST(row_number() OVER (PARTITION BY CustomerID ORDER BY InvoiceNo) - 1 AS INTEGER) AS pos, n_items
FROM (SELECT CustomerID, Country, InvoiceNo, InvoiceDate, count(*) AS n_items FROM cust_items
      GROUP BY CustomerID, Country, InvoiceNo, InvoiceDate)""", "cust_items"))
def q_udaf_group_apply(spark: SparkSession, sf: str) -> DataFrame:
    """group → list of records: ``collect_list(struct)`` per customer (no Python)."""
    return q_nest_invoices(spark, sf)
