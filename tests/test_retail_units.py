"""Hand fixtures for the retail operators (FIXTURES.md §1–3)."""

import datetime as dt

from pyspark.sql import functions as F

from quarry.operators import clean, dml, docs, retail
from quarry.sources.retail import RAW_SCHEMA


def raw(spark):
    rows = [
        ("1", "A", "apple", 2, "2011-05-03 10:00:00", 1.50, 10.0, "UK"),
        ("1", "A", "apple", 2, "2011-05-03 10:00:00", 1.50, 10.0, "UK"),      # exact duplicate
        ("1", "B", None, 1, "2011-05-03 10:00:00", 2.00, 10.0, "UK"),         # null first description
        ("1", "B", "banana", 3, "2011-05-03 10:00:00", 2.50, 10.0, "UK"),     # same key, other price
        ("2", "A", "apple", -1, "2011-12-31 23:00:00", 1.50, 11.0, "FR"),     # negative qty, 31 Dec
        ("3", "C", "cherry", 1, "not a date", 3.00, 11.0, "FR"),              # bad date
        ("4", "C", "cherry", 1, "2011-06-01 00:00:00", 3.00, None, "FR"),     # null customer
        ("5", "D", "date", 4, "2011-06-02 00:00:00", 4.00, 11.0, "DE"),       # second country for 11
    ]
    from decimal import Decimal
    rows = [r[:5] + (Decimal(str(r[5])),) + r[6:] for r in rows]
    return spark.createDataFrame(rows, RAW_SCHEMA)


def test_clean_pipeline(spark):
    out = clean.clean_pipeline(raw(spark))
    assert out.count() == 5  # null customer, bad date, duplicate dropped
    assert dict(out.dtypes)["CustomerID"] == "int"
    assert dict(out.dtypes)["InvoiceDate"] == "timestamp_ntz"
    assert out.filter("Quantity < 0").count() == 1  # never filtered


def _retail(spark):
    c = clean.clean_pipeline(raw(spark))
    return c.withColumn("RowKey", F.struct(F.col("InvoiceNo").cast("int"), F.col("StockCode"), F.col("Quantity")))


def test_item_rollup_first_non_null(spark):
    r = docs.item_rollup(_retail(spark))
    b = r.filter("InvoiceNo = '1' AND StockCode = 'B'").first()
    assert b["Description"] == "banana"
    assert b["Quantity"] == 4
    assert float(b["UnitPrice"]) == 2.5


def test_keep_first_customer_country(spark):
    k = clean.keep_first(_retail(spark), ["CustomerID"], "RowKey", ["Country"])
    got = {r["CustomerID"]: r["Country"] for r in k.collect()}
    assert got == {10: "UK", 11: "FR"}


def test_layouts_flatten_identity_and_chunks(spark):
    r = _retail(spark)
    for max_items in (1, 2, 2048):
        lay = docs.build_layouts(r, max_items=max_items, max_invoices=1)
        flat = docs.unwind_items(lay["transactions"]).select("InvoiceNo", "StockCode", "Quantity")
        rollup = lay["rollup"].select("InvoiceNo", "StockCode", "Quantity")
        assert sorted(flat.collect()) == sorted(rollup.collect())
        two = docs.unwind_two_level(lay["customers"]).select("InvoiceNo", "StockCode", "Quantity")
        assert sorted(two.collect()) == sorted(rollup.collect())
        per_inv = lay["transactions"].groupBy("InvoiceNo").agg(F.count("*").alias("docs"), F.sum(F.size("Items")).alias("n"))
        assert per_inv.filter(F.col("docs") > F.ceil(F.col("n") / max_items)).count() == 0
        if max_items == 2048:
            assert per_inv.filter("docs > 1").count() == 0


def test_sales_by_country_layouts_agree(spark):
    lay = docs.build_layouts(_retail(spark))
    a = retail.sales_by_country(lay["transactions"], lay["customer_refs"]).collect()
    b = retail.sales_by_country_nested(lay["customers"]).collect()
    assert [tuple(x) for x in a] == [tuple(x) for x in b]


def test_month_range_december_rolls_over():
    assert retail.month_range(2011, 12) == (dt.datetime(2011, 12, 1), dt.datetime(2012, 1, 1))


def test_invoices_by_month_half_open(spark):
    lay = docs.build_layouts(_retail(spark))
    assert retail.invoices_by_month(lay["transactions"], 11, 2011, 12).count() == 1
    assert retail.invoices_by_month_nested(lay["customers"], 11, 2011, 12).count() == 1
    assert retail.invoices_by_month_nested(lay["customers"], 999, 2011, 12).count() == 0


def test_update_first_vs_all(spark):
    item = "struct<StockCode:string,Description:string,Quantity:bigint,UnitPrice:decimal(18,2)>"
    tx = spark.createDataFrame(
        [("9", 0, None, 1, [("X", "x", 1, None), ("X", "x", 2, None)])],
        f"InvoiceNo string, Chunk int, InvoiceDate timestamp_ntz, CustomerID int, Items array<{item}>")
    first = dml.update_item_qty(tx, "9", "X", 7).first()["Items"]
    assert [i["Quantity"] for i in first] == [7, 2]
    cust = tx.select("CustomerID", "Chunk", F.lit("UK").alias("Country"),
                     F.array(F.struct("InvoiceNo", "InvoiceDate", "Items")).alias("Invoices"))
    allm = dml.update_item_qty_nested(cust, 1, "9", "X", 7).first()["Invoices"][0]["Items"]
    assert [i["Quantity"] for i in allm] == [7, 7]


def test_push_then_pull_is_identity(spark):
    lay = docs.build_layouts(_retail(spark))
    c = lay["customers"]
    entry = F.struct(F.lit("NEW").alias("InvoiceNo"), F.lit(None).cast("timestamp_ntz").alias("InvoiceDate"),
                     F.expr("slice(Invoices[0].Items, 1, 1)").alias("Items"))
    pushed = dml.push_invoice(c, 10, entry)
    assert pushed.filter(F.exists("Invoices", lambda i: i["InvoiceNo"] == "NEW")).count() == 1
    back = dml.pull_invoice(pushed, "NEW")
    key = lambda df: sorted((r["CustomerID"], r["Chunk"], [i["InvoiceNo"] for i in r["Invoices"]]) for r in df.collect())
    assert key(back) == key(c)


def test_upsert_twice_equals_once(spark):
    t = spark.createDataFrame([(1, "a"), (2, "b")], "k int, v string")
    s = spark.createDataFrame([(2, "B", 1), (2, "B2", 2), (3, "c", 1)], "k int, v string, o int")
    once = dml.upsert_replace(t, s, ["k"], order="o")   # last row per key in the source wins
    twice = dml.upsert_replace(once, s, ["k"], order="o")
    assert sorted(once.collect()) == sorted(twice.collect()) == [(1, "a"), (2, "B2"), (3, "c")]


def test_bulk_insert_rejects_existing_and_repeated(spark):
    t = spark.createDataFrame([("1", "a")], "k string, v string")
    new = spark.createDataFrame([("1", "x", 0), ("2", "y", 0), ("2", "z", 1)], "k string, v string, o int")
    out = dml.bulk_insert(t.withColumn("o", F.lit(0)), new, ["k"], order="o")
    assert sorted((r["k"], r["v"]) for r in out.collect()) == [("1", "a"), ("2", "y")]


def test_pk_and_fk_checks(spark):
    items = spark.createDataFrame([("1", "A"), ("1", "A"), ("9", "Z")], "InvoiceNo string, StockCode string")
    inv = spark.createDataFrame([("1",)], "InvoiceNo string")
    assert clean.pk_violations(items, ["InvoiceNo", "StockCode"]).count() == 1
    assert clean.fk_orphans(items, inv, ["InvoiceNo"]).count() == 1


def test_synthetic_rows_follow_reference_formulas(spark):
    ids = spark.createDataFrame([(0,), (13,)], "CustomerID int")
    rows = {r["InvoiceNo"]: r for r in dml.synthetic_invoices(ids).collect()}
    it = rows["800013"]["Items"][0]
    assert it["StockCode"] == "TEST0013" and it["Quantity"] == 4 and float(it["UnitPrice"]) == 18.99
    upd = {r["invoice_no"]: r["new_quantity"] for r in dml.synthetic_updates(ids).collect()}
    assert upd == {"800000": 5, "800013": 18}


def test_hot_invoice_is_split_into_bounded_chunks(spark):
    """One invoice holds a third of all rows: its items are spread over
    ceil(n / max_items) documents of about max_items each, never one row."""
    from decimal import Decimal
    rows = [("HOT", f"S{i:04d}", "d", 1, dt.datetime(2011, 1, 1), Decimal("1.00"), 1, "UK") for i in range(1000)]
    rows += [(f"I{i}", f"S{i % 50:04d}", "d", 1, dt.datetime(2011, 1, 1), Decimal("1.00"), 2 + i % 7, "FR")
             for i in range(2000)]
    from quarry.sources.retail import RETAIL_SCHEMA
    df = spark.createDataFrame(rows, RETAIL_SCHEMA).withColumn("RowKey", F.struct("InvoiceNo", "StockCode"))
    tx = docs.build_layouts(df, max_items=100)["transactions"]
    hot = tx.filter("InvoiceNo = 'HOT'").select(F.size("Items").alias("n")).collect()
    assert len(hot) == 10 and sum(r["n"] for r in hot) == 1000
    assert max(r["n"] for r in hot) < 200   # balls-in-bins load around 100
    assert tx.filter("InvoiceNo <> 'HOT'").filter("Chunk <> 0").count() == 0


def test_country_is_joined_before_nesting(spark, tmp_path):
    """Every chunk of a customer has the country, and the documents are
    grouped by the last shuffle: none comes after it."""
    for name, df in docs.build_layouts(_retail(spark)).items():
        if name in ("transactions", "customer_refs"):
            df.write.parquet(str(tmp_path / name))
    tx, refs = (spark.read.parquet(str(tmp_path / n)) for n in ("transactions", "customer_refs"))
    got = docs.nest_invoices(tx, refs, max_invoices=1)
    want = {r["CustomerID"]: r["Country"] for r in refs.collect()}
    rows = got.collect()
    assert {r["CustomerID"] for r in rows} == set(want) - {None} and all(r["Country"] == want[r["CustomerID"]] for r in rows)
    assert sum(len(r["Invoices"]) for r in rows) == tx.filter("CustomerID IS NOT NULL").count()
    plan = got._jdf.queryExecution().sparkPlan().toString().splitlines()
    joins = [i for i, line in enumerate(plan) if "Join" in line]
    group = [i for i, line in enumerate(plan) if "Aggregate" in line and "collect_list" in line]
    assert joins and min(joins) > max(group)  # the tree is printed from the top
