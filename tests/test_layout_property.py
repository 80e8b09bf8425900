"""Layout property test: for random retail rows, both layouts flatten to the
brute-force item rollup and answer the country rollup identically."""

import datetime as dt
from decimal import Decimal

import pandas as pd
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quarry.operators import docs, retail
from quarry.sources.retail import RETAIL_SCHEMA

row = st.tuples(
    st.sampled_from(["1", "2", "3", "4"]),                 # invoice
    st.sampled_from(["A", "B", "C"]),                      # stock code
    st.one_of(st.none(), st.sampled_from(["x", "y"])),     # description
    st.integers(-3, 9),                                    # quantity
    st.integers(1, 200).map(lambda c: Decimal(c) / 100),   # price
    st.sampled_from([7, 8]),                               # customer
    st.sampled_from(["UK", "FR"]),                         # country
)


@settings(max_examples=4, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=1, max_size=25), st.integers(1, 3))
def test_layouts_match_bruteforce(spark, rows, max_items):
    when = dt.datetime(2011, 5, 1)
    data = [(inv, code, desc, q, when, price, cust, country) for inv, code, desc, q, price, cust, country in rows]
    df = spark.createDataFrame(data, RETAIL_SCHEMA).withColumn("RowKey", F.monotonically_increasing_id())
    df = df.checkpoint()  # fix the row keys before they are used twice
    lay = docs.build_layouts(df, max_items=max_items, max_invoices=max_items)

    pdf = df.toPandas()
    pdf["Quantity"] = pdf["Quantity"].astype(int)
    brute = (pdf.groupby(["InvoiceNo", "StockCode"]).agg(Quantity=("Quantity", "sum"), UnitPrice=("UnitPrice", "max"))
             .reset_index())
    want = sorted((r.InvoiceNo, r.StockCode, int(r.Quantity), Decimal(r.UnitPrice)) for r in brute.itertuples())

    flat_tx = docs.unwind_items(lay["transactions"]).select("InvoiceNo", "StockCode", "Quantity", "UnitPrice")
    flat_cu = docs.unwind_two_level(lay["customers"]).select("InvoiceNo", "StockCode", "Quantity", "UnitPrice")
    assert sorted(tuple(r) for r in flat_tx.collect()) == want
    assert sorted(tuple(r) for r in flat_cu.collect()) == want

    a = retail.sales_by_country(lay["transactions"], lay["customer_refs"]).collect()
    b = retail.sales_by_country_nested(lay["customers"]).collect()
    assert [tuple(x) for x in a] == [tuple(x) for x in b]
    # an invoice keeps the customer of its first row, so only header customers own documents
    headers = pdf.sort_values("RowKey").drop_duplicates("InvoiceNo")
    assert pd.Series([r["uniqueCustomers"] for r in a]).sum() == headers["CustomerID"].nunique()
