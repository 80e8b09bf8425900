"""Round 3: shuffles of the layout build, the indexes and TF-IDF."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from quarry.operators import docs, ml, stored
from quarry.sources import layout_store
from quarry.sources.versioned_store import VersionedStore

SCHEMA = ("InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, "
          "UnitPrice decimal(18,2), CustomerID int, Country string, RowKey int")


def _retail(spark, n=60):
    day = dt.datetime(2011, 1, 1)
    rows = [(f"I{i % 7}", f"S{i % 23}", None if i % 5 == 0 else f"d{i % 23}", i, day, Decimal("1.50"), i % 7 % 3, "A", i) for i in range(n)]
    return spark.createDataFrame([*rows, rows[0]], SCHEMA)


def test_layouts_are_the_same_placed_or_not(spark, tmp_path):
    r = _retail(spark)
    paths = layout_store.build_and_write_layouts(spark, r, str(tmp_path / "lay"), 4, n_cells=2)
    want = docs.build_layouts(r)
    for name in ("transactions", "customers"):
        got = spark.read.parquet(paths[name])
        key = layout_store.KEYS[name]
        assert got.filter(F.col("bucket") != layout_store.bucket_of(F.col(key), 4)).count() == 0
        cols = want[name].columns
        assert sorted(map(str, got.select(*cols).collect())) == sorted(map(str, want[name].collect()))


def test_split_documents_keep_every_item(spark):
    rollup = docs.item_rollup(_retail(spark))
    headers = docs.invoice_headers(rollup)
    tx = docs.nest_items(rollup, headers, max_items=3)
    assert tx.agg(F.max("Chunk")).first()[0] > 0 and tx.filter("InvoiceDate IS NULL OR size(Items) = 0").count() == 0
    flat = docs.unwind_items(tx)
    assert flat.count() == rollup.count() and flat.exceptAll(docs.unwind_items(docs.nest_items(rollup, headers))).count() == 0
    cust = docs.nest_invoices(tx, docs.customer_refs(headers), max_invoices=2)
    assert cust.agg(F.max("Chunk")).first()[0] > 0 and cust.filter("Country IS NULL").count() == 0
    assert docs.unwind_two_level(cust).count() == rollup.count()


def test_items_are_shuffled_once(spark, tmp_path):
    rollup = docs.item_rollup(_retail(spark))
    headers = docs.invoice_headers(rollup)
    rollup.write.parquet(str(tmp_path / "r"))
    headers.write.parquet(str(tmp_path / "h"))
    made = docs.nest_items(spark.read.parquet(str(tmp_path / "r")), spark.read.parquet(str(tmp_path / "h")), place=(4, 2))
    text = made._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1 and "Join" not in text.replace("BroadcastHashJoin", "")


def test_index_rows_are_written_once(spark, tmp_path):
    store = VersionedStore.create(spark, str(tmp_path / "s"))
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), ("a", 3)] * 5, "k string, v int")
    store.define("t", "k", 4, rows.schema)
    store.commit([store.stage("t", rows, distinct=2)])
    assert sorted(tuple(r) for r in store.table("t").collect()) == [("a", 1), ("a", 3), ("b", 2)]
    assert [r[0] for r in store.lookup("t", ["b"]).select("v").collect()] == [2]


def test_words_of_an_index_do_not_repeat_within_a_document(spark):
    tx = docs.nest_items(*(lambda r: (r, docs.invoice_headers(r)))(docs.item_rollup(_retail(spark))))
    assert stored._tx_words(tx).count() == stored.tx_words(tx).count()


def test_tfidf_moves_each_text_once(spark):
    rows = spark.createDataFrame([(1, "a1 bb bb"), (1, "bb cc"), (2, "cc"), (None, "dd"), (3, None)], "id long, text string")
    w = ml.tfidf_transform(rows, ml.tfidf_fit(rows).localCheckpoint())
    text = w._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1
    got = {(r["id"], r["term"]): r["weight"] for r in w.collect()}
    assert set(got) == {(1, "a1"), (1, "bb"), (1, "cc"), (2, "cc"), (None, "dd")} and got[(2, "cc")] == 1.0
