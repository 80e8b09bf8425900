"""Versioned store: whole commits, and indexes that follow every write."""

import datetime as dt
import random
import re
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry.operators import dml, docs, stored
from quarry.plans.retail_queries import open_store
from quarry.sources import layout_store
from quarry.sources.retail import RETAIL_SCHEMA
from quarry.sources.versioned_store import Conflict, VersionedStore

SF = "/root/testdata/sf0.001"
B = 4


@pytest.fixture(scope="module")
def base_store(spark):
    r = random.Random(5)
    words = ["Red Widget", "blue WIDGET big", "gear", "Ge", None, "a+b case", "WIDGETS (new)", "lamp"]
    rows = [(str(inv), f"P{r.randrange(9)}", r.choice(words), r.randrange(1, 9), dt.datetime(2011, 1 + inv % 12, 1), Decimal(r.randrange(100, 999)) / 100,
             inv % 7, "UK") for inv in range(60) for _ in range(r.randrange(1, 5))]
    df = spark.createDataFrame(rows, RETAIL_SCHEMA).withColumn("RowKey", F.monotonically_increasing_id()).checkpoint()
    lay = docs.build_layouts(df, max_items=3, max_invoices=3)  # chunks
    base = tempfile.mkdtemp()
    paths = layout_store.write_layouts(lay, base, B)
    return stored.build_store(spark, base + "/store", paths, B)


@pytest.fixture
def store(base_store):
    return base_store.fork(tempfile.mkdtemp() + "/fork")


def rows(df):
    return sorted(map(repr, df.collect()))


def assert_indexes_follow(s):
    tx, customers = s.table("transactions"), s.table("customers")
    for name, want in (("customer_invoices", stored.customer_invoices(tx)), ("invoice_customers", stored.invoice_customers(customers)),
                       ("tx_words", stored.tx_words(tx)), ("customer_words", stored.customer_words(customers))):
        assert rows(s.table(name).select(*want.columns)) == rows(want), name
    held, need = set(rows(s.table("trigrams"))), rows(stored.trigrams(stored.tx_words(tx).select("Description").unionByName(stored.customer_words(customers).select("Description"))))
    assert set(need) <= held and len(held) == s.table("trigrams").count()
    for name in s.manifest["tables"]:  # every row lies in its key's bucket
        for b in range(s.n_buckets(name)):
            assert s.table(name, [b]).filter(layout_store.bucket_of(F.col(s.key(name)), s.n_buckets(name)) != b).count() == 0


def item(code, text, qty=1):
    return F.struct(F.lit(code).alias("StockCode"), F.lit(text).alias("Description"), F.lit(qty).cast("long").alias("Quantity"),
                    F.lit(1.5).cast("decimal(18,2)").alias("UnitPrice"))


def invoice(spark, number, customer=3, text="brand new thing"):
    return spark.range(1).select(F.lit(number).alias("InvoiceNo"), F.lit(0).alias("Chunk"), F.lit("2011-05-05").cast("timestamp_ntz").alias("InvoiceDate"),
                                 F.lit(customer).cast("int").alias("CustomerID"), F.array(item("P1", text), item("P2", None)).alias("Items"))


def test_writes_keep_tables_and_indexes_equal(spark, store):
    assert_indexes_follow(store)
    before = rows(docs.unwind_items(store.table("transactions")))
    stored.insert_invoices(store, invoice(spark, "900").unionByName(invoice(spark, "900", text="twin")).unionByName(invoice(spark, "7")))
    assert store.lookup("transactions", ["900"]).count() == 1 and store.version == 1
    assert_indexes_follow(store)
    want = rows(docs.unwind_items(dml.delete_invoice(dml.delete_invoice(store.table("transactions"), "7"), "900")))
    stored.delete_invoices(store, spark.createDataFrame([("7",), ("900",), ("none",)], "InvoiceNo string"))
    assert rows(docs.unwind_items(store.table("transactions"))) == want != before
    assert_indexes_follow(store)
    code = store.lookup("transactions", ["8"]).first()["Items"][0]["StockCode"]
    want = rows(dml.update_item_qty(store.table("transactions"), "8", code, 77))
    stored.update_item_qty(store, "8", code, 77)
    assert rows(store.table("transactions")) == want
    upd = spark.createDataFrame([("8", code, 5), ("9", "P1", 6), ("x", "P1", 7)], "invoice_no string, stock_code string, new_quantity int")
    want = rows(dml.bulk_update_qty(store.table("transactions"), upd))
    stored.bulk_update_qty(store, upd)
    assert rows(store.table("transactions")) == want
    assert_indexes_follow(store)


def test_customer_writes(spark, store):
    entry = F.struct(F.lit("901").alias("InvoiceNo"), F.lit("2011-05-05").cast("timestamp_ntz").alias("InvoiceDate"), F.array(item("P1", "pushed lamp")).alias("Items"))
    want = rows(docs.unwind_two_level(dml.push_invoice(store.table("customers"), 3, entry)))
    stored.push_invoice(store, 3, entry)
    assert rows(docs.unwind_two_level(store.table("customers"))) == want
    version = store.version
    assert stored.push_invoice(store, 999, entry).version == version
    assert_indexes_follow(store)
    assert {x.CustomerID for x in stored.find_invoice_nested(store, "901").collect()} == {3}
    want = rows(docs.unwind_two_level(dml.update_item_qty_nested(store.table("customers"), 3, "901", "P1", 44)))
    stored.update_item_qty_nested(store, 3, "901", "P1", 44)
    assert rows(docs.unwind_two_level(store.table("customers"))) == want
    for number in ("901", "10", "missing"):
        want = rows(dml.pull_invoice(store.table("customers"), number))
        stored.pull_invoice(store, number)
        assert rows(store.table("customers")) == want
        assert_indexes_follow(store)


def test_writer_that_dies_leaves_the_old_version(spark, store, monkeypatch):
    stored.insert_invoices(store, invoice(spark, "900"))
    seen = {n: rows(store.table(n)) for n in store.manifest["tables"]}
    # at every step of a write: before each stage, and before the rename
    for dies_at in range(5):
        steps = iter(range(99))

        def step(method, real):
            def run(*a, **k):
                if next(steps) == dies_at:
                    raise RuntimeError("killed")
                return real(*a, **k)
            monkeypatch.setattr(VersionedStore, method, run)

        with monkeypatch.context() as monkeypatch_here:
            monkeypatch = monkeypatch_here
            step("stage", VersionedStore.stage)
            step("commit", VersionedStore.commit)
            writer = store.refresh()
            try:
                stored.insert_invoices(writer, invoice(spark, "910"))
                assert dies_at >= 5
            except RuntimeError as exc:
                assert str(exc) == "killed"
        reader = store.refresh()
        assert reader.version == 1 and {n: rows(reader.table(n)) for n in seen} == seen
    assert reader.vacuum() > 0  # what the dead writers left
    assert {n: rows(reader.table(n)) for n in seen} == seen
    stored.insert_invoices(reader, invoice(spark, "910"))
    assert reader.lookup("transactions", ["910"]).count() == 1


def test_two_writers_and_versions(spark, store):
    stored.insert_invoices(store, invoice(spark, "900"))
    other = store.refresh()
    stored.insert_invoices(store, invoice(spark, "901"))
    with pytest.raises(Conflict):
        stored.insert_invoices(other, invoice(spark, "902"))
    last = other.refresh()
    assert last.lookup("transactions", ["901"]).count() == 1 and last.lookup("transactions", ["902"]).count() == 0
    old = VersionedStore.open(spark, store.base, version=1)
    assert old.lookup("transactions", ["900"]).count() == 1 and old.lookup("transactions", ["901"]).count() == 0
    want = rows(last.table("transactions"))
    last.compact("transactions")
    assert rows(last.table("transactions")) == want and all(len(f) == 1 for f in last.manifest["tables"]["transactions"]["folders"].values())
    last.vacuum()
    assert rows(last.refresh().table("transactions")) == want
    assert VersionedStore.open(spark, tempfile.mkdtemp()) is None


def test_fork_leaves_its_origin_alone(spark, base_store, store):
    seen = rows(base_store.table("transactions"))
    stored.delete_invoices(store, base_store.table("transactions").select("InvoiceNo"))
    assert store.table("transactions").count() == store.table("tx_words").count() == 0
    assert rows(base_store.table("transactions")) == seen


@pytest.mark.parametrize("most", [10_000, 2])
def test_search_equals_a_scan(spark, store, monkeypatch, most):
    monkeypatch.setattr(stored, "MOST_KEYS", most)  # by buckets, or by joins
    flat = [x for x in docs.unwind_two_level(store.table("customers")).collect()]
    r = random.Random(3)
    texts = sorted({x.Description for x in flat if x.Description})
    terms = ["widget", "WIDGET", "ge", "e", "a\\+b", "new", "zzz", "t b", "w.d", "(new|lamp)"]
    for t in r.sample(texts, 3):
        k = r.randrange(max(len(t) - 3, 1))
        terms.append(re.escape(t[k:k + r.randrange(1, 6)]))
    for term in terms:
        for limit in (3, 100):
            hit = [x for x in flat if x.Description and re.search(term, x.Description, re.I)]
            invoices = sorted({x.InvoiceNo for x in hit})[:limit]
            got = {x.InvoiceNo: sorted(map(repr, x.Items)) for x in stored.product_search(store, term, limit).collect()}
            assert sorted(got) == invoices
            assert all(len(v) == sum(x.InvoiceNo == i for x in flat) for i, v in got.items())
            customers = sorted({x.CustomerID for x in hit})[:limit]
            nested = {x.CustomerID: sum(map(len, x.Items)) for x in stored.product_search_nested(store, term, limit).collect()}
            assert nested == {c: sum(x.CustomerID == c for x in flat) for c in customers}
    assert rows(docs.unwind_items(stored.invoices_by_customer(store, 3))) == rows(docs.unwind_items(store.table("transactions").filter("CustomerID = 3")))
    assert stored.invoices_by_customer(store, 12345).count() == 0


def test_reads_prune_to_buckets(spark):
    s = open_store(spark, SF)
    n = s.n_buckets("transactions")
    assert len(s.lookup("customer_invoices", [42]).inputFiles()) < len(s.table("customer_invoices").inputFiles())
    found = stored.find_invoice_nested(s, "42")
    buckets = {re.search(r"bucket=(\d+)", f).group(1) for f in found.inputFiles()}
    assert len(buckets) == 1 < n
    one = stored.invoices_by_customer(s, 42)
    asked = {layout_store.literal_bucket(x.InvoiceNo, "string", n) for x in one.select("InvoiceNo").collect()}
    assert {int(re.search(r"bucket=(\d+)", f).group(1)) for f in one.inputFiles()} <= asked
