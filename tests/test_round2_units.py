"""Chunk-independent readers, splits, layout store, CSV, unique keys, text."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from quarry.functions import arrays, scalars, text
from quarry.operators import dml, docs, ml, models, retail
from quarry.operators.windows import best_so_far, per_class_sequence, rank_key, rank_key_sql
from quarry.session import checkpoint_dir, clear_scratch, scratch_path
from quarry.sources import layout_store as store
from quarry.sources.retail import RETAIL_SCHEMA, read_csv, write_csv


def retail_rows(spark):
    rows = [(f"I{i}", f"S{k}", f"item {k} {'BELL' if k == 3 else ''}", k + 1, dt.datetime(2011, 1, 1 + i), Decimal(2 + k), i % 2, "UK", i * 100 + k)
            for i in range(6) for k in range(8)]
    return spark.createDataFrame(rows, "InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, "
                                       "UnitPrice decimal(18,2), CustomerID int, Country string, RowKey int")


@pytest.mark.parametrize("max_items", [1, 4, 2048])
def test_readers_at_any_chunk_bound(spark, max_items):
    lay = docs.build_layouts(retail_rows(spark), max_items=max_items, max_invoices=max_items)
    found = retail.product_search(lay["transactions"], "bell", 4).collect()
    assert [r["InvoiceNo"] for r in sorted(found)] == ["I0", "I1", "I2", "I3"] and all(len(r["Items"]) == 8 for r in found)
    nested = retail.product_search_nested(lay["customers"], "bell", 4).collect()
    assert sorted(r["CustomerID"] for r in nested) == [0, 1] and all([len(x) for x in r["Items"]] == [8, 8, 8] for r in nested)
    whole = docs.whole_transactions(lay["transactions"]).collect()
    assert len(whole) == 6 and all([i["StockCode"] for i in r["Items"]] == [f"S{k}" for k in range(8)] for r in whole)
    customers = docs.whole_customers(lay["customers"]).collect()
    assert [[i["InvoiceNo"] for i in r["Invoices"]] for r in sorted(customers)] == [["I0", "I2", "I4"], ["I1", "I3", "I5"]]
    assert {(r[0], r[1]) for r in docs.invoice_counts(dml.pull_invoice(lay["customers"], "I2")).collect()} == {(0, 2), (1, 3)}


def test_splits_keep_null_rows_and_sizes(spark):
    rows = [(i, None if i % 5 == 0 else i % 7) for i in range(100)] + [(None, 3)]
    df = spark.createDataFrame(rows, "id long, label int")
    out = ml.split_holdout(df, "id", 0.2, 42, stratify="label")
    assert out.count() == 101 and out.filter("split = 'test'").count() == 21  # ceil(20.2)
    per = {r["label"]: (r["n"], r["t"]) for r in out.groupBy("label").agg(F.count("*").alias("n"), F.sum(F.expr("int(split = 'test')")).alias("t")).collect()}
    assert all(abs(t - 0.2 * n) < 1 for n, t in per.values())
    assert ml.split_holdout(df, "id", 0.2).filter("split = 'test'").count() == 21
    assert ml.split_ratio(df, "id", 0.8).filter("split = 'train'").count() == 80
    assert ml.balanced_subset(df, "id", "label", -1).count() == 101
    assert ml.balanced_subset(df, "id", "label", 500).count() == 101
    some = ml.balanced_subset(df, "id", "label", 40)
    assert some.count() == 40 and some.filter("label IS NULL").count() >= 5
    assert per_class_sequence(df, "label", "id").count() == 101
    assert ml.sample_n(df, "id", 7).count() == 7 and ml.sample_n(df, "id", 700).count() == 101


def test_seeds_give_unrelated_orders(spark):
    df = spark.range(2000)
    tests = [{r["id"] for r in ml.split_holdout(df, "id", 0.2, s).filter("split = 'test'").collect()} for s in (42, 1234)]
    assert len(tests[0]) == len(tests[1]) == 400 and 40 < len(tests[0] & tests[1]) < 130  # 80 by chance
    keys = [r[0] for r in df.select(rank_key("id", 7)).collect()]
    assert len(set(keys)) == 2000
    import duckdb
    assert keys == [r[0] for r in duckdb.sql(f"SELECT {rank_key_sql('range', 7)} FROM range(2000) ORDER BY range").fetchall()]


def test_best_so_far_null_group(spark):
    df = spark.createDataFrame([(None, 1, 1.0), (None, 2, 3.0), ("a", 1, 2.0)], "g string, t int, v double")
    assert best_so_far(df, ["g"], ["t"], "v", F.col("t")).filter("is_best").count() == 3


def test_depth_is_not_clamped():
    with pytest.raises(ValueError, match="deep"):
        models.random_forest(max_depth=40)


def test_emptied_buckets_go(spark):
    df = spark.createDataFrame([("A1", 1), ("B2", 2)], "InvoiceNo string, x int")
    path = store.write_table(df, scratch_path(spark, "t"), "InvoiceNo", 64)
    store.rewrite_bucket(spark, path, "InvoiceNo", "A1", 64, lambda d: dml.delete_invoice(d, "A1"))
    assert [r["InvoiceNo"] for r in spark.read.parquet(path).collect()] == ["B2"]
    store.append_rows(df.filter("x = 1"), path, "InvoiceNo", 64)
    store.rewrite_buckets(spark, path, "InvoiceNo", df.select("InvoiceNo").limit(1), 64, lambda d: dml.bulk_delete(d, df.filter("x = 1"), ["InvoiceNo"]))
    assert [r["InvoiceNo"] for r in spark.read.parquet(path).collect()] == ["B2"]


def test_written_files_are_sorted(spark):
    df = spark.range(500).select(F.concat(F.lit("K"), F.pmod(F.col("id") * 7919, F.lit(500))).alias("k"))
    path = store.write_table(df, scratch_path(spark, "t"), "k", 4)
    rows = spark.read.parquet(path).select("k", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i")).collect()
    by = {}
    for r in sorted(rows, key=lambda r: r["i"]):
        by.setdefault(r["f"], []).append(r["k"])
    assert len(by) >= 4 and all(v == sorted(v) for v in by.values())


def test_fingerprint_sees_changed_files(spark):
    path = scratch_path(spark, "t")
    spark.range(10).write.parquet(path)
    first, counts = store.source_fingerprint({"a": spark.read.parquet(path)})
    assert counts == {"a": 10} and store.source_fingerprint({"a": spark.read.parquet(path)})[0] == first
    spark.range(10).select((F.col("id") * 2).alias("id")).write.mode("overwrite").parquet(path)
    assert store.source_fingerprint({"a": spark.read.parquet(path)})[0] != first


def test_csv_quotes_and_breaks(spark, tmp_path):
    import pandas as pd
    odd = ['CHARLIE "EXTREMELY BUSY", SIGN', "two\nlines", " blanks ", "plain"]
    names = [f.name for f in RETAIL_SCHEMA.fields]
    fill = {"InvoiceNo": "1", "StockCode": "2", "Quantity": 3, "InvoiceDate": "2011-01-01 00:00:00", "UnitPrice": 1.5, "CustomerID": 4, "Country": "UK"}
    pdf = pd.DataFrame([{**fill, "Description": d} for d in odd])[names]
    pdf.to_csv(tmp_path / "x.csv", index=False)
    got = read_csv(spark, str(tmp_path / "x.csv"))
    assert [r["Description"] for r in got.collect()] == odd and got.filter("Country = 'UK'").count() == 4
    back = read_csv(spark, write_csv(got, scratch_path(spark, "csv")))
    assert sorted(r["Description"] for r in back.collect()) == sorted(odd)
    (tmp_path / "bad.csv").write_text(",".join(names) + "\n1,2,d,notanumber,2011-01-01 00:00:00,1.5,4,UK\n")
    with pytest.raises(Exception):
        read_csv(spark, str(tmp_path / "bad.csv")).collect()
    assert [r["_bad"] is None for r in read_csv(spark, str(tmp_path / "bad.csv"), corrupt_col="_bad").collect()] == [False]


def test_unique_keys(spark):
    t = spark.createDataFrame([("A", 1)], "k string, v int")
    new = spark.createDataFrame([("A", 2), ("Z", 3), ("Z", 4)], "k string, v int")
    assert sorted(map(tuple, dml.bulk_insert(t, new, ["k"]).collect())) == [("A", 1), ("Z", 3)]
    assert sorted(map(tuple, dml.insert_rows(t, new, ["k"]).collect())) == [("A", 1), ("Z", 3)]
    assert sorted(map(tuple, dml.upsert_replace(t, new, ["k"]).collect())) == [("A", 2), ("Z", 4)]
    got = retail.lookup_array(t, spark.createDataFrame([("A", 8), ("A", 7)], "k string, w int"), "k", "m").collect()
    assert len(got) == 1 and [m["w"] for m in got[0]["m"]] == [7, 8]
    none = retail.lookup_array(t, spark.createDataFrame([("B", 8)], "k string, w int"), "k", "m").collect()
    assert none[0]["m"] == []


def test_text_and_numbers_as_python(spark):
    s = "déjà\xa0vu\x1fx　y\x85z don't!"
    row = spark.createDataFrame([(s,)], "s string").select(text.tokens("s").alias("t"), text.clean_text("s").alias("c")).first()
    assert row["t"] == s.split() and row["c"].split() == ["déjà", "vu", "x", "y", "z", "don't"]
    cases = ["10d", "10f", "0x1p3", "1_000", "1__0", " 12 ", "1e5", ".5", "5.", "inf", "-Infinity", "nan", "", "abc", "1_0.5", "9" * 40, "+3", "1e", "\xa07"]

    def ok(kind, x):
        try:
            kind(x)
            return True
        except ValueError:
            return False

    got = spark.createDataFrame([(c,) for c in cases], "s string").select(scalars.is_int("s"), scalars.is_float("s")).collect()
    assert [tuple(r) for r in got] == [(ok(int, c), ok(float, c)) for c in cases]


def test_class_scores_use_every_element(spark):
    v = [float((7 * i) % 64) for i in range(64)]
    got = spark.createDataFrame([(v,)], "v array<double>").select(arrays.class_scores("v", 10)).first()[0]
    assert got == [max(v[c::10]) for c in range(10)]


def test_scratch_is_cleared(spark):
    path = scratch_path(spark, "gone")
    spark.range(3).write.parquet(path)
    assert path.startswith(checkpoint_dir(spark)) and clear_scratch(spark) >= 1
    with pytest.raises(Exception):
        spark.read.parquet(path)
