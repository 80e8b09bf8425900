"""File sources and sinks with hand fixtures (FIXTURES.md §11–12)."""

import json
import os
import tempfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources import files
from quarry.sources.retail import read_csv
from quarry.streaming import jobs


def test_json_document_absent_null_and_empty(spark):
    doc = {
        "students": [
            {"id": 1, "name": "A", "courses": ["x", "y"], "gpa": 3.5, "active": True,
             "graduation_date": "2025-06-01", "advisor": None, "special_programs": []},
            {"id": 2, "name": "B", "courses": [], "gpa": None, "active": False},   # absent keys
        ],
        "last_updated": "2024-01-01T00:00:00Z",
        "total_students": 2,
    }
    d = tempfile.mkdtemp()
    with open(os.path.join(d, "q1.json"), "w") as fh:
        json.dump(doc, fh, indent=2)
    docs = files.read_json_documents(spark, d, files.STUDENT_SCHEMA)
    rows = {r["id"]: r for r in files.explode_students(docs).collect()}
    assert rows[1]["advisor"] is None and rows[1]["special_programs"] == []
    assert rows[2]["notes"] is None and rows[2]["graduation_date"] is None and rows[2]["courses"] == []
    assert docs.first()["total_students"] == 2


def test_labelled_tree_flat_and_split(spark):
    root = tempfile.mkdtemp() + "/tree"
    rows = spark.createDataFrame([("train", "cat", 0, b"ab"), ("train", "dog", 0, b"c"), ("test", "cat", 0, b"d"),
                                  ("train", "cat", 1, b"ef")], "split string, class string, seq int, content binary")
    files.sink_labelled_tree(rows, root, "split", "class", "seq", "content")
    assert sorted(os.listdir(os.path.join(root, "train", "cat"))) == ["00000.bin", "00001.bin"]
    t = files.read_labelled_tree(spark, root)
    got = sorted((r["split"], r["class"], r["class_index"], r["length"]) for r in t.collect())
    assert got == [("test", "cat", 0, 1), ("train", "cat", 0, 2), ("train", "cat", 0, 2), ("train", "dog", 1, 1)]
    flat = files.read_labelled_tree(spark, os.path.join(root, "train"), flat=True)
    assert sorted(r["class"] for r in flat.collect()) == ["cat", "cat", "dog"]


def test_csv_scan_missing_path_raises(spark):
    with pytest.raises(Exception):
        read_csv(spark, tempfile.mkdtemp() + "/nope").count()


def test_score_stream_quarantines_malformed(spark):
    base = tempfile.mkdtemp()
    spark.createDataFrame([(1, [0.1, 0.9]), (2, [0.8, 0.2]), (3, None)], "id long, s array<float>").write.json(base + "/in")
    with open(base + "/in/broken.json", "w") as f:
        f.write('{"id": 7, "s": [0.1,\n')
    schema = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.ArrayType(T.FloatType()))])
    jobs.score_stream(spark, base + "/in", schema, lambda: F.size("s") == 2,
                      lambda df: df.select("id", (F.array_position("s", F.array_max("s")) - 1).alias("pred")),
                      base + "/out", base + "/bad", base + "/ckpt")
    assert sorted((r["id"], r["pred"]) for r in spark.read.parquet(base + "/out").collect()) == [(1, 1), (2, 0)]
    bad = {r["_corrupt_record"]: r["id"] for r in spark.read.parquet(base + "/bad").collect()}
    assert bad == {None: 3, '{"id": 7, "s": [0.1,': None}


def test_create_tables_from_schemas(spark):
    names = files.create_tables(spark, files.TWO_NF_SCHEMAS, tempfile.mkdtemp(), database="ddl_test")
    assert names == ["ddl_test.products", "ddl_test.invoices", "ddl_test.invoice_items"]
    cols = [f.name for f in spark.table("ddl_test.invoice_items").schema.fields]
    assert cols == ["InvoiceNo", "StockCode", "Quantity", "UnitPrice"]
