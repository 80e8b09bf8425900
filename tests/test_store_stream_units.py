"""Bucketed document tables and file streams."""

import tempfile

from pyspark.sql import functions as F

from quarry.operators import dml
from quarry.sources import layout_store as store
from quarry.streaming import jobs


def _table(spark):
    return spark.createDataFrame([(i, f"v{i}") for i in range(200)], "k int, v string")


def test_lookup_prunes_and_rewrite_changes_one_bucket(spark):
    path = store.write_table(_table(spark), tempfile.mkdtemp() + "/t", "k", 8)
    assert store.lookup(spark.read.parquet(path), "k", 17, 8).select("v").first()["v"] == "v17"
    got = {r["k"]: r["bucket"] for r in spark.read.parquet(path).collect()}
    assert all(store.literal_bucket(k, "int", 8) == b for k, b in got.items())
    before = {r["k"]: r["bucket"] for r in spark.read.parquet(path).collect()}
    b = store.rewrite_bucket(spark, path, "k", 17, 8, lambda d: d.filter(F.col("k") != 17))
    after = spark.read.parquet(path)
    assert after.count() == 199 and after.filter("k = 17").count() == 0
    assert before[17] == b
    # other buckets untouched
    assert after.filter(F.col("bucket") != b).count() == sum(1 for v in before.values() if v != b)


def test_rewrite_buckets_bulk_upsert(spark):
    path = store.write_table(_table(spark), tempfile.mkdtemp() + "/t", "k", 8)
    src = spark.createDataFrame([(5, "new5"), (500, "new500")], "k int, v string")
    store.rewrite_buckets(spark, path, "k", src.select("k"), 8, lambda d: dml.upsert_replace(d, src, ["k"]))
    got = {r["k"]: r["v"] for r in spark.read.parquet(path).collect()}
    assert len(got) == 201 and got[5] == "new5" and got[500] == "new500" and got[6] == "v6"


def test_upsert_stream_replay_is_harmless(spark):
    base = tempfile.mkdtemp()
    target = store.write_table(_table(spark), base + "/t", "k", 4)
    src_dir = base + "/in"
    spark.createDataFrame([(1, "a"), (300, "b")], "k int, v string").coalesce(1).write.parquet(src_dir)
    schema = "k int, v string"
    from pyspark.sql.types import _parse_datatype_string
    st = _parse_datatype_string(schema)
    jobs.upsert_stream(spark, src_dir, st, target, ["k"], base + "/ckpt", 4)
    once = sorted(spark.read.parquet(target).drop("bucket").collect())
    # a new checkpoint replays the same files: same table
    jobs.upsert_stream(spark, src_dir, st, target, ["k"], base + "/ckpt2", 4)
    twice = sorted(spark.read.parquet(target).drop("bucket").collect())
    assert once == twice and len(once) == 201


def test_push_as_chunk_equals_in_place_push(spark):
    import datetime as dt
    from decimal import Decimal

    from quarry.operators import docs
    from quarry.sources.retail import RETAIL_SCHEMA
    rows = [("1", "A", "a", 1, dt.datetime(2011, 1, 1), Decimal("1.00"), 7, "UK"),
            ("2", "B", "b", 2, dt.datetime(2011, 2, 1), Decimal("2.00"), 7, "UK")]
    r = spark.createDataFrame(rows, RETAIL_SCHEMA).withColumn("RowKey", F.struct("InvoiceNo", "StockCode"))
    cust = docs.build_layouts(r)["customers"]
    path = store.write_table(cust, tempfile.mkdtemp() + "/c", "CustomerID", 4)
    entry = F.struct(F.lit("9").alias("InvoiceNo"), F.lit("2011-03-01").cast("timestamp_ntz").alias("InvoiceDate"),
                     F.expr("array(named_struct('StockCode', 'Z', 'Description', 'z', 'Quantity', CAST(3 AS BIGINT), "
                            "'UnitPrice', CAST(1.5 AS DECIMAL(18,2))))").alias("Items"))
    assert store.push_as_chunk(spark, path, spark.read.parquet(path), 7, entry, 4)
    assert not store.push_as_chunk(spark, path, spark.read.parquet(path), 999, entry, 4)
    appended = docs.unwind_two_level(spark.read.parquet(path).drop("bucket"))
    in_place = docs.unwind_two_level(dml.push_invoice(cust, 7, entry))
    key = lambda df: sorted(tuple(x) for x in df.select("CustomerID", "InvoiceNo", "StockCode", "Quantity").collect())
    assert key(appended) == key(in_place)
