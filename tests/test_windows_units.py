"""Quantile buckets follow the rows and where they lie."""

from pyspark.sql import functions as F

from quarry.operators import windows


def _events(spark):
    """Two users; half of one user's rows lie in a single hour."""
    rows = [(i, i % 7 == 0, 1_700_000_000 + (i * 13 % 3600 if i % 2 else i * 5000), float(i * 7919 % 1000)) for i in range(600)]
    return spark.createDataFrame(rows, "id long, u boolean, s long, value double").withColumn("ts", F.timestamp_seconds("s"))


def test_hot_hour_is_cut_and_best_so_far_exact(spark):
    df = _events(spark)
    cut = windows.quantile_bucket(df, "ts", 50)
    sizes = [r["count"] for r in cut.groupBy("_bucket").count().collect()]
    assert len(sizes) == 12 and max(sizes) <= 100
    hot = cut.filter(F.date_trunc("hour", "ts") == F.date_trunc("hour", F.timestamp_seconds(F.lit(1_700_000_000 + 1300))))
    assert hot.select("_bucket").distinct().count() > 3
    want, best = [], {}
    for r in sorted(df.collect(), key=lambda r: (r["s"], r["id"])):
        if r["value"] > best.get(r["u"], 0.0):
            best[r["u"]] = r["value"]
            want.append(r["id"])
    for per in (50, 10_000):
        got = windows.best_so_far(df, ["u"], ["ts", "id"], "value", rows_per_bucket=per).filter("is_best")
        assert sorted(r["id"] for r in got.collect()) == sorted(want)


def test_sequence_is_exact_at_any_bucket_size(spark):
    df = _events(spark)
    want, n = {}, {}
    for r in sorted(df.collect(), key=lambda r: r["id"]):
        want[r["id"]] = n.get(r["u"], 0)
        n[r["u"]] = want[r["id"]] + 1
    for per in (1, 64, 10_000):
        got = windows.per_class_sequence(df, "u", "id", per)
        assert {r["id"]: r["seq"] for r in got.collect()} == want
    assert windows.per_class_sequence(df.limit(0), "u", "id").count() == 0
