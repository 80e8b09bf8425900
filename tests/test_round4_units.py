"""Round 4: the join of invoice headers with nested items; forests that tasks grow whole."""

import datetime as dt
import math
from decimal import Decimal

import numpy as np
import pytest
from pyspark.ml.classification import RandomForestClassificationModel
from pyspark.sql import functions as F

from quarry.operators import docs, forest, models
from quarry.plans import retail_queries

RETAIL = ("InvoiceNo string, StockCode string, Description string, Quantity int, InvoiceDate timestamp_ntz, "
          "UnitPrice decimal(18,2), CustomerID int, Country string, RowKey int")


def _rollup(spark):
    day = dt.datetime(2011, 1, 1)
    rows = [(f"I{i % 7}", None if i == 8 else f"S{i % 23}", None if i % 5 == 0 else f"d{i % 23}", i, None if i % 7 == 2 else day,
             Decimal("1.50"), None if i % 7 == 3 else i % 3, "A", i) for i in range(60)]
    return docs.item_rollup(spark.createDataFrame([*rows, rows[0], (None, "S1", "d", 1, day, Decimal(1), 1, "A", 99)], RETAIL))


def test_invoice_headers_meet_nested_items(spark, monkeypatch):
    rollup = _rollup(spark).checkpoint()
    headers = docs.invoice_headers(rollup).checkpoint()
    monkeypatch.setattr(retail_queries, "layouts", lambda *_: {"rollup": rollup, "headers": headers})
    got = retail_queries.q_join_invoice_items(spark, "unused")
    want = headers.filter("InvoiceNo IS NOT NULL").select("InvoiceNo", "InvoiceDate", "CustomerID", F.col("_n_items").alias("n_items"))
    assert got.dtypes == want.dtypes and sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "collect_list" in plan and "StockCode" in plan and "Join Inner" in plan  # items are nested, then joined


def test_split_invoices_join_with_every_chunk(spark):
    rollup = _rollup(spark)
    headers = docs.invoice_headers(rollup)
    joined = docs.join_invoice_items(headers, docs.nested_items(rollup, headers, 3), 3)
    assert joined.agg(F.max("Chunk")).first()[0] > 0
    want = docs.nest_items(rollup, headers, 3).select(*joined.columns)
    assert sorted(map(str, joined.collect())) == sorted(map(str, want.collect()))


def _blobs(spark, n=240):
    rows = [(i, float(i % 3 * 4 + math.sin(i)), float(-(i % 3) * 3 + math.cos(i)), 7.0, float(i % 2), i % 3) for i in range(n)]
    return models.with_features(spark.createDataFrame([*rows, rows[0]], "id long, x double, y double, same double, coin double, label int"),
                                cols=["x", "y", "same", "coin"])


def _gini_gain(x, y, w, cut):
    def part(rows):
        c = np.bincount(y[rows], w[rows], 4)
        return c.sum() - (c * c).sum() / max(c.sum(), 1e-9)
    return part(x >= -1) - part(x <= cut) - part(x > cut)


def test_a_node_takes_the_best_split_and_a_tree_every_row():
    rng = np.random.default_rng(3)
    for n in (9, 40, 500):  # by rows and by bins
        bins, y, w = rng.integers(0, 32, (n, 5)).astype(np.uint8), rng.integers(0, 4, n), rng.integers(1, 4, n).astype(float)
        tree, _, gain = forest.grow(bins, y, w, 4, 1, 5, rng)
        best = max(_gini_gain(bins[:, f].astype(int), y, w, c) for f in range(5) for c in range(31))
        if tree.feature[0] >= 0:  # else both leaves have one class and are pruned
            assert abs(gain.sum() - best) < 1e-9 and abs(_gini_gain(bins[:, tree.feature[0]].astype(int), y, w, tree.cut[0]) - best) < 1e-9
        tree, counts, _ = forest.grow(bins, y, w, 4, 30, 5, rng)
        at = forest.walk(tree, bins)
        assert all((np.bincount(y[at == i], w[at == i], 4) == counts[i]).all() for i in np.flatnonzero(tree.feature < 0))
        assert (counts[at].argmax(axis=1) == y).mean() > 0.95


@pytest.mark.parametrize("local_rows, depth", [(200_000, None), (30, None), (30, 3)])
def test_deep_forest_is_grown_by_the_executors(spark, monkeypatch, tmp_path, local_rows, depth):
    """Also with nodes near the roots that all tasks split."""
    df = _blobs(spark).checkpoint()
    monkeypatch.setattr(forest, "LOCAL_ROWS", local_rows)
    monkeypatch.setattr(forest, "DRIVER_NODES", 100)
    monkeypatch.setattr(forest, "WAVE_ROWS", 2_500)  # ten trees at once
    model = models.fit(df, models.random_forest(25, depth, 5), scale=True)
    assert isinstance(model.stages[-1], forest.DeepForestModel)
    assert models.evaluate(model, df).first()["accuracy"] > 0.98
    out = model.transform(df)
    rows = {(r["id"], r["prediction"], tuple(r["probability"])) for r in out.collect()}
    assert out.count() == 241 and len(rows) == 240 and all(abs(sum(p) - 1) < 1e-9 and len(p) == 3 for _, _, p in rows)
    shares = model.stages[-1].featureImportances
    assert abs(sum(shares) - 1) < 1e-9 and shares[2] == 0 and shares[0] + shares[1] > 0.9
    again = models.load_model(models.save_model(model, str(tmp_path / "m")))
    assert {(r["id"], r["prediction"], tuple(r["probability"])) for r in again.transform(df).collect()} == rows
    assert abs(again.stages[-1].featureImportances[0] - shares[0]) < 1e-9


def test_one_unlimited_tree_knows_its_rows(spark, monkeypatch):
    monkeypatch.setattr(forest, "DRIVER_NODES", 0)
    rng = np.random.default_rng(1)
    rows = [(int(y), [float(v) for v in x]) for y, x in zip(rng.integers(0, 3, 300), rng.normal(size=(300, 6)))]
    df = models.with_features(spark.createDataFrame(rows, "label int, v array<double>"), vec="v").checkpoint()
    assert models.evaluate(models.fit(df, models.random_forest(1, None, 1)), df).first()["accuracy"] > 0.99
    deep, flat = (models.evaluate(models.fit(df, models.random_forest(20, d, 1)), df).first()["accuracy"] for d in (None, 2))
    assert deep > 0.95 > 0.8 > flat
    for bad in (df.withColumn("label", F.when(F.col("label") > 0, F.col("label"))), df.withColumn("label", F.col("label") - 1)):
        with pytest.raises(ValueError):
            models.fit(bad, models.random_forest(2, None, 1))


def test_small_forests_stay_with_spark(spark):
    df = _blobs(spark, 60)
    assert isinstance(models.fit(df, models.random_forest(5, None, 1)).stages[-1], RandomForestClassificationModel)
    assert not forest.too_deep(models.random_forest(100, 7), df) and not forest.too_deep(models.logistic(1.0, 10), df)


def test_bags_are_poisson_draws():
    rows = np.arange(50_000)
    a, b = forest.bags(rows, 3, 42), forest.bags(rows, 4, 42)
    assert abs(a.mean() - 1) < 0.02 and abs(a.var() - 1) < 0.03 and abs(np.corrcoef(a, b)[0, 1]) < 0.02
    assert (forest.bags(rows[::-1], 3, 42) == a[::-1]).all()


def test_sweep_sends_only_deep_forests_to_the_executors(spark, monkeypatch):
    df = _blobs(spark, 60).checkpoint()
    grown = []
    monkeypatch.setattr(forest, "DRIVER_NODES", 400)
    monkeypatch.setattr(forest.DeepForestClassifier, "_fit", lambda self, data, fit=forest.DeepForestClassifier._fit: grown.append(self.settings["trees"]) or fit(self, data))
    runs = models.sweep(df, df, [{"model": "rf", "n_estimators": 9, "max_depth": 2}, {"model": "rf", "n_estimators": 12, "max_depth": None}]).collect()
    assert grown == [12] and [r["status"] for r in runs] == ["FINISHED"] * 2 and min(r["test_accuracy"] for r in runs) > 0.9
