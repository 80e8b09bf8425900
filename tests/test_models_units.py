"""Model shape and bound checks on a separable fixture (the test embeddings
carry no label signal, so quality is checked here)."""

import math
import tempfile

from pyspark.sql import functions as F

from quarry.operators import ml, models


def _blobs(spark, n=120):
    rows = []
    for i in range(n):
        c = i % 3
        rows.append((i, float(c * 4 + math.sin(i)), float(-c * 3 + math.cos(i)), c))
    return spark.createDataFrame(rows, "id long, x double, y double, label int")


def test_fit_predict_save_load(spark):
    df = models.with_features(_blobs(spark), cols=["x", "y"])
    sp = ml.split_holdout(df, "id", 0.25, 42, stratify="label")
    train, test = sp.filter("split = 'train'"), sp.filter("split = 'test'")
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / test.count()
    for est, scale in [(models.random_forest(30, 4, 1), False), (models.logistic(1.0, train.count(), 200), True)]:
        m = models.fit(train, est, scale=scale)
        acc = models.evaluate(m, test).first()["accuracy"]
        assert acc > majority and acc >= 0.9
    pb = models.predict_batch(m, test, ["a", "b", "c"])
    sums = pb.select(F.aggregate(F.map_values("probabilities"), F.lit(0.0), lambda a, x: a + x).alias("s")).collect()
    assert all(abs(r["s"] - 1) < 1e-9 for r in sums)
    path = models.save_model(m, tempfile.mkdtemp() + "/m", example=test.select("id", "x", "y"))
    again = models.load_model(path)
    a = sorted((r["id"], r["prediction"]) for r in m.transform(test).collect())
    b = sorted((r["id"], r["prediction"]) for r in again.transform(test).collect())
    assert a == b
    sig = spark.read.json(path + "/signature").first()
    assert models.check_signature(test, sig["input_schema"])
    assert not models.check_signature(test.drop("x"), sig["input_schema"])
    assert models.load_model(tempfile.mkdtemp() + "/absent") is None


def test_sweep_rows_and_best(spark):
    df = models.with_features(_blobs(spark, 60), cols=["x", "y"])
    sp = ml.split_holdout(df, "id", 0.25, 42)
    runs = models.sweep(sp.filter("split = 'train'"), sp.filter("split = 'test'"),
                        [{"model": "rf", "n_estimators": 10, "max_depth": 3}, {"model": "lr", "C": 1.0, "max_iter": 50}])
    assert runs.count() == 2 and runs.filter("status = 'FINISHED'").count() == 2
    best = ml.select_best_run(runs, "test_accuracy", "run_order").first()
    assert best["test_accuracy"] == runs.agg(F.max("test_accuracy")).first()[0]


def test_registry_versions(spark):
    empty = spark.createDataFrame([], "name string, uri string, run_order bigint, version bigint")
    first = models.register_versions(empty, spark.createDataFrame([("m", "u1", 0), ("m", "u2", 1)], "name string, uri string, run_order bigint"))
    both = models.register_versions(first, spark.createDataFrame([("m", "u3", 5), ("k", "v1", 0)], "name string, uri string, run_order bigint"))
    latest = {r["name"]: (r["version"], r["uri"]) for r in models.latest_versions(both).collect()}
    assert latest == {"m": (3, "u3"), "k": (1, "v1")}


def test_damaged_model_raises(spark):
    import os

    import pytest
    df = models.with_features(_blobs(spark, 30), cols=["x", "y"])
    path = models.save_model(models.fit(df, models.random_forest(2, 2, 1)), tempfile.mkdtemp() + "/m")
    for folder, _, names in os.walk(path + "/metadata"):
        for n in names:
            open(os.path.join(folder, n), "w").close()
    with pytest.raises(Exception):
        models.load_model(path)


def test_sweep_keeps_order_and_bugs(spark):
    import pytest
    df = models.with_features(_blobs(spark, 60), cols=["x", "y"]).checkpoint()
    settings = [{"model": "rf", "n_estimators": n, "max_depth": 2} for n in (7, 3, 5)] + [{"model": "rf", "n_estimators": 2, "max_depth": 99}]
    rows = models.sweep(df, df, settings).collect()
    assert [r["run_name"] for r in rows] == [f"RF_estimators_{n}_depth_{d}" for n, d in ((7, 2), (3, 2), (5, 2), (2, 99))]
    assert [r["status"] for r in rows] == ["FINISHED"] * 3 + ["FAILED: ValueError"] and min(r["test_accuracy"] for r in rows[:3]) > 0.9
    with pytest.raises(TypeError):  # a bug in the caller is no failed run
        models.sweep(df, df, [{"model": "rf", "n_estimators": "many"}])


def test_logistic_against_plain_gradient(spark):
    """The fitted probabilities are those of the same loss minimised directly."""
    import numpy as np
    rows = _blobs(spark, 90).filter("label < 2").collect()
    x, y = np.array([[r["x"], r["y"]] for r in rows]), np.array([r["label"] for r in rows], float)
    df = models.with_features(_blobs(spark, 90).filter("label < 2"), cols=["x", "y"])
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    w, b, reg = np.zeros(2), 0.0, 1.0 / len(y)
    for _ in range(20_000):
        p = 1 / (1 + np.exp(-(z @ w + b)))
        w -= 0.5 * (z.T @ (p - y) / len(y) + reg * w)
        b -= 0.5 * (p - y).mean()
    model = models.fit(df, models.logistic(1.0, len(y), 500), scale=True)
    got = {r["id"]: r["probability"][1] for r in model.transform(df).collect()}
    for r, p in zip(rows, 1 / (1 + np.exp(-(z @ w + b)))):
        assert abs(got[r["id"]] - p) < 2e-3
