"""Splits, windows, scaling, TF-IDF and metrics against brute force."""

import math

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.functions import arrays
from quarry.functions.config import enabled_flags
from quarry.operators import ml
from quarry.operators.windows import best_so_far, rank_key, rank_within


def test_rank_within_equals_row_number(spark):
    df = spark.range(0, 3000).select(F.col("id"), (F.col("id") % 3).alias("g")).withColumn("k", rank_key("id", 7))
    mine = rank_within(df, ["g"], "k", ["id"], n_buckets=16).select("id", "rank")
    ref = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("k", "id")).alias("rank"))
    assert sorted(mine.collect()) == sorted(ref.collect())


def test_best_so_far_equals_plain_window(spark):
    rows = [(u, t, float((t * 37 + u * 11) % 23)) for u in range(3) for t in range(60)]
    df = spark.createDataFrame(rows, "u int, t int, v double")
    mine = best_so_far(df, ["u"], ["t"], "v", F.floor(F.col("t") / 7)).filter("is_best").select("u", "t")
    w = Window.partitionBy("u").orderBy("t").rowsBetween(Window.unboundedPreceding, -1)
    ref = (df.withColumn("p", F.coalesce(F.max("v").over(w), F.lit(0.0)))
           .filter("v > greatest(p, 0.0)").select("u", "t"))
    assert sorted(mine.collect()) == sorted(ref.collect())


def test_split_sizes_exact(spark):
    df = spark.range(0, 101).select(F.col("id"), (F.col("id") % 4).alias("label"))
    sp = ml.split_holdout(df, "id", 0.2, 42)
    assert sp.filter("split = 'test'").count() == math.ceil(0.2 * 101)
    st = ml.split_holdout(df, "id", 0.2, 42, stratify="label")
    per = {r["label"]: r["n"] for r in st.filter("split = 'test'").groupBy("label").agg(F.count("*").alias("n")).collect()}
    assert per == {0: 6, 1: 5, 2: 5, 3: 5}
    assert ml.split_ratio(df, "id", 0.8).filter("split = 'train'").count() == 80
    assert ml.sample_n(df, "id", 7).count() == 7


def test_balanced_subset(spark):
    df = spark.range(0, 50).select(F.col("id"), F.when(F.col("id") < 40, 0).otherwise(1).alias("label"))
    b = ml.balanced_subset(df, "id", "label", 9)
    assert b.count() == 9 and b.select("id").distinct().count() == 9
    assert b.filter("label = 1").count() >= 4
    assert ml.balanced_subset(df, "id", "label", -1).count() == 50
    assert ml.balanced_subset(df, "id", "label", 500).count() == 50


def test_standardize_population_std(spark):
    tr = spark.createDataFrame([(1.0,), (3.0,)], "x double")
    a, _ = ml.standardize_columns(tr, tr, ["x"])
    assert sorted(r["x"] for r in a.collect()) == [-1.0, 1.0]


def test_tfidf_matches_formula(spark):
    docs = spark.createDataFrame([(1, "aa bb bb"), (2, "bb cc")], "id int, text string")
    w = {(r["id"], r["term"]): r["weight"] for r in ml.tfidf(docs, "id", "text").collect()}
    idf = lambda d: math.log(3 / (1 + d)) + 1
    v1 = {"aa": 1 * idf(1), "bb": 2 * idf(2)}
    n1 = math.sqrt(sum(x * x for x in v1.values()))
    assert abs(w[(1, "bb")] - v1["bb"] / n1) < 1e-12


def test_metrics_zero_division_and_zero_cells(spark):
    p = spark.createDataFrame([(0, 0), (0, 1), (1, 1), (2, 1)], "y int, p int")
    m = {r["label"]: r for r in ml.per_class_metrics(p, "y", "p").collect()}
    assert m[2]["precision"] == 0.0 and m[2]["f1"] == 0.0
    cm = ml.confusion_matrix(p, "y", "p")
    assert cm.count() == 9 and cm.filter("n = 0").count() == 5
    rep = {r["row"]: r for r in ml.classification_report(p, "y", "p").collect()}
    assert rep["accuracy"]["f1"] == 0.5 and rep["macro avg"]["support"] == 4


def test_softmax_and_argmax(spark):
    df = spark.createDataFrame([([1.0, 3.0, 3.0],)], "s array<double>")
    r = df.select(arrays.softmax("s").alias("p"), arrays.argmax("s").alias("i")).first()
    assert abs(sum(r["p"]) - 1) < 1e-12 and r["i"] == 1


def test_select_best_run_first_max_wins(spark):
    runs = spark.createDataFrame([(0, 0.9), (1, 0.95), (2, 0.95), (3, 0.1)], "run_order int, acc double")
    assert ml.select_best_run(runs, "acc", "run_order").first()["run_order"] == 1
    none = spark.createDataFrame([(0, 0.0)], "run_order int, acc double")
    assert ml.select_best_run(none, "acc", "run_order").count() == 0


def test_grid_expand_reference_shape(spark):
    # layers as in the reference configs: default override < toml < per-architecture override
    rows = [
        ("resnet34", 0, "limit", ["-1"]), ("resnet34", 1, "lr", ["0.001"]), ("resnet34", 1, "optimizer", ["sgd"]),
        ("resnet34", 2, "optimizer", ["sgd", "adam"]),
        ("resnet50", 0, "limit", ["-1"]), ("resnet50", 1, "lr", ["0.01"]),
        ("resnet101", 0, "limit", ["-1"]), ("resnet101", 1, "lr", ["0.1"]),
    ]
    layers = spark.createDataFrame(rows, "architecture string, precedence int, key string, values array<string>")
    g = ml.grid_expand(layers)
    counts = {r["architecture"]: r["n"] for r in g.groupBy("architecture").agg(F.count("*").alias("n")).collect()}
    assert counts == {"resnet34": 2, "resnet50": 1, "resnet101": 1}


def test_enabled_flags(spark):
    df = spark.createDataFrame([([("a", True), ("b", False), ("c", True)],)], "flags array<struct<name:string,enabled:boolean>>")
    r = enabled_flags(df).first()
    assert r["n_flags"] == 3 and r["enabled"] == ["a", "c"]


def test_drift_noise_is_partition_independent(spark):
    df = spark.range(0, 200).select(F.col("id"), F.lit(0.0).alias("x"))
    a = ml.drift_shift(df, "id", ["x"], seed=3).collect()
    b = ml.drift_shift(df.repartition(7), "id", ["x"], seed=3).collect()
    assert sorted(a) == sorted(b)
    mean = sum(r["x"] for r in a) / len(a)
    assert 0.45 < mean < 0.55


def test_rank_within_spreads_a_hot_group(spark):
    """A group with most of the rows is numbered by many bucket tasks, and
    the numbering is still exact."""
    df = spark.range(0, 5000).select(F.col("id"), F.when(F.col("id") < 4500, 0).otherwise(F.col("id") % 5 + 1).alias("g"))
    df = df.withColumn("k", rank_key("id", 3))
    out = rank_within(df, ["g"], "k", ["id"], n_buckets=32)
    hot = out.filter("g = 0")
    assert hot.select(F.floor(F.col("k") / (2 ** 31 // 32)).alias("b")).distinct().count() >= 16
    assert sorted(r["rank"] for r in hot.select("rank").collect()) == list(range(1, 4501))


def test_tfidf_fit_on_train_transform_unseen(spark):
    train = spark.createDataFrame([(1, "aa bb"), (2, "bb cc")], "id int, text string")
    test = spark.createDataFrame([(3, "bb zz"), (4, "zz yy")], "id int, text string")
    model = ml.tfidf_fit(train, "id", "text")
    w = ml.tfidf_transform(test, model, "id", "text")
    assert {(r["id"], r["term"]) for r in w.collect()} == {(3, "bb")}
    vecs = {r["id"]: r["features"] for r in ml.tfidf_vectors(test, model).collect()}
    assert vecs[4].numNonzeros() == 0 and vecs[3].numNonzeros() == 1 and vecs[3].size == 3
    # the vectors hold the weights of the long form, terms in alphabetical order
    long = {(r["id"], r["term"]): r["weight"] for r in ml.tfidf_transform(train, model, "id", "text").collect()}
    for r in ml.tfidf_vectors(train, model).collect():
        assert {(r["id"], ["aa", "bb", "cc"][i]): round(v, 12) for i, v in zip(r["features"].indices, r["features"].values)} == \
            {k: round(v, 12) for k, v in long.items() if k[0] == r["id"]}


def test_quantile_buckets_handle_clustered_keys(spark):
    from quarry.operators.windows import rank_within_quantiles
    # 3000 ids packed near 0 plus a few far outliers: equal-width buckets would put almost all in one
    ids = [(i, i % 2) for i in range(3000)] + [(10 ** 12 + i, i % 2) for i in range(5)]
    df = spark.createDataFrame(ids, "id long, g int")
    out = rank_within_quantiles(df, ["g"], "id", ["id"], n_buckets=16)
    ref = df.select("id", F.row_number().over(Window.partitionBy("g").orderBy("id")).alias("rank"))
    assert sorted(out.select("id", "rank").collect()) == sorted(ref.collect())


def test_fixed_point_ratio_is_exact_half_up(spark):
    from fractions import Fraction
    rows = [(380917, 8), (5, 2), (1, 3), (2, 3), (123456789, 1000), (0, 7), (47614687 * 2 + 1, 2 * 10 ** 6)]
    df = spark.createDataFrame(rows, "a long, b long").select("a", "b", ml.fixed_point_ratio("a", "b", 6).alias("r"))
    for r in df.collect():
        q = Fraction(r["a"], r["b"]) * 10 ** 6
        want = (q + Fraction(1, 2)).__floor__() / 10 ** 6      # half-up
        assert r["r"] == want, (r["a"], r["b"], r["r"], want)
