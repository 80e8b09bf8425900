"""Model fitting, prediction, sweeps, drift and weak-vs-full training (rows checks)."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import ml, models
from quarry.plans.ml_queries import CLASS_NAMES, SEED, embeddings
from quarry.plans.registry import query
from quarry.session import checkpoint_dir, scratch_path

# Fixed values that must equal the reference's sweep: four forests, three
# logistic regressions.
RF_SETTINGS = [
    {"model": "rf", "n_estimators": 50, "max_depth": 3, "random_state": 42},
    {"model": "rf", "n_estimators": 100, "max_depth": 5, "random_state": 42},
    {"model": "rf", "n_estimators": 100, "max_depth": 7, "random_state": 42},
    {"model": "rf", "n_estimators": 200, "max_depth": None, "random_state": 42},
]
LR_SETTINGS = [
    {"model": "lr", "C": 0.1, "random_state": 42, "max_iter": 1000},
    {"model": "lr", "C": 1.0, "random_state": 42, "max_iter": 1000},
    {"model": "lr", "C": 10.0, "random_state": 42, "max_iter": 1000},
]


def split_features(spark: SparkSession, sf: str, stratify: bool = True) -> tuple[DataFrame, DataFrame]:
    """Train / test feature rows, checkpointed once: every fit and
    evaluation pass then reads the cut table instead of re-running the split."""
    checkpoint_dir(spark)
    e = embeddings(spark, sf)
    sp = ml.split_holdout(e, "vec_id", 0.2, SEED, stratify="label" if stratify else None)
    sp = models.with_features(sp, vec="embedding").checkpoint()
    return sp.filter("split = 'train'"), sp.filter("split = 'test'")


def _predicted(model, test: DataFrame) -> DataFrame:
    """Each test row's class and the probability that the model gives it."""
    out = model.transform(test)
    return out.select("vec_id", "label", F.col("prediction").cast("int").alias("prediction"),
                      F.round(F.array_max(vector_to_array("probability")), 6).alias("probability"))


@query("train_random_forest")
def q_train_rf(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split_features(spark, sf)
    return _predicted(models.fit(train, models.random_forest(50, 5, SEED)), test)


@query("train_logistic")
def q_train_lr(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split_features(spark, sf)
    return _predicted(models.fit(train, models.logistic(1.0, train.count(), 200), scale=True), test)


@query("predict_batch")
def q_predict_batch(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split_features(spark, sf)
    model = models.fit(train, models.logistic(1.0, train.count(), 200), scale=True)
    out = models.predict_batch(model, test, CLASS_NAMES)
    return out.select("vec_id", "label", "predicted_class", "predicted_name", F.explode("probabilities").alias("class_name", "probability"))


@query("feature_importance_rank")
def q_feature_importance(spark: SparkSession, sf: str) -> DataFrame:
    train, _ = split_features(spark, sf)
    model = models.fit(train, models.random_forest(50, 5, SEED))
    names = [f"f{i}" for i in range(64)]
    return models.feature_importance(model, names)


@query("sweep_random_forest")
def q_sweep_rf(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split_features(spark, sf)
    return models.sweep(train, test, RF_SETTINGS)


@query("sweep_logistic")
def q_sweep_lr(spark: SparkSession, sf: str) -> DataFrame:
    train, test = split_features(spark, sf)
    return models.sweep(train, test, LR_SETTINGS)


def _u_sql(seed: int, k: int) -> str:
    h = f"(((vec_id % 2147483648) * 1103515245 + {12345 + 7919 * seed + 15485863 * k} + pos * 104729) % 2147483648)"
    h = f"((xor({h}, {h} >> 13) * 1103515245 + 12345) % 2147483648)"
    return f"((CAST(xor({h}, {h} >> 16) AS DOUBLE) + 0.5) / 2147483648.0)"


@query("drift_shift", f"""
SELECT vec_id, pos, round(CAST(x AS DOUBLE) + 0.5 + 0.1 * sqrt(-2.0 * ln({_u_sql(99, 1)})) * cos(2.0 * pi() * {_u_sql(99, 2)}), 6) AS value
FROM (SELECT vec_id, unnest(embedding) AS x, unnest(range(len(embedding))) AS pos FROM embeddings)""")
def q_drift_shift(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf)
    shifted = ml.drift_shift_vector(e, "vec_id", "embedding", seed=99)
    return (shifted.select("vec_id", F.posexplode("embedding").alias("pos", "value"))
            .select("vec_id", F.col("pos").cast("long").alias("pos"), F.round("value", 6).alias("value")))


@query("drift_compare")
def q_drift_compare(spark: SparkSession, sf: str) -> DataFrame:
    """Baseline vs shifted-test accuracy of one model, and the alert rule."""
    train, test = split_features(spark, sf, stratify=False)
    model = models.fit(train, models.random_forest(50, None, SEED))
    shifted = models.with_features(ml.drift_shift_vector(test.drop("features"), "vec_id", "embedding", seed=99), vec="embedding")
    base = models.evaluate(model, test).select(F.lit("baseline-run").alias("run"), "accuracy")
    drift = models.evaluate(model, shifted).select(F.lit("drifted-run").alias("run"), "accuracy")
    both = base.unionByName(drift)
    return both.withColumn("alert", F.col("accuracy") < F.lit(0.85))


@query("weak_vs_full")
def q_weak_vs_full(spark: SparkSession, sf: str) -> DataFrame:
    """One classifier on TF-IDF features trained twice — on the label model's
    weak labels and on the true labels — and evaluated on the same labelled test rows."""
    from quarry.functions import text as tx
    from quarry.operators import weak
    from quarry.plans.weak_queries import REVIEW_LFS, review_matrix
    from quarry.sources.text import reviews

    checkpoint_dir(spark)
    docs = reviews(spark, sf).select("id", tx.clean_text("text").alias("text"))
    L = weak.label_model(review_matrix(spark, sf), REVIEW_LFS, cardinality=2, n_epochs=50).withColumnRenamed("pred", "weak")
    sp = ml.split_holdout(docs.join(L.select("id", "label", "weak"), "id"), "id", 0.2, SEED).checkpoint()
    # the vectorizer is fitted on the training documents only, then applied to both splits
    model = ml.tfidf_fit(sp.filter("split = 'train'"), "id", "text", 5000).checkpoint()
    data = ml.tfidf_vectors(sp, model).select("id", "features", "label", "weak", "split").checkpoint()   # read by two fits
    train, test = data.filter("split = 'train'"), data.filter("split = 'test' AND label IS NOT NULL")
    out = None
    for source, col, rows in [("weak", "weak", train.filter(F.col("weak") != weak.ABSTAIN)),
                              ("full", "label", train.filter(F.col("label").isNotNull()))]:
        model = models.fit(rows, models.logistic(1.0, rows.count(), 200, label=col), label=col)
        pred = model.transform(test).select(F.col("label").alias("y"), F.col("prediction").cast("int").alias("p"))
        m = ml.weighted_prf(pred, "y", "p").select(F.lit(source).alias("source"), "accuracy", "precision", "recall", "f1")
        out = m if out is None else out.unionByName(m)
    return out


@query("sink_model")
def q_sink_model(spark: SparkSession, sf: str) -> DataFrame:
    """Save a fitted pipeline with its signature, load it back, predict."""
    train, test = split_features(spark, sf)
    model = models.fit(train, models.logistic(1.0, train.count(), 100), scale=True)
    path = scratch_path(spark, "model")
    models.save_model(model, path, example=test.select("vec_id", "embedding"))
    return _predicted(models.load_model(path), test)


@query("src_model")
def q_src_model(spark: SparkSession, sf: str) -> DataFrame:
    """Predictions of a saved forest.  Loading an absent model gives an error
    value, not an exception."""
    train, test = split_features(spark, sf)
    if models.load_model(scratch_path(spark, "absent-model")) is not None:
        raise AssertionError("an absent model was loaded")
    model = models.fit(train, models.random_forest(20, 4, SEED))
    return _predicted(models.load_model(models.save_model(model, scratch_path(spark, "model"))), test)


@query("model_signature")
def q_model_signature(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf).orderBy("vec_id")
    sig = models.model_signature(e.select("vec_id", "embedding"))
    schema_json = sig.first()["input_schema"]
    ok = models.check_signature(e, schema_json)
    return sig.withColumn("input_matches", F.lit(ok))
