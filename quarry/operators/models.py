"""Model fitting, prediction, persistence and a run / model registry.

Fitting uses ``pyspark.ml`` (distributed training); everything around it —
metrics, run tables, version numbers — is DataFrame algebra.
"""

from __future__ import annotations

import json
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import ElementwiseProduct, StandardScaler, VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark import inheritable_thread_target
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import forest, ml

MAX_TREE_DEPTH = 30   # Spark's limit; sklearn's max_depth=None (unlimited) maps here


def with_features(df: DataFrame, vec: str | None = None, cols: Sequence[str] = ()) -> DataFrame:
    """A ``features`` vector column from an array column or numeric columns."""
    if vec is not None:
        return df.withColumn("features", array_to_vector(F.transform(vec, lambda x: x.cast("double"))))
    return VectorAssembler(inputCols=list(cols), outputCol="features").transform(df)


def random_forest(n_estimators: int = 100, max_depth: int | None = None, seed: int = 42,
                  label: str = "label") -> RandomForestClassifier:
    if max_depth is not None and max_depth > MAX_TREE_DEPTH:
        raise ValueError(f"Spark's trees are at most {MAX_TREE_DEPTH} deep; max_depth={max_depth}")
    depth = MAX_TREE_DEPTH if max_depth is None else max_depth
    return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=n_estimators,
                                  maxDepth=depth, seed=seed)


def logistic(C: float, n_train: int, max_iter: int = 100, label: str = "label") -> LogisticRegression:
    """sklearn's ``C`` (inverse strength on Σloss) → Spark's ``regParam = 1/(C·n)``
    on the mean loss; no feature standardisation inside the solver."""
    return LogisticRegression(labelCol=label, featuresCol="features", maxIter=max_iter,
                              regParam=1.0 / (C * max(n_train, 1)), elasticNetParam=0.0,
                              standardization=False)


def fit(train: DataFrame, estimator, scale: bool = False, label: str = "label") -> PipelineModel:
    """Fit ``[scaler?] → estimator`` as one pipeline (the scaler is a stage of
    the saved model, so prediction always sees scaled features).  A forest
    whose trees the driver could not hold is grown and kept by the executors
    (``forest``)."""
    stages = []
    if scale:
        # Spark scales by the sample deviation; the factor makes it the population's
        n, width = train.count(), len(train.select("features").first()[0])
        factor = Vectors.dense([(n / (n - 1)) ** 0.5 if n > 1 else 1.0] * width)
        stages.append(StandardScaler(inputCol="features", outputCol="_sample_scaled", withMean=True, withStd=True))
        stages.append(ElementwiseProduct(scalingVec=factor, inputCol="_sample_scaled", outputCol="scaled"))
        estimator = estimator.copy().setFeaturesCol("scaled")
    if forest.too_deep(estimator, train):
        estimator = forest.DeepForestClassifier(estimator)
    stages.append(estimator)
    data = train.withColumn(label, F.col(label).cast("double"))
    return Pipeline(stages=stages).fit(data)


def predict_batch(model: PipelineModel, df: DataFrame, class_names: Sequence[str]) -> DataFrame:
    """Class, class name and a name → probability map per row."""
    out = model.transform(df)
    names = F.array(*[F.lit(n) for n in class_names])
    probs = vector_to_array("probability")
    return out.select(
        "*",
        F.col("prediction").cast("int").alias("predicted_class"),
        F.element_at(names, F.col("prediction").cast("int") + 1).alias("predicted_name"),
        F.map_from_arrays(F.slice(names, 1, F.size(probs)), probs).alias("probabilities"),
    )


def evaluate(model: PipelineModel, df: DataFrame, label: str = "label") -> DataFrame:
    """accuracy / weighted precision, recall, f1 of a fitted model on ``df``."""
    p = model.transform(df.withColumn(label, F.col(label).cast("double")))
    return ml.weighted_prf(p.withColumn("pred", F.col("prediction").cast("int"))
                           .withColumn("y", F.col(label).cast("int")), "y", "pred")


def feature_importance(model: PipelineModel, feature_names: Sequence[str]) -> DataFrame:
    """Features by importance, descending (tree models)."""
    spark = SparkSession.getActiveSession()
    imp = model.stages[-1].featureImportances.toArray()  # one value per feature
    rows = [(n, float(v)) for n, v in zip(feature_names, imp)]
    return (spark.createDataFrame(rows, "feature string, importance double")
            .orderBy(F.desc("importance"), F.asc("feature")))


def sweep(train: DataFrame, test: DataFrame, settings: Sequence[dict], label: str = "label", parallel: int = 4) -> DataFrame:
    """Fit each setting (``{"model": "rf"|"lr", ...params}``) and collect one
    metric row per run, in run order.  Each fit is a distributed job;
    ``parallel`` of them run at a time, so ``train`` and ``test`` should be
    cut tables."""
    spark = train.sparkSession
    n = train.count()

    def run(order: int, s: dict) -> tuple:
        params = {k: v for k, v in s.items() if k != "model"}
        if s["model"] == "rf":
            name, mtype = f"RF_estimators_{params.get('n_estimators')}_depth_{params.get('max_depth')}", "RandomForestClassifier"
        else:
            name, mtype = f"LR_C_{params.get('C')}", "LogisticRegression"
        head = (order, name, mtype, json.dumps(params, sort_keys=True))
        try:
            if s["model"] == "rf":
                est = random_forest(params.get("n_estimators", 100), params.get("max_depth"), params.get("random_state", 42), label)
            else:
                est = logistic(params.get("C", 1.0), n, params.get("max_iter", 100), label)
            model = fit(train, est, scale=True, label=label)
            tr, te = evaluate(model, train, label).first(), evaluate(model, test, label).first()
        except (ValueError, PySparkException) as exc:  # a setting that can't be fitted is a row, not a silent skip
            return (*head, f"FAILED: {type(exc).__name__}", None, None, None, None, None)
        return (*head, "FINISHED", tr["accuracy"], te["accuracy"], te["precision"], te["recall"], te["f1"])

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        rows = list(pool.map(inheritable_thread_target(spark)(run), range(len(settings)), settings))
    return spark.createDataFrame(rows, "run_order int, run_name string, model_type string, params string, status string, "
                                       "train_accuracy double, test_accuracy double, test_precision double, "
                                       "test_recall double, test_f1_score double")


# ------------------------------------------------------------------ persistence

def save_model(model: PipelineModel, path: str, example: DataFrame | None = None) -> str:
    """Save the pipeline; with ``example``, also its input schema and a 3-row
    input example (the model signature) beside it."""
    model.write().overwrite().save(path)
    if example is not None:
        model_signature(example).write.mode("overwrite").json(path.rstrip("/") + "/signature")
    return path


def load_model(path: str) -> PipelineModel | None:
    """Load a saved pipeline; an absent model gives ``None`` (not an exception).
    A damaged one, or a folder that may not be read, raises."""
    spark = SparkSession.getActiveSession()
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(at):
        return None
    return PipelineModel.load(path)


def model_signature(example: DataFrame, n: int = 3) -> DataFrame:
    """One row: the input schema as JSON and the first ``n`` rows as JSON."""
    schema_json = example.schema.json()
    head = example.limit(n).agg(F.to_json(F.collect_list(F.struct(*example.columns))).alias("input_example"))
    return head.select(F.lit(schema_json).alias("input_schema"), "input_example")


def check_signature(df: DataFrame, signature_schema_json: str) -> bool:
    """The frame carries every field of the recorded input schema, same types."""
    from pyspark.sql.types import StructType
    want = StructType.fromJson(json.loads(signature_schema_json))
    have = {f.name: f.dataType for f in df.schema.fields}
    return all(have.get(f.name) == f.dataType for f in want.fields)


# ------------------------------------------------------------------ registry

def register_versions(registry: DataFrame, new: DataFrame) -> DataFrame:
    """Append registrations ``(name, uri, run_order)`` with the next version
    numbers per name: ``coalesce(max(version), 0) + rank``."""
    from pyspark.sql import Window
    base = registry.groupBy("name").agg(F.max("version").alias("_v0"))
    w = Window.partitionBy("name").orderBy("run_order", "uri")  # within one registration batch
    numbered = (new.join(base, "name", "left")
                .withColumn("version", (F.coalesce("_v0", F.lit(0)) + F.row_number().over(w)).cast("long"))
                .drop("_v0"))
    return registry.unionByName(numbered.select(*registry.columns))


def latest_versions(registry: DataFrame) -> DataFrame:
    """Latest version and its uri per registered name."""
    return registry.groupBy("name").agg(F.max("version").alias("version"),
                                        F.max_by("uri", "version").alias("uri"))
