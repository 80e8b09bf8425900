"""Run log, run comparison, nested runs, model registry.

The run log is derived from ``events``: each user is a run, each event type a
metric key (value = mean of the user's values), the first event type of a
user is its ``model_type`` parameter.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.operators import ml
from quarry.plans.registry import query
from quarry.plans.sqlviews import register_view, with_views
from quarry.session import scratch_path
from quarry.sources.tables import table

register_view("run_metrics", """
SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_id, user_id AS run_order, event_type AS key,
       CAST((CAST(sum(CAST(round(value * 100) AS BIGINT)) AS HUGEINT) * 2000000 + CAST(count(*) AS HUGEINT) * 100)
            // (2 * CAST(count(*) AS HUGEINT) * 100) AS BIGINT) / 1000000.0 AS value
FROM events GROUP BY user_id, event_type""", [])
register_view("run_params", """
SELECT 'run_' || CAST(user_id AS VARCHAR) AS run_id, arg_min(event_type, (ts, event_id)) AS model_type
FROM events GROUP BY user_id""", [])
register_view("runs", """
SELECT m.run_id, 'user ' || CAST(min(m.run_order) AS VARCHAR) AS run_name, min(m.run_order) AS run_order,
       coalesce(min(p.model_type), 'Unknown') AS model_type,
       round(coalesce(max(m.value) FILTER (WHERE m.key = 'purchase'), 0.0), 6) AS test_accuracy,
       round(coalesce(max(m.value) FILTER (WHERE m.key = 'click'), 0.0), 6) AS test_f1_score,
       'FINISHED' AS status
FROM run_metrics m LEFT JOIN run_params p ON m.run_id = p.run_id GROUP BY m.run_id""", ["run_metrics", "run_params"])


def run_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Long metric table ``(run_id, run_order, key, value)``; the value is the
    mean of the run's values, fixed to 6 decimals with exact integer
    arithmetic (the values have two decimals), so ties cannot flip."""
    e = table(spark, sf, "events", "user_id", "event_type", "value")
    return (e.groupBy("user_id", "event_type")
            .agg(F.sum(F.round(F.col("value") * 100).cast("long")).alias("_cents"), F.count(F.lit(1)).alias("_n"))
            .withColumn("value", ml.fixed_point_ratio("_cents", "_n * 100"))
            .select(F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"),
                    F.col("user_id").alias("run_order"), F.col("event_type").alias("key"), "value"))


def run_params(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "user_id", "event_type", "ts", "event_id")
    return (e.groupBy("user_id").agg(F.min_by("event_type", F.struct("ts", "event_id")).alias("model_type"))
            .select(F.concat(F.lit("run_"), F.col("user_id").cast("string")).alias("run_id"), "model_type"))


def compare_runs(metrics: DataFrame, params: DataFrame) -> DataFrame:
    """Runs side by side, missing params 'Unknown', missing metrics 0,
    sorted by test accuracy (descending) then run id."""
    wide = (metrics.groupBy("run_id").pivot("key", ["purchase", "click"]).agg(F.max("value"))
            .join(metrics.groupBy("run_id").agg(F.min("run_order").alias("run_order")), "run_id"))
    return (wide.join(params, "run_id", "left").select(
        "run_id",
        F.concat(F.lit("user "), F.col("run_order").cast("string")).alias("run_name"),
        "run_order",
        F.coalesce("model_type", F.lit("Unknown")).alias("model_type"),
        F.round(F.coalesce("purchase", F.lit(0.0)), 6).alias("test_accuracy"),
        F.round(F.coalesce("click", F.lit(0.0)), 6).alias("test_f1_score"),
        F.lit("FINISHED").alias("status"))
        .orderBy(F.desc("test_accuracy"), F.asc("run_id")))


@query("compare_runs", with_views("SELECT * FROM runs ORDER BY test_accuracy DESC, run_id", "runs"))
def q_compare_runs(spark: SparkSession, sf: str) -> DataFrame:
    return compare_runs(run_metrics(spark, sf), run_params(spark, sf))


@query("sink_metric_log", with_views("SELECT run_id, count(*) AS n_metrics, round(sum(value), 6) AS total FROM run_metrics GROUP BY run_id", "run_metrics"))
def q_sink_metric_log(spark: SparkSession, sf: str) -> DataFrame:
    """Append metric rows to a long metric table in two batches, read it back."""
    path = scratch_path(spark, "metric-log")
    m = run_metrics(spark, sf).withColumn("step", F.lit(0))
    m.filter(F.col("key") < "m").write.mode("append").parquet(path)
    m.filter(F.col("key") >= "m").write.mode("append").parquet(path)
    back = spark.read.parquet(path)
    return back.groupBy("run_id").agg(F.count(F.lit(1)).alias("n_metrics"), F.round(F.sum("value"), 6).alias("total"))


@query("src_run_log", with_views("SELECT * FROM runs", "runs"))
def q_src_run_log(spark: SparkSession, sf: str) -> DataFrame:
    """Read a written run log back and rebuild the comparison with defaults."""
    mpath, ppath = scratch_path(spark, "runlog-metrics"), scratch_path(spark, "runlog-params")
    run_metrics(spark, sf).write.mode("overwrite").parquet(mpath)
    run_params(spark, sf).write.mode("overwrite").parquet(ppath)
    return compare_runs(spark.read.parquet(mpath), spark.read.parquet(ppath))


@query("select_best_run", with_views("""
SELECT run_id, run_order, test_accuracy FROM runs WHERE test_accuracy > 0 ORDER BY test_accuracy DESC, run_order LIMIT 1""", "runs"))
def q_select_best_run(spark: SparkSession, sf: str) -> DataFrame:
    runs = compare_runs(run_metrics(spark, sf), run_params(spark, sf))
    return ml.select_best_run(runs, "test_accuracy", "run_order").select("run_id", "run_order", "test_accuracy")


@query("nested_runs", with_views("""
SELECT 'session_' || key AS parent_run_id, arg_max(run_id, (round(value, 6), -run_order)) AS best_child_run_id,
       round(max(value), 6) AS best_value, count(*) AS n_children
FROM run_metrics GROUP BY key""", "run_metrics"))
def q_nested_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Child runs (one per user and metric key) under a parent per key; the
    parent logs its best child (first maximum in run order)."""
    m = run_metrics(spark, sf).withColumn("parent_run_id", F.concat(F.lit("session_"), "key"))
    best = F.max_by("run_id", F.struct(F.round("value", 6), -F.col("run_order")))
    return m.groupBy("parent_run_id").agg(best.alias("best_child_run_id"), F.round(F.max("value"), 6).alias("best_value"),
                                          F.count(F.lit(1)).alias("n_children"))


@query("model_version_registry", with_views("""
SELECT name, max(version) AS version, arg_max(uri, version) AS uri FROM (
  SELECT model_type AS name, 'runs:/' || run_id || '/model' AS uri,
         row_number() OVER (PARTITION BY model_type ORDER BY run_order % 2, run_order, run_id) AS version FROM runs)
GROUP BY name""", "runs"))
def q_model_registry(spark: SparkSession, sf: str) -> DataFrame:
    """Register one model per run under its model type (two registration
    batches), then resolve the latest version per name."""
    from quarry.operators import models
    runs = compare_runs(run_metrics(spark, sf), run_params(spark, sf))
    regs = runs.select(F.col("model_type").alias("name"), F.concat(F.lit("runs:/"), "run_id", F.lit("/model")).alias("uri"),
                       "run_order")
    empty = spark.createDataFrame([], "name string, uri string, run_order bigint, version bigint")
    first = models.register_versions(empty, regs.filter(F.col("run_order") % 2 == 0))
    both = models.register_versions(first, regs.filter(F.col("run_order") % 2 == 1))
    return models.latest_versions(both)
