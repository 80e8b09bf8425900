"""ML data operators and evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.functions import arrays
from quarry.functions import text as tx
from quarry.operators import ml
from quarry.operators.windows import best_so_far, per_class_sequence, rank_key_sql
from quarry.plans.registry import query
from quarry.plans.sqlviews import register_view, with_views
from quarry.sources.tables import table
from quarry.sources.text import reviews

SEED = 42
CLASS_NAMES = [f"class_{i}" for i in range(10)]


def _key_sql(id_col: str, seed: int = SEED) -> str:
    return rank_key_sql(id_col, seed)


register_view("emb", f"""
SELECT vec_id, label, embedding, {_key_sql('vec_id')} AS k FROM embeddings""", [])
register_view("emb_pred", f"""
SELECT vec_id, label, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS pred, s, embedding, k
FROM (SELECT vec_id, label, embedding, k, {arrays.class_scores_sql('embedding', 10)} AS s FROM emb)""", ["emb"])
register_view("emb_split", """
SELECT *, CASE WHEN row_number() OVER (ORDER BY k, vec_id) <= ceil(0.2 * count(*) OVER ()) THEN 'test' ELSE 'train' END AS split
FROM emb_pred""", ["emb_pred"])


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "embeddings", "vec_id", "embedding", "label")


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """Deterministic scores of ten classes from all elements → prediction: argmax."""
    e = embeddings(spark, sf)
    s = arrays.class_scores("embedding", len(CLASS_NAMES))
    return e.select("vec_id", "label", "embedding", s.alias("s"), arrays.argmax(s).alias("pred"))


# ------------------------------------------------------------------ samples / splits

@query("sample_n", with_views("SELECT vec_id, label FROM emb ORDER BY k, vec_id LIMIT 20", "emb"))
def q_sample_n(spark: SparkSession, sf: str) -> DataFrame:
    return ml.sample_n(embeddings(spark, sf), "vec_id", 20, SEED).select("vec_id", "label")


@query("split_ratio", with_views("""
SELECT vec_id, CASE WHEN row_number() OVER (ORDER BY k, vec_id) <= floor(count(*) OVER () * 0.8) THEN 'train' ELSE 'val' END AS split
FROM emb""", "emb"))
def q_split_ratio(spark: SparkSession, sf: str) -> DataFrame:
    return ml.split_ratio(embeddings(spark, sf), "vec_id", 0.8, SEED).select("vec_id", "split")


@query("split_holdout", with_views("SELECT vec_id, split FROM emb_split", "emb_split"))
def q_split_holdout(spark: SparkSession, sf: str) -> DataFrame:
    return ml.split_holdout(embeddings(spark, sf), "vec_id", 0.2, SEED).select("vec_id", "split")


register_view("strat_quota", """
SELECT label, floor(n * 0.2) + CASE WHEN row_number() OVER (ORDER BY round(n * 0.2 - floor(n * 0.2), 9) DESC, label)
             <= ceil(sum(n) OVER () * 0.2) - sum(floor(n * 0.2)) OVER () THEN 1 ELSE 0 END AS quota
FROM (SELECT label, count(*) AS n FROM emb GROUP BY label)""", ["emb"])


@query("split_stratified", with_views("""
SELECT e.vec_id, e.label, CASE WHEN row_number() OVER (PARTITION BY e.label ORDER BY e.k, e.vec_id) <= q.quota THEN 'test' ELSE 'train' END AS split
FROM emb e JOIN strat_quota q ON q.label = e.label""", "emb", "strat_quota"))
def q_split_stratified(spark: SparkSession, sf: str) -> DataFrame:
    return ml.split_holdout(embeddings(spark, sf), "vec_id", 0.2, SEED, stratify="label").select("vec_id", "label", "split")


BALANCED_LIMIT = 95


@query("balanced_subset", with_views(f"""
SELECT vec_id, label FROM (
  SELECT *, row_number() OVER (PARTITION BY picked ORDER BY k, vec_id) AS rn2,
         {BALANCED_LIMIT} - count(*) FILTER (WHERE picked) OVER () AS remaining
  FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY k, vec_id)
                    <= {BALANCED_LIMIT} // (SELECT count(DISTINCT label) FROM emb) AS picked FROM emb))
WHERE picked OR rn2 <= remaining""", "emb"))
def q_balanced_subset(spark: SparkSession, sf: str) -> DataFrame:
    return ml.balanced_subset(embeddings(spark, sf), "vec_id", "label", BALANCED_LIMIT, SEED).select("vec_id", "label")


@query("per_class_sequence", """
SELECT vec_id, label, row_number() OVER (PARTITION BY label ORDER BY vec_id) - 1 AS seq FROM embeddings""")
def q_per_class_sequence(spark: SparkSession, sf: str) -> DataFrame:
    e = embeddings(spark, sf).select("vec_id", "label")
    return per_class_sequence(e, "label", "vec_id").select("vec_id", "label", "seq")


@query("best_so_far", """
SELECT event_id, user_id, value FROM (
  SELECT *, coalesce(max(value) OVER (PARTITION BY user_id ORDER BY ts, event_id
                                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS prev FROM events)
WHERE value > greatest(prev, 0.0)""")
def q_best_so_far(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events", "event_id", "user_id", "ts", "value")
    b = best_so_far(e, ["user_id"], ["ts", "event_id"], "value")
    return b.filter("is_best").select("event_id", "user_id", "value")


# ------------------------------------------------------------------ scaling / tf-idf

register_view("emb_long", """
SELECT vec_id, split, unnest(embedding) AS x, unnest(generate_series(0, len(embedding) - 1)) AS pos FROM emb_split""", ["emb_split"])
register_view("emb_stats", """
SELECT pos, avg(x) AS m, CASE WHEN stddev_pop(x) = 0 THEN 1.0 ELSE stddev_pop(x) END AS s
FROM emb_long WHERE split = 'train' GROUP BY pos""", ["emb_long"])


@query("standardize", with_views("""
SELECT t.vec_id, t.pos, round((CAST(t.x AS DOUBLE) - st.m) / st.s, 5) AS z
FROM emb_long t JOIN emb_stats st ON t.pos = st.pos WHERE t.split = 'test'""", "emb_long", "emb_stats"))
def q_standardize(spark: SparkSession, sf: str) -> DataFrame:
    sp = ml.split_holdout(embeddings(spark, sf), "vec_id", 0.2, SEED)
    stats = ml.fit_vector_stats(sp.filter("split = 'train'"), "embedding")
    z = ml.standardize_vectors(sp.filter("split = 'test'"), "embedding", stats, "z")
    return (z.select("vec_id", F.posexplode("z").alias("pos", "z"))
            .select("vec_id", F.col("pos").cast("long").alias("pos"), F.round("z", 5).alias("z")))


_CLEAN_SQL = r"lower(regexp_replace(regexp_replace(text, '<br\s*/?>', ' ', 'g'), '[^\p{L}\p{N}_\s'']', '', 'g'))"
register_view("tf", rf"""
SELECT id, term, count(*) AS tf FROM (
  SELECT id, unnest(regexp_extract_all(lower(clean), '[\p{{L}}\p{{N}}_]{{2,}}')) AS term
  FROM (SELECT id, {_CLEAN_SQL} AS clean FROM reviews)) GROUP BY id, term""", ["reviews"])
register_view("tfidf", """
SELECT id, term, w / sqrt(sum(w * w) OVER (PARTITION BY id)) AS weight FROM (
  SELECT tf.id, tf.term, tf.tf * (ln((1 + (SELECT count(*) FROM reviews)) / (1 + v.df)) + 1) AS w
  FROM tf JOIN (SELECT term, count(*) AS df FROM tf GROUP BY term ORDER BY sum(tf) DESC, term LIMIT 5000) v ON tf.term = v.term)""",
              ["tf", "reviews"])


def review_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    r = reviews(spark, sf).select("id", tx.clean_text("text").alias("text"), "label")
    return ml.tfidf(r, "id", "text", 5000)


@query("tfidf", with_views("SELECT id, term, round(weight, 6) AS weight FROM tfidf", "tfidf"))
def q_tfidf(spark: SparkSession, sf: str) -> DataFrame:
    return review_tfidf(spark, sf).withColumn("weight", F.round("weight", 6))


# ------------------------------------------------------------------ profiles

@query("class_distribution", "SELECT label, count(*) AS n FROM embeddings GROUP BY label ORDER BY n DESC, label")
def q_class_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return (embeddings(spark, sf).groupBy("label").agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), "label"))


@query("dataset_profile", """
SELECT count(*) AS n_rows, CAST(max(len(embedding)) AS INTEGER) AS n_features, count(DISTINCT label) AS n_classes FROM embeddings""")
def q_dataset_profile(spark: SparkSession, sf: str) -> DataFrame:
    return embeddings(spark, sf).agg(F.count(F.lit(1)).alias("n_rows"), F.max(F.size("embedding")).alias("n_features"),
                                     F.count_distinct("label").alias("n_classes"))


# ------------------------------------------------------------------ evaluation

@query("accuracy", with_views("SELECT round(coalesce(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 0.0), 6) AS accuracy, count(*) AS n FROM emb_pred", "emb_pred"))
def q_accuracy(spark: SparkSession, sf: str) -> DataFrame:
    return ml.accuracy(predictions(spark, sf), "label", "pred").withColumn("accuracy", F.round("accuracy", 6))


register_view("cls", """
SELECT l AS label, coalesce(s.support, 0) AS support, coalesce(p.predicted, 0) AS predicted, coalesce(t.tp, 0) AS tp,
  CASE WHEN coalesce(p.predicted, 0) > 0 THEN coalesce(t.tp, 0) / p.predicted ELSE 0.0 END AS precision,
  CASE WHEN coalesce(s.support, 0) > 0 THEN coalesce(t.tp, 0) / s.support ELSE 0.0 END AS recall
FROM (SELECT label AS l FROM emb_pred UNION SELECT pred FROM emb_pred) ls
LEFT JOIN (SELECT label, count(*) AS support FROM emb_pred GROUP BY label) s ON s.label = ls.l
LEFT JOIN (SELECT pred, count(*) AS predicted FROM emb_pred GROUP BY pred) p ON p.pred = ls.l
LEFT JOIN (SELECT label, count(*) AS tp FROM emb_pred WHERE label = pred GROUP BY label) t ON t.label = ls.l""", ["emb_pred"])
register_view("cls_f1", """
SELECT *, CASE WHEN precision + recall > 0 THEN 2 * precision * recall / (precision + recall) ELSE 0.0 END AS f1 FROM cls""", ["cls"])


@query("weighted_prf", with_views("""
SELECT round(sum(precision * support) / sum(support), 6) AS precision, round(sum(recall * support) / sum(support), 6) AS recall,
       round(sum(f1 * support) / sum(support), 6) AS f1,
       (SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) FROM emb_pred) AS accuracy
FROM cls_f1""", "cls_f1", "emb_pred"))
def q_weighted_prf(spark: SparkSession, sf: str) -> DataFrame:
    out = ml.weighted_prf(predictions(spark, sf), "label", "pred")
    return out.select(*[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1", "accuracy"]])


_REPORT_SQL = """
SELECT CAST(label AS VARCHAR) AS "row", round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM cls_f1
UNION ALL SELECT 'accuracy', NULL, NULL, (SELECT round(avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END), 6) FROM emb_pred), (SELECT count(*) FROM emb_pred)
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), sum(support)::BIGINT FROM cls_f1
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / sum(support), 6), round(sum(recall * support) / sum(support), 6),
                 round(sum(f1 * support) / sum(support), 6), sum(support)::BIGINT FROM cls_f1"""


def _report(spark: SparkSession, sf: str) -> DataFrame:
    r = ml.classification_report(predictions(spark, sf), "label", "pred")
    return r.select("row", *[F.round(c, 6).alias(c) for c in ["precision", "recall", "f1"]], "support")


@query("classification_report", with_views(_REPORT_SQL, "cls_f1", "emb_pred"))
def q_classification_report(spark: SparkSession, sf: str) -> DataFrame:
    return _report(spark, sf)


@query("report_to_metrics", with_views("""
SELECT 'class_' || CAST(label AS VARCHAR) || '_precision' AS key, round(precision, 6) AS value FROM cls_f1
UNION ALL SELECT 'class_' || CAST(label AS VARCHAR) || '_recall', round(recall, 6) FROM cls_f1
UNION ALL SELECT 'class_' || CAST(label AS VARCHAR) || '_f1', round(f1, 6) FROM cls_f1""", "cls_f1"))
def q_report_to_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return ml.report_to_metrics(_report(spark, sf))


@query("confusion_matrix", with_views("""
SELECT a.l AS y, b.l AS p, count(e.vec_id) AS n
FROM (SELECT label AS l FROM emb_pred UNION SELECT pred FROM emb_pred) a
CROSS JOIN (SELECT label AS l FROM emb_pred UNION SELECT pred FROM emb_pred) b
LEFT JOIN emb_pred e ON e.label = a.l AND e.pred = b.l GROUP BY a.l, b.l""", "emb_pred"))
def q_confusion_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return ml.confusion_matrix(predictions(spark, sf), "label", "pred")


@query("align_pred_truth", with_views("""
SELECT vec_id, pred, label, pred = label AS correct FROM emb_pred""", "emb_pred"))
def q_align(spark: SparkSession, sf: str) -> DataFrame:
    p = predictions(spark, sf).select("vec_id", "pred")
    truth = embeddings(spark, sf).select("vec_id", "label")
    return p.join(truth, "vec_id").select("vec_id", "pred", "label", (F.col("pred") == F.col("label")).alias("correct"))


N_FEATURES = 64


@query("rename_predict_output", with_views(f"""
SELECT vec_id, {", ".join(f"CAST(embedding[{i + 1}] AS DOUBLE) AS f{i}" for i in range(N_FEATURES))},
       pred AS predicted_class, 'class_' || CAST(pred AS VARCHAR) AS predicted_name
FROM emb_pred""", "emb_pred"))
def q_rename_predict_output(spark: SparkSession, sf: str) -> DataFrame:
    p = predictions(spark, sf)
    names = F.array(*[F.lit(n) for n in CLASS_NAMES])
    return p.select("vec_id", *[F.col("embedding")[i].cast("double").alias(f"f{i}") for i in range(N_FEATURES)],
                    F.col("pred").alias("predicted_class"), F.element_at(names, F.col("pred") + 1).alias("predicted_name"))


@query("score_vector", with_views("""
SELECT vec_id, pred, round(1.0 / list_sum(list_transform(s, lambda x: exp(x - list_max(s)))), 6) AS confidence FROM emb_pred""", "emb_pred"))
def q_score_vector(spark: SparkSession, sf: str) -> DataFrame:
    p = predictions(spark, sf)
    probs = arrays.softmax("s")
    return p.select("vec_id", arrays.argmax(probs).alias("pred"), F.round(F.array_max(probs), 6).alias("confidence"))


@query("sample_predictions", with_views("""
SELECT vec_id, 'class_' || CAST(pred AS VARCHAR) AS predicted, 'class_' || CAST(label AS VARCHAR) AS actual
FROM emb_pred ORDER BY k, vec_id LIMIT 20""", "emb_pred"))
def q_sample_predictions(spark: SparkSession, sf: str) -> DataFrame:
    names = F.array(*[F.lit(n) for n in CLASS_NAMES])
    s = ml.sample_n(predictions(spark, sf), "vec_id", 20, SEED)
    return s.select("vec_id", F.element_at(names, F.col("pred") + 1).alias("predicted"),
                    F.element_at(names, F.col("label") + 1).alias("actual"))


@query("threshold_alert", with_views("""
SELECT label, round(acc, 6) AS accuracy, 'Low accuracy detected' AS title, 'WARN' AS level FROM (
  SELECT label, avg(CASE WHEN label = pred THEN 1.0 ELSE 0.0 END) AS acc FROM emb_pred GROUP BY label) WHERE acc < 0.85""", "emb_pred"))
def q_threshold_alert(spark: SparkSession, sf: str) -> DataFrame:
    p = predictions(spark, sf)
    per = p.groupBy("label").agg(F.avg((F.col("label") == F.col("pred")).cast("double")).alias("accuracy"))
    a = ml.threshold_alert(per, "accuracy", 0.85)
    return a.select("label", F.round("accuracy", 6).alias("accuracy"), "title", "level")


@query("train_test_gap", with_views("""
SELECT round(avg(CASE WHEN split = 'train' THEN CASE WHEN label = pred THEN 1.0 ELSE 0.0 END END), 6) AS train_accuracy,
       round(avg(CASE WHEN split = 'test' THEN CASE WHEN label = pred THEN 1.0 ELSE 0.0 END END), 6) AS test_accuracy
FROM emb_split""", "emb_split"))
def q_train_test_gap(spark: SparkSession, sf: str) -> DataFrame:
    sp = ml.split_holdout(predictions(spark, sf), "vec_id", 0.2, SEED)
    per = sp.groupBy().pivot("split", ["train", "test"]).agg(F.avg((F.col("label") == F.col("pred")).cast("double")))
    return per.select(F.round("train", 6).alias("train_accuracy"), F.round("test", 6).alias("test_accuracy"))


# ------------------------------------------------------------------ batch / epoch metrics

register_view("batches", """
SELECT event_type AS run_id, CAST(ts AS DATE) AS epoch, hour(ts) AS batch,
       CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS loss_units, count(*) AS n,
       count(*) FILTER (WHERE value > 25) AS correct
FROM events GROUP BY event_type, CAST(ts AS DATE), hour(ts)""", [])


def batches(spark: SparkSession, sf: str) -> DataFrame:
    """Batch metric rows derived from events: one batch per (type, day, hour);
    the per-sample loss is the event value, kept as an integer total in
    hundredths (``loss_units``) so epoch metrics are exact; ``loss`` is the
    batch mean."""
    e = table(spark, sf, "events", "event_type", "ts", "value")
    return (e.groupBy(F.col("event_type").alias("run_id"), F.to_date("ts").alias("epoch"), F.hour("ts").alias("batch")).agg(
        F.sum(F.round(F.col("value") * 100).cast("long")).alias("loss_units"), F.count(F.lit(1)).alias("n"),
        F.count(F.when(F.col("value") > 25, 1)).alias("correct"))
        .withColumn("loss", F.col("loss_units") / (F.col("n") * F.lit(100.0))))


def _fx(numer: str, denom: str) -> str:
    """SQL twin of ``ml.fixed_point_ratio`` (6 places)."""
    n, d = f"CAST(({numer}) AS HUGEINT)", f"CAST(({denom}) AS HUGEINT)"   # // on HUGEINT is integer division
    return f"(CAST(({n} * 2000000 + {d}) // (2 * {d}) AS BIGINT) / 1000000.0)"


@query("epoch_loss_weighted", with_views(f"""
SELECT run_id, epoch, {_fx('sum(loss_units)', 'sum(n) * 100')} AS loss, {_fx('sum(correct)', 'sum(n)')} AS accuracy
FROM batches GROUP BY run_id, epoch""", "batches"))
def q_epoch_weighted(spark: SparkSession, sf: str) -> DataFrame:
    return ml.epoch_loss_weighted_fixed(batches(spark, sf), ["run_id", "epoch"])


@query("epoch_loss_batch_mean", with_views(f"""
SELECT run_id, epoch,
       CAST((2 * CAST(sum(micro) AS HUGEINT) + count(*)) // (2 * CAST(count(*) AS HUGEINT)) AS BIGINT) / 1000000.0 AS loss,
       {_fx('sum(correct) * 100', 'sum(n)')} AS accuracy_pct
FROM (SELECT *, CAST((CAST(loss_units AS HUGEINT) * 2000000 + CAST(n AS HUGEINT) * 100)
                     // (2 * CAST(n AS HUGEINT) * 100) AS BIGINT) AS micro FROM batches)
GROUP BY run_id, epoch""", "batches"))
def q_epoch_mean(spark: SparkSession, sf: str) -> DataFrame:
    return ml.epoch_loss_batch_mean_fixed(batches(spark, sf), ["run_id", "epoch"])
