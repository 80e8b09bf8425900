"""ML data operators: splits, samples, scaling, TF-IDF, metrics, models, drift.

Everything except model fitting is DataFrame algebra.  Randomness is a
function of the row id and a seed (``rank_key``), never of partitioning, so
every split and sample is reproducible and exact in size.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.operators.windows import rank_key, smallest
from quarry.sources.tables import join_small, with_scalars


# ------------------------------------------------------------------ splits / samples

def _keyed(df: DataFrame, id_col: str, seed: int) -> DataFrame:
    return df.withColumn("_key", rank_key(id_col, seed))


def sample_n(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly ``min(n, count)`` rows without replacement, seeded: a top-k of
    the order key (no full sort)."""
    return _keyed(df, id_col, seed).orderBy("_key", id_col).limit(n).drop("_key")


def split_holdout(df: DataFrame, id_col: str, test_size: float = 0.2, seed: int = 42,
                  stratify: str | None = None) -> DataFrame:
    """Adds ``split`` ∈ {train, test}: ``ceil(test_size·n)`` test rows in all.

    With ``stratify`` they are allotted to the classes in proportion, by
    largest remainder (ties by class): every class gets the floor of its
    share, and what is left goes to the largest fractions.  Rows of a null
    class are a class of their own.
    """
    keyed = _keyed(df, id_col, seed)
    if stratify is None:
        taken = smallest(keyed, [], "_key", [id_col], None, F.ceil(F.col("_n") * F.lit(test_size)))
    else:
        per = df.groupBy(stratify).agg(F.count(F.lit(1)).alias("_class_n"))  # one row per class
        total = per.agg(F.sum("_class_n").alias("_all"), F.sum(F.floor(F.col("_class_n") * F.lit(test_size))).alias("_floors"))
        rest = F.col("_class_n") * F.lit(test_size) - F.floor(F.col("_class_n") * F.lit(test_size))
        nth = F.row_number().over(Window.orderBy(F.round(rest, 9).desc(), F.col(stratify).asc_nulls_first()))
        sizes = with_scalars(per, total).withColumn("_nth", nth).select(
            stratify, (F.floor(F.col("_class_n") * F.lit(test_size))
                       + (F.col("_nth") <= F.ceil(F.col("_all") * F.lit(test_size)) - F.col("_floors")).cast("long")).alias("_n_test"))
        taken = smallest(keyed, [stratify], "_key", [id_col], sizes, F.col("_n_test"))
    return taken.withColumn("split", F.when(F.col("taken"), "test").otherwise("train")).drop("_key", "taken")


def split_ratio(df: DataFrame, id_col: str, first: float = 0.8, seed: int = 42,
                names: tuple[str, str] = ("train", "val")) -> DataFrame:
    """``random_split(ds, [int(first·n), n − int(first·n)])`` with exact sizes."""
    taken = smallest(_keyed(df, id_col, seed), [], "_key", [id_col], None, F.floor(F.col("_n") * F.lit(first)))
    return taken.withColumn("split", F.when(F.col("taken"), names[0]).otherwise(names[1])).drop("_key", "taken")


def balanced_subset(df: DataFrame, id_col: str, label: str, limit: int, seed: int = 42) -> DataFrame:
    """``limit // k`` random rows per class, the remainder filled at random
    from the leftovers; ``limit == -1`` or ``limit ≥ n`` keeps all rows.  A
    null label is a class of its own."""
    if limit == -1:
        return df
    classes = df.groupBy(label).agg(F.count(F.lit(1)).alias("_class_n"))
    stats = classes.agg(F.sum("_class_n").alias("_all"), F.count(F.lit(1)).alias("_k"))
    sizes = with_scalars(classes, stats).select(
        label, F.when(F.lit(limit) >= F.col("_all"), F.col("_class_n")).otherwise(F.floor(F.lit(limit) / F.col("_k"))).alias("_quota"))
    first = smallest(_keyed(df, id_col, seed), [label], "_key", [id_col], sizes, F.col("_quota"))
    got = sizes.join(classes.withColumnRenamed(label, "_label"), F.col(label).eqNullSafe(F.col("_label"))).agg(
        F.sum(F.least("_quota", "_class_n")).alias("_got"))
    more = smallest(first.filter("NOT taken").drop("taken"), [], "_key", [id_col], got, F.lit(limit) - F.col("_got"))
    return first.filter("taken").drop("taken", "_key").unionByName(more.filter("taken").drop("taken", "_key"))


# ------------------------------------------------------------------ scaling

def standardize_columns(train: DataFrame, test: DataFrame, cols: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Fit mean and **population** std on train; transform both (zero std → 1)."""
    stats = train.agg(*[F.avg(c).alias(f"_m_{c}") for c in cols],
                      *[F.stddev_pop(c).alias(f"_s_{c}") for c in cols])

    def apply(df: DataFrame) -> DataFrame:
        j = with_scalars(df, stats)
        for c in cols:
            s = F.when(F.col(f"_s_{c}") == 0, F.lit(1.0)).otherwise(F.col(f"_s_{c}"))
            j = j.withColumn(c, (F.col(c) - F.col(f"_m_{c}")) / s)
        return j.drop(*[f"_m_{c}" for c in cols], *[f"_s_{c}" for c in cols])

    return apply(train), apply(test)


def fit_vector_stats(train: DataFrame, vec: str) -> DataFrame:
    """One row ``(mean array, population-std array)`` of an array column;
    the width of the arrays is the vector dimension, not the data size."""
    per_pos = (train.select(F.posexplode(vec).alias("pos", "x"))
               .groupBy("pos").agg(F.avg("x").alias("m"), F.stddev_pop("x").alias("s")))
    return per_pos.agg(F.array_sort(F.collect_list(F.struct("pos", "m", "s"))).alias("_st")).select(
        F.transform("_st", lambda e: e["m"]).alias("_mean"),
        F.transform("_st", lambda e: F.when(e["s"] == 0, F.lit(1.0)).otherwise(e["s"])).alias("_std"))


def standardize_vectors(df: DataFrame, vec: str, stats: DataFrame, out: str | None = None) -> DataFrame:
    j = with_scalars(df, stats)
    z = F.zip_with(F.zip_with(vec, "_mean", lambda x, m: x.cast("double") - m), "_std", lambda d, s: d / s)
    return j.withColumn(out or vec, z).drop("_mean", "_std")


# ------------------------------------------------------------------ TF-IDF

TOKEN_PATTERN = r"[\p{L}\p{N}_]{2,}"   # (?u)\b\w\w+\b on Unicode word characters


def term_counts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``(id, term, tf)`` after lower-casing and word-token extraction, dealt by
    id: the texts are moved once, which is less than their terms, and neither
    these counts nor sums over a document need a further shuffle."""
    toks = F.regexp_extract_all(F.lower(F.col(text_col)), F.lit(TOKEN_PATTERN), 0)
    return (docs.select(id_col, text_col).repartition(id_col).select(id_col, F.explode(toks).alias("term"))
            .groupBy(id_col, "term").agg(F.count(F.lit(1)).alias("tf")))


def tfidf_fit(docs: DataFrame, id_col: str = "id", text_col: str = "text", max_features: int = 5000) -> DataFrame:
    """Fit a TF-IDF vocabulary on ``docs``: ``(term, idf)`` for the
    ``max_features`` terms of largest total count (ties by term), with
    idf = ln((1+n)/(1+df)) + 1.  At most ``max_features`` rows, so applying
    it is a broadcast bounded by construction."""
    tc = term_counts(docs, id_col, text_col)
    vocab = (tc.groupBy("term").agg(F.sum("tf").alias("_total"), F.count(F.lit(1)).alias("_df"))
             .orderBy(F.desc("_total"), F.asc("term")).limit(max_features))
    n_docs = docs.agg(F.count(F.lit(1)).alias("_n"))
    return (with_scalars(vocab, n_docs)
            .select("term", (F.log((1 + F.col("_n")) / (1 + F.col("_df"))) + 1).alias("idf")))


def tfidf_transform(docs: DataFrame, model: DataFrame, id_col: str = "id", text_col: str = "text") -> DataFrame:
    """Long TF-IDF ``(id, term, weight)`` of ``docs`` under a fitted
    vocabulary; weights are L2-normalised per document."""
    tc = term_counts(docs, id_col, text_col)
    w = tc.join(F.broadcast(model), "term").withColumn("_w", F.col("tf") * F.col("idf"))  # ≤ max_features rows
    norm = Window.partitionBy(id_col)
    return (w.withColumn("weight", F.col("_w") / F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(norm)))
            .select(id_col, "term", "weight"))


def tfidf(docs: DataFrame, id_col: str = "id", text_col: str = "text", max_features: int = 5000) -> DataFrame:
    """Fit on ``docs`` and transform the same documents."""
    return tfidf_transform(docs, tfidf_fit(docs, id_col, text_col, max_features), id_col, text_col)


def tfidf_vectors(docs: DataFrame, model: DataFrame, text_col: str = "text", out: str = "features") -> DataFrame:
    """``docs`` with L2-normalised TF-IDF vectors of a fitted vocabulary (at
    most ``max_features`` rows, which the driver reads), terms in alphabetical
    order; a document without a known term gets the zero vector."""
    from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, Normalizer
    from pyspark.ml.linalg import Vectors
    terms = sorted((r["term"], r["idf"]) for r in model.collect())
    if not terms:
        raise ValueError("the vocabulary is empty")
    counter = CountVectorizerModel.from_vocabulary([t for t, _ in terms], inputCol="_tokens", outputCol="_counts")
    weigh = ElementwiseProduct(scalingVec=Vectors.dense([w for _, w in terms]), inputCol="_counts", outputCol="_weighted")
    tokens = docs.withColumn("_tokens", F.regexp_extract_all(F.lower(F.coalesce(F.col(text_col), F.lit(""))), F.lit(TOKEN_PATTERN), 0))
    made = Normalizer(p=2.0, inputCol="_weighted", outputCol=out).transform(weigh.transform(counter.transform(tokens)))
    return made.drop("_tokens", "_counts", "_weighted")


# ------------------------------------------------------------------ metrics

def confusion_counts(pred: DataFrame, y: str, p: str) -> DataFrame:
    """``(y, p, n)`` for every observed pair (partial aggregation)."""
    return pred.groupBy(F.col(y).alias("y"), F.col(p).alias("p")).agg(F.count(F.lit(1)).alias("n"))


def confusion_matrix(pred: DataFrame, y: str, p: str) -> DataFrame:
    """Truth × prediction counts including zero cells over the observed labels."""
    cc = confusion_counts(pred, y, p)
    # the observed label set as one array (its size is the number of classes)
    labels = cc.agg(F.array_sort(F.array_distinct(F.concat(F.collect_set("y"), F.collect_set("p")))).alias("_l"))
    grid = (labels.select(F.explode("_l").alias("y"), "_l")
            .select("y", F.explode("_l").alias("p")))  # classes² cells: the matrix itself
    return grid.join(cc, ["y", "p"], "left").select("y", "p", F.coalesce("n", F.lit(0)).alias("n"))


def per_class_metrics(pred: DataFrame, y: str, p: str) -> DataFrame:
    """precision, recall, f1, support per class (0 on zero division)."""
    cc = confusion_counts(pred, y, p)
    tp = cc.filter(F.col("y") == F.col("p")).select(F.col("y").alias("label"), F.col("n").alias("tp"))
    true_n = cc.groupBy(F.col("y").alias("label")).agg(F.sum("n").alias("support"))
    pred_n = cc.groupBy(F.col("p").alias("label")).agg(F.sum("n").alias("predicted"))
    m = (true_n.join(pred_n, "label", "full").join(tp, "label", "left")
         .select("label", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ["support", "predicted", "tp"]]))
    prec = F.when(F.col("predicted") > 0, F.col("tp") / F.col("predicted")).otherwise(0.0)
    rec = F.when(F.col("support") > 0, F.col("tp") / F.col("support")).otherwise(0.0)
    m = m.withColumn("precision", prec).withColumn("recall", rec)
    f1 = F.when(F.col("precision") + F.col("recall") > 0,
                2 * F.col("precision") * F.col("recall") / (F.col("precision") + F.col("recall"))).otherwise(0.0)
    return m.withColumn("f1", f1)


def accuracy(pred: DataFrame, y: str, p: str) -> DataFrame:
    """Share of equal predictions; 0.0 on an empty input."""
    return pred.agg(F.coalesce(F.avg((F.col(y) == F.col(p)).cast("double")), F.lit(0.0)).alias("accuracy"),
                    F.count(F.lit(1)).alias("n"))


def weighted_prf(pred: DataFrame, y: str, p: str) -> DataFrame:
    """Support-weighted precision, recall and F1, plus accuracy."""
    m = per_class_metrics(pred, y, p)
    s = F.sum("support")
    out = m.agg(*[F.coalesce(F.sum(F.col(c) * F.col("support")) / F.when(s > 0, s), F.lit(0.0)).alias(c)
                  for c in ["precision", "recall", "f1"]])
    return with_scalars(out, accuracy(pred, y, p).select("accuracy"))


def classification_report(pred: DataFrame, y: str, p: str) -> DataFrame:
    """Per-class rows plus ``accuracy``, ``macro avg`` and ``weighted avg`` rows."""
    m = per_class_metrics(pred, y, p)
    per = m.select(F.col("label").cast("string").alias("row"), "precision", "recall", "f1",
                   F.col("support").cast("long").alias("support"))
    tot = F.sum("support")
    macro = m.agg(F.lit("macro avg").alias("row"), F.avg("precision").alias("precision"),
                  F.avg("recall").alias("recall"), F.avg("f1").alias("f1"), tot.cast("long").alias("support"))
    weighted = m.agg(F.lit("weighted avg").alias("row"),
                     *[(F.sum(F.col(c) * F.col("support")) / tot).alias(c) for c in ["precision", "recall", "f1"]],
                     tot.cast("long").alias("support"))
    acc = accuracy(pred, y, p).select(F.lit("accuracy").alias("row"), F.lit(None).cast("double").alias("precision"),
                                      F.lit(None).cast("double").alias("recall"), F.col("accuracy").alias("f1"),
                                      F.col("n").alias("support"))
    return per.unionByName(acc).unionByName(macro).unionByName(weighted)


def report_to_metrics(report: DataFrame) -> DataFrame:
    """Per-class rows of a report (not the averages) as ``(key, value)`` with
    keys ``class_<k>_precision / _recall / _f1``."""
    per = report.filter(F.col("row").rlike("^[0-9]+$"))
    return per.select(F.explode(F.array(*[
        F.struct(F.concat(F.lit("class_"), "row", F.lit(f"_{suffix}")).alias("key"), F.col(col).alias("value"))
        for col, suffix in [("precision", "precision"), ("recall", "recall"), ("f1", "f1")]])).alias("m")).select("m.*")


def threshold_alert(metrics: DataFrame, metric: str, threshold: float, title: str = "Low accuracy detected") -> DataFrame:
    """Alert rows where the metric is below the threshold."""
    return (metrics.filter(F.col(metric) < F.lit(threshold))
            .withColumn("title", F.lit(title))
            .withColumn("text", F.format_string(f"Accuracy %.3f below threshold {threshold}", F.col(metric)))
            .withColumn("level", F.lit("WARN")))


def select_best_run(runs: DataFrame, metric: str, order: str, start: float = 0.0) -> DataFrame:
    """The first run (in ``order``) with the largest metric, if it beats ``start``:
    a strict ``>`` scan keeps the earliest of tied maxima."""
    return runs.filter(F.col(metric) > F.lit(start)).orderBy(F.desc(metric), F.asc(order)).limit(1)


# ------------------------------------------------------------------ epoch metrics

def epoch_loss_weighted(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Sample-weighted epoch loss Σ(loss·n)/Σn and accuracy Σcorrect/Σn."""
    return batches.groupBy(*keys).agg(
        (F.sum(F.col("loss") * F.col("n")) / F.sum("n")).alias("loss"),
        (F.sum("correct") / F.sum("n")).alias("accuracy"))


def fixed_point_ratio(numer: str, denom: str, places: int = 6) -> Column:
    """``numer / denom`` rounded half-up to ``places`` decimals with integer
    division (``numer`` ≥ 0, ``denom`` > 0 are SQL expressions of integers).
    Exact, so every engine gives the same double; plain double means round
    differently near ties depending on summation order."""
    s = 10 ** places
    n, d = f"CAST(({numer}) AS DECIMAL(38,0))", f"CAST(({denom}) AS DECIMAL(38,0))"
    return F.expr(f"({n} * {2 * s} + {d}) div (2 * {d})") / F.lit(float(s))


def epoch_loss_weighted_fixed(batches: DataFrame, keys: Sequence[str], unit: int = 100, places: int = 6) -> DataFrame:
    """Sample-weighted epoch loss and accuracy from integer batch totals:
    ``loss_units`` = Σ per-sample loss in 1/``unit``; exact to ``places``."""
    agg = batches.groupBy(*keys).agg(F.sum("loss_units").alias("_lu"), F.sum("n").alias("_n"),
                                     F.sum("correct").alias("_c"))
    return agg.select(*keys, fixed_point_ratio("_lu", f"_n * {unit}", places).alias("loss"),
                      fixed_point_ratio("_c", "_n", places).alias("accuracy"))


def epoch_loss_batch_mean_fixed(batches: DataFrame, keys: Sequence[str], unit: int = 100, places: int = 6) -> DataFrame:
    """Unweighted mean of batch losses (each batch loss first fixed to
    ``places`` decimals) and accuracy in percent, exact."""
    s = 10 ** places
    per_batch = batches.withColumn("_micro", F.expr(
        f"(CAST(loss_units AS DECIMAL(38,0)) * {2 * s} + CAST(n AS DECIMAL(38,0)) * {unit}) "
        f"div (2 * CAST(n AS DECIMAL(38,0)) * {unit})"))
    agg = per_batch.groupBy(*keys).agg(F.sum("_micro").alias("_m"), F.count(F.lit(1)).alias("_b"),
                                       F.sum("correct").alias("_c"), F.sum("n").alias("_n"))
    return agg.select(*keys, (fixed_point_ratio("_m", "_b", 0) / F.lit(float(s))).alias("loss"),
                      fixed_point_ratio("_c * 100", "_n", places).alias("accuracy_pct"))


def epoch_loss_batch_mean(batches: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Unweighted mean of batch losses, accuracy in percent."""
    return batches.groupBy(*keys).agg(
        F.avg("loss").alias("loss"), (F.lit(100.0) * F.sum("correct") / F.sum("n")).alias("accuracy_pct"))


# ------------------------------------------------------------------ drift

M31 = 2 ** 31


def portable_uniform(id_col: str | Column, seed: int, salt: Column | int, k: int) -> Column:
    """U(0, 1) draw that depends only on (id, seed, salt, k): two rounds of a
    31-bit multiplicative step with xor-shift mixing.  Integer arithmetic
    below 2^62, so no overflow, and SQL engines can reproduce it exactly."""
    i = F.col(id_col) if isinstance(id_col, str) else id_col
    s = salt if isinstance(salt, Column) else F.lit(salt)
    h = F.pmod(F.pmod(i.cast("long"), F.lit(M31)) * F.lit(1103515245)
               + F.lit(12345 + 7919 * seed + 15485863 * k) + s.cast("long") * F.lit(104729), F.lit(M31))
    h = F.pmod(h.bitwiseXOR(F.shiftright(h, 13)) * F.lit(1103515245) + F.lit(12345), F.lit(M31))
    h = h.bitwiseXOR(F.shiftright(h, 16))
    return (h.cast("double") + 0.5) / float(M31)


def portable_normal(id_col: str | Column, seed: int, salt: Column | int, loc: float = 0.0, scale: float = 1.0) -> Column:
    """N(loc, scale) by Box–Muller over two ``portable_uniform`` draws;
    reproducible under any partitioning."""
    z = F.sqrt(-2.0 * F.log(portable_uniform(id_col, seed, salt, 1))) * F.cos(2.0 * math.pi * portable_uniform(id_col, seed, salt, 2))
    return F.lit(loc) + F.lit(scale) * z


def drift_shift(df: DataFrame, id_col: str, cols: Sequence[str], seed: int = 0,
                loc: float = 0.5, scale: float = 0.1) -> DataFrame:
    """Add N(loc, scale) noise to every feature column (simulated drift)."""
    out = df
    for i, c in enumerate(cols):
        out = out.withColumn(c, F.col(c) + portable_normal(id_col, seed, i, loc, scale))
    return out


def drift_shift_vector(df: DataFrame, id_col: str, vec: str, seed: int = 0,
                       loc: float = 0.5, scale: float = 0.1) -> DataFrame:
    """Same, for every element of an array feature column (element index = salt)."""
    return df.withColumn(vec, F.transform(vec, lambda x, i: x.cast("double") + portable_normal(id_col, seed, i, loc, scale)))


# ------------------------------------------------------------------ parameter grid

def grid_expand(layers: DataFrame) -> DataFrame:
    """Cartesian product of parameter lists per architecture.

    ``layers``: ``(architecture, precedence, key, values array<string>)``;
    for each (architecture, key) the highest precedence wins (default <
    config file < override), scalars are one-element lists.  Output: one row
    per combination with a ``params`` map.
    """
    w = Window.partitionBy("architecture", "key").orderBy(F.desc("precedence"))
    merged = (layers.withColumn("_r", F.row_number().over(w)).filter("_r = 1")  # one row per (arch, key)
              .select("architecture", "key", "values"))
    per_key = merged.select("architecture", "key", F.explode("values").alias("value"))
    archs = merged.select("architecture").distinct()
    keys = [r["key"] for r in merged.select("key").distinct().orderBy("key").collect()]  # parameter names only
    combos = archs.withColumn("params", F.create_map().cast("map<string,string>"))
    for k in keys:
        opts = per_key.filter(F.col("key") == k).select("architecture", F.col("value").alias("_v"))
        combos = (combos.join(opts, "architecture", "left")
                  .withColumn("params", F.when(F.col("_v").isNull(), F.col("params"))
                              .otherwise(F.map_concat("params", F.create_map(F.lit(k), F.col("_v")))))
                  .drop("_v"))
    return combos
