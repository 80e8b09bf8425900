"""Sources, sinks and streams."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.functions import arrays
from quarry.operators import clean, dml
from quarry.plans.registry import query
from quarry.plans.sqlviews import with_views
from quarry.session import scratch_path
from quarry.sources import files
from quarry.sources.retail import RETAIL_COLUMNS, convert_csv_to_parquet, read_csv, retail_view, write_csv
from quarry.sources.tables import table, with_scalars
from quarry.sources.text import TAG_NAMES, sentences
from quarry.streaming import jobs

# descriptions with commas, doubled quotes and line breaks, as landing files have them
RETAIL_SQL = with_views("""
SELECT InvoiceNo, StockCode, Description || CASE CAST(StockCode AS BIGINT) % 3 WHEN 0 THEN ' "EXTREMELY BUSY", SIGN'
         WHEN 1 THEN ', large' || chr(10) || 'second line ' ELSE '' END AS Description, Quantity, InvoiceDate, CAST(UnitPrice AS DOUBLE) AS UnitPrice, CustomerID, Country FROM retail""", "retail")


def _quoted(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.pmod(F.col("StockCode").cast("bigint"), F.lit(3))
    more = F.when(kind == 0, ' "EXTREMELY BUSY", SIGN').when(kind == 1, ", large\nsecond line ").otherwise("")
    return retail_view(spark, sf, with_row_key=False).withColumn("Description", F.concat("Description", more))


def _flat(df: DataFrame) -> DataFrame:
    return df.select(*RETAIL_COLUMNS).withColumn("UnitPrice", F.col("UnitPrice").cast("double"))


@query("src_csv_scan", RETAIL_SQL)
def q_src_csv_scan(spark: SparkSession, sf: str) -> DataFrame:
    """CSV landing file (written from the tables) scanned with an explicit schema."""
    path = write_csv(_quoted(spark, sf), scratch_path(spark, "retail-csv"))
    return _flat(read_csv(spark, path))


@query("sink_csv", with_views("""
SELECT Country, count(*) AS n_rows, CAST(sum(Quantity) AS BIGINT) AS qty FROM clean GROUP BY Country""", "clean"))
def q_sink_csv(spark: SparkSession, sf: str) -> DataFrame:
    """Cleaned table written as CSV with a header, read back."""
    from quarry.sources.retail import raw_retail_view
    cleaned = clean.clean_pipeline(raw_retail_view(spark, sf))
    path = write_csv(cleaned, scratch_path(spark, "clean-csv"))
    back = read_csv(spark, path)
    return back.groupBy("Country").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("Quantity").alias("qty"))


@query("convert_format", RETAIL_SQL)
def q_convert_format(spark: SparkSession, sf: str) -> DataFrame:
    """CSV → typed parquet rewrite."""
    csv = write_csv(_quoted(spark, sf), scratch_path(spark, "retail-csv"))
    return _flat(convert_csv_to_parquet(spark, csv, scratch_path(spark, "retail-parquet")))


def _split_dataset(spark: SparkSession, sf: str) -> str:
    return files.write_splits(sentences(spark, sf), scratch_path(spark, "sentences"))


@query("src_parquet_splits", with_views("""
SELECT split, count(*) AS n_sentences, CAST(sum(len(tokens)) AS BIGINT) AS n_tokens FROM sentences GROUP BY split""", "sentences"))
def q_src_parquet_splits(spark: SparkSession, sf: str) -> DataFrame:
    ds = files.read_splits(spark, _split_dataset(spark, sf))
    return ds.groupBy("split").agg(F.count(F.lit(1)).alias("n_sentences"), F.sum(F.size("tokens")).cast("long").alias("n_tokens"))


@query("src_split_with_dictionary", with_views("""
SELECT tag, count(*) AS n_tokens FROM (
  SELECT unnest(list_transform(ner_tags, lambda i: ['O', 'B-PER', 'I-PER', 'B-ORG', 'I-ORG', 'B-LOC', 'I-LOC', 'B-MISC', 'I-MISC'][i + 1])) AS tag
  FROM sentences WHERE split = 'validation') GROUP BY tag""", "sentences"))
def q_src_split_dict(spark: SparkSession, sf: str) -> DataFrame:
    df, names = files.read_split(spark, _split_dataset(spark, sf), "validation", TAG_NAMES)
    tags = F.transform("ner_tags", lambda i: F.element_at(names, i + 1))
    return df.select(F.explode(tags).alias("tag")).groupBy("tag").agg(F.count(F.lit(1)).alias("n_tokens"))


@query("src_head_slice", with_views("""
SELECT id, CAST(len(tokens) AS INTEGER) AS n_tokens FROM sentences WHERE split = 'train' ORDER BY id LIMIT 20""", "sentences"))
def q_src_head_slice(spark: SparkSession, sf: str) -> DataFrame:
    df, _ = files.read_split(spark, _split_dataset(spark, sf), "train")
    return files.head_slice(df, "id", 20).select("id", F.size("tokens").alias("n_tokens"))


EVENT_DOC_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("event", T.StructType([T.StructField("type", T.StringType()), T.StructField("user", T.LongType()),
                                         T.StructField("value", T.DoubleType())])),
    T.StructField("props", T.StructType([T.StructField("k", T.LongType()), T.StructField("missing", T.StringType())])),
    T.StructField("tags", T.ArrayType(T.StringType())),
])


@query("src_json_document", """
SELECT event_id, event_type, user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k, NULL::VARCHAR AS missing,
       unnest([event_type, 'user ' || user_id]) AS tag FROM events""")
def q_src_json_document(spark: SparkSession, sf: str) -> DataFrame:
    """Nested JSON documents (written from ``events`` as files that hold one
    array over many lines) read with an explicit schema: the absent
    ``missing`` key reads as null, and each element of ``tags`` is a row."""
    e = table(spark, sf, "events", "event_id", "event_type", "user_id", "value", "props")
    docs = e.select("event_id",
                    F.struct(F.col("event_type").alias("type"), F.col("user_id").alias("user"), "value").alias("event"),
                    F.from_json("props", "k long").alias("props"), F.array("event_type", F.concat(F.lit("user "), "user_id")).alias("tags"))
    path = scratch_path(spark, "event-json")
    files.write_json_arrays(docs, path)
    back = files.read_json_documents(spark, path, EVENT_DOC_SCHEMA)
    return back.select("event_id", F.col("event.type").alias("event_type"), F.col("event.user").alias("user_id"),
                       F.col("props.k").alias("k"), F.col("props.missing").alias("missing"), F.explode("tags").alias("tag"))


def _tree(spark: SparkSession, sf: str) -> str:
    from quarry.operators import ml
    from quarry.operators.windows import per_class_sequence
    e = table(spark, sf, "embeddings", "vec_id", "label")
    sp = ml.split_holdout(e, "vec_id", 0.2, 42)
    rows = (sp.withColumn("class", F.concat(F.lit("class_"), F.col("label").cast("string")))
            .withColumn("cls_split", F.concat_ws("/", "split", "class")))
    seq = per_class_sequence(rows, "cls_split", "vec_id")
    root = scratch_path(spark, "labelled-tree")
    files.sink_labelled_tree(seq.withColumn("content", F.encode(F.col("vec_id").cast("string"), "UTF-8")),
                             root, "split", "class", "seq", "content")
    return root


register_tree_sql = with_views("""
SELECT split, 'class_' || CAST(label AS VARCHAR) AS class, label AS class_index, count(*) AS n_files,
       CAST(sum(length(CAST(vec_id AS VARCHAR))) AS BIGINT) AS n_bytes,
       max(lpad(CAST(seq AS VARCHAR), 5, '0')) AS last_file
FROM (SELECT *, row_number() OVER (PARTITION BY split, label ORDER BY vec_id) - 1 AS seq FROM emb_split)
GROUP BY split, label""", "emb_split")


@query("src_labelled_file_tree", register_tree_sql)
def q_src_labelled_tree(spark: SparkSession, sf: str) -> DataFrame:
    t = files.read_labelled_tree(spark, _tree(spark, sf))
    return t.groupBy("split", "class", "class_index").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").cast("long").alias("n_bytes"),
        F.max(F.regexp_extract("file", r"^(\d+)", 1)).alias("last_file"))


@query("sink_labelled_tree", register_tree_sql)
def q_sink_labelled_tree(spark: SparkSession, sf: str) -> DataFrame:
    return q_src_labelled_tree(spark, sf)


@query("sink_table_replace", with_views("""
SELECT 'products' AS table_name, count(DISTINCT StockCode) AS n_rows FROM retail
UNION ALL SELECT 'invoices', count(DISTINCT InvoiceNo) FROM retail
UNION ALL SELECT 'invoice_items', count(*) FROM retail""", "retail"))
def q_sink_table_replace(spark: SparkSession, sf: str) -> DataFrame:
    """Write the three 2NF tables twice (the second write replaces the first),
    from flat rows that are joined once and written aside."""
    flat = scratch_path(spark, "flat")
    retail_view(spark, sf).write.mode("overwrite").parquet(flat)
    r = spark.read.parquet(flat)
    t = {"products": clean.products_2nf(r), "invoices": clean.invoices_2nf(r), "invoice_items": clean.invoice_items_2nf(r)}
    base = scratch_path(spark, "2nf")
    files.replace_tables(t, base)
    paths = files.replace_tables(t, base)
    out = None
    for name, p in paths.items():
        one = spark.read.parquet(p).agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(name).alias("table_name"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("ddl_tables", with_views("""
SELECT 'retail.products' AS table_name, 'StockCode:string,Description:string' AS columns, count(DISTINCT StockCode) AS n_rows FROM retail
UNION ALL SELECT 'retail.invoices', 'InvoiceNo:string,InvoiceDate:timestamp_ntz,CustomerID:int,Country:string', count(DISTINCT InvoiceNo) FROM retail
UNION ALL SELECT 'retail.invoice_items', 'InvoiceNo:string,StockCode:string,Quantity:int,UnitPrice:decimal(18,2)', count(*) FROM retail""", "retail"))
def q_ddl_tables(spark: SparkSession, sf: str) -> DataFrame:
    """Create the 2NF tables from schema constants, insert the data, report
    columns and row counts per table."""
    base = scratch_path(spark, "ddl")
    names = files.create_tables(spark, files.TWO_NF_SCHEMAS, base)
    r = retail_view(spark, sf)
    data = {"retail.products": clean.products_2nf(r), "retail.invoices": clean.invoices_2nf(r),
            "retail.invoice_items": clean.invoice_items_2nf(r)}
    for n in names:
        data[n].select(*spark.table(n).columns).write.insertInto(n, overwrite=True)
    out = None
    for n in names:
        cols = ",".join(f"{f.name}:{f.dataType.simpleString()}" for f in spark.table(n).schema.fields)
        one = spark.table(n).agg(F.count(F.lit(1)).alias("n_rows")).select(
            F.lit(n).alias("table_name"), F.lit(cols).alias("columns"), "n_rows")
        out = one if out is None else out.unionByName(one)
    return out


@query("sink_upsert_batch", with_views("""
SELECT * FROM refs WHERE CustomerID NOT IN (
  SELECT CAST(c_custkey AS INTEGER) FROM customer WHERE c_mktsegment = 'BUILDING')
UNION ALL
SELECT CAST(c.c_custkey AS INTEGER), n.n_name || ' (' || c.c_mktsegment || ')' FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment = 'BUILDING'""", "refs"))
def q_sink_upsert_batch(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed replace-or-insert into a written table, applied twice (idempotent)."""
    from quarry.plans.dml_queries import _upsert_source
    from quarry.plans.retail_queries import layouts
    refs = layouts(spark, sf)["customer_refs"]
    p0, p1, p2 = (scratch_path(spark, f"refs-v{i}") for i in range(3))
    refs.write.mode("overwrite").parquet(p0)
    src = _upsert_source(spark, sf)
    dml.upsert_replace(spark.read.parquet(p0), src, ["CustomerID"]).write.mode("overwrite").parquet(p1)
    dml.upsert_replace(spark.read.parquet(p1), src, ["CustomerID"]).write.mode("overwrite").parquet(p2)
    return spark.read.parquet(p2)


@query("sink_json_result", with_views("""
SELECT run_id, count(DISTINCT epoch) AS num_epochs, (SELECT CAST(least(count(*), 20) AS INTEGER) FROM embeddings) AS n_samples, 10 AS n_classes
FROM batches GROUP BY run_id""", "batches"))
def q_sink_json_result(spark: SparkSession, sf: str) -> DataFrame:
    """Result document: per-epoch metrics, accuracy, counts, class names and
    sample predictions, written as JSON and read back."""
    from quarry.plans.ml_queries import CLASS_NAMES, batches, q_sample_predictions
    from quarry.operators import ml as mlops
    epochs = mlops.epoch_loss_weighted(batches(spark, sf), ["run_id", "epoch"])
    per_epoch = epochs.groupBy("run_id").agg(F.array_sort(F.collect_list(F.struct("epoch", "loss", "accuracy"))).alias("epochs"))
    samples = q_sample_predictions(spark, sf).agg(F.collect_list(F.struct("predicted", "actual")).alias("samples"))
    doc = (with_scalars(per_epoch, samples)
           .withColumn("classes", F.array(*[F.lit(c) for c in CLASS_NAMES]))
           .withColumn("num_epochs", F.size("epochs")))
    path = scratch_path(spark, "results-json")
    doc.write.mode("overwrite").json(path)
    back = spark.read.json(path)
    return back.select("run_id", "num_epochs", F.size("samples").alias("n_samples"), F.size("classes").alias("n_classes"))


# ------------------------------------------------------------------ streams

@query("stream_score", f"""
SELECT vec_id, CAST(list_position(s, list_max(s)) - 1 AS INTEGER) AS pred,
       round(1.0 / list_sum(list_transform(s, lambda x: exp(x - list_max(s)))), 6) AS confidence
FROM (SELECT vec_id, {arrays.class_scores_sql('embedding', 10)} AS s FROM embeddings)""")
def q_stream_score(spark: SparkSession, sf: str) -> DataFrame:
    """File stream of typed score requests: valid rows (64 floats) are scored,
    malformed rows (documents posted to the same endpoint) are quarantined."""
    src = scratch_path(spark, "score-in")
    e = table(spark, sf, "embeddings", "vec_id", "embedding")
    e.write.mode("overwrite").json(src + "/good")
    bad = table(spark, sf, "documents", "doc_id").select(F.col("doc_id").alias("vec_id"), F.lit(None).cast("array<float>").alias("embedding"))
    bad.write.mode("append").json(src + "/bad")
    schema = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType()))])

    def score(df: DataFrame) -> DataFrame:
        s = arrays.class_scores("embedding", 10)
        probs = arrays.softmax(s)
        return df.select("vec_id", arrays.argmax(probs).alias("pred"), F.round(F.array_max(probs), 6).alias("confidence"))

    out, quarantine = scratch_path(spark, "scored"), scratch_path(spark, "quarantine")
    jobs.score_stream(spark, src + "/*", schema, lambda: F.col("vec_id").isNotNull() & (F.size("embedding") == 64),
                      score, out, quarantine, scratch_path(spark, "score-ckpt"))
    return spark.read.parquet(out).drop("epoch")


@query("stream_upsert", with_views("""
SELECT * FROM refs WHERE CustomerID NOT IN (
  SELECT CAST(c_custkey AS INTEGER) FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY'))
UNION ALL
SELECT CAST(c.c_custkey AS INTEGER), n.n_name || ' (' || c.c_mktsegment || ')' FROM customer c JOIN nation n ON c.c_nationkey = n.n_nationkey
WHERE c.c_mktsegment IN ('BUILDING', 'MACHINERY')""", "refs"))
def q_stream_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """Keyed upserts arriving as files, applied micro-batch by micro-batch."""
    from quarry.plans.retail_queries import layouts
    refs = layouts(spark, sf)["customer_refs"]
    c = table(spark, sf, "customer", "c_custkey", "c_nationkey", "c_mktsegment")
    n = table(spark, sf, "nation", "n_nationkey", "n_name")
    upd = (c.join(n, c.c_nationkey == n.n_nationkey)
           .select(F.col("c_custkey").cast("int").alias("CustomerID"),
                   F.concat("n_name", F.lit(" ("), "c_mktsegment", F.lit(")")).alias("Country"), "c_mktsegment"))
    src = scratch_path(spark, "upsert-in")
    for seg in ["BUILDING", "MACHINERY"]:  # two arriving files → two micro-batches
        upd.filter(F.col("c_mktsegment") == seg).drop("c_mktsegment").write.mode("append").parquet(src)
    from quarry.sources import layout_store as store
    target = store.write_table(refs, scratch_path(spark, "refs-bucketed"), "CustomerID", 8)
    jobs.upsert_stream(spark, src, refs.schema, target, ["CustomerID"], scratch_path(spark, "upsert-ckpt"), 8)
    return spark.read.parquet(target).drop("bucket")
