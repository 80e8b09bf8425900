"""File-based sources and sinks: split-partitioned datasets, nested JSON,
labelled file trees, replaced tables and DDL."""

from __future__ import annotations

import re
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.tables import join_small

# ------------------------------------------------------------------ named splits


def write_splits(df: DataFrame, path: str, split_col: str = "split") -> str:
    """Write a dataset partitioned by its split (one folder per split)."""
    df.write.mode("overwrite").partitionBy(split_col).parquet(path)
    return path


def read_splits(spark: SparkSession, path: str) -> DataFrame:
    """All splits; a later ``filter(split == x)`` prunes the other folders."""
    return spark.read.parquet(path)


def read_split(spark: SparkSession, path: str, split: str, tag_names: Sequence[str] | None = None,
               tags_col: str = "ner_tags") -> tuple[DataFrame, object]:
    """One split plus its tag dictionary (as a literal array column)."""
    df = read_splits(spark, path).filter(F.col("split") == F.lit(split))
    dictionary = F.array(*[F.lit(n) for n in tag_names]) if tag_names else None
    return df, dictionary


def head_slice(df: DataFrame, order: str, n: int) -> DataFrame:
    """First ``n`` rows in an explicit order (a top-k, not file order)."""
    return df.orderBy(order).limit(n)


# ------------------------------------------------------------------ JSON documents

STUDENT_SCHEMA = T.StructType([
    T.StructField("students", T.ArrayType(T.StructType([
        T.StructField("id", T.IntegerType()),
        T.StructField("name", T.StringType()),
        T.StructField("courses", T.ArrayType(T.StringType())),
        T.StructField("gpa", T.DoubleType()),
        T.StructField("active", T.BooleanType()),
        T.StructField("graduation_date", T.DateType()),
        T.StructField("advisor", T.StringType()),
        T.StructField("notes", T.StringType()),
        T.StructField("special_programs", T.ArrayType(T.StringType())),
    ]))),
    T.StructField("last_updated", T.TimestampType()),
    T.StructField("total_students", T.IntegerType()),
])


def read_json_documents(spark: SparkSession, path: str, schema: T.StructType, multiline: bool = True) -> DataFrame:
    """Nested JSON with an explicit schema: absent keys and explicit nulls both
    read as null; no inference pass."""
    return spark.read.schema(schema).option("multiLine", multiline).json(path)


def write_json_arrays(docs: DataFrame, path: str) -> None:
    """One file for each partition: a JSON array with each document over
    several lines, as ``read_json_documents`` takes it."""
    def lines(batches):
        import pyarrow as pa
        begun = False
        for b in batches:
            rows = b.column(0).to_pylist()
            yield pa.RecordBatch.from_arrays([pa.array([("," if begun or k else "[") + "\n" + r for k, r in enumerate(rows)], pa.string())], names=["value"])
            begun = begun or bool(rows)
        yield pa.RecordBatch.from_arrays([pa.array(["]" if begun else "[]"])], names=["value"])

    docs.select(F.to_json(F.struct(*docs.columns), {"pretty": "true"}).alias("value")).mapInArrow(lines, "value string").write.mode("overwrite").text(path)


def explode_students(docs: DataFrame) -> DataFrame:
    return docs.select(F.explode("students").alias("s")).select("s.*")


# ------------------------------------------------------------------ labelled file trees

def sink_labelled_tree(df: DataFrame, root: str, split: str, label: str, seq: str, content: str,
                       ext: str = "bin") -> None:
    """Write one file per row at ``root/split/label/{seq:05d}.ext``.

    Files are written by the executors through the Arrow filesystem layer;
    a root without a scheme lies in Spark's default file system.  A file is
    written aside and then takes its name, so a failed or repeated task leaves
    no half file, and of two attempts at a file either is whole.
    """
    jvm, conf = df.sparkSession.sparkContext._jvm, df.sparkSession.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path(root)
    uri = str(at.getFileSystem(conf).makeQualified(at).toUri())
    uri = re.sub(r"^file:/+", "file:///", uri)

    def write_partition(rows):
        from pyarrow import fs as pafs
        filesystem, base = pafs.FileSystem.from_uri(uri)
        for r in rows:
            d, name = f"{base}/{r[split]}/{r[label]}", f"{int(r[seq]):05d}.{ext}"
            filesystem.create_dir(d, recursive=True)
            aside = f"{d}/.{name}.{uuid.uuid4().hex}"
            with filesystem.open_output_stream(aside) as out:
                out.write(bytes(r[content]))
            filesystem.move(aside, f"{d}/{name}")

    df.select(split, label, seq, content).foreachPartition(write_partition)


def read_labelled_tree(spark: SparkSession, root: str, flat: bool = False) -> DataFrame:
    """Scan ``split/class/file`` (or ``class/file`` when ``flat``); the class set
    comes from directory names, class index = rank of the sorted name − 1."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    rel = F.regexp_replace(F.col("path"), r"^.*?" + root.rstrip("/").split("://")[-1] + "/", "")
    parts = F.split(rel, "/")
    out = files.select("path", "length", "content",
                       (F.lit(None).cast("string") if flat else parts[0]).alias("split"),
                       (parts[0] if flat else parts[1]).alias("class"),
                       F.element_at(parts, -1).alias("file"))
    classes = out.select("class").distinct()  # one row per class directory
    index = classes.select("class", (F.row_number().over(Window.orderBy("class")) - 1).cast("int").alias("class_index"))
    return join_small(out, index, "class", "inner", max_rows=100_000)


# ------------------------------------------------------------------ tables

def replace_tables(tables: dict[str, DataFrame], base: str) -> dict[str, str]:
    """Write each table to ``base/name``, replacing what is there."""
    paths = {}
    for name, df in tables.items():
        p = f"{base.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(p)
        paths[name] = p
    return paths


def create_tables(spark: SparkSession, schemas: dict[str, T.StructType], base: str, database: str = "retail") -> list[str]:
    """Create empty parquet tables from schema constants, dropping old ones
    first (the DDL script), and return their qualified names."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}")
    names = []
    for name, schema in schemas.items():
        q = f"{database}.{name}"
        spark.sql(f"DROP TABLE IF EXISTS {q}")
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL")
                         for f in schema.fields)
        spark.sql(f"CREATE TABLE {q} ({cols}) USING parquet LOCATION '{base.rstrip('/')}/{name}'")
        names.append(q)
    return names


TWO_NF_SCHEMAS = {
    "products": T.StructType([T.StructField("StockCode", T.StringType(), False),
                              T.StructField("Description", T.StringType(), True)]),
    "invoices": T.StructType([T.StructField("InvoiceNo", T.StringType(), False),
                              T.StructField("InvoiceDate", T.TimestampNTZType(), False),
                              T.StructField("CustomerID", T.IntegerType(), True),
                              T.StructField("Country", T.StringType(), True)]),
    "invoice_items": T.StructType([T.StructField("InvoiceNo", T.StringType(), False),
                                   T.StructField("StockCode", T.StringType(), False),
                                   T.StructField("Quantity", T.IntegerType(), False),
                                   T.StructField("UnitPrice", T.DecimalType(18, 2), False)]),
}
