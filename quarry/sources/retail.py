"""The flat retail table and its file forms (CSV landing, typed parquet).

The reference reads a retail export with eight columns.  Here that table is
derived from the star schema:

    InvoiceNo   = string(l_orderkey)      StockCode  = string(l_partkey)
    Description = p_name                  Quantity   = int(l_quantity)
    InvoiceDate = o_orderdate             UnitPrice  = decimal(18,2) l_extendedprice
    CustomerID  = int(o_custkey)          Country    = n_name

``RowKey`` (a struct of the lineitem columns that makes a row unique) stands
in for file order wherever "keep the first row" semantics are needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.sources.tables import join_small, table

MONEY = T.DecimalType(18, 2)

RETAIL_COLUMNS = [
    "InvoiceNo", "StockCode", "Description", "Quantity",
    "InvoiceDate", "UnitPrice", "CustomerID", "Country",
]

RETAIL_SCHEMA = T.StructType([
    T.StructField("InvoiceNo", T.StringType(), True),
    T.StructField("StockCode", T.StringType(), True),
    T.StructField("Description", T.StringType(), True),
    T.StructField("Quantity", T.IntegerType(), True),
    T.StructField("InvoiceDate", T.TimestampNTZType(), True),
    T.StructField("UnitPrice", MONEY, True),
    T.StructField("CustomerID", T.IntegerType(), True),
    T.StructField("Country", T.StringType(), True),
])

# Raw landing form: the id read as a float, the date as text (as a CSV reader
# without a schema would deliver them).
RAW_SCHEMA = T.StructType([
    T.StructField("InvoiceNo", T.StringType(), True),
    T.StructField("StockCode", T.StringType(), True),
    T.StructField("Description", T.StringType(), True),
    T.StructField("Quantity", T.IntegerType(), True),
    T.StructField("InvoiceDate", T.StringType(), True),
    T.StructField("UnitPrice", MONEY, True),
    T.StructField("CustomerID", T.DoubleType(), True),
    T.StructField("Country", T.StringType(), True),
])


def _customer_country(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = table(spark, sf_dir, "nation", "n_nationkey", "n_name")
    cust = table(spark, sf_dir, "customer", "c_custkey", "c_nationkey")
    # nation has 25 rows at every scale; the bound is checked, not assumed.
    return join_small(cust, nation.withColumnRenamed("n_nationkey", "c_nationkey"), "c_nationkey", max_rows=10_000)


def retail_view(spark: SparkSession, sf_dir: str, with_row_key: bool = True, n_parts: int | None = None) -> DataFrame:
    """Flat retail rows: lineitem ⋈ orders ⋈ customer ⋈ nation ⋈ part.

    Join order keeps the big side (lineitem) to two equi-joins; orders are
    first enriched with the country so the customer join runs on the
    smaller orders table.  The join by invoice comes last and on ``InvoiceNo``
    itself, so its rows are already dealt by invoice: grouping them by invoice,
    or by invoice and stock code, needs no further shuffle.  ``n_parts`` is the
    number of parts of that join (default: the session's).
    """
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cc = _customer_country(spark, sf_dir)
    orders_c = orders.join(cc, orders.o_custkey == cc.c_custkey, "inner")
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_suppkey",
               "l_linenumber", "l_quantity", "l_extendedprice")
    part = table(spark, sf_dir, "part", "p_partkey", "p_name")
    invoice = F.col("l_orderkey").cast("string")
    lines = li.join(part, li.l_partkey == part.p_partkey, "inner")
    lines = lines.repartition(n_parts, invoice) if n_parts else lines
    j = lines.join(orders_c, invoice == F.col("o_orderkey").cast("string"), "inner")
    cols = [
        F.col("l_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.col("o_orderdate").alias("InvoiceDate"),
        F.col("l_extendedprice").cast(MONEY).alias("UnitPrice"),
        F.col("o_custkey").cast("int").alias("CustomerID"),
        F.col("n_name").alias("Country"),
    ]
    if with_row_key:
        cols.append(F.struct("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey",
                             "l_quantity", "l_extendedprice").alias("RowKey"))
    return j.select(*cols)


def raw_retail_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Uncleaned landing rows: every order, with or without lines.

    Orders without a line give null StockCode/Quantity/..., so the key
    null-drop of the cleaning step has real work; the customer id comes as a
    float and the date as text, as in the reference's CSV.
    """
    orders = table(spark, sf_dir, "orders", "o_orderkey", "o_custkey", "o_orderdate")
    cc = _customer_country(spark, sf_dir)
    orders_c = orders.join(cc, orders.o_custkey == cc.c_custkey, "inner")
    li = table(spark, sf_dir, "lineitem", "l_orderkey", "l_partkey", "l_quantity", "l_extendedprice")
    part = table(spark, sf_dir, "part", "p_partkey", "p_name")
    j = (orders_c.join(li, orders_c.o_orderkey == li.l_orderkey, "left")
                 .join(part, li.l_partkey == part.p_partkey, "left"))
    return j.select(
        F.col("o_orderkey").cast("string").alias("InvoiceNo"),
        F.col("l_partkey").cast("string").alias("StockCode"),
        F.col("p_name").alias("Description"),
        F.col("l_quantity").cast("int").alias("Quantity"),
        F.date_format("o_orderdate", "yyyy-MM-dd HH:mm:ss").alias("InvoiceDate"),
        F.col("l_extendedprice").cast(MONEY).alias("UnitPrice"),
        F.col("o_custkey").cast("double").alias("CustomerID"),
        F.col("n_name").alias("Country"),
    )


# ---------------------------------------------------------------- file forms

def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> str:
    """CSV sink with a header row (reference: ``to_csv(index=False)``): quotes
    inside a field are doubled, line breaks and blanks are kept."""
    (df.write.mode(mode).option("header", True).option("escape", '"')
     .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


def read_csv(spark: SparkSession, path: str, schema: T.StructType = RETAIL_SCHEMA, corrupt_col: str | None = None,
             multiline: bool = True) -> DataFrame:
    """CSV scan with an explicit schema; a missing path raises.

    Fields may be quoted, with doubled quotes and line breaks inside.  A row
    that doesn't fit the schema raises, or with ``corrupt_col`` is returned
    with its text in that column.  Files whose fields have no line breaks can
    be read with ``multiline=False``, which lets Spark split large files.
    No schema inference: it costs a full extra pass and guesses per file.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    if corrupt_col is None:
        return reader.schema(schema).option("mode", "FAILFAST").csv(path)
    full = T.StructType([*schema.fields, T.StructField(corrupt_col, T.StringType())])
    return (reader.schema(full).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", corrupt_col).csv(path))


def convert_csv_to_parquet(spark: SparkSession, csv_path: str, parquet_path: str,
                           schema: T.StructType = RETAIL_SCHEMA) -> DataFrame:
    """Landing-format conversion: typed parquet rewrite of a CSV folder."""
    read_csv(spark, csv_path, schema).write.mode("overwrite").parquet(parquet_path)
    return spark.read.parquet(parquet_path)
