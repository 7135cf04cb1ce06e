"""File sources (S1-S3) and the log normalisation of the producer."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import product_id_from_url, strip_braces

# fixed values: raw log header names and their click-data names
LOG_RENAMES = {
    "Visitor Unique ID": "userId",
    "IP Address": "ip",
    "29": "userAgent",  # the user-agent column has no name in the log
    "Unix Timestamp": "original_timestamp",
}
LOG_URL_COLUMN = "Product Page URL"
CLICK_LOG_SCHEMA = T.StructType([
    T.StructField("Visitor Unique ID", T.StringType()),
    T.StructField("IP Address", T.StringType()),
    T.StructField("29", T.StringType()),
    T.StructField("Unix Timestamp", T.LongType()),
    T.StructField("Product Page URL", T.StringType()),
])
NORMALISED_COLUMNS = ["original_timestamp", "userId", "ip", "userAgent", "productId"]

PRODUCT_SCHEMA = "id string, category string, title string, description string, image string, price double"
VISITOR_SCHEMA = "userId string, birthDate string, gender string"


def read_click_log(spark: SparkSession, path: str) -> DataFrame:
    """Tab-separated log with a header line.

    Columns are taken by header *name* (the real log has many more columns
    in an order we do not rely on), all read as text -- no schema-inference
    pass over the data -- and the timestamp is cast to long.
    """
    raw = spark.read.option("sep", "\t").option("header", True).csv(path)
    cols = [F.col(f"`{c}`") for c in CLICK_LOG_SCHEMA.fieldNames()]
    return raw.select(*cols).withColumn("Unix Timestamp", F.col("`Unix Timestamp`").cast("long"))


def write_click_log(df: DataFrame, path: str) -> None:
    """Write a raw log in the same TSV layout (header line per file)."""
    df.write.mode("overwrite").option("sep", "\t").option("header", True).csv(path)


def normalise_log(raw: DataFrame) -> DataFrame:
    """P1 + F1 + F2 + P2: rename, strip braces, product id from URL, subset."""
    df = raw.withColumnsRenamed(LOG_RENAMES)
    df = df.withColumn("userId", strip_braces("userId"))
    df = df.withColumn("productId", product_id_from_url(LOG_URL_COLUMN))
    return df.select(*NORMALISED_COLUMNS)


def read_products(spark: SparkSession, path: str) -> DataFrame:
    """Product catalogue as JSON arrays, one per file."""
    return spark.read.option("multiLine", True).schema(PRODUCT_SCHEMA).json(path)


def write_products(df: DataFrame, path: str) -> None:
    """A catalogue as JSON arrays: one file per task, one array per file, streamed as its lines."""
    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lead = "["
        for batch in batches:
            if batch.num_rows:
                rows = batch.column(0).to_pylist()
                yield pa.RecordBatch.from_arrays([pa.array([lead + rows[0], *("," + r for r in rows[1:])])], names=["value"])
                lead = ","
        if lead == ",":
            yield pa.RecordBatch.from_arrays([pa.array(["]"])], names=["value"])

    (df.select(F.to_json(F.struct(*df.columns)).alias("value")).mapInArrow(lines, "value string")
     .write.option("maxRecordsPerFile", 0).text(path))


def read_visitors(spark: SparkSession, path: str) -> DataFrame:
    """S3: visitors as JSON Lines."""
    return spark.read.schema(VISITOR_SCHEMA).json(path)


def with_arrival_order(df: DataFrame) -> DataFrame:
    """Arrival order of file rows as sortable columns: file name, block start, and row number.

    Row numbers grow within a file block as it is read, so (file, block, row) is the order
    of the rows in the files, however Spark packs the blocks into tasks."""
    return (df.withColumn("_file", F.input_file_name()).withColumn("_block", F.input_file_block_start())
            .withColumn("_row", F.monotonically_increasing_id()))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """The rows of a file read (not filtered yet) numbered from 0 in the order of file name, block and line.

    A block's rows have consecutive row ids, so a row's place in its block is a difference.
    One aggregate gives each block's first id and size; the running sum over these, one row a
    block, gives every block its first number."""
    here = with_arrival_order(rows)
    blocks = here.groupBy("_file", "_block").agg(F.min("_row").alias("_first"), F.count(F.lit(1)).alias("_size"))
    before = Window.orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)  # one row a file block
    starts = blocks.select("_file", "_block", "_first", F.coalesce(F.sum("_size").over(before), F.lit(0)).alias("_start"))
    out = here.join(starts, ["_file", "_block"])
    return out.withColumn(name, F.col("_start") + F.col("_row") - F.col("_first")).drop("_file", "_block", "_row", "_first", "_start")
