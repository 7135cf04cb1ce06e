"""Stream sources and sinks.

Production reads/writes a message broker through Spark's Kafka connector
(the visitor id is the message key, so one visitor's clicks stay ordered in
one partition). No Kafka connector ships with this environment, so those
functions are written but only the file-source forms run in the tests.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

CLICK_SCHEMA = T.StructType([
    T.StructField("event_id", T.LongType()),
    T.StructField("timestamp", T.TimestampNTZType()),
    T.StructField("original_timestamp", T.LongType()),
    T.StructField("userId", T.StringType()),
    T.StructField("ip", T.StringType()),
    T.StructField("userAgent", T.StringType()),
    T.StructField("age", T.StringType()),
    T.StructField("gender", T.StringType()),
    T.StructField("productId", T.StringType()),
])

ENRICHED_SCHEMA = T.StructType([
    *CLICK_SCHEMA.fields[:6],
    T.StructField("productId", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("title", T.StringType()),
    T.StructField("birthdate", T.DateType()),
    T.StructField("country", T.StringType()),
    T.StructField("deviceType", T.StringType()),
    T.StructField("age", T.IntegerType()),
    T.StructField("gender", T.StringType()),
    T.StructField("day", T.DateType()),  # the table's partition columns
    T.StructField("batch", T.LongType()),
])


def file_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                max_files_per_trigger: int | None = None) -> DataFrame:
    """File-source stream (explicit schema, no inference)."""
    r = spark.readStream.format(fmt).schema(schema)
    if max_files_per_trigger:
        r = r.option("maxFilesPerTrigger", max_files_per_trigger)
    return r.load(path)


def kafka_click_stream(spark: SparkSession, servers: str, topic: str, schema: T.StructType = CLICK_SCHEMA,
                       starting_offsets: str = "latest", max_offsets_per_trigger: int | None = None) -> DataFrame:
    """Click messages (JSON values) from a topic; arrival order kept as
    (partition, offset). Requires the spark-sql-kafka package."""
    r = (spark.readStream.format("kafka").option("kafka.bootstrap.servers", servers)
         .option("subscribe", topic).option("startingOffsets", starting_offsets))
    if max_offsets_per_trigger:
        r = r.option("maxOffsetsPerTrigger", max_offsets_per_trigger)
    return parse_topic(r.load(), schema)


# Arrival order of topic rows: the broker's append time, then the partition's own order.
ARRIVAL = ["arrived", "partition", "offset"]


def parse_topic(messages: DataFrame, schema: T.StructType = CLICK_SCHEMA) -> DataFrame:
    """Rows of a topic (key, value, partition, offset, timestamp) to clicks that keep their arrival order in the
    columns ``ARRIVAL``. A value that is no JSON object gives a row of nulls, as a bad message does."""
    value = F.from_json(F.col("value").cast("string"), schema, {"timestampNTZFormat": NTZ_FORMAT})
    return (messages.select(value.alias("v"), F.col("timestamp").cast("timestamp_ntz").alias("arrived"), "partition", "offset")
            .select("v.*", *ARRIVAL))


NTZ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS]"


def to_keyed_messages(df: DataFrame, key_col: str = "userId", parent_col: str | None = None) -> DataFrame:
    """K1/K2/K8: rows -> (key, JSON value[, header with the id of the stream the row came from])."""
    cols = [F.col(key_col).cast("string").alias("key"), F.to_json(F.struct("*"), {"timestampNTZFormat": NTZ_FORMAT}).alias("value")]
    if parent_col:
        cols.append(F.array(F.struct(F.lit("parent").alias("key"),
                                     F.col(parent_col).cast("binary").alias("value"))).alias("headers"))
    return df.select(*cols)


def kafka_sink(df: DataFrame, servers: str, topic: str, checkpoint: str, key_col: str = "userId"):
    """K1 + K8: publish keyed rows to a topic, with their stream as parent (requires the spark-sql-kafka package)."""
    return (to_keyed_messages(df, key_col, key_col).writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())


def offer_events(offers: DataFrame, topic: str = "special-offers") -> DataFrame:
    """K2 + P14 shape: (topicName, streamId, timestamp ns, tags, id, value)."""
    return offers.select(
        F.lit(topic).alias("topicName"), F.col("userId").alias("streamId"),
        (F.unix_micros(F.col("timestamp").cast("timestamp")) * 1000).alias("timestamp"),
        F.create_map().cast("map<string,string>").alias("tags"),
        F.lit("offer").alias("id"), F.col("offer").alias("value"))


def subscribe(events: DataFrame, topic: str, stream_id: str, event_id: str = "offer") -> DataFrame:
    """The events of one (topic, stream, event id) subscription."""
    return events.filter((F.col("topicName") == topic) & (F.col("streamId") == stream_id)
                         & (F.col("id") == event_id))


def stamp_arrival(df: DataFrame, col: str = "timestamp") -> DataFrame:
    """P5: stamp each row with the (UTC) time it is published."""
    return df.withColumn(col, F.current_timestamp().cast("timestamp_ntz"))
