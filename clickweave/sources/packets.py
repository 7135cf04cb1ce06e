"""Columnar telemetry packets <-> rows.

A packet carries parallel arrays: ``timestamps[i]`` (ns, relative to
``epoch``) and, per parameter name, ``stringValues[name][i]`` /
``numericValues[name][i]``. Element *i* of every array belongs to row *i*.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.temporal import timestamp_from_nanos

# ids are text: a numeric value is a double, which holds whole numbers to 2^53 only
STRING_PARAMS = ["event_id", "userId", "age", "gender", "ip", "userAgent", "productId"]
NUMERIC_PARAMS = ["original_timestamp"]
PACKET_STREAM = "streamId"


def click_packets(clicks: DataFrame) -> DataFrame:
    """Packets as the web shop sends them: one per click, one-element arrays,
    stream id = visitor, epoch = start of the click's day (ns)."""
    day = F.unix_micros(F.date_trunc("day", F.col("timestamp").cast("timestamp")))
    us = F.unix_micros(F.col("timestamp").cast("timestamp"))
    return clicks.select(
        F.col("userId").alias(PACKET_STREAM),
        (day * 1000).alias("epoch"),
        F.array((us - day) * 1000).alias("timestamps"),
        F.create_map(*[x for p in STRING_PARAMS for x in (F.lit(p), F.array(F.col(p).cast("string")))]).alias("stringValues"),
        F.create_map(*[x for p in NUMERIC_PARAMS for x in (F.lit(p), F.array(F.col(p).cast("double")))])
        .alias("numericValues"),
    )


def packet_rows(packets: DataFrame) -> DataFrame:
    """Explode packets to one row per timestamp (``posexplode`` + index)."""
    exploded = packets.select("*", F.posexplode("timestamps").alias("_i", "_t"))
    sv = [F.try_element_at(F.col("stringValues")[p], F.col("_i") + 1).alias(p) for p in STRING_PARAMS[1:]]
    return exploded.select(
        # text first; packets that carry the id as a number are still read
        F.coalesce(F.try_element_at(F.col("stringValues")["event_id"], F.col("_i") + 1).cast("long"),
                   F.try_element_at(F.col("numericValues")["event_id"], F.col("_i") + 1).cast("long")).alias("event_id"),
        timestamp_from_nanos(F.col("epoch") + F.col("_t")).cast("timestamp_ntz").alias("timestamp"),
        *sv,
    )
