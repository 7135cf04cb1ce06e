"""The whole clickstream system as Spark jobs (what the reference runs as services).

    lookups   : products JSON array + visitors JSON Lines -> upserted dimension tables (K5)
    replay    : tab-separated click log -> normalised clicks with a replay schedule (S1, W1, W2)
    enrichment: click stream -> enriched "topic" (versioned dimensions, looked for per micro-batch)
    consumers : bucket counts (X4), panes of the marts and the sequence detector (X1) as
                independent streaming queries on the enriched topic, each with its own checkpoint (X8)
    marts     : dashboard tables recomputed each second from the panes and the bucket log

Between jobs the data sits in folders under one base directory (a message
broker in production, see ``streaming.sources``). Every batch is committed by a
manifest before its consumers see it, once; every stateful step is checkpointed. ``main``
loads the lookups, replays the log and serves until it is stopped.

Usage: python -m clickweave.app <base_dir> <click_log_tsv> <products_json> <visitors_jsonl>
"""

from __future__ import annotations

import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators.ordered import replay_schedule
from .operators.upsert import upsert_fields
from .sources import dimensions as D
from .sources.files import normalise_log, numbered, read_click_log, read_products, read_visitors
from .streaming import jobs as J
from .streaming.panes import start_panes
from .streaming.sources import CLICK_SCHEMA, ENRICHED_SCHEMA, file_stream


def paths(base: str) -> dict[str, str]:
    b = base.rstrip("/")
    names = ["products", "visitors", "ip_ranges", "countries", "dimensions", "clicks", "enriched", "buckets",
             "panes", "detection", "marts", "checkpoints"]
    return {n: f"{b}/{n}" for n in names} | {"offers": f"{b}/detection/offers"}


# ------------------------------------------------------------------- lookups

def _read_or_none(spark: SparkSession, path: str) -> DataFrame | None:
    from pyspark.errors import AnalysisException
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def current_dimension(spark: SparkSession, path: str) -> DataFrame | None:
    """Newest load of a dimension table (partition ``load``; the max-load
    filter is a scalar subquery, so only that partition is read)."""
    t = _read_or_none(spark, path)
    if t is None:
        return None
    return t.filter(F.col("load") == t.agg(F.max("load")).scalar()).drop("load")


def _upsert_table(spark: SparkSession, path: str, updates: DataFrame, key: str, fields: list[str]) -> None:
    """K5 into a parquet table: the new state is written as the next ``load``
    partition, so readers of the current load never see a half-written table
    and a failed load leaves the previous state current."""
    table = _read_or_none(spark, path)
    stored = current_dimension(spark, path) if table is not None else updates.select(key, *fields).limit(0)
    nxt = 0 if table is None else table.agg(F.max("load")).first()[0] + 1
    (upsert_fields(stored, updates, key, fields).withColumn("load", F.lit(nxt).cast("long"))
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("load").parquet(path))


def ingest_lookups(spark: SparkSession, base: str, products_json: str | None, visitors_jsonl: str | None) -> None:
    """Lookup ingestion: products (cat, title) and visitors (birthday, gender).
    Records later in a file win; a null field keeps the stored value."""
    p = paths(base)
    if products_json:
        prod = numbered(read_products(spark, products_json).select("id", "category", "title"), "seq")
        _upsert_table(spark, p["products"], prod, "id", ["category", "title"])
    if visitors_jsonl:
        vis = numbered(read_visitors(spark, visitors_jsonl), "seq")
        _upsert_table(spark, p["visitors"], vis, "userId", ["birthDate", "gender"])


def load_dims(spark: SparkSession, base: str) -> dict[str, DataFrame]:
    p = paths(base)
    ranges = _read_or_none(spark, p["ip_ranges"])
    countries = _read_or_none(spark, p["countries"])
    products, visitors = (current_dimension(spark, p[k]) for k in ("products", "visitors"))
    # before the first lookup load every click gets the defaults
    return {
        "products": products if products is not None else spark.createDataFrame([], "id string, category string, title string"),
        "visitors": visitors if visitors is not None else spark.createDataFrame([], "userId string, birthDate string, gender string"),
        "ip_ranges": ranges if ranges is not None else spark.createDataFrame([], "lo long, hi long, code string"),
        "countries": countries if countries is not None else spark.createDataFrame([], "code string, name string"),
    }


def dimension_reader(spark: SparkSession, base: str) -> D.DimensionReader:
    """The prepared lookup tables; a change of the stored ones is published as the next version."""
    p = paths(base)
    seen: list[str] = []

    def refresh() -> None:
        marker = D.change_marker(spark, *(p[k] for k in ("products", "visitors", "ip_ranges", "countries")))
        if seen != [marker]:
            d = load_dims(spark, base)
            D.publish(spark, p["dimensions"], d["products"], d["visitors"], d["ip_ranges"], d["countries"])
            seen[:] = [marker]

    return D.DimensionReader(spark, p["dimensions"], refresh)


# -------------------------------------------------------------------- replay

def replay(spark: SparkSession, base: str, click_log: str) -> DataFrame:
    """The producer: normalise the log and attach each row's replay offset
    (seconds from the start, delays clamped to [0, 10] s). The rows are
    written as click messages stamped with their original event time."""
    log = numbered(normalise_log(read_click_log(spark, click_log)), "event_id")
    sched = replay_schedule(log.select("event_id", F.col("original_timestamp").cast("double")
                                       .alias("original_timestamp")))
    clicks = (log.join(sched, "event_id")
              .withColumn("timestamp", F.timestamp_seconds("original_timestamp").cast("timestamp_ntz"))
              .withColumn("age", F.lit(None).cast("string")).withColumn("gender", F.lit(None).cast("string")))
    clicks.select(*CLICK_SCHEMA.fieldNames(), "at").write.mode("append").parquet(paths(base)["clicks"])
    return clicks


# ------------------------------------------------------------------ services

MAX_FILES_PER_BATCH = 1000  # a backfill is many batches, not one


def _make_folder(spark: SparkSession, path: str) -> None:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).mkdirs(p)


def start_services(spark: SparkSession, base: str, window_minutes: int = 30, trigger: dict | None = None,
                   max_files: int = MAX_FILES_PER_BATCH):
    """Enrichment (a new version of the dimensions is seen by the next micro-batch, day-partitioned output), then
    the consumers of the enriched table (bucket counts, panes of the marts, offers and transition trace), each
    with its own checkpoint. Starts on an empty base: schemas are fixed, folders are made. Services that run on
    keep 8.5 hours of buckets."""
    p = paths(base)
    ck = p["checkpoints"]
    once = trigger is None or trigger.get("availableNow", False)
    for k in ("clicks", "enriched"):
        _make_folder(spark, p[k])
    q1 = J.start_enrichment(file_stream(spark, p["clicks"], CLICK_SCHEMA, max_files_per_trigger=max_files),
                            dimension_reader(spark, base), p["enriched"], f"{ck}/enrichment", trigger)
    if once:
        q1.awaitTermination()

    def enriched():
        return file_stream(spark, p["enriched"], ENRICHED_SCHEMA, max_files_per_trigger=max_files)

    q2 = J.start_bucket_counts(enriched(), p["buckets"], f"{ck}/aggregation", trigger, None if once else J.recent_buckets)
    q3 = start_panes(enriched(), p["panes"], f"{ck}/panes", trigger)
    q4 = J.start_detection(enriched(), p["detection"], f"{ck}/detection", window_minutes, trigger)
    return [q1, q2, q3, q4]


def refresh_dashboard(spark: SparkSession, base: str, as_of=None, buffer: str = "1 hour") -> dict:
    """One refresh of every mart (``streaming.jobs.start_marts`` runs the same
    refresh on a clock)."""
    p = paths(base)
    if as_of is None:
        as_of = F.current_timestamp().cast("timestamp_ntz")
    return J.refresh_marts(spark, p["enriched"], p["buckets"], p["marts"], as_of, buffer, panes_path=p["panes"])


def serve(spark: SparkSession, base: str, window_minutes: int = 30, period: str = "1 second") -> list:
    """The services and the mart clock, running on until they are stopped."""
    p = paths(base)
    queries = start_services(spark, base, window_minutes, {"processingTime": period})
    clock = J.start_marts(spark, p["enriched"], p["buckets"], p["marts"], f"{p['checkpoints']}/marts", period, panes_path=p["panes"])
    return [*queries, clock]


def main(argv: list[str]) -> None:
    from .session import build_session
    base, log, prods, vis = argv[1:5]
    spark = build_session()
    ingest_lookups(spark, base, prods, vis)
    replay(spark, base, log)
    serve(spark, base)
    spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main(sys.argv)
