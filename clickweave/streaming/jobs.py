"""Structured Streaming jobs.

* ``start_enrichment``: click stream -> enriched table. ``foreachBatch`` so
  a new version of the dimensions is seen by the next batch (J9); each batch is
  committed under its own ``batch`` partition by a manifest (``commits.commit_batch``):
  consumers see all of it or nothing, and a retried batch once -- X13.
* ``start_bucket_counts``: X4, the 30-minute (bucket, visitor) counts: each
  batch adds its partial counts to a levelled log (``commits.RunLog``); readers sum
  them per key (``latest_bucket_counts``). Nothing is dropped, whatever the
  order of event times; ``odd_times`` counts late and future clicks (X7).
* ``start_detection``: X1 for offers and trace at once: each micro-batch is folded on from stored
  states by the batch fold, so a visitor may fill a whole batch. ``start_offers`` and
  ``start_trace``: the same rule as keyed state, file sink (exactly once).
* ``start_marts``: X6/X11, a ``rate`` source as the clock; each tick recomputes every mart from the
  panes (``panes``) or from the trailing slice of the enriched table, and publishes it (K3).

Every query has its own checkpoint folder (a consumer group, X8) under the
shared ``spark.checkpoint.dir``.
"""

from __future__ import annotations

import time
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..operators import enrich as E
from ..operators import metrics as M
from ..operators import sequence as S
from .commits import Folder, RunLog, commit_batch
from .detector import offers_stream, sequence_trace_stream
from .panes import pane_marts
from .sources import ENRICHED_SCHEMA

BUCKET_RETENTION = "8 hours 30 minutes"
BUCKET_SCHEMA = "datetime timestamp_ntz, userId string, count long"
DAY_PARTITION = "day"
BATCH_BROADCAST = 1 << 20  # bytes of a lookup table that every micro-batch may send through the driver

_write_batch = commit_batch


# ------------------------------------------------------------------ enrichment

def start_enrichment(clicks_stream: DataFrame, load_dims: Callable[[], dict], out_path: str,
                     checkpoint: str, trigger: dict | None = None, commit: Callable = commit_batch) -> StreamingQuery:
    """Enrich every micro-batch against the current dimensions: prepared ones (a
    ``DimensionReader``) are joined as they are, raw ones are prepared for the batch. A broadcast
    table passes through the driver in every batch, so batches broadcast only small ones
    (``BATCH_BROADCAST``, or the session's limit if that is lower) and join others by a shuffle."""

    def batch(df: DataFrame, batch_id: int) -> None:
        _broadcast_at_most(df.sparkSession, BATCH_BROADCAST)
        d = load_dims()
        lookups = d if "country_ranges" in d else E.prepare_lookups(d["products"], d["visitors"], d["ip_ranges"], d["countries"])
        out = E.enrich_prepared(df, lookups)
        out = (out.withColumn(DAY_PARTITION, F.to_date("timestamp"))
               .sortWithinPartitions(DAY_PARTITION, "timestamp"))
        commit(out, out_path, batch_id, [DAY_PARTITION])

    w = clicks_stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _broadcast_at_most(spark: SparkSession, limit: int) -> None:
    """Lower a session's broadcast limits; a stream's batches have a session of their own."""
    plain, adaptive = "spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"
    for name, given in ((plain, spark.conf.get(plain)), (adaptive, spark.conf.get(adaptive, None))):
        if given and not given.startswith("-"):
            spark.conf.set(name, min(limit, int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(given))))


def read_enriched(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """The enriched table; with ``since``, only day partitions >= date(since)
    are read (partition pruning) and the pushed-down time filter skips row
    groups (files are time-sorted within a day)."""
    df = spark.read.parquet(path)
    return df.drop("batch", DAY_PARTITION) if since is None else since_time(df, since)


def since_time(enriched: DataFrame, since: Column) -> DataFrame:
    """The enriched clicks after a time: older day partitions are pruned, the time filter is pushed down."""
    rows = enriched.filter((F.col(DAY_PARTITION) >= F.to_date(since)) & (F.col("timestamp") > since))
    return rows.drop("batch", DAY_PARTITION)


# ---------------------------------------------------------------- X4 buckets

def _merged_buckets(counts: DataFrame) -> DataFrame:
    return counts.groupBy("datetime", "userId").agg(F.sum("count").alias("count"))


def bucket_log(spark: SparkSession, path: str, retain: Callable[[DataFrame], DataFrame] | None = None) -> RunLog:
    return RunLog(spark, path, BUCKET_SCHEMA, _merged_buckets, retain)


def recent_buckets(buckets: DataFrame) -> DataFrame:
    """The retention of a live service: buckets of the last 8.5 hours (and future ones)."""
    return buckets.where(F.col("datetime") >= F.current_timestamp().cast("timestamp_ntz") - M.interval(BUCKET_RETENTION))


def start_bucket_counts(enriched_stream: DataFrame, out_path: str, checkpoint: str,
                        trigger: dict | None = None, retain: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Each batch adds its own partial counts (G1), once.

    No state and no watermark, so a late or future-dated click is counted like any other and
    cannot make the job lose later ones. Full levels are merged on the way; ``retain`` says which
    buckets a merge keeps (default: all)."""

    def batch(df: DataFrame, batch_id: int) -> None:
        bucket_log(df.sparkSession, out_path, retain).commit(M.user_bucket_counts(df), batch_id)

    q = enriched_stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return q.trigger(**(trigger or {"availableNow": True})).start()


def latest_bucket_counts(spark: SparkSession, path: str, since: Column | None = None) -> DataFrame:
    """The sum of the batches' partial counts per (bucket, visitor).

    ``since`` keeps only buckets starting at or after it (the 8.5-hour
    retention of the reference), filtered before the aggregation.
    """
    return bucket_log(spark, path).read(lambda df: df if since is None else df.filter(F.col("datetime") >= since))


def odd_times(buckets: DataFrame, as_of: Column, late: str = BUCKET_RETENTION) -> DataFrame:
    """How many counted clicks lie in buckets after ``as_of`` (future) or before the
    retention (late): one row, for an alarm. They stay counted."""
    future, old = F.col("datetime") > as_of, F.col("datetime") < as_of - M.interval(late)
    total = lambda c: F.coalesce(F.sum(F.when(c, F.col("count"))), F.lit(0)).cast("long")
    return buckets.agg(total(future).alias("future"), total(old).alias("late"), total(F.lit(True)).alias("clicks"))


# ------------------------------------------------------------------ X1 offers

def start_offers(enriched_stream: DataFrame, out_path: str, checkpoint: str, within_minutes: int,
                 trigger: dict | None = None) -> StreamingQuery:
    q = (offers_stream(enriched_stream, within_minutes).writeStream.format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append"))
    return q.trigger(**(trigger or {"availableNow": True})).start()


def start_trace(enriched_stream: DataFrame, out_path: str, checkpoint: str, within_minutes: int,
                trigger: dict | None = None) -> StreamingQuery:
    q = (sequence_trace_stream(enriched_stream, within_minutes).writeStream.format("parquet")
         .option("path", out_path).option("checkpointLocation", checkpoint).outputMode("append"))
    return q.trigger(**(trigger or {"availableNow": True})).start()


STATE_LOG_SCHEMA = S.STATE_SCHEMA + ", us long, batch long"


def _latest_states(states: DataFrame) -> DataFrame:
    """A visitor's state is that of their last batch; of several rows of it, the open one."""
    order = F.struct("batch", (F.col("st") != S.INIT).alias("open"))
    rest = [c.split()[0] for c in STATE_LOG_SCHEMA.split(", ")][1:]
    return (states.groupBy("userId").agg(F.max_by(F.struct(*rest), order).alias("last"))
            .select("userId", *[F.col(f"last.{c}").alias(c) for c in rest]))


def expired_states(states: DataFrame, before_us: Column, within_minutes: int) -> DataFrame:
    """Sequences that began so early that no click from ``before_us`` on can continue them, shrunk to a
    tombstone: their next click but a refresh is lost, which is all that the rule asks of them. (``init`` states stay:
    they hide open ones in older runs.)"""
    over = (F.col("st") == S.EXPIRED) | F.coalesce(F.col("first_us") + int(within_minutes) * 60_000_000 <= before_us, F.lit(False))
    return states.select(
        "userId", F.when(over, S.EXPIRED).otherwise(F.col("st")).alias("st"), F.when(~over, F.col("first_us")).alias("first_us"),
        F.when(~over, F.col("first_pid")).alias("first_pid"), "last_pid", "us", "batch")


def start_detection(enriched_stream: DataFrame, out_path: str, checkpoint: str, within_minutes: int, trigger: dict | None = None,
                    partitions: int | None = None, lateness: str | None = None) -> StreamingQuery:
    """One query for offers and trace.

    A micro-batch is folded on from the stored states of its visitors by ``operators.sequence.fold_batch``: ordered
    over range partitions, visitors who cannot open or continue a sequence left out in the JVM, a visitor's
    clicks spread over as many tasks as they fill. Trace and end states are committed
    together (``out_path/folded``), then the states join a levelled log, then the offers are committed; each step is done once,
    whichever attempt does it. With ``lateness``, merges of the state log expire sequences as ``expired_states`` does,
    for clicks that come at most that late; without, states stay whole, as in the reference."""
    states_path, folded_path, offers_path = (f"{out_path.rstrip('/')}/{n}" for n in ("states", "folded", "offers"))

    def retain(states: DataFrame) -> DataFrame:
        newest = states.agg(F.max("us").alias("us")).first().us
        if newest is None:
            return states
        return expired_states(_latest_states(states), F.lit(newest) - int(M.step_seconds(lateness) * 1_000_000), within_minutes)

    def batch(df: DataFrame, batch_id: int) -> None:
        spark = df.sparkSession
        # An expired state may go to a lower level before an older open one is merged away: the later batch still wins.
        log = RunLog(spark, states_path, STATE_LOG_SCHEMA, _latest_states, retain if lateness else None)
        if not Folder(spark, folded_path).exists(f"_batches/{batch_id}"):
            here = df.select("userId").distinct()
            state = log.read(lambda rows: rows.join(here, "userId", "left_semi"))
            folded = S.fold_batch(df, state.select(*[c.split()[0] for c in S.STATE_SCHEMA.split(", ")]), within_minutes, partitions)
            commit_batch(folded, folded_path, batch_id, ["kind"])
        else:
            commit_batch(df, folded_path, batch_id, ["kind"])  # moves what a broken attempt left
        schema = S.FOLDED_SCHEMA + ", batch long"
        rows = spark.read.schema(schema).parquet(folded_path).where(F.col("batch") == batch_id)
        newest = df.agg(F.max(F.unix_micros(F.col("timestamp").cast("timestamp"))).alias("us")).first().us
        log.commit(rows.where("kind = 'state'").select("userId", F.col("state").alias("st"), "first_us", "first_pid", "last_pid",
                                                       F.lit(newest).cast("long").alias("us"), F.lit(batch_id).cast("long").alias("batch")), batch_id)
        commit_batch(_trace_rows(rows).where(F.col("state") == S.OFFER).select("userId", "event_id", "timestamp", "offer"), offers_path, batch_id, [])

    w = enriched_stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


def _trace_rows(folded: DataFrame) -> DataFrame:
    return folded.where("kind = 'trace'").select("userId", "event_id", F.timestamp_micros("us").cast("timestamp_ntz").alias("timestamp"),
                                                 "productId", "category", "state", "offer", "live")


def read_trace(spark: SparkSession, out_path: str) -> DataFrame:
    """The transitions of ``start_detection``."""
    return _trace_rows(spark.read.schema(S.FOLDED_SCHEMA + ", batch long").parquet(f"{out_path.rstrip('/')}/folded"))


def read_offers(spark: SparkSession, out_path: str) -> DataFrame:
    """The offers of ``start_detection``."""
    rows = spark.read.schema("userId string, event_id long, timestamp timestamp_ntz, offer string").parquet(f"{out_path.rstrip('/')}/offers")
    return rows.select("userId", "event_id", "timestamp", "offer")


# --------------------------------------------------------------- X6/X11 marts

KEPT_VERSIONS = 3  # readers that began on an older version can end


def _versions(spark: SparkSession, base: str):
    """(file system, the versions of a mart that were written to the end, oldest first)."""
    hadoop = spark._jvm.org.apache.hadoop.fs
    path = hadoop.Path(base)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [s.getPath().getName() for s in fs.listStatus(path)] if fs.exists(path) else []
    return fs, sorted(n for n in names if n.startswith("v") and fs.exists(hadoop.Path(f"{base}/{n}/_SUCCESS")))


def publish(df: DataFrame, out_dir: str, name: str) -> None:
    """K3: replace a mart in one step. Every refresh is a new version; Spark marks it as
    written at its very end, and readers take the newest marked one. So a reader sees the
    old or the new mart, never none or half. Old versions are deleted but for a few."""
    spark = df.sparkSession
    base = f"{out_dir.rstrip('/')}/{name}"
    df.write.parquet(f"{base}/v{time.time_ns():020d}")
    fs, versions = _versions(spark, base)
    for v in versions[:-KEPT_VERSIONS]:
        fs.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{base}/{v}"), True)


def read_mart(spark: SparkSession, out_dir: str, name: str, schema: StructType | None = None) -> DataFrame:
    """The current version of a mart; with its schema, no file is opened to learn it."""
    base = f"{out_dir.rstrip('/')}/{name}"
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(f"{base}/{_versions(spark, base)[1][-1]}")


# each mart's row order in its document
MART_ORDER = {
    "last_15_minutes": ["datetime"],
    "products_last_hour": ["-count", "productId", "category"],
    "latest_visitors": ["-Date and Time", "ip"],
    "category_popularity": ["-count", "category"],
    "device_type_popularity": ["_place"],
    "raw_data": ["-timestamp", "-event_id"],
    "sessions": ["datetime"],
}


def refresh_marts(spark: SparkSession, enriched_path: str, buckets_path: str | None, out_dir: str,
                  as_of: Column, buffer: str = "1 hour", documents: bool = True, panes_path: str | None = None) -> dict[str, DataFrame]:
    """Recompute every dashboard mart: from the panes if there are any, else from one
    snapshot of the trailing buffer.

    Each mart is published under its key (K3, ``read_mart``); with ``documents``
    the same marts are also published as one (key, JSON) row each (K4) under
    the key ``documents`` -- every mart is bounded (top-k, pivot, per
    category / minute / bucket), so each document is one small aggregate.
    """
    since = as_of - M.interval(buffer)
    snap = None
    try:
        if panes_path is not None:
            table = spark.read.schema(ENRICHED_SCHEMA).parquet(enriched_path)  # listed once for all marts
            marts = pane_marts(spark, panes_path, lambda start: since_time(table, start), as_of, buffer)
        else:
            snap = M.trailing(read_enriched(spark, enriched_path, since), as_of, buffer).persist()
            marts = {
                "last_15_minutes": M.visits_per_minute(snap, as_of, "15 minutes"),
                "products_last_hour": M.top_products(snap),
                "latest_visitors": M.latest_visitors(snap, as_of),
                "category_popularity": M.category_popularity(snap),
                "device_type_popularity": M.device_popularity(snap, as_of, "10 minutes"),
                "raw_data": M.raw_latest(snap),
            }
        if buckets_path is not None:
            recent = latest_bucket_counts(spark, buckets_path, as_of - M.interval(BUCKET_RETENTION))
            marts["sessions"] = M.visitors_per_bucket(recent, as_of)
        # the marts are small and independent: their jobs run side by side
        with ThreadPoolExecutor(len(marts)) as pool:
            list(pool.map(lambda item: publish(item[1], out_dir, item[0]), marts.items()))
        if documents:
            from ..sources.logs import column_json
            docs = []
            for n in marts:
                mart = read_mart(spark, out_dir, n, marts[n].schema)
                if n == "device_type_popularity":
                    place = F.array_position(F.array(*map(F.lit, M.DEVICE_PIVOT)), F.col("Device type"))
                    mart = mart.withColumn("_place", F.when(place == 0, len(M.DEVICE_PIVOT) + 1).otherwise(place))
                docs.append(column_json(mart, n, MART_ORDER[n]))
            union = docs[0]
            for d in docs[1:]:
                union = union.unionByName(d)
            publish(union, out_dir, "documents")
    finally:
        if snap is not None:
            snap.unpersist()
    return marts


def start_marts(spark: SparkSession, enriched_path: str, buckets_path: str | None, out_dir: str,
                checkpoint: str, period: str = "1 second", buffer: str = "1 hour", panes_path: str | None = None) -> StreamingQuery:
    """A ``rate`` source (one row per tick) drives the recomputation, so the
    trailing windows shrink even while no clicks arrive."""
    clock = spark.readStream.format("rate").option("rowsPerSecond", 1).load()

    def tick(df: DataFrame, batch_id: int) -> None:
        now = F.current_timestamp().cast("timestamp_ntz")
        refresh_marts(spark, enriched_path, buckets_path, out_dir, now, buffer, panes_path=panes_path)

    return (clock.writeStream.foreachBatch(tick).option("checkpointLocation", checkpoint)
            .trigger(processingTime=period).start())
