"""Named queries over the test tables: ``name -> (spark, sf_dir) -> DataFrame``.

Every query reads whole test tables (through the adapter in
``sources.testbed``) so its work grows with the scale factor. Parameters
that the reference takes from wall-clock time use ``as_of = max(event time)``.
The reference's trailing windows are minutes to an hour over a live stream;
the test events are ~0.2-2 clicks per minute, so the marts over the raw
buffer use a 7-day buffer (``BUFFER``) and a 1-day device window, while the
chart queries keep the reference's own 15-minute / 8.5-hour windows.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions.device import device_type
from ..functions.temporal import age_from_birthdate, relative_time
from ..functions.visitors import gender_label
from ..operators import enrich as E
from ..operators import metrics as M
from ..operators import ordered as O
from ..operators import sequence as S
from ..operators import setops as U
from ..operators import upsert as K
from ..operators.range_join import ip_to_long, range_lookup
from ..sources import dimensions as D
from ..sources import logs as L
from ..sources import packets as PK
from ..sources import testbed as TB
from ..sources.files import normalise_log, read_click_log, write_click_log

# query parameters
BUFFER = "7 days"
DEVICE_WINDOW = "1 day"
MERGE_SPLIT = "2024-01-15 00:00:00"
PAGE_ID_PATTERN = r"https?://[\w.]+/\w+/(\w+)"
CATEGORY_SELECTION = ["clothing", "shoes"]
OFFER_WINDOW_MINUTES = 1440
RELATIVE_TIME_SHIFT_HOURS = 12
LOG_KEEP, LOG_SHOW = 10, 8
TOP_PRODUCTS_ORDER = ["-count", "productId", "category"]
LATE_DAYS, FUTURE_YEARS = 30, 7
CATALOGUE_TASKS = 4
HOST_SERVICE = "www"
TOPIC_DELAY_SECONDS = 7
PANE_MINUTES = "2 hours"
REPLAY_SPEED = 48


def _as_of(clicks: DataFrame) -> Column:
    return M.default_as_of(clicks)


def _lookups(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The dimension tables, published in the shared folder once per state of their source files."""
    def load() -> tuple[DataFrame, ...]:
        return TB.products(spark, sf), TB.visitors(spark, sf), TB.ip_ranges(spark, sf), TB.countries(spark, sf)
    return D.published(spark, [f"{sf.rstrip('/')}/{t}.parquet" for t in ("part", "customer", "nation")], load)


def _enriched(spark: SparkSession, sf: str) -> DataFrame:
    return E.enrich_prepared(TB.clicks(spark, sf), _lookups(spark, sf))


def _buffer(spark: SparkSession, sf: str) -> tuple[DataFrame, Column]:
    """The trailing clicks, not enriched: each mart adds only what it reads."""
    c = TB.clicks(spark, sf)
    as_of = _as_of(c)
    return M.trailing(c, as_of, BUFFER), as_of


def _product_buffer(spark: SparkSession, sf: str) -> DataFrame:
    b, _ = _buffer(spark, sf)
    return E.with_product(b, _lookups(spark, sf)["products"], prepared=True)


def _device_buffer(spark: SparkSession, sf: str) -> tuple[DataFrame, Column]:
    b, as_of = _buffer(spark, sf)
    return b.withColumn("deviceType", device_type("userAgent")), as_of


# ----------------------------------------------------------------- enrichment

def q_enrich_clicks(spark, sf):
    return _enriched(spark, sf)


def q_country_by_ip(spark, sf):
    return E.with_prepared_country(TB.clicks(spark, sf), _lookups(spark, sf)["country_ranges"]).select("event_id", "ip", "country")


def q_known_product_clicks(spark, sf):
    t = TB.load(spark, sf)
    return E.known_product_clicks(t["clicks"], t["products"]).select("event_id", "userId", "productId")


def q_product_id_from_url(spark, sf):
    pages = TB.read_table(spark, sf, "pages")
    return pages.select("page_id", "url",
                        T.product_id_from_url("url", PAGE_ID_PATTERN, 1).alias("productId"))


def q_normalised_log(spark, sf):
    """S1 + P1 + F1 + F2 + P2: raw log written as TSV, read back, normalised."""
    from ..session import shared_path
    path = shared_path(spark, "click-log")
    write_click_log(L.raw_log_from_events(TB.read_table(spark, sf, "events")), path)
    return normalise_log(read_click_log(spark, path))


def q_visitor_age(spark, sf):
    v = TB.visitors(spark, sf)
    as_of = _as_of(TB.clicks(spark, sf))
    return v.select("userId", "birthDate", age_from_birthdate("birthDate", as_of).alias("age"))


def q_gender_label(spark, sf):
    e = E.with_gender(TB.clicks(spark, sf), _lookups(spark, sf)["visitors"], prepared=True)
    return e.select("event_id", "gender", gender_label("gender").alias("genderLabel"))


def q_device_type(spark, sf):
    c = TB.clicks(spark, sf)
    return c.select("event_id", "userAgent", device_type("userAgent").alias("deviceType"))


def q_relative_time(spark, sf):
    c = TB.clicks(spark, sf)
    as_of = _as_of(c) - F.make_dt_interval(hours=F.lit(RELATIVE_TIME_SHIFT_HOURS))
    return c.select("event_id", "timestamp", relative_time("timestamp", as_of).alias("relativeTime"))


def q_price_label(spark, sf):
    p = TB.products(spark, sf)
    return p.select("id", T.price_label("price").alias("priceLabel"),
                    T.title_case("title").alias("displayTitle"))


# ------------------------------------------------------------------- buckets

def q_user_bucket_counts(spark, sf):
    return M.user_bucket_counts(TB.clicks(spark, sf))


def q_merge_partials(spark, sf):
    c = TB.clicks(spark, sf)
    split = F.lit(MERGE_SPLIT).cast("timestamp_ntz")
    old = M.user_bucket_counts(c.filter(F.col("timestamp") < split))
    new = M.user_bucket_counts(c.filter(F.col("timestamp") >= split))
    return M.merge_partials(old, new)


def q_visitors_per_bucket(spark, sf):
    c = TB.clicks(spark, sf)
    return M.recent_visitors_per_bucket(c, _as_of(c))


def q_visits_per_minute(spark, sf):
    c = TB.clicks(spark, sf)
    return M.visits_per_minute(c, _as_of(c))


def q_visits_dense_15m(spark, sf):
    c = TB.clicks(spark, sf)
    return M.visits_dense_15m(c, _as_of(c))


def q_sessions_dense_8h(spark, sf):
    c = TB.clicks(spark, sf)
    as_of = _as_of(c)
    return M.sessions_dense_8h(M.user_bucket_counts(M.trailing(c, as_of, "8 hours 30 minutes", inclusive=True)), as_of)


# ---------------------------------------------------------------- popularity

def q_top_products(spark, sf):
    return M.top_products(_product_buffer(spark, sf))


def q_category_popularity(spark, sf):
    return M.category_popularity(_product_buffer(spark, sf))


def q_device_counts(spark, sf):
    b, as_of = _device_buffer(spark, sf)
    return M.device_counts(b, as_of, DEVICE_WINDOW)


def q_device_popularity(spark, sf):
    b, as_of = _device_buffer(spark, sf)
    return M.device_popularity(b, as_of, DEVICE_WINDOW)


def q_device_share(spark, sf):
    b, as_of = _device_buffer(spark, sf)
    return M.device_popularity(b, as_of, DEVICE_WINDOW, with_share=True)


def q_device_total(spark, sf):
    """G8: "Total devices" = sum of the device pivot."""
    b, as_of = _device_buffer(spark, sf)
    return M.grand_total(M.device_popularity(b, as_of, DEVICE_WINDOW), "Total", "total_devices")


def q_axis_bound(spark, sf):
    return M.axis_bound(M.category_popularity(_product_buffer(spark, sf)))


def q_category_list(spark, sf):
    return M.category_list(TB.products(spark, sf))


def q_category_filter(spark, sf):
    return M.category_filter(TB.products(spark, sf), CATEGORY_SELECTION).select("id", "category")


def q_latest_visitors(spark, sf):
    """The newest rows first, then only these are enriched."""
    b, as_of = _buffer(spark, sf)
    last = b.orderBy(F.desc("event_id")).limit(M.LATEST)
    return M.latest_visitors(E.with_prepared_country(last, _lookups(spark, sf)["country_ranges"]), as_of)


def q_raw_latest(spark, sf):
    b, _ = _buffer(spark, sf)
    last = b.orderBy(F.desc("timestamp"), F.desc("event_id")).limit(M.RAW_LATEST)
    return M.raw_latest(E.enrich_prepared(last, _lookups(spark, sf)))


# --------------------------------------------------------------- row order

def q_drop_refreshes(spark, sf):
    return O.drop_refreshes(TB.clicks(spark, sf)).select("event_id", "userId", "productId")


def _replay_log(spark, sf):
    return L.raw_log_from_events(TB.read_table(spark, sf, "events")).select(
        "event_id", F.col("Unix Timestamp").cast("double").alias("original_timestamp"))


def q_replay_delays(spark, sf):
    return O.replay_schedule(_replay_log(spark, sf)).select("event_id", "delay")


def q_replay_schedule(spark, sf):
    return O.replay_schedule(_replay_log(spark, sf))


# ------------------------------------------------------------------ set ops

def q_align_union(spark, sf):
    c = TB.clicks(spark, sf)
    live = c.filter(F.col("original_timestamp").isNull()).select(
        "event_id", "timestamp", "userId", "productId", "age", "gender")
    replayed = c.filter(F.col("original_timestamp").isNotNull()).select(
        "event_id", "timestamp", "original_timestamp", "userId", "productId")
    return U.align_union(live, replayed)


def q_snapshot_changed(spark, sf):
    """The buffer now and a day ago: only clicks that one of them lacks are enriched and compared."""
    c = TB.clicks(spark, sf)
    as_of = _as_of(c)
    return U.marked_diff(E.enrich_prepared(U.period_diff(c, *_snapshots(as_of)), _lookups(spark, sf), keep=["_d"]))


def _snapshots(as_of: Column) -> tuple[Column, Column]:
    """Conditions of the buffer now, and a day ago."""
    ts, buffer, day = F.col("timestamp"), M.interval(BUFFER), F.make_dt_interval(days=F.lit(1))
    return ts > as_of - buffer, (ts <= as_of - day) & (ts > as_of - day - buffer)


def q_snapshot_digest(spark, sf):
    """Did the buffer change within a day? By additive digests of both."""
    c = TB.clicks(spark, sf)
    now, before = _snapshots(_as_of(c))
    return U.same_rows(c.where(now), c.where(before))


def q_visitor_upsert(spark, sf):
    cust = TB.read_table(spark, sf, "customer")
    old = TB.visitors(spark, sf)
    return K.upsert_fields(old, K.visitor_updates_from_customers(cust), "userId", ["birthDate", "gender"])


# ----------------------------------------------------------------- packets

def q_packet_rows(spark, sf):
    packets = PK.click_packets(TB.clicks(spark, sf))
    return PK.packet_rows(packets)


# --------------------------------------------------------------- sequences

def _offers(window: int):
    def q(spark, sf):
        return S.detect_offers(_enriched(spark, sf), window)
    return q


def q_offers_default_window(spark, sf):
    """The reference's 30 minutes, on a replay of the clicks at ``REPLAY_SPEED`` times their pace."""
    fast = TB.faster(TB.clicks(spark, sf), REPLAY_SPEED)
    return S.detect_offers(E.enrich_prepared(fast, _lookups(spark, sf)), S.DEFAULT_WINDOW_MINUTES)


# Another rule table. A visitor reaches a page without a product ("lost") and finds clothing or
# shoes of another product again; the code is the category found.
RECOVERY_RULE = S.SequenceRule(
    labels={"no_product": lambda: F.col("category") == "Unknown", "wares": lambda: F.col("category").isin("clothing", "shoes")},
    steps=(S.Step("init", "no_product", "lost"), S.Step("lost", "no_product", "lost"), S.Step("lost", "wares", "recovered", "other")),
    emits="recovered",
    code=lambda: F.col("category"),
)


def q_recoveries(spark, sf):
    c = E.with_product(TB.clicks(spark, sf), _lookups(spark, sf)["products"], prepared=True)
    return S.detect_sequence(c, RECOVERY_RULE, OFFER_WINDOW_MINUTES)


def q_offer_events(spark, sf):
    """K2: every offer as the event the shop subscribes to (stream = visitor)."""
    from ..streaming.sources import offer_events
    o = S.detect_offers(_enriched(spark, sf), OFFER_WINDOW_MINUTES)
    return offer_events(o).drop("tags")


def q_offer_summary(spark, sf):
    o = S.detect_offers(_enriched(spark, sf), OFFER_WINDOW_MINUTES)
    return o.groupBy("offer").agg(F.count(F.lit(1)).alias("offers"),
                                  F.countDistinct("userId").alias("visitors"))


def q_transition_log(spark, sf):
    trace = S.sequence_trace(_enriched(spark, sf), OFFER_WINDOW_MINUTES)
    return L.transition_log(trace)


def q_log_tail(spark, sf):
    trace = S.sequence_trace(_enriched(spark, sf), OFFER_WINDOW_MINUTES)
    return L.log_tail(L.transition_log(trace), LOG_KEEP, LOG_SHOW)


def q_snapshot_json(spark, sf):
    """K4: the top products as one document, in the mart's order."""
    top = M.top_products(_product_buffer(spark, sf))
    return L.column_json(top, "top_products", order=TOP_PRODUCTS_ORDER)


def q_snapshot_roundtrip(spark, sf):
    """K4 + S7: top products -> JSON document -> rows again."""
    doc = L.column_json(M.top_products(_product_buffer(spark, sf)), "products_last_hour", order=TOP_PRODUCTS_ORDER)
    return L.rows_from_column_json(doc, [("productId", "string"), ("category", "string"), ("count", "bigint")])


# ---------------------------------------------------------------- streaming

STREAM_SLICES = 4


def _staged(spark, sf, what: str) -> tuple[str, object, int]:
    """Stage the click (or enriched) table as time-ordered files; returns
    (path, schema, files per micro-batch)."""
    from ..session import shared_path
    df = TB.clicks(spark, sf) if what == "clicks" else _enriched(spark, sf)
    path = shared_path(spark, f"stage-{what}")
    per = spark.sparkContext.defaultParallelism
    TB.stage_time_slices(df, path, STREAM_SLICES, per)
    return path, df.schema, per


def _run(q) -> None:
    q.awaitTermination()
    if q.exception() is not None:
        raise q.exception()


def q_stream_enrich(spark, sf):
    """Click stream -> foreachBatch enrichment (dims re-read per batch)."""
    from ..session import shared_path
    from ..streaming.jobs import read_enriched, start_enrichment
    from ..streaming.sources import file_stream
    path, schema, per = _staged(spark, sf, "clicks")
    out, ck = shared_path(spark, "enriched"), shared_path(spark, "ck-enrich")
    stream = file_stream(spark, path, schema, max_files_per_trigger=per)
    _run(start_enrichment(stream, lambda: _lookups(spark, sf), out, ck))
    return read_enriched(spark, out)


def q_stream_bucket_counts(spark, sf):
    """Partial counts of every micro-batch in a levelled log, summed."""
    from ..session import shared_path
    from ..streaming.jobs import latest_bucket_counts, start_bucket_counts
    from ..streaming.sources import file_stream
    path, schema, per = _staged(spark, sf, "enriched")
    out, ck = shared_path(spark, "buckets"), shared_path(spark, "ck-buckets")
    _run(start_bucket_counts(file_stream(spark, path, schema, max_files_per_trigger=per), out, ck))
    return latest_bucket_counts(spark, out)


def _odd_clicks(spark, sf) -> DataFrame:
    """Clicks of which some are dated far in the future and some arrive late."""
    shift = (F.when(F.col("event_id") % 97 == 0, F.make_ym_interval(F.lit(FUTURE_YEARS), F.lit(0))))
    late = F.when(F.col("event_id") % 89 == 0, F.col("timestamp") - F.make_dt_interval(days=F.lit(LATE_DAYS)))
    c = TB.clicks(spark, sf)
    return c.withColumn("timestamp", F.coalesce(F.col("timestamp") + shift, late, F.col("timestamp")))


def _odd_buckets(spark, sf) -> DataFrame:
    """The clicks arrive in the order of their ids, not of their times."""
    from ..session import shared_path
    from ..streaming.jobs import latest_bucket_counts, start_bucket_counts
    from ..streaming.sources import file_stream
    df, path, per = _odd_clicks(spark, sf), shared_path(spark, "stage-odd"), spark.sparkContext.defaultParallelism
    TB.stage_time_slices(df, path, STREAM_SLICES, per, ts="event_id")
    out = shared_path(spark, "odd-buckets")
    _run(start_bucket_counts(file_stream(spark, path, df.schema, max_files_per_trigger=per), out, shared_path(spark, "ck-odd")))
    return latest_bucket_counts(spark, out)


def q_stream_odd_times(spark, sf):
    """Late and future-dated clicks are all counted."""
    return _odd_buckets(spark, sf)


def q_odd_time_counts(spark, sf):
    """How many counted clicks are late or in the future."""
    from ..streaming.jobs import odd_times
    return odd_times(_odd_buckets(spark, sf), _as_of(TB.clicks(spark, sf)))


# ------------------------------------------------------- single operators

def q_catalogue_files(spark, sf):
    """The catalogue written as a JSON array per task, read back."""
    from ..session import shared_path
    from ..sources.files import read_products, write_products
    path = shared_path(spark, "products-json")
    write_products(TB.products(spark, sf).repartition(CATALOGUE_TASKS), path)
    return read_products(spark, path).select("id", "category", "title", "price")


def q_visitor_files(spark, sf):
    """S3: visitors as JSON Lines, read back."""
    from ..session import shared_path
    from ..sources.files import read_visitors
    path = shared_path(spark, "visitors-jsonl")
    TB.visitors(spark, sf).write.json(path)
    return read_visitors(spark, path)


def q_keyed_messages(spark, sf):
    """K1 + K8: clicks as keyed messages whose header names the stream (visitor) they came from."""
    from ..streaming.sources import to_keyed_messages
    c = TB.clicks(spark, sf).select("event_id", "userId", "productId")
    m = to_keyed_messages(c, "userId", "userId")
    return m.select("key", "value", F.col("headers")[0]["key"].alias("header"), F.col("headers")[0]["value"].cast("string").alias("parent"))


def q_offer_subscription(spark, sf):
    """The offers of the visitor with the smallest id that has one."""
    from ..streaming.sources import offer_events, subscribe
    events = offer_events(S.detect_offers(_enriched(spark, sf), OFFER_WINDOW_MINUTES)).drop("tags")
    first = events.agg(F.min("streamId")).first()[0]
    return subscribe(events, "special-offers", first)


def q_product_detail(spark, sf):
    """One product by its id, out of the whole catalogue."""
    p = TB.products(spark, sf)
    return M.product_by_id(p, p.agg(F.max("id")).first()[0])


def q_offers_demographics(spark, sf):
    """P10: the detector skips clicks without age or gender."""
    return S.detect_offers(_enriched(spark, sf), OFFER_WINDOW_MINUTES, require_demographics=True)


def q_stream_visitors_per_bucket(spark, sf):
    """G3 on the streamed bucket table."""
    buckets = q_stream_bucket_counts(spark, sf)
    return M.visitors_per_bucket(buckets, _as_of(TB.clicks(spark, sf)))


def q_stream_offers(spark, sf):
    """X1 keyed state (transformWithStateInPandas) over time-ordered batches."""
    from ..session import shared_path
    from ..streaming.jobs import start_offers
    from ..streaming.sources import file_stream
    path, schema, per = _staged(spark, sf, "enriched")
    out, ck = shared_path(spark, "offers"), shared_path(spark, "ck-offers")
    _run(start_offers(file_stream(spark, path, schema, max_files_per_trigger=per), out, ck, OFFER_WINDOW_MINUTES))
    return spark.read.parquet(out)


# ------------------------------------------------ lookups, files and topics

def q_overlapping_ranges(spark, sf):
    """Clicks looked up in ranges that overlap and nest: one row a click, with the narrowest range's code."""
    c = TB.clicks(spark, sf).select("event_id", "ip", ip_to_long("ip").alias("_n"))
    return range_lookup(c, "_n", TB.overlapping_ranges(spark, sf), ["code"]).select("event_id", "ip", "code")


def q_stream_enrich_versions(spark, sf):
    """Visitors are updated (K5) between two micro-batches; later clicks see the new version."""
    from ..session import shared_path
    from ..streaming.jobs import read_enriched, start_enrichment
    from ..streaming.sources import file_stream
    base, path, out, ck = (shared_path(spark, n) for n in ("dims", "stage-versions", "enriched", "ck-versions"))
    c, per = TB.clicks(spark, sf), spark.sparkContext.defaultParallelism
    split = F.lit(MERGE_SPLIT).cast("timestamp_ntz")
    reader = D.DimensionReader(spark, base)
    rest = (TB.ip_ranges(spark, sf), TB.countries(spark, sf))
    visitors = TB.visitors(spark, sf)
    updated = q_visitor_upsert(spark, sf)
    for table, part in ((visitors, c.where(F.coalesce(F.col("timestamp") < split, F.lit(True)))), (updated, c.where(F.col("timestamp") >= split))):
        D.publish(spark, base, TB.products(spark, sf), table, *rest)
        part.repartition(per).write.mode("append").parquet(path)
        _run(start_enrichment(file_stream(spark, path, c.schema, max_files_per_trigger=per), reader, out, ck))
    return read_enriched(spark, out)


def q_log_file_order(spark, sf):
    """S1 + W1: a log of many files, numbered in file order, and each row's delay to the next one."""
    from ..session import shared_path
    from ..sources.files import numbered
    path = shared_path(spark, "click-log-files")
    log = L.raw_log_from_events(TB.read_table(spark, sf, "events"))
    write_click_log(log.repartitionByRange(2 * spark.sparkContext.defaultParallelism, "event_id").sortWithinPartitions("event_id"), path)
    rows = numbered(normalise_log(read_click_log(spark, path)), "line")
    delays = O.replay_schedule(rows.select("line", F.col("original_timestamp").cast("double").alias("original_timestamp")), order="line")
    return rows.join(delays, "line").select("line", "userId", "productId", "original_timestamp", "delay")


def _topic(spark, sf) -> DataFrame:
    """The clicks as rows of a topic: two partitions by visitor, appended some seconds after the click."""
    from ..streaming.sources import to_keyed_messages
    c = TB.clicks(spark, sf)
    messages = to_keyed_messages(c)
    parsed = F.from_json("value", "event_id long, timestamp timestamp_ntz")
    late = F.make_dt_interval(secs=F.col("_v.event_id") % TOPIC_DELAY_SECONDS)
    return (messages.withColumn("_v", parsed)
            .select(F.col("key").cast("binary").alias("key"), F.col("value").cast("binary").alias("value"),
                    (F.crc32(F.col("key").cast("binary")) % 2).cast("int").alias("partition"), F.col("_v.event_id").alias("offset"),
                    (F.col("_v.timestamp") + late).cast("timestamp").alias("timestamp")))


def q_topic_arrival(spark, sf):
    """S4 + W4: messages parsed and enriched; the last visitors by arrival in the topic."""
    from ..streaming.sources import ARRIVAL, parse_topic
    clicks = parse_topic(_topic(spark, sf))
    as_of = _as_of(TB.clicks(spark, sf))
    last = clicks.orderBy(*[F.desc(c) for c in ARRIVAL]).limit(M.LATEST)
    return M.latest_visitors(E.enrich_prepared(last, _lookups(spark, sf)), as_of, arrival=ARRIVAL)


def q_lookup_keys(spark, sf):
    """the lookup keys of products and visitors."""
    p = TB.products(spark, sf).select(T.product_key("id").alias("key"), T.topic_id(F.lit("shop"), "category").alias("topic"))
    v = TB.visitors(spark, sf).select(T.visitor_key("userId").alias("key"), T.topic_id(F.lit("shop"), F.lit("visitors")).alias("topic"))
    return p.unionByName(v)


def q_asset_paths(spark, sf):
    """image paths of the products and of the offers that clicks can trigger."""
    from ..functions.visitors import offer_for_gender
    p = TB.products(spark, sf).select("id", T.product_image_path(F.concat("id", F.lit(".jpg"))).alias("path"))
    v = TB.visitors(spark, sf).select(F.col("userId").alias("id"), T.offer_image_path(offer_for_gender("gender")).alias("path"))
    return p.unionByName(v)


def q_text_cleanup(spark, sf):
    """first line feed removed, and the label behind a host's service label."""
    docs = TB.read_table(spark, sf, "documents").select(F.lit("document").alias("kind"), F.col("doc_id").alias("id"), T.strip_first_line_feed("text").alias("text"))
    pages = TB.read_table(spark, sf, "pages").select(F.lit("page").alias("kind"), F.col("page_id").alias("id"), T.subdomain("url", HOST_SERVICE).alias("text"))
    return docs.unionByName(pages).select("kind", "id", F.sha2("text", 256).alias("text_sha256"))


def q_age_domain(spark, sf):
    """F27 + F3: visitors whose age the shop accepts."""
    from ..functions.visitors import valid_age
    v = TB.visitors(spark, sf)
    aged = v.select("userId", age_from_birthdate("birthDate", _as_of(TB.clicks(spark, sf))).alias("age"))
    return aged.select("userId", "age", valid_age("age").alias("valid"))


def q_click_lag(spark, sf):
    """seconds from a replayed click's original time to its own."""
    from ..functions.temporal import seconds_between
    c = TB.clicks(spark, sf).where(F.col("original_timestamp").isNotNull())
    return c.select("event_id", seconds_between(F.timestamp_seconds("original_timestamp"), "timestamp").alias("lag"))


def q_arrival_stamp(spark, sf):
    """P5: every click is stamped with the time it is published (how many, and whether before the query's end)."""
    from ..streaming.sources import stamp_arrival
    stamped = stamp_arrival(TB.clicks(spark, sf), "published")
    early = F.col("published") > F.col("timestamp")
    return stamped.agg(F.count("published").alias("stamped"), F.count(F.when(early, 1)).alias("later_than_click"))


# ------------------------------------------------------- commits, logs and panes

def q_stream_recovery(spark, sf):
    """The enrichment breaks off once before a batch's manifest and once behind it, and is started again:
    clicks per day of the enriched table."""
    from ..session import shared_path
    from ..streaming import commits
    from ..streaming.jobs import start_enrichment
    from ..streaming.sources import file_stream
    path, schema, per = _staged(spark, sf, "clicks")
    out, ck = shared_path(spark, "enriched"), shared_path(spark, "ck-recovery")
    lookups = _lookups(spark, sf)
    for step in ("before manifest", "behind manifest", None):
        stream = file_stream(spark, path, schema, max_files_per_trigger=per)
        q = start_enrichment(stream, lambda: lookups, out, ck, commit=commits.breaking_off(step, 1) if step else commits.commit_batch)
        try:
            _run(q)
        except StreamingQueryException as e:
            if step is None or f"broken off {step}" not in str(e):
                raise
    days = spark.read.parquet(out).groupBy("day").agg(F.count(F.lit(1)).alias("clicks"), F.countDistinct("event_id").alias("ids"))
    return days.select("day", "clicks", "ids")


def q_stream_bucket_compaction(spark, sf):
    """X4 + X7: more micro-batches than a level of the log holds: levels are merged on the way, counts stay."""
    from ..session import shared_path
    from ..streaming.jobs import latest_bucket_counts, start_bucket_counts
    from ..streaming.sources import file_stream
    path, schema, per = _staged(spark, sf, "clicks")
    out, ck = shared_path(spark, "buckets"), shared_path(spark, "ck-compaction")
    few = max(1, per * STREAM_SLICES // 12)
    _run(start_bucket_counts(file_stream(spark, path, schema, max_files_per_trigger=few), out, ck))
    return latest_bucket_counts(spark, out)


def _panes(spark, sf) -> tuple[str, str]:
    """(enriched table, panes) of the clicks, as the services leave them."""
    from ..session import shared_path
    from ..streaming.jobs import start_enrichment
    from ..streaming.panes import start_panes
    from ..streaming.sources import ENRICHED_SCHEMA, file_stream
    path, schema, per = _staged(spark, sf, "clicks")
    enriched, panes = shared_path(spark, "enriched"), shared_path(spark, "panes")
    lookups = _lookups(spark, sf)
    _run(start_enrichment(file_stream(spark, path, schema, max_files_per_trigger=per), lambda: lookups, enriched, shared_path(spark, "ck-enrich")))
    _run(start_panes(file_stream(spark, enriched, ENRICHED_SCHEMA), panes, shared_path(spark, "ck-panes")))
    return enriched, panes


def q_pane_marts(spark, sf):
    """X6 + X11: the marts from panes, as rows (mart, name, count)."""
    from ..streaming.jobs import read_enriched
    from ..streaming.panes import pane_marts
    enriched, panes = _panes(spark, sf)
    as_of = _as_of(TB.clicks(spark, sf))
    marts = pane_marts(spark, panes, lambda since: read_enriched(spark, enriched, since), as_of, BUFFER, PANE_MINUTES, DEVICE_WINDOW)
    named = {
        "last_15_minutes": (F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"), F.col("count")),
        "products_last_hour": (F.concat_ws("|", "productId", "category"), F.col("count")),
        "category_popularity": (F.col("category"), F.col("count")),
        "device_type_popularity": (F.col("Device type"), F.col("Total")),
        "latest_visitors": (F.concat_ws("|", "Date and Time", "ip", "country"), F.lit(1).cast("long")),
        "raw_data": (F.col("userId"), F.col("event_id")),
    }
    out = None
    for mart, (name, count) in named.items():
        rows = marts[mart].select(F.lit(mart).alias("mart"), name.alias("name"), count.alias("count"))
        out = rows if out is None else out.unionByName(rows)
    return out


def _detected(spark, sf, **options) -> str:
    from ..session import shared_path
    from ..streaming.jobs import start_detection
    from ..streaming.sources import file_stream
    path, schema, per = _staged(spark, sf, "enriched")
    out = shared_path(spark, "detection")
    _run(start_detection(file_stream(spark, path, schema, max_files_per_trigger=per), out, shared_path(spark, "ck-detection"), OFFER_WINDOW_MINUTES, **options))
    return out


def q_stream_detection(spark, sf):
    """X1 + X9 + X10 + K7 in one stream: the log lines of its live transitions (offers included)."""
    from ..streaming.jobs import read_trace
    return L.transition_log(read_trace(spark, _detected(spark, sf)))


def q_stream_expiry(spark, sf):
    """X2 + X9: as ``stream_offers``, with states expired to tombstones when the state log is merged."""
    from ..streaming.jobs import read_offers
    return read_offers(spark, _detected(spark, sf, lateness="0 seconds"))


def q_stream_progress(spark, sf):
    """The rows that a listener saw pass through the enrichment, batch by batch."""
    from ..session import shared_path
    from ..streaming.jobs import start_enrichment
    from ..streaming.progress import ProgressTable, await_reports, counted, read_progress
    from ..streaming.sources import file_stream
    path, schema, per = _staged(spark, sf, "clicks")
    out = shared_path(spark, "progress")
    table = ProgressTable(spark, out)
    lookups = _lookups(spark, sf)
    spark.streams.addListener(table)
    try:
        stream, _ = counted(file_stream(spark, path, schema, max_files_per_trigger=per))
        q = start_enrichment(stream, lambda: lookups, shared_path(spark, "enriched"), shared_path(spark, "ck-progress"))
        _run(q)
        await_reports(table, q)
    finally:
        spark.streams.removeListener(table)
    return read_progress(spark, out).groupBy("name").agg(F.count(F.lit(1)).alias("batches"), F.sum("rows").alias("rows"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "enrich_clicks": q_enrich_clicks,
    "country_by_ip": q_country_by_ip,
    "known_product_clicks": q_known_product_clicks,
    "product_id_from_url": q_product_id_from_url,
    "normalised_log": q_normalised_log,
    "visitor_age": q_visitor_age,
    "gender_label": q_gender_label,
    "device_type": q_device_type,
    "relative_time": q_relative_time,
    "price_label": q_price_label,
    "user_bucket_counts": q_user_bucket_counts,
    "merge_partials": q_merge_partials,
    "visitors_per_bucket": q_visitors_per_bucket,
    "visits_per_minute": q_visits_per_minute,
    "visits_dense_15m": q_visits_dense_15m,
    "sessions_dense_8h": q_sessions_dense_8h,
    "top_products": q_top_products,
    "category_popularity": q_category_popularity,
    "device_counts": q_device_counts,
    "device_popularity": q_device_popularity,
    "device_share": q_device_share,
    "device_total": q_device_total,
    "axis_bound": q_axis_bound,
    "category_list": q_category_list,
    "category_filter": q_category_filter,
    "latest_visitors": q_latest_visitors,
    "raw_latest": q_raw_latest,
    "drop_refreshes": q_drop_refreshes,
    "replay_delays": q_replay_delays,
    "replay_schedule": q_replay_schedule,
    "align_union": q_align_union,
    "snapshot_changed": q_snapshot_changed,
    "visitor_upsert": q_visitor_upsert,
    "packet_rows": q_packet_rows,
    "offers": _offers(OFFER_WINDOW_MINUTES),
    "offers_default_window": q_offers_default_window,
    "offers_month_window": _offers(43200),
    "offer_events": q_offer_events,
    "recoveries": q_recoveries,
    "offer_summary": q_offer_summary,
    "transition_log": q_transition_log,
    "log_tail": q_log_tail,
    "snapshot_json": q_snapshot_json,
    "snapshot_roundtrip": q_snapshot_roundtrip,
    "stream_enrich": q_stream_enrich,
    "stream_bucket_counts": q_stream_bucket_counts,
    "stream_visitors_per_bucket": q_stream_visitors_per_bucket,
    "stream_offers": q_stream_offers,
    "stream_odd_times": q_stream_odd_times,
    "odd_time_counts": q_odd_time_counts,
    "catalogue_files": q_catalogue_files,
    "visitor_files": q_visitor_files,
    "keyed_messages": q_keyed_messages,
    "offer_subscription": q_offer_subscription,
    "product_detail": q_product_detail,
    "offers_demographics": q_offers_demographics,
    "snapshot_digest": q_snapshot_digest,
    "overlapping_ranges": q_overlapping_ranges,
    "stream_enrich_versions": q_stream_enrich_versions,
    "log_file_order": q_log_file_order,
    "topic_arrival": q_topic_arrival,
    "lookup_keys": q_lookup_keys,
    "asset_paths": q_asset_paths,
    "text_cleanup": q_text_cleanup,
    "age_domain": q_age_domain,
    "click_lag": q_click_lag,
    "arrival_stamp": q_arrival_stamp,
    "stream_recovery": q_stream_recovery,
    "stream_bucket_compaction": q_stream_bucket_compaction,
    "pane_marts": q_pane_marts,
    "stream_detection": q_stream_detection,
    "stream_expiry": q_stream_expiry,
    "stream_progress": q_stream_progress,
}
