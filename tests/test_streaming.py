import datetime as dt
import os
import time

from pyspark.sql import functions as F

from clickweave.session import shared_path
from clickweave.streaming import jobs as P
from clickweave.streaming.sources import file_stream, offer_events, subscribe

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
SCHEMA = "event_id long, timestamp timestamp_ntz, userId string, category string, original_timestamp long"


def _write(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def test_bucket_counts_lose_no_late_or_future_rows(spark):
    """Batch counts are summed on read: a far-future click does not cost later ones."""
    src, out, ck = shared_path(spark, "src"), shared_path(spark, "out"), shared_path(spark, "ck")
    schema = spark.createDataFrame([], SCHEMA).schema
    hour = dt.timedelta(hours=1)
    far = T0.replace(year=2031)
    _write(spark, src, [(1, T0, "u", "x", 1), (2, far, "u", "x", 1)])
    _write(spark, src, [(4, T0 + 2 * hour, "v", "x", 1)])
    _write(spark, src, [(3, T0 - 30 * hour, "u", "x", 1), (5, T0 + 2 * hour, "v", "x", 1), (6, T0, "u", "x", 1)])
    for _ in range(2):  # the second run finds nothing new
        P.start_bucket_counts(file_stream(spark, src, schema, max_files_per_trigger=1), out, ck).awaitTermination()
    counts = P.latest_bucket_counts(spark, out)
    got = {(r.datetime, r.userId): r["count"] for r in counts.collect()}
    assert got == {(T0, "u"): 2, (T0 + 2 * hour, "v"): 2, (T0 - 30 * hour, "u"): 1, (far, "u"): 1}
    as_of = F.expr(f"TIMESTAMP_NTZ '{T0 + 3 * hour}'")
    assert tuple(P.odd_times(counts, as_of).first()) == (1, 1, 6)


def test_batch_is_written_once(spark):
    path = shared_path(spark, "once")
    df = spark.range(3)
    for _ in range(2):
        P._write_batch(df, path, 7, [])
    names = [f for f in os.listdir(path + "/batch=7") if f.endswith(".parquet")]
    P._write_batch(df, path, 7, [])
    assert spark.read.parquet(path).count() == 3
    assert names == [f for f in os.listdir(path + "/batch=7") if f.endswith(".parquet")]


def test_staging_loses_no_row_without_a_time(spark):
    from clickweave.sources.testbed import stage_time_slices
    df = spark.createDataFrame([(i, T0 + dt.timedelta(minutes=i) if i % 5 else None, "u", "x", 1) for i in range(40)], SCHEMA)
    path = shared_path(spark, "staged")
    stage_time_slices(df, path, 4, 2)
    assert sorted(r.event_id for r in spark.read.parquet(path).collect()) == list(range(40))


def test_marts_refresh_and_clock(spark):
    enriched_path = shared_path(spark, "enriched")
    rows = [(i, T0 + dt.timedelta(minutes=i), f"u{i % 3}", "1.2.3.4", None, str(i % 4), "clothing", "t", None,
             "Unknown", ["Mobile", "Desktop", "Bot"][i % 3], 30, "F", T0.date()) for i in range(90)]
    cols = ("event_id long, timestamp timestamp_ntz, userId string, ip string, userAgent string, productId string, "
            "category string, title string, birthdate date, country string, deviceType string, age int, "
            "gender string, day date")
    (spark.createDataFrame(rows, cols).withColumn("original_timestamp", F.lit(None).cast("long"))
     .withColumn("batch", F.lit(0).cast("long")).write.partitionBy("day", "batch").parquet(enriched_path))
    out = shared_path(spark, "marts")
    as_of = F.expr(f"TIMESTAMP_NTZ '{T0 + dt.timedelta(minutes=89)}'")
    P.refresh_marts(spark, enriched_path, None, out, as_of)
    top = P.read_mart(spark, out, "products_last_hour").collect()
    assert sum(r["count"] for r in top) == 60  # strict 1-hour window: minutes 30..89
    dev = {r["Device type"]: r["Total"] for r in P.read_mart(spark, out, "device_type_popularity").collect()}
    assert dev == {"Desktop": 3, "Tablet": 0, "Mobile": 3, "Other": 4}  # minutes 80..89 (> 79): 4 bots
    assert P.read_mart(spark, out, "latest_visitors").count() == 10
    docs = {r.key: r.value for r in P.read_mart(spark, out, "documents").collect()}
    assert set(docs) == {"last_15_minutes", "products_last_hour", "latest_visitors", "category_popularity",
                         "device_type_popularity", "raw_data"}
    assert docs["category_popularity"] == '{"category":{"0":"clothing"},"count":{"0":60}}'
    # the clock: a rate source ticks the same refresh (as_of = now, so empty windows)
    out2, ck = shared_path(spark, "marts2"), shared_path(spark, "ck-marts")
    q = P.start_marts(spark, enriched_path, None, out2, ck, period="1 second")
    deadline = time.time() + 60
    while time.time() < deadline and not P._versions(spark, f"{out2}/raw_data")[1]:
        time.sleep(0.5)
    q.stop()
    assert P.read_mart(spark, out2, "device_type_popularity").count() == 0


def test_published_marts_are_replaced_in_one_step(spark):
    out = shared_path(spark, "published")
    for n in range(5):
        P.publish(spark.range(n), out, "m")
        assert P.read_mart(spark, out, "m").count() == n
    assert len([v for v in os.listdir(f"{out}/m") if v.startswith("v")]) == P.KEPT_VERSIONS


def test_offer_events_subscription(spark):
    offers = spark.createDataFrame([("u1", 1, T0, "offer1"), ("u2", 2, T0, "offer2")],
                                   "userId string, event_id long, timestamp timestamp_ntz, offer string")
    ev = offer_events(offers)
    got = subscribe(ev, "special-offers", "u2").collect()
    assert [(r.streamId, r.id, r.value) for r in got] == [("u2", "offer", "offer2")]


def test_offers_stream_restart_from_checkpoint(spark):
    """Stop after half the data, restart from the checkpoint with the
    rest -- the keyed state survives and the offers equal the batch fold."""
    from clickweave.operators.sequence import detect_offers
    from clickweave.plans.catalog import _enriched
    from clickweave.sources.testbed import stage_time_slices
    from tests.conftest import SF_MID
    e = _enriched(spark, SF_MID)
    split = e.agg(F.percentile_approx(F.unix_micros(F.col("timestamp").cast("timestamp")), 0.5)).first()[0]
    us = F.unix_micros(F.col("timestamp").cast("timestamp"))
    src, out, ck = shared_path(spark, "src"), shared_path(spark, "offers"), shared_path(spark, "ck")
    for half in (e.filter(us < split), e.filter(us >= split)):
        # stage this half as time-ordered files, then (re)start the query
        stage_time_slices(half, src, 2, 2)
        q = P.start_offers(file_stream(spark, src, e.schema, max_files_per_trigger=2), out, ck, 1440)
        q.awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).select("userId", "event_id", "offer").collect())
    expect = sorted(tuple(r) for r in detect_offers(e, 1440).select("userId", "event_id", "offer").collect())
    assert got == expect and len(expect) == 26


def test_bucket_counts_restart_from_checkpoint(spark):
    """Two runs on one checkpoint give the batch (bucket, visitor) counts."""
    from clickweave.sources import testbed as TB
    from clickweave.sources.testbed import stage_time_slices
    from tests.conftest import SF_SMALL
    c = TB.clicks(spark, SF_SMALL)
    split = c.agg(F.percentile_approx(F.unix_micros(F.col("timestamp").cast("timestamp")), 0.5)).first()[0]
    us = F.unix_micros(F.col("timestamp").cast("timestamp"))
    src, out, ck = shared_path(spark, "src"), shared_path(spark, "buckets"), shared_path(spark, "ck")
    for half in (c.filter(us < split), c.filter(us >= split)):
        stage_time_slices(half, src, 2, 2)
        P.start_bucket_counts(file_stream(spark, src, c.schema, max_files_per_trigger=2), out, ck).awaitTermination()
    from clickweave.operators.metrics import user_bucket_counts
    got = sorted(tuple(r) for r in P.latest_bucket_counts(spark, out).collect())
    assert got == sorted(tuple(r) for r in user_bucket_counts(c).collect())


def test_visitors_of_a_group_keep_their_own_sequences(spark, monkeypatch):
    """All visitors in one call a batch; each goes on from their own state."""
    from clickweave.operators.sequence import detect_offers
    from clickweave.streaming import detector
    monkeypatch.setattr(detector, "VISITOR_GROUPS", 1)
    schema = SCHEMA + ", productId string, gender string, age int"
    src, out, ck = shared_path(spark, "src"), shared_path(spark, "offers"), shared_path(spark, "ck")
    rows, n = [], 0
    for step, category in enumerate(["clothing", "shoes", "clothing", "shoes", "clothing", "clothing"]):
        batch = []
        for user in range(12):
            n += 1
            kind = "books" if (step + user) % 5 == 0 else category
            at = T0 + dt.timedelta(minutes=20 * step + user % 3)
            batch.append((n, at, f"u{user}", kind, None, None if user == 7 else f"p{(step * user) % 4}", "FM"[user % 2], 20 + 3 * user))
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(src)
        rows += batch
    clicks = spark.createDataFrame(rows, schema)
    for _ in range(2):  # the second run finds nothing new
        P.start_offers(file_stream(spark, src, clicks.schema, max_files_per_trigger=1), out, ck, 50).awaitTermination()
    got = sorted(tuple(r) for r in spark.read.parquet(out).collect())
    assert got == sorted(tuple(r) for r in detect_offers(clicks, 50).collect()) and got


def test_a_staged_slice_is_read_alone(spark):
    from clickweave.sources.testbed import stage_time_slices
    df = spark.createDataFrame([(i, T0 + dt.timedelta(minutes=i) if i % 5 else None, "u", "x", 1) for i in range(40)], SCHEMA)
    path = shared_path(spark, "staged")
    stage_time_slices(df, path, 4, 2)
    folder, name = os.path.split(path)
    whole, = [f"{folder}/{f}" for f in os.listdir(folder) if f.startswith(f"{name}-whole-")]
    ids = [sorted(r.event_id for r in spark.read.schema(df.schema).parquet(f"{whole}/_slice={i}").collect()) for i in range(4)]
    timed = [i for i in range(40) if i % 5]
    assert sorted(sum(ids, [])) == list(range(40)) and set(range(0, 40, 5)) <= set(ids[0])
    assert [i for part in ids for i in part if i % 5] == timed


def test_batches_broadcast_only_small_tables(spark):
    """A table above the limit is joined by a shuffle, in the batches alone; rows stay the same."""
    from clickweave.sources import dimensions as D
    from clickweave.streaming.sources import CLICK_SCHEMA
    base, src, out, ck = (shared_path(spark, n) for n in ("dims", "src", "enriched", "ck"))
    n = 40000
    products = spark.range(n).select(F.col("id").cast("string").alias("id"), F.lit("clothing").alias("category"), F.sha2(F.col("id").cast("string"), 256).alias("title"))
    visitors = spark.createDataFrame([("u1", "1990-01-02", "F")], "userId string, birthDate string, gender string")
    ranges = spark.createDataFrame([(0, 1 << 24, "N0")], "lo long, hi long, code string")
    countries = spark.createDataFrame([("N0", "Here")], "code string, name string")
    D.publish(spark, base, products, visitors, ranges, countries)
    clicks = [(i, T0, None, "u1", "0.0.0.9", None, None, None, str(i * 1000)) for i in range(50)]
    spark.createDataFrame(clicks, CLICK_SCHEMA).write.parquet(src)
    plans = []

    def commit(df, path, batch_id, cols):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        P.commit_batch(df, path, batch_id, cols)

    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    P.start_enrichment(file_stream(spark, src, CLICK_SCHEMA), D.DimensionReader(spark, base), out, ck, commit=commit).awaitTermination()
    assert spark.conf.get("spark.sql.autoBroadcastJoinThreshold") == before
    assert len(plans) == 1 and plans[0].count("SortMergeJoin") == 1 and plans[0].count("BroadcastHashJoin") == 2
    got = {r.event_id: (r.title is not None and r.title != "Unknown", r.country, r.gender) for r in P.read_enriched(spark, out).collect()}
    assert got == {i: (i * 1000 < n, "Here", "F") for i in range(50)}
