"""Commits, run logs, versioned dimensions, panes, disjoint ranges, file order, catalogue files, progress."""
import datetime as dt
import os
import random

import pytest
from pyspark.sql import functions as F

from clickweave.operators import metrics as M
from clickweave.operators import range_join as R
from clickweave.operators import sequence as S
from clickweave.operators import setops as U
from clickweave.session import shared_path
from clickweave.sources import dimensions as D
from clickweave.sources import files
from clickweave.streaming import commits as C
from clickweave.streaming import jobs as J
from clickweave.streaming import panes as P

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)


# ---- commits

@pytest.mark.parametrize("step", ["before manifest", "behind manifest"])
def test_a_broken_commit_shows_nothing_and_is_done_once(spark, step):
    path = shared_path(spark, "commit")
    df = spark.range(100).withColumn("k", F.col("id") % 3)
    C.commit_batch(df, path, 0, ["k"])
    with pytest.raises(RuntimeError, match="broken off"):
        C.breaking_off(step, 1)(df, path, 1, ["k"])
    assert spark.read.parquet(path).count() == 100
    # a retry that reads its input in another order adds the same rows, once
    C.commit_batch(df.repartition(7), path, 1, ["k"])
    C.commit_batch(df, path, 1, ["k"])
    assert spark.read.parquet(path).count() == 200
    assert {r.batch for r in spark.read.parquet(path).select("batch").distinct().collect()} == {0, 1}


def test_an_empty_batch_is_committed(spark):
    path = shared_path(spark, "commit-empty")
    for _ in range(2):
        C.commit_batch(spark.range(0).withColumn("k", F.lit(1)), path, 0, ["k"])
    assert C.Folder(spark, path).names("_batches") == ["0"]


# ---- run logs

def _counts(spark, path, retain=None, fanout=3):
    return C.RunLog(spark, path, "k string, n long", lambda df: df.groupBy("k").agg(F.sum("n").alias("n")), retain, fanout)


def test_log_over_100_batches_keeps_few_folders(spark):
    path = shared_path(spark, "log")
    want = {}
    for b in range(100):
        rows = [(f"k{(b * i) % 11}", i + 1) for i in range(3)]
        for k, n in rows:
            want[k] = want.get(k, 0) + n
        _counts(spark, path).commit(spark.createDataFrame(rows, "k string, n long").coalesce(1), b)
        if b % 10 == 0:
            _counts(spark, path).commit(spark.createDataFrame([("twice", 1)], "k string, n long"), b)  # a retried batch
    log = _counts(spark, path)
    assert {r.k: r.n for r in log.read().collect()} == want
    _, state = log._state()
    assert len(state["runs"]) <= 3 * 5
    assert len(log.folder.names("runs")) <= 3 * 5 + 3 * C.KEPT_COMMITS and len(log.folder.names("_manifest")) <= C.KEPT_COMMITS


def test_log_that_breaks_off_before_its_manifest(spark, monkeypatch):
    path = shared_path(spark, "log-broken")
    log = _counts(spark, path, fanout=2)
    one = spark.createDataFrame([("a", 1)], "k string, n long")
    log.commit(one, 0)
    with monkeypatch.context() as m:
        m.setattr(C.Folder, "write", lambda *a: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            log.commit(one, 1)
    assert [tuple(r) for r in log.read().collect()] == [("a", 1)]
    log.commit(one, 1)
    assert [tuple(r) for r in log.read().collect()] == [("a", 2)]


def test_log_retention_at_merges(spark):
    log = _counts(spark, shared_path(spark, "log-retain"), lambda df: df.where("k <> 'old'"), fanout=2)
    for b in range(4):
        log.commit(spark.createDataFrame([("old", 1), ("new", 1)], "k string, n long"), b)
    assert {r.k: r.n for r in log.read().collect()} == {"new": 4}


def test_reading_an_empty_log(spark):
    assert _counts(spark, shared_path(spark, "log-none")).read().count() == 0


# ---- dimensions

def _raw(spark, title):
    return (spark.createDataFrame([("A", "shoes", "first", 0), ("A", "shoes", title, 1)], "id string, category string, title string, seq int"),
            spark.createDataFrame([("v", "1990-01-01", "F")], "userId string, birthDate string, gender string"),
            spark.createDataFrame([(0, 100, "a"), (50, 60, "b")], "lo long, hi long, code string"),
            spark.createDataFrame([("a", "Aland"), ("b", "Bland")], "code string, name string"))


def test_dimensions_are_opened_again_only_for_a_new_version(spark):
    path = shared_path(spark, "dims")
    reader = D.DimensionReader(spark, path)
    assert reader() == {} and reader.opened == 0
    D.publish(spark, path, *_raw(spark, "one"))
    assert [tuple(r) for r in reader()["products"].collect()] == [("A", "shoes", "one")]
    assert sorted(tuple(r)[1:] for r in reader()["country_ranges"].collect()) == [(0, 49, "Aland"), (50, 60, "Bland"), (61, 100, "Aland")]
    first = reader()
    assert reader() is first and reader.opened == 1
    for n in range(D.KEPT_VERSIONS + 1):
        D.publish(spark, path, *_raw(spark, f"t{n}"))
    assert reader()["products"].first().title == f"t{D.KEPT_VERSIONS}" and reader.opened == 2
    assert len(D._versions(C.Folder(spark, path))) == D.KEPT_VERSIONS
    # a version without its marker is not there
    _raw(spark, "half")[0].write.parquet(f"{path}/v9999999999-x/products")
    assert reader() and reader.opened == 2


def test_published_dimensions_follow_their_source(spark, tmp_path):
    src = str(tmp_path / "src.parquet")
    spark.range(3).write.parquet(src)
    loads = []

    def load():
        loads.append(1)
        return _raw(spark, "x")
    D.published(spark, [src], load)
    D.published(spark, [src], load)
    assert len(loads) == 1
    spark.range(5).write.mode("overwrite").parquet(src)
    D.published(spark, [src], load)
    assert len(loads) == 2


def test_enrichment_plan_has_no_aggregate(spark):
    import contextlib
    import io

    from clickweave.plans.catalog import _enriched
    from tests.conftest import SF_SMALL
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        _enriched(spark, SF_SMALL).explain()
    assert "Aggregate" not in buf.getvalue() and "Generate" not in buf.getvalue()


# ---- disjoint ranges

@pytest.mark.parametrize("bits", [4, 16])
def test_overlapping_ranges_have_one_winner(spark, bits):
    rng = random.Random(4)
    rows = []
    for _ in range(200):
        lo = rng.randrange(0, 3000)
        rows.append((lo, lo + rng.choice([0, 1, 5, 40, 300, 2000]), rng.choice(["a", "b", "c", None])))
    rows += [(50, 40, "bad"), (None, 9, "bad"), (7, None, "bad")]
    df = spark.createDataFrame(rows, "lo long, hi long, code string").repartition(3)
    got = {r.v: r.code for r in R.range_lookup(spark.range(0, 5200).withColumnRenamed("id", "v"), "v", df, ["code"], bits).collect()}
    assert len(got) == 5200
    for v in range(5200):
        covers = [(h - lo, -lo, (x is not None, x or ""), x) for lo, h, x in rows if lo is not None and h is not None and lo <= v <= h]
        assert got[v] == (min(covers)[3] if covers else None)


def test_disjoint_ranges_of_an_empty_table(spark):
    assert R.disjoint_ranges(spark.createDataFrame([], "lo long, hi long, code string"), ["code"]).count() == 0


# ---- files

@pytest.mark.parametrize("tasks", [1, 4, 16])
def test_catalogue_keeps_all_rows(spark, tasks):
    path = shared_path(spark, "catalogue")
    rows = spark.range(1000).select(F.col("id").cast("string").alias("id"), F.lit("c,]\"[").alias("category"), F.lit("t\n").alias("title"), F.col("id").cast("double").alias("price"))
    files.write_products(rows.repartition(tasks), path)
    back = files.read_products(spark, path)
    assert sorted(r.id for r in back.collect()) == sorted(str(i) for i in range(1000))
    assert {(r.category, r.title) for r in back.select("category", "title").collect()} == {("c,]\"[", "t\n")}


def test_empty_catalogue(spark):
    path = shared_path(spark, "catalogue-none")
    files.write_products(spark.createDataFrame([], "id string"), path)
    assert files.read_products(spark, path).count() == 0


def test_rows_are_numbered_in_file_order(spark):
    path = shared_path(spark, "lines")
    spark.range(5000).select(F.format_string("%06d", "id").alias("line")).repartitionByRange(7, "line").sortWithinPartitions("line").write.text(path)
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "3000")  # many blocks a file
    try:
        rows = files.numbered(spark.read.text(path), "n").collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert sorted((r.n, int(r.value)) for r in rows) == [(i, i) for i in range(5000)]


# ---- digests

def test_multiset_digests(spark):
    a = spark.createDataFrame([(1, None), (2, "x"), (2, "x")], "k int, v string")
    assert not U.same_rows(a, a.repartition(3)).first().changed
    assert U.same_rows(a, a.distinct()).first().changed
    assert U.same_rows(a, a.withColumn("v", F.coalesce("v", F.lit("null")))).first().changed
    none = a.where("false")
    assert tuple(U.same_rows(none, none).first()) == (0, 0, False)
    now, before = F.col("k") >= 1, F.col("k") <= 1
    got = U.marked_diff(U.period_diff(a, now, before)).first()
    want = U.snapshot_diff(a.where(now), a.where(before)).first()
    assert tuple(got) == tuple(want)


# ---- panes

ENRICHED = ("event_id long, timestamp timestamp_ntz, original_timestamp long, userId string, ip string, userAgent string, productId string, category string, "
            "title string, birthdate date, country string, deviceType string, age int, gender string")


def test_pane_marts_equal_direct_marts(spark):
    """Windows that cut a minute, late rows, null keys, a minute that holds a whole batch, more batches than a level."""
    rng = random.Random(5)
    rows = [(i, T0 + dt.timedelta(seconds=rng.randrange(0, 7200), microseconds=rng.randrange(10**6)) if i % 50 else None, None, f"u{i % 7}", f"1.1.1.{i % 5}", None,
             rng.choice([None, "A", "B", "C"]), rng.choice([None, "shoes", "clothing"]), "t", None, "Unknown", rng.choice([None, "Mobile", "Desktop", "Bot"]), 30, "F")
            for i in range(3000)]
    rows += [(5000 + i, T0 + dt.timedelta(minutes=118, microseconds=i), None, "u", "9.9.9.9", None, "A", "shoes", "t", None, "X", "Tablet", 1, "M") for i in range(400)]
    df = spark.createDataFrame(rows, ENRICHED)
    path = shared_path(spark, "panes")
    parts = df.withColumn("b", F.when(F.col("event_id") >= 5000, 9).otherwise(F.col("event_id") % 9)).persist()
    for b in range(10):
        batch = parts.where(F.col("b") == b).drop("b")
        P.count_log(spark, path).commit(P.count_panes(batch), b)
        P.newest_log(spark, path).commit(P.newest_panes(batch), b)
    as_of = F.expr(f"TIMESTAMP_NTZ '{T0 + dt.timedelta(minutes=119, seconds=31)}'")
    got = P.pane_marts(spark, path, lambda since: df.where(F.col("timestamp") > since), as_of)
    snap = M.trailing(df, as_of, "1 hour")
    want = {"last_15_minutes": M.visits_per_minute(snap, as_of, "15 minutes"), "products_last_hour": M.top_products(snap), "latest_visitors": M.latest_visitors(snap, as_of),
            "category_popularity": M.category_popularity(snap), "device_type_popularity": M.device_popularity(snap, as_of, "10 minutes"), "raw_data": M.raw_latest(snap)}
    assert set(got) == set(want)
    for name in want:
        assert got[name].columns == want[name].columns
        a, b = [tuple(r) for r in got[name].collect()], [tuple(r) for r in want[name].collect()]
        assert a and sorted(a, key=repr) == sorted(b, key=repr), name


# ---- detection

CLICKS = "userId string, event_id long, timestamp timestamp_ntz, productId string, category string, gender string, age int, original_timestamp long"


def _hot_clicks(n):
    rng = random.Random(9)
    rows = []
    for i in range(n):
        user = "hot" if i % 300 < 200 or i % 5 else f"u{i % 13}"
        rows.append((user, i, T0 + dt.timedelta(seconds=7 * i), f"p{rng.randrange(7)}", rng.choice(["clothing", "clothing", "shoes", "books"]), rng.choice(["M", "F"]), rng.choice([30, 40]), None))
    return rows


@pytest.mark.parametrize("lateness", [None, "0 seconds"])
def test_detection_with_a_visitor_that_fills_batches(spark, monkeypatch, lateness):
    """One visitor holds most of every micro-batch, over many partitions and batches: the offers and the trace of the batch
    fold; with expiry the same. No task sees more of the visitor than its partition."""
    rows = _hot_clicks(2400)
    df = spark.createDataFrame(rows, CLICKS)
    src = shared_path(spark, "hot-src")
    for b in range(12):
        df.where((F.col("event_id") >= 200 * b) & (F.col("event_id") < 200 * (b + 1))).coalesce(1).write.mode("append").parquet(src)
    out = shared_path(spark, "hot-out")
    stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
    J.start_detection(stream, out, shared_path(spark, "hot-ck"), 30, partitions=6, lateness=lateness).awaitTermination()
    key = ["userId", "event_id", "timestamp", "productId", "category", "state", "offer"]
    want = sorted(tuple(r) for r in S.sequence_trace(df, 30, 5).select(*key).collect())
    assert sorted(tuple(r) for r in J.read_trace(spark, out).select(*key).collect()) == want
    offers = sorted(tuple(r) for r in S.detect_offers(df, 30, 5).collect())
    assert sorted(tuple(r) for r in J.read_offers(spark, out).collect()) == offers and offers


def test_expired_states_are_tombstones(spark):
    """A sequence beyond its limit keeps a flag and the last product; its next click but a refresh is lost."""
    us = int(T0.timestamp() * 1_000_000)
    states = spark.createDataFrame([("a", "clothes_visited", us, "A", "A", us, 1), ("b", "clothes_visited", us + 10**9, "A", "A", us, 1), ("c", "init", None, None, None, us, 1)],
                                   J.STATE_LOG_SCHEMA)
    kept = J.expired_states(states, F.lit(us + 1800 * 10**6).cast("long"), 30)
    got = {r.userId: (r.st, r.first_us, r.first_pid, r.last_pid) for r in kept.collect()}
    assert got["a"] == (S.EXPIRED, None, None, "A") and got["b"][0] == "clothes_visited" and got["c"][0] == "init"
    late = T0 + dt.timedelta(hours=1)
    clicks = [("a", 1, late, "A", "clothing", "M", 40, None), ("a", 2, late + dt.timedelta(minutes=1), "B", "clothing", "M", 40, None),
              ("a", 3, late + dt.timedelta(minutes=2), "C", "clothing", "M", 40, None)]
    for state in (states, kept):
        folded = S.fold_batch(spark.createDataFrame(clicks, CLICKS), state.select("userId", "st", "first_us", "first_pid", "last_pid"), 30)
        assert [r.event_id for r in folded.where("kind = 'trace' and userId = 'a'").collect()] == [3]  # the refresh is skipped, B is lost, C begins


def test_detection_retries_between_its_steps(spark, monkeypatch):
    rows = _hot_clicks(400)
    df = spark.createDataFrame(rows, CLICKS)
    src, out, ck = (shared_path(spark, n) for n in ("retry-src", "retry-out", "retry-ck"))
    for b in range(2):
        df.where((F.col("event_id") >= 200 * b) & (F.col("event_id") < 200 * (b + 1))).coalesce(1).write.mode("append").parquet(src)

    def run():
        stream = spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(src)
        J.start_detection(stream, out, ck, 30, partitions=3).awaitTermination()

    real = C.RunLog.commit
    for wrong in (lambda self, rows, batch: 1 / 0 if batch == 1 else real(self, rows, batch), lambda self, rows, batch: (real(self, rows, batch), 1 / 0)):
        with monkeypatch.context() as m:
            m.setattr(C.RunLog, "commit", wrong)
            with pytest.raises(Exception, match="division by zero"):
                run()
    run()
    assert sorted(tuple(r) for r in J.read_offers(spark, out).collect()) == sorted(tuple(r) for r in S.detect_offers(df, 30, 5).collect())


def test_services_keep_their_files_apart(spark, tmp_path):
    """Hidden folders are no rows: a file stream over a committed table sees committed files only."""
    path = shared_path(spark, "visible")
    with pytest.raises(RuntimeError):
        C.breaking_off("before manifest", 0)(spark.range(5), path, 0, [])
    C.commit_batch(spark.range(5), path, 1, [])
    assert spark.read.parquet(path).count() == 5
    assert any(n.startswith("_staging") for n in os.listdir(path))
