import datetime as dt

from pyspark.sql import functions as F

from clickweave.operators import metrics as M

T0 = dt.datetime(2024, 1, 1, 10, 45, 0)


def enriched(spark, rows):
    return spark.createDataFrame(rows, "event_id long, timestamp timestamp_ntz, userId string, deviceType string")


def lit_ts(t):
    return F.lit(t).cast("timestamp_ntz")


def test_device_pivot_empty_and_bots(spark):
    empty = enriched(spark, [(1, T0 - dt.timedelta(hours=2), "u", "Mobile")])
    assert M.device_popularity(empty, lit_ts(T0), "10 minutes").count() == 0
    bots = enriched(spark, [(1, T0, "u", "Bot"), (2, T0, "v", "Unknown")])
    got = {r["Device type"]: r["Total"] for r in M.device_popularity(bots, lit_ts(T0), "10 minutes").collect()}
    assert got == {"Desktop": 0, "Tablet": 0, "Mobile": 0, "Other": 2}
    share = M.device_popularity(bots, lit_ts(T0), "10 minutes", with_share=True).collect()
    assert [(r["Device type"], r["Percentage"]) for r in share] == [("Other", 100.0)]


def test_trailing_bounds(spark):
    df = enriched(spark, [(1, T0 - dt.timedelta(minutes=10), "u", "Mobile"), (2, T0, "u", "Mobile")])
    assert M.trailing(df, lit_ts(T0), "10 minutes").count() == 1
    assert M.trailing(df, lit_ts(T0), "10 minutes", inclusive=True).count() == 2


def test_dense_axis_ends_on_full_hour(spark):
    buckets = spark.createDataFrame([(dt.datetime(2024, 1, 1, 10, 30), "u", 3)],
                                    "datetime timestamp_ntz, userId string, count long")
    out = M.sessions_dense_8h(buckets, lit_ts(T0)).orderBy("datetime").collect()
    assert len(out) == 16
    assert out[-1].datetime == dt.datetime(2024, 1, 1, 10, 0)
    assert out[0].datetime == dt.datetime(2024, 1, 1, 2, 30)
    assert sum(r["count"] for r in out) == 0  # the running half hour is not on the axis


def test_visits_per_minute_fills_inner_gaps(spark):
    df = enriched(spark, [(1, T0 - dt.timedelta(minutes=5), "u", "x"), (2, T0, "u", "x"), (3, T0, "v", "x")])
    out = [(r.datetime.minute, r["count"]) for r in M.visits_per_minute(df, lit_ts(T0)).orderBy("datetime").collect()]
    assert out == [(40, 1), (41, 0), (42, 0), (43, 0), (44, 0), (45, 2)]


def test_top_products_ties_by_key(spark):
    rows = [("p2", "a"), ("p1", "a"), ("p3", "a"), ("p3", "a")]
    df = spark.createDataFrame(rows, "productId string, category string")
    got = [(r.productId, r["count"]) for r in M.top_products(df, 2).collect()]
    assert got == [("p3", 2), ("p1", 1)]


def test_merge_partials_equals_whole(spark):
    rows = [(i, T0 + dt.timedelta(minutes=7 * i), f"u{i % 3}", "x") for i in range(40)]
    df = enriched(spark, rows)
    whole = sorted(tuple(r) for r in M.user_bucket_counts(df).collect())
    split = lit_ts(T0 + dt.timedelta(minutes=100))
    merged = M.merge_partials(M.user_bucket_counts(df.filter(F.col("timestamp") < split)),
                              M.user_bucket_counts(df.filter(F.col("timestamp") >= split)))
    assert sorted(tuple(r) for r in merged.collect()) == whole


def test_snapshot_diff_multiset(spark):
    from clickweave.operators.setops import snapshot_diff
    a = spark.createDataFrame([(1, None), (1, None), (2, "x"), (3, "y")], "k int, v string")
    b = spark.createDataFrame([(1, None), (2, "x"), (2, "x"), (4, "z")], "k int, v string")
    r = snapshot_diff(a, b).first()
    assert (r.only_new, r.only_old, r.changed) == (a.exceptAll(b).count(), b.exceptAll(a).count(), True)
    same = snapshot_diff(a, a).first()
    assert (same.only_new, same.only_old, same.changed) == (0, 0, False)


def test_enrich_shuffle_fallback_equals_broadcast(spark):
    from clickweave.operators.enrich import enrich
    from clickweave.sources import testbed as TB
    from tests.conftest import SF_SMALL
    t = TB.load(spark, SF_SMALL)
    args = (t["clicks"], t["products"], t["visitors"], t["ip_ranges"], t["countries"])
    small = enrich(*args)  # Spark broadcasts by statistics
    rows = sorted(map(tuple, small.collect()))
    import contextlib
    import io
    buf = io.StringIO()
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = enrich(*args)
        with contextlib.redirect_stdout(buf):
            big.explain()
        assert "SortMergeJoin" in buf.getvalue() or "ShuffledHashJoin" in buf.getvalue()
        assert rows == sorted(map(tuple, big.collect()))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_repeated_lookup_keys_do_not_repeat_clicks(spark):
    from clickweave.operators.enrich import enrich
    from clickweave.sources import testbed as TB
    from tests.conftest import SF_SMALL
    t = TB.load(spark, SF_SMALL)
    twice = t["products"].selectExpr("id", "'old' AS category", "title", "0 AS seq").unionByName(
        t["products"].selectExpr("id", "category", "title", "1 AS seq"))
    rest = (t["visitors"], t["ip_ranges"], t["countries"])
    assert sorted(map(tuple, enrich(t["clicks"], twice, *rest).collect())) == sorted(map(tuple, enrich(t["clicks"], t["products"], *rest).collect()))


def test_documents_keep_the_order_of_the_mart(spark):
    from clickweave.sources.logs import column_json
    df = spark.createDataFrame([("a", 1, 3), ("z", 9, 1), ("m", 5, 2), (None, 5, 0)], "k string, n long, _i int")
    by_n = column_json(df, "x", ["-n", "k"]).first().value
    assert by_n == '{"k":{"0":"z","1":"m","2":null,"3":"a"},"n":{"0":9,"1":5,"2":5,"3":1}}' or '"3":"a"' in by_n
    assert '"0":9,"1":5,"2":5,"3":1' in by_n and "_i" not in by_n
    assert '"n":{"0":5,"1":9,"2":5,"3":1}' in column_json(df, "x", ["_i"]).first().value


def test_octets_above_255_match_nothing(spark):
    from clickweave.operators.range_join import ip_to_long
    rows = spark.createDataFrame([("10.300.1.1",), ("10.0.0.1",), ("1.2.3",), ("256.0.0.0",), ("-1.0.0.0",), (None,)], "ip string")
    assert [r[0] for r in rows.select(ip_to_long("ip")).collect()] == [None, 167772161, None, None, None, None]
