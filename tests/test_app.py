import datetime as dt

from pyspark.sql import functions as F

from clickweave import app
from clickweave.session import shared_path


def test_end_to_end_services(spark, tmp_path):
    base = shared_path(spark, "app")
    # lookups: two loads; the second has a null title (kept) and a new category
    (tmp_path / "p1.json").write_text('[{"id": "A", "category": "clothing", "title": "Shirt", "description": "", '
                                      '"image": "a", "price": 10}, {"id": "B", "category": "clothing", '
                                      '"title": "Dress", "description": "", "image": "b", "price": 12}, '
                                      '{"id": "S", "category": "shoes", "title": "Boot", "description": "", '
                                      '"image": "s", "price": 50}]')
    (tmp_path / "p2.json").write_text('[{"id": "B", "category": "clothing", "title": null, "description": "", '
                                      '"image": "b", "price": 12}]')
    (tmp_path / "u.json").write_text('{"userId": "v1", "birthDate": "1988-05-01", "gender": "M"}\n')
    app.ingest_lookups(spark, base, str(tmp_path / "p1.json"), str(tmp_path / "u.json"))
    app.ingest_lookups(spark, base, str(tmp_path / "p2.json"), None)
    prods = {r.id: (r.category, r.title) for r in app.current_dimension(spark, app.paths(base)["products"]).collect()}
    assert prods["B"] == ("clothing", "Dress")
    # click log: v1 views A, S, B within minutes -> one offer
    t0 = int(dt.datetime(2024, 3, 1, 12, 0, tzinfo=dt.timezone.utc).timestamp())
    lines = ["Visitor Unique ID\tIP Address\t29\tUnix Timestamp\tProduct Page URL\tExtra"]
    for i, pid in enumerate(["A", "A", "S", "B"]):
        lines.append(f"{{v1}}\t10.0.0.1\tMozilla/5.0 (Windows NT 10.0)\t{t0 + 60 * i}\t"
                     f"http://www.acme.com/shop/{pid}\tx")
    (tmp_path / "log.tsv").write_text("\n".join(lines) + "\n")
    clicks = app.replay(spark, base, str(tmp_path / "log.tsv"))
    assert sorted(r.at for r in clicks.collect()) == [0.0, 10.0, 20.0, 30.0]
    for q in app.start_services(spark, base):
        q.awaitTermination()
    offers = spark.read.parquet(app.paths(base)["offers"]).collect()
    assert [(o.userId, o.offer) for o in offers] == [("v1", "offer1")]
    marts = app.refresh_dashboard(spark, base, F.expr("TIMESTAMP_NTZ '2024-03-01 12:05:00'"))
    top = app.J.read_mart(spark, app.paths(base)["marts"], "products_last_hour").collect()
    assert sum(r["count"] for r in top) == 4 and "sessions" in marts


def test_services_start_on_an_empty_base(spark):
    """No lookups, no clicks, a continuous trigger: everything starts, and clicks get the defaults."""
    import time

    from clickweave.streaming.sources import CLICK_SCHEMA
    base = shared_path(spark, "fresh")
    queries = app.start_services(spark, base, trigger={"processingTime": "1 second"})
    try:
        row = (1, dt.datetime(2024, 1, 1), None, "v", "10.0.0.1", None, None, None, "A")
        spark.createDataFrame([row], CLICK_SCHEMA).write.mode("append").parquet(app.paths(base)["clicks"])
        deadline, rows = time.time() + 120, []
        while time.time() < deadline and not rows:
            time.sleep(1)
            assert all(q.exception() is None for q in queries)
            rows = (spark.read.schema("category string, country string, gender string").parquet(app.paths(base)["enriched"])
                        .select("category", "country", "gender").collect())
        assert [tuple(r) for r in rows] == [("Unknown", "Unknown", "U")]
    finally:
        for q in queries:
            q.stop()


def test_dimension_update_seen_by_next_batch(spark, tmp_path):
    """The enrichment re-reads dimensions per micro-batch."""
    from clickweave.streaming.jobs import start_enrichment
    from clickweave.streaming.sources import CLICK_SCHEMA, file_stream
    base = shared_path(spark, "j9")
    p = app.paths(base)
    (tmp_path / "p1.json").write_text('[{"id": "A", "category": "shoes", "title": "T", "description": "", '
                                      '"image": "", "price": 1}]')
    (tmp_path / "p2.json").write_text('[{"id": "A", "category": "clothing", "title": null, "description": "", '
                                      '"image": "", "price": 1}]')
    (tmp_path / "u.json").write_text('{"userId": "v", "birthDate": null, "gender": "F"}\n')
    app.ingest_lookups(spark, base, str(tmp_path / "p1.json"), str(tmp_path / "u.json"))

    def click(i):
        row = (i, dt.datetime(2024, 1, 1, 0, i), None, "v", "10.0.0.1", None, None, None, "A")
        spark.createDataFrame([row], CLICK_SCHEMA).write.mode("append").parquet(p["clicks"])

    def run():
        q = start_enrichment(file_stream(spark, p["clicks"], CLICK_SCHEMA), lambda: app.load_dims(spark, base),
                             p["enriched"], f"{p['checkpoints']}/e")
        q.awaitTermination()

    click(1)
    run()
    app.ingest_lookups(spark, base, str(tmp_path / "p2.json"), None)  # category changes, title kept
    click(2)
    run()
    got = {r.event_id: (r.category, r.title) for r in spark.read.parquet(p["enriched"]).collect()}
    assert got == {1: ("shoes", "T"), 2: ("clothing", "T")}
