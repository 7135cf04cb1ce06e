import datetime as dt


from pyspark.sql import functions as F

from clickweave.functions import text as T
from clickweave.functions.device import device_type
from clickweave.functions.temporal import age_from_birthdate, relative_time, timestamp_from_nanos
from clickweave.functions.visitors import gender_label, in_target_group, offer_for_gender, or_default


def one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_age_feb29_and_birthday(spark):
    rows = [("2000-02-29", dt.date(2023, 2, 28)), ("2000-02-29", dt.date(2023, 3, 1)),
            ("1990-06-15", dt.date(2020, 6, 15)), ("1990-06-15", dt.date(2020, 6, 14)), (None, dt.date(2020, 1, 1))]
    got = one(spark, age_from_birthdate("b", F.col("n")), "b string, n date", rows)
    assert got == [22, 23, 30, 29, None]


def test_product_id_from_url(spark):
    rows = [("http://www.acme.com/shop/item42",), ("http://www.acme.com/404",),
            ("see http://www.acme.com/a/b_c?x=1 here",)]
    got = one(spark, T.product_id_from_url("u"), "u string", rows)
    assert got == ["item42", "http://www.acme.com/404", "b_c"]


def test_strip_braces_and_labels(spark):
    assert one(spark, T.strip_braces("s"), "s string", [("{{abc}}",), ("x{y}",)]) == ["abc", "x{y"]
    assert one(spark, gender_label("g"), "g string", [("M",), ("F",), ("U",), ("X",), (None,)]) == \
        ["Male", "Female", "Unknown", "Not Specified", "Not Specified"]
    assert one(spark, offer_for_gender("g"), "g string", [("M",), ("F",), (None,)]) == ["offer1", "offer2", "offer2"]
    assert one(spark, or_default("g", "U"), "g string", [("",), (None,), ("F",)]) == ["U", "U", "F"]


def test_target_group_bounds(spark):
    rows = [("F", 24), ("F", 25), ("F", 35), ("F", 36), ("M", 34), ("M", 35), ("M", 45), ("M", 46), ("U", 30),
            ("M", None)]
    got = one(spark, in_target_group("g", "a"), "g string, a int", rows)
    assert got == [False, True, True, False, False, True, True, False, False, False]


def test_device_ladder(spark):
    rows = [("Mozilla/5.0 (iPhone; CPU iPhone OS 16_0 like Mac OS X) Mobile",),
            ("Mozilla/5.0 (iPad; CPU OS 16_0 like Mac OS X)",),
            ("Mozilla/5.0 (Linux; Android 13; SM-X700) AppleWebKit/537.36 Safari/537.36",),
            ("Mozilla/5.0 (Linux; Android 13; Pixel 7) AppleWebKit/537.36 Mobile Safari/537.36",),
            ("Mozilla/5.0 (Windows NT 10.0; Win64; x64)",), ("Mozilla/5.0 (Macintosh; Intel Mac OS X 13_0)",),
            ("Googlebot/2.1 (+http://www.google.com/bot.html)",), ("curl/8.0",), (None,)]
    got = one(spark, device_type("ua"), "ua string", rows)
    assert got == ["Mobile", "Tablet", "Tablet", "Mobile", "Desktop", "Desktop", "Bot", "Other", "Unknown"]


def test_relative_time_cutoffs(spark):
    now = dt.datetime(2024, 1, 10, 12, 0, 0)
    secs = [0, 1, 59, 60, 119, 120, 3599, 3600, 7199, 7200, 86399, 86400, 2 * 86400, 45 * 86400, 400 * 86400]
    rows = [(now - dt.timedelta(seconds=s), now) for s in secs] + [(now + dt.timedelta(seconds=90), now)]
    got = one(spark, relative_time("t", "n"), "t timestamp_ntz, n timestamp_ntz", rows)
    assert got == ["now", "a second ago", "59 seconds ago", "a minute ago", "a minute ago", "2 minutes ago",
                   "59 minutes ago", "an hour ago", "an hour ago", "2 hours ago", "23 hours ago", "a day ago",
                   "2 days ago", "a month ago", "1 year, 1 month ago", "a minute from now"]


def test_nanos_exact(spark):
    ns = 1704067207179575000
    got = one(spark, timestamp_from_nanos("x").cast("timestamp_ntz"), "x long", [(ns,)])
    assert got == [dt.datetime(2024, 1, 1, 0, 0, 7, 179575)]


def test_price_and_title(spark):
    rows = [(1234.5, "forest green LAVENDER")]
    df = spark.createDataFrame(rows, "p double, t string")
    r = df.select(T.price_label("p"), T.title_case("t")).first()
    assert r[0] == "€1,234.50" and r[1] == "Forest Green Lavender"


def test_json_catalogue_readers(spark, tmp_path):
    from clickweave.sources.files import read_products, read_visitors
    (tmp_path / "products.json").write_text(
        '[{"id": "1", "category": "shoes", "title": "A", "description": "d", "image": "a.png", "price": 9.5},\n'
        ' {"id": "2", "category": "clothing", "title": "B", "description": "d", "image": "b.png", "price": 20}]')
    (tmp_path / "users.json").write_text('{"userId": "u1", "birthDate": "1990-01-01", "gender": "M"}\n'
                                         '{"userId": "u2", "birthDate": null, "gender": null}\n')
    p = read_products(spark, str(tmp_path / "products.json")).orderBy("id").collect()
    assert [(r.id, r.category, r.price) for r in p] == [("1", "shoes", 9.5), ("2", "clothing", 20.0)]
    v = read_visitors(spark, str(tmp_path / "users.json")).orderBy("userId").collect()
    assert [(r.userId, r.birthDate, r.gender) for r in v] == [("u1", "1990-01-01", "M"), ("u2", None, None)]


def test_progress_observation(spark):
    from clickweave.streaming.progress import counted
    df, obs = counted(spark.range(25))
    df.write.format("noop").mode("overwrite").save()
    assert obs.get["rows"] == 25


def test_packets_keep_large_ids(spark):
    import datetime as dt

    from clickweave.sources.packets import click_packets, packet_rows
    big = 2**53 + 1
    row = (big, dt.datetime(2024, 1, 1), None, "u", "10.0.0.1", None, None, None, "A")
    from clickweave.streaming.sources import CLICK_SCHEMA
    assert packet_rows(click_packets(spark.createDataFrame([row], CLICK_SCHEMA))).first().event_id == big


def test_packets_multi_element(spark):
    from clickweave.sources.packets import packet_rows
    day_ns = 1704067200 * 10**9
    rows = [("u1", day_ns, [1000, 2_000_000_000],
             {"userId": ["u1", "u1"], "productId": ["A", None], "age": ["30"], "gender": ["Male", "Male"],
              "ip": ["1.1.1.1", "1.1.1.1"], "userAgent": ["x", "y"]}, {"event_id": [7.0, 8.0]})]
    df = spark.createDataFrame(rows, "streamId string, epoch long, timestamps array<long>, "
                                     "stringValues map<string,array<string>>, numericValues map<string,array<double>>")
    out = packet_rows(df).orderBy("timestamp").collect()
    assert [(r.event_id, r.productId, r.age, r.userAgent) for r in out] == [(7, "A", "30", "x"), (8, None, None, "y")]
    assert out[1].timestamp == dt.datetime(2024, 1, 1, 0, 0, 2)


def test_transition_log_offer_two_lines(spark):
    from clickweave.sources.logs import log_tail, transition_log
    trace = spark.createDataFrame(
        [("u", 1, dt.datetime(2024, 1, 1, 0, 0, 1), "A", "clothing", "clothes_visited", "offer1", True),
         ("u", 2, dt.datetime(2024, 1, 1, 0, 0, 2), "S", "shoes", "shoes_visited", "offer1", False),
         ("u", 3, dt.datetime(2024, 1, 1, 0, 0, 3), "B", "clothing", "offer", "offer1", True)],
        "userId string, event_id long, timestamp timestamp_ntz, productId string, category string, "
        "state string, offer string, live boolean")
    log = transition_log(trace).orderBy("event_id", "line").collect()
    assert [r.msg for r in log] == ["[User u entered state clothes_visited][Event: clicked A][Category: clothing]",
                                    "[User u entered state offer][Event: clicked B][Category: clothing]",
                                    "[User u triggered offer offer1]"]
    tail = log_tail(transition_log(trace), keep=10, show=2).collect()
    assert [r.text for r in tail] == ["2024-01-01 00:00:03: [User u triggered offer offer1]",
                                      "2024-01-01 00:00:03: [User u entered state offer][Event: clicked B]"
                                      "[Category: clothing]"]


def test_ip_to_long_malformed(spark):
    from clickweave.operators.range_join import ip_to_long
    rows = [("10.1.2.3",), ("1.2.3",), ("a.b.c.d",), (None,), ("1.2.3.4.5",), ("",)]
    assert one(spark, ip_to_long("ip"), "ip string", rows) == [167838211, None, None, None, None, None]


def test_small_text_helpers(spark):
    from clickweave.functions.visitors import valid_age
    from clickweave.operators.metrics import product_by_id
    df = spark.createDataFrame([("42", "u7", "shop", "clicks", "img.png", "offer1", "tok\nen\n",
                                 "https://portal-api.dev.example.io/x", 17)],
                               "p string, u string, w string, t string, i string, o string, s string, url string, a int")
    r = df.select(T.product_key("p"), T.visitor_key("u"), T.topic_id("w", "t"), T.product_image_path("i"),
                  T.offer_image_path("o"), T.strip_first_line_feed("s"), T.subdomain("url", "portal-api"),
                  T.subdomain(F.lit("http://other"), "portal-api"), valid_age("a")).first()
    assert tuple(r) == ("product:42", "visitor:u7", "shop-clicks", "assets/products/img.png", "assets/offer1.png",
                        "token\n", "dev", "platform", False)
    products = spark.createDataFrame([("1", "a"), ("2", "b")], "id string, category string")
    assert [x.category for x in product_by_id(products, "2").collect()] == ["b"]
