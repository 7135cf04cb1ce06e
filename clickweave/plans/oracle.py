"""DuckDB SQL oracles for the named queries (same names as ``catalog.QUERIES``).

Each oracle re-derives the adapter tables from the raw test tables in DuckDB
(``testbed.duckdb_ctes``) and states the operator's rule in plain SQL. The
sequence detector's oracle is a recursive CTE that walks every visitor's
clicks one by one -- an independent formulation of the fold.
"""

from __future__ import annotations

from ..functions.device import device_case_sql
from ..functions.temporal import step_seconds
from ..functions.visitors import FEMALE_AGE_RANGE, MALE_AGE_RANGE
from ..operators.upsert import UPDATE_COLUMNS_FIRST, UPDATE_COLUMNS_SECOND
from ..sources.testbed import IP_RANGE_COLUMNS_NATION, IP_RANGE_COLUMNS_REGION, OVERLAPPING_SQL, REPLAY_ORIGIN_US, SUPPLIER_RANGE_COLUMNS, duckdb_ctes
from . import catalog as C

AS_OF = "(SELECT max(timestamp) FROM clicks)"


def _secs(text: str) -> str:
    return f"to_seconds({step_seconds(text)})"


def _with(extra: str, body: str, recursive: bool = False) -> str:
    head = "WITH RECURSIVE " if recursive else "WITH "
    ctes = duckdb_ctes()
    if extra:
        ctes += ",\n" + extra
    return f"{head}{ctes}\n{body}"


BUFFER_CTE = f"buffer AS (SELECT * FROM enriched WHERE timestamp > {AS_OF} - {_secs(C.BUFFER)})"
BUCKETS_CTE = ("buckets AS (SELECT time_bucket(INTERVAL 30 minute, timestamp) AS datetime, userId, "
               "count(*) AS count FROM clicks WHERE userId IS NOT NULL AND timestamp IS NOT NULL GROUP BY ALL)")
VPB_CTE = (f"vpb AS (SELECT datetime, count(userId) AS userId, count(count) AS count FROM buckets "
           f"WHERE datetime >= {AS_OF} - {_secs('8 hours 30 minutes')} GROUP BY datetime)")
VPM_CTE = (f"vpm_counts AS (SELECT date_trunc('minute', timestamp) AS datetime, count(*) AS count FROM clicks "
           f"WHERE timestamp > {AS_OF} - {_secs('15 minutes')} GROUP BY 1),\n"
           "vpm_axis AS (SELECT unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 minute)) AS datetime "
           "FROM vpm_counts),\n"
           "vpm AS (SELECT a.datetime, CAST(COALESCE(c.count, 0) AS BIGINT) AS count "
           "FROM vpm_axis a LEFT JOIN vpm_counts c ON a.datetime = c.datetime)")


def relative_time_sql(ts: str, as_of: str) -> str:
    """F12 in DuckDB SQL (mirrors functions.temporal.relative_time)."""
    diff = f"(epoch_us({as_of}) - epoch_us({ts}))"
    total = f"abs({diff})"
    days = f"({total} // 86400000000)"
    secs = f"(({total} % 86400000000) // 1000000)"
    years = f"({days} // 365)"
    d = f"({days} % 365)"
    months = f"CAST(floor({d} / 30.5) AS BIGINT)"
    phrase = f"""CASE
      WHEN {years} = 0 AND {d} < 1 THEN CASE
        WHEN {secs} = 0 THEN NULL WHEN {secs} = 1 THEN 'a second'
        WHEN {secs} < 60 THEN printf('%d seconds', {secs}) WHEN {secs} < 120 THEN 'a minute'
        WHEN {secs} < 3600 THEN printf('%d minutes', {secs} // 60) WHEN {secs} < 7200 THEN 'an hour'
        ELSE printf('%d hours', {secs} // 3600) END
      WHEN {years} = 0 THEN CASE
        WHEN {d} = 1 THEN 'a day' WHEN {months} = 0 THEN printf('%d days', {d})
        WHEN {months} = 1 THEN 'a month' ELSE printf('%d months', {months}) END
      WHEN {years} = 1 THEN CASE
        WHEN {months} = 0 AND {d} = 0 THEN 'a year'
        WHEN {months} = 0 THEN CASE WHEN {d} = 1 THEN '1 year, 1 day' ELSE printf('1 year, %d days', {d}) END
        WHEN {months} = 1 THEN '1 year, 1 month' ELSE printf('1 year, %d months', {months}) END
      ELSE printf('%d years', {years}) END"""
    return (f"CASE WHEN {ts} IS NULL OR {as_of} IS NULL THEN NULL WHEN ({phrase}) IS NULL THEN 'now' "
            f"WHEN {diff} < 0 THEN ({phrase}) || ' from now' ELSE ({phrase}) || ' ago' END")


def _age_sql(birth: str, now: str) -> str:
    b, n = f"CAST({birth} AS DATE)", f"CAST({now} AS DATE)"
    return (f"CAST(year({n}) - year({b}) - CAST(month({n}) * 100 + day({n}) < month({b}) * 100 + day({b}) "
            f"AS INTEGER) AS INTEGER)")


def _fold_ctes(window_minutes: int, entered: dict[str, str], emits: str, code: str) -> str:
    """The fold as a recursive walk of every visitor's clicks. ``entered``: for each state the SQL of
    the state that click x enters (null: none)."""
    w = window_minutes * 60 * 1_000_000
    later = "\n        ".join(f"WHEN x.st = '{st}' THEN {sql}" for st, sql in entered.items() if st != "init")
    return f"""seq AS (SELECT userId, event_id, timestamp, epoch_us(timestamp) AS us, productId, category, gender, age,
    original_timestamp IS NULL AS live,
    row_number() OVER (PARTITION BY userId ORDER BY timestamp, event_id) AS rn
  FROM enriched WHERE userId IS NOT NULL AND timestamp IS NOT NULL),
fold(userId, rn, st, ft, fp, lp, entered, event_id, timestamp, productId, category, offer, live) AS (
  SELECT userId, CAST(0 AS BIGINT), 'init', CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
         CAST(NULL AS VARCHAR), CAST(NULL AS BIGINT), CAST(NULL AS TIMESTAMP), CAST(NULL AS VARCHAR),
         CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN)
  FROM (SELECT DISTINCT userId FROM seq)
  UNION ALL
  SELECT userId, rn,
    CASE WHEN refresh THEN st WHEN entered IS NULL OR entered = '{emits}' THEN 'init' ELSE entered END,
    CASE WHEN refresh THEN ft WHEN entered IS NULL OR entered = '{emits}' THEN NULL WHEN st = 'init' THEN us ELSE ft END,
    CASE WHEN refresh THEN fp WHEN entered IS NULL OR entered = '{emits}' THEN NULL
         WHEN st = 'init' THEN productId ELSE fp END,
    CASE WHEN refresh THEN lp WHEN entered IS NULL OR entered = '{emits}' THEN NULL ELSE productId END,
    entered, event_id, timestamp, productId, category,
    {code}, live
  FROM (
    SELECT x.*, CASE
        WHEN x.refresh THEN NULL
        WHEN x.st = 'init' THEN {entered["init"]}
        WHEN NOT (x.us - x.ft < {w}) THEN NULL
        {later}
      END AS entered
    FROM (SELECT f.userId, s.rn, f.st, f.ft, f.fp, f.lp, s.event_id, s.timestamp, s.us, s.productId, s.category,
                 s.gender, s.age, s.live, (f.st <> 'init' AND f.lp IS NOT DISTINCT FROM s.productId) AS refresh
          FROM fold f JOIN seq s ON s.userId = f.userId AND s.rn = f.rn + 1) x
  ) y
)"""


def _sequence_ctes(window_minutes: int) -> str:
    m_lo, m_hi = MALE_AGE_RANGE
    f_lo, f_hi = FEMALE_AGE_RANGE
    return _fold_ctes(window_minutes, {
        "init": f"""CASE WHEN x.category = 'clothing' AND COALESCE(
              (x.gender = 'M' AND x.age BETWEEN {m_lo} AND {m_hi}) OR (x.gender = 'F' AND x.age BETWEEN {f_lo} AND {f_hi}),
              false) THEN 'clothes_visited' END""",
        "clothes_visited": """CASE WHEN x.category = 'shoes' THEN 'shoes_visited'
                                                WHEN x.category = 'clothing' THEN 'clothes_visited' END""",
        "shoes_visited": """CASE WHEN x.category = 'clothing' AND x.productId IS DISTINCT FROM x.fp THEN 'offer'
                  WHEN x.category = 'clothing' THEN 'clothes_visited' END""",
    }, "offer", "CASE WHEN gender = 'M' THEN 'offer1' ELSE 'offer2' END")


def _recoveries_sql() -> str:
    ctes = _fold_ctes(C.OFFER_WINDOW_MINUTES, {
        "init": "CASE WHEN x.category = 'Unknown' THEN 'lost' END",
        "lost": "CASE WHEN x.category = 'Unknown' THEN 'lost' "
                "WHEN x.category IN ('clothing', 'shoes') AND x.productId IS DISTINCT FROM x.fp THEN 'recovered' END",
    }, "recovered", "category")
    return _with(ctes, "SELECT userId, event_id, timestamp, offer AS code FROM fold WHERE entered = 'recovered'", recursive=True)


TRANSITION_LOG_CTE = """tlog AS (
  SELECT timestamp AS created, event_id, userId, CAST(0 AS INTEGER) AS line,
         printf('[User %s entered state %s][Event: clicked %s][Category: %s]', userId, entered, productId, category) AS msg
  FROM fold WHERE entered IS NOT NULL AND live
  UNION ALL
  SELECT timestamp, event_id, userId, CAST(1 AS INTEGER), printf('[User %s triggered offer %s]', userId, offer)
  FROM fold WHERE entered = 'offer' AND live)"""

REPLAY_CTE = """rlog AS (SELECT event_id, CAST(CAST(epoch(date_trunc('second', ts)) AS BIGINT) AS DOUBLE) AS t FROM events),
rnext AS (SELECT event_id, t, lead(t) OVER (ORDER BY event_id) AS nt FROM rlog),
rdelay AS (SELECT event_id, CASE WHEN nt IS NOT NULL THEN CAST(least(greatest(nt - t, 0), 10) AS DOUBLE) END AS delay
           FROM rnext),
rsched AS (SELECT event_id, delay,
           COALESCE(sum(delay) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0.0) AS "at"
           FROM rdelay)"""


def _device_pivot(share: bool) -> str:
    win = f"timestamp > {AS_OF} - {_secs(C.DEVICE_WINDOW)}"
    dev = (f"dev AS (SELECT count(*) AS total, count(*) FILTER (WHERE deviceType = 'Desktop') AS d1, "
           f"count(*) FILTER (WHERE deviceType = 'Tablet') AS d2, count(*) FILTER (WHERE deviceType = 'Mobile') AS d3 "
           f"FROM buffer WHERE {win} AND deviceType IS NOT NULL)")
    rows = [("Desktop", "d1"), ("Tablet", "d2"), ("Mobile", "d3"), ("Other", "total - d1 - d2 - d3")]
    parts = []
    for label, expr in rows:
        pct = f", ({expr}) / total * 100 AS Percentage" if share else ""
        parts.append(f"SELECT 'Device type' AS \"Device\", '{label}' AS \"Device type\", "
                     f"CAST({expr} AS BIGINT) AS \"Total\"{pct} FROM dev WHERE total > 0")
    body = " UNION ALL ".join(parts)
    if share:
        body = f"SELECT * FROM ({body}) WHERE Percentage <> 0"
    return _with(BUFFER_CTE + ",\n" + dev, body)


def _upsert_ctes() -> str:
    """The visitors after the update (K5), as the CTE ``upserted``."""
    first = ", ".join(UPDATE_COLUMNS_FIRST)
    second = ", ".join(UPDATE_COLUMNS_SECOND).replace("NULL AS birthDate", "CAST(NULL AS VARCHAR) AS birthDate")
    extra = (f"updates AS (SELECT {first} FROM customer UNION ALL SELECT {second} FROM customer),\n"
             "latest AS (SELECT userId, arg_max(birthDate, seq) FILTER (WHERE birthDate IS NOT NULL) AS birthDate, "
             "arg_max(gender, seq) FILTER (WHERE gender IS NOT NULL) AS gender FROM updates "
             "WHERE userId IS NOT NULL GROUP BY userId)")
    return extra + (",\nupserted AS (SELECT COALESCE(v.userId, l.userId) AS userId, COALESCE(l.birthDate, v.birthDate) AS birthDate, "
                    "COALESCE(l.gender, v.gender) AS gender FROM visitors v FULL OUTER JOIN latest l ON v.userId = l.userId)")


def _pane_marts_sql(top: str) -> str:
    minutes = (f"m AS (SELECT date_trunc('minute', timestamp) AS datetime, count(*) AS count FROM enriched WHERE timestamp > {AS_OF} - {_secs(C.PANE_MINUTES)} GROUP BY 1),\n"
               "axis AS (SELECT unnest(generate_series(min(datetime), max(datetime), INTERVAL 1 minute)) AS datetime FROM m)")
    window = f"FROM buffer WHERE timestamp > {AS_OF} - {_secs(C.DEVICE_WINDOW)} AND deviceType IS NOT NULL"
    named = "CASE WHEN deviceType IN ('Desktop', 'Tablet', 'Mobile') THEN deviceType ELSE 'Other' END"
    return _with(f"{BUFFER_CTE},\n{top},\n{minutes}", f"""
SELECT 'last_15_minutes' AS mart, strftime(axis.datetime, '%Y-%m-%d %H:%M:%S') AS name, coalesce(count, 0) AS count FROM axis LEFT JOIN m USING (datetime)
UNION ALL SELECT 'products_last_hour', productId || '|' || category, count FROM top
UNION ALL SELECT 'category_popularity', category, count(*) FROM buffer WHERE category IS NOT NULL GROUP BY category
UNION ALL SELECT 'device_type_popularity', kind, (SELECT count(*) {window} AND {named} = kind) FROM (SELECT unnest(['Desktop', 'Tablet', 'Mobile', 'Other']) AS kind) WHERE EXISTS (SELECT 1 {window})
UNION ALL SELECT 'latest_visitors', strftime(timestamp, '%Y-%m-%d %H:%M:%S') || '|' || ip || '|' || country, 1 FROM (SELECT * FROM buffer ORDER BY event_id DESC LIMIT 10)
UNION ALL SELECT 'raw_data', userId, event_id FROM (SELECT * FROM buffer ORDER BY timestamp DESC, event_id DESC LIMIT 100)""")


def _offers_sql(window: int) -> str:
    return _with(_sequence_ctes(window),
                 "SELECT userId, event_id, timestamp, offer FROM fold WHERE entered = 'offer'", recursive=True)


def oracle_sql() -> dict[str, str]:
    base = _batch_oracles()
    base.update(stream_oracles(base))
    base.update(_single_oracles())
    return base


def _batch_oracles() -> dict[str, str]:
    pat = C.PAGE_ID_PATTERN.replace("'", "''")
    rel_as_of = f"({AS_OF} - INTERVAL {C.RELATIVE_TIME_SHIFT_HOURS} HOUR)"
    split = f"TIMESTAMP '{C.MERGE_SPLIT}'"
    cats = ", ".join(f"'{c}'" for c in C.CATEGORY_SELECTION)
    latest = (f"SELECT {relative_time_sql('timestamp', AS_OF)} AS \"Relative Time\", "
              "strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS \"Date and Time\", ip, country "
              "FROM (SELECT * FROM buffer ORDER BY event_id DESC LIMIT 10)")
    title = ("array_to_string(list_transform(string_split(lower(title), ' '), "
             "lambda x: upper(x[1]) || x[2:]), ' ')")
    return {
        "enrich_clicks": _with("", "SELECT * FROM enriched"),
        "country_by_ip": _with("", "SELECT event_id, ip, country FROM enriched"),
        "known_product_clicks": _with("", "SELECT event_id, userId, productId FROM clicks "
                                          "WHERE productId IN (SELECT id FROM products)"),
        "product_id_from_url": (f"SELECT page_id, url, CASE WHEN regexp_matches(url, '{pat}') "
                                f"THEN regexp_extract(url, '{pat}', 1) ELSE url END AS productId FROM pages"),
        "normalised_log": _with("", "SELECT _epoch AS original_timestamp, userId, ip, userAgent, "
                                    f"{_product_id('url')} AS productId FROM raw_clicks"),
        "visitor_age": _with("", f"SELECT userId, birthDate, {_age_sql('birthDate', AS_OF)} AS age FROM visitors"),
        "gender_label": _with("", "SELECT event_id, gender, CASE gender WHEN 'M' THEN 'Male' WHEN 'F' THEN 'Female' "
                                  "WHEN 'U' THEN 'Unknown' ELSE 'Not Specified' END AS genderLabel FROM enriched"),
        "device_type": _with("", f"SELECT event_id, userAgent, {device_case_sql('userAgent')} AS deviceType "
                                 "FROM clicks"),
        "relative_time": _with("", f"SELECT event_id, timestamp, {relative_time_sql('timestamp', rel_as_of)} "
                                   "AS relativeTime FROM clicks"),
        "price_label": _with("", f"SELECT id, '€' || printf('%,.2f', price) AS priceLabel, {title} AS displayTitle "
                                 "FROM products"),
        "user_bucket_counts": _with(BUCKETS_CTE, "SELECT * FROM buckets"),
        "merge_partials": _with("", "SELECT datetime, userId, CAST(sum(count) AS BIGINT) AS count FROM ("
                                    "SELECT time_bucket(INTERVAL 30 minute, timestamp) AS datetime, userId, "
                                    f"count(*) AS count FROM clicks WHERE timestamp < {split} AND userId IS NOT NULL "
                                    "GROUP BY ALL UNION ALL "
                                    "SELECT time_bucket(INTERVAL 30 minute, timestamp) AS datetime, userId, "
                                    f"count(*) AS count FROM clicks WHERE timestamp >= {split} AND userId IS NOT NULL "
                                    "GROUP BY ALL) GROUP BY ALL"),
        "visitors_per_bucket": _with(BUCKETS_CTE + ",\n" + VPB_CTE, "SELECT * FROM vpb"),
        "visits_per_minute": _with(VPM_CTE, "SELECT * FROM vpm"),
        "visits_dense_15m": _with(VPM_CTE, "SELECT a.datetime, CAST(COALESCE(v.count, 0) AS BIGINT) AS count FROM ("
                                           "SELECT unnest(generate_series(date_trunc('minute', " + AS_OF + ") - "
                                           "INTERVAL 14 minute, date_trunc('minute', " + AS_OF + "), "
                                           "INTERVAL 1 minute)) AS datetime) a LEFT JOIN vpm v "
                                           "ON a.datetime = v.datetime"),
        "sessions_dense_8h": _with(BUCKETS_CTE + ",\n" + VPB_CTE,
                                   "SELECT a.datetime, CAST(COALESCE(v.count, 0) AS BIGINT) AS count FROM ("
                                   "SELECT unnest(generate_series(date_trunc('hour', " + AS_OF + ") - "
                                   "INTERVAL 450 minute, date_trunc('hour', " + AS_OF + "), "
                                   "INTERVAL 30 minute)) AS datetime) a LEFT JOIN vpb v ON a.datetime = v.datetime"),
        "top_products": _with(BUFFER_CTE, "SELECT productId, category, count(*) AS count FROM buffer "
                                          "WHERE productId IS NOT NULL AND category IS NOT NULL GROUP BY ALL "
                                          "ORDER BY count DESC, productId, category LIMIT 10"),
        "category_popularity": _with(BUFFER_CTE, "SELECT category, count(*) AS count FROM buffer "
                                                 "WHERE category IS NOT NULL GROUP BY 1"),
        "device_counts": _with(BUFFER_CTE, "SELECT deviceType, count(*) AS count FROM buffer WHERE timestamp > "
                                           f"{AS_OF} - {_secs(C.DEVICE_WINDOW)} AND deviceType IS NOT NULL GROUP BY 1"),
        "device_popularity": _device_pivot(False),
        "device_share": _device_pivot(True),
        "device_total": _with(BUFFER_CTE, "SELECT CAST(count(*) AS BIGINT) AS total_devices FROM buffer "
                                          f"WHERE timestamp > {AS_OF} - {_secs(C.DEVICE_WINDOW)} "
                                          "AND deviceType IS NOT NULL"),
        "axis_bound": _with(BUFFER_CTE, "SELECT CAST(greatest(1, COALESCE(max(count), 1)) AS BIGINT) AS bound FROM ("
                                        "SELECT category, count(*) AS count FROM buffer WHERE category IS NOT NULL "
                                        "GROUP BY 1)"),
        "category_list": _with("", "SELECT DISTINCT category FROM products WHERE category IS NOT NULL"),
        "category_filter": _with("", f"SELECT id, category FROM products WHERE category IN ({cats})"),
        "latest_visitors": _with(BUFFER_CTE, latest),
        "raw_latest": _with(BUFFER_CTE, "SELECT * EXCLUDE (original_timestamp) FROM buffer "
                                        "ORDER BY timestamp DESC, event_id DESC LIMIT 100"),
        "drop_refreshes": _with("", "SELECT event_id, userId, productId FROM ("
                                    "SELECT event_id, userId, productId, lag(productId) OVER w AS prev, "
                                    "row_number() OVER w AS rn FROM clicks WHERE userId IS NOT NULL "
                                    "WINDOW w AS (PARTITION BY userId ORDER BY timestamp, event_id)) "
                                    "WHERE rn = 1 OR prev IS DISTINCT FROM productId"),
        "replay_delays": _with(REPLAY_CTE, "SELECT event_id, delay FROM rsched"),
        "replay_schedule": _with(REPLAY_CTE, "SELECT event_id, delay, \"at\" FROM rsched"),
        "align_union": _with("", "SELECT event_id, timestamp, userId, productId, age, gender, original_timestamp "
                                 "FROM clicks"),
        "snapshot_changed": _with(
            f"snap_now AS (SELECT * FROM enriched WHERE timestamp > {AS_OF} - {_secs(C.BUFFER)}),\n"
            f"snap_old AS (SELECT * FROM enriched WHERE timestamp <= {AS_OF} - INTERVAL 1 DAY "
            f"AND timestamp > {AS_OF} - INTERVAL 1 DAY - {_secs(C.BUFFER)}),\n"
            "d AS (SELECT (SELECT count(*) FROM (SELECT * FROM snap_now EXCEPT ALL SELECT * FROM snap_old)) AS only_new, "
            "(SELECT count(*) FROM (SELECT * FROM snap_old EXCEPT ALL SELECT * FROM snap_now)) AS only_old)",
            "SELECT only_new, only_old, only_new + only_old > 0 AS changed FROM d"),
        "visitor_upsert": _with(_upsert_ctes(), "SELECT * FROM upserted"),
        "packet_rows": _with("", "SELECT event_id, timestamp, userId, age, gender, ip, userAgent, productId "
                                 "FROM clicks"),
        "offers": _offers_sql(C.OFFER_WINDOW_MINUTES),
        "offers_default_window": _offers_sql(30).replace("clicks AS (SELECT event_id, timestamp,", f"clicks AS (SELECT event_id, make_timestamp({REPLAY_ORIGIN_US} "
                                                         f"+ CAST(floor((epoch_us(timestamp) - {REPLAY_ORIGIN_US}) / {C.REPLAY_SPEED}) AS BIGINT)) AS timestamp,"),
        "offers_month_window": _offers_sql(43200),
        "offer_events": _with(_sequence_ctes(C.OFFER_WINDOW_MINUTES),
                              "SELECT 'special-offers' AS topicName, userId AS streamId, "
                              "epoch_us(timestamp) * 1000 AS timestamp, 'offer' AS id, offer AS value "
                              "FROM fold WHERE entered = 'offer'", recursive=True),
        "recoveries": _recoveries_sql(),
        "offer_summary": _with(_sequence_ctes(C.OFFER_WINDOW_MINUTES),
                               "SELECT offer, count(*) AS offers, count(DISTINCT userId) AS visitors "
                               "FROM fold WHERE entered = 'offer' GROUP BY offer", recursive=True),
        "transition_log": _with(_sequence_ctes(C.OFFER_WINDOW_MINUTES) + ",\n" + TRANSITION_LOG_CTE,
                                "SELECT created, event_id, userId, line, msg FROM tlog", recursive=True),
        "log_tail": _with(_sequence_ctes(C.OFFER_WINDOW_MINUTES) + ",\n" + TRANSITION_LOG_CTE,
                          "SELECT created, event_id, line, strftime(created, '%Y-%m-%d %H:%M:%S') || ': ' || msg "
                          "AS text FROM (SELECT * FROM (SELECT * FROM tlog ORDER BY created DESC, event_id DESC, "
                          f"line DESC LIMIT {C.LOG_KEEP}) ORDER BY created DESC, event_id DESC, line DESC "
                          f"LIMIT {C.LOG_SHOW})", recursive=True),
    }


ODD_CTE = (f"odd AS (SELECT * REPLACE (CASE WHEN event_id % 97 = 0 THEN timestamp + INTERVAL {C.FUTURE_YEARS} YEAR "
           f"WHEN event_id % 89 = 0 THEN timestamp - INTERVAL {C.LATE_DAYS} DAY ELSE timestamp END AS timestamp) FROM clicks),\n"
           "odd_buckets AS (SELECT time_bucket(INTERVAL 30 minute, timestamp) AS datetime, userId, count(*) AS count "
           "FROM odd WHERE userId IS NOT NULL AND timestamp IS NOT NULL GROUP BY ALL)")


def _single_oracles() -> dict[str, str]:
    top = ("top AS (SELECT productId, category, count(*) AS count, row_number() OVER (ORDER BY count(*) DESC, productId, category) - 1 AS i "
           "FROM buffer WHERE productId IS NOT NULL AND category IS NOT NULL GROUP BY productId, category QUALIFY i < 10)")
    cols = " || '},' || ".join(f"""'"{c}":{{' || string_agg('"' || i || '":' || to_json({c})::VARCHAR, ',' ORDER BY i)"""
                               for c in ("productId", "category", "count"))
    seq = _sequence_ctes(C.OFFER_WINDOW_MINUTES)
    demographics = seq.replace("FROM enriched", "FROM enriched_known")
    known = "enriched_known AS (SELECT * FROM enriched WHERE gender IS NOT NULL AND age IS NOT NULL)"
    snap = (f"a AS (SELECT * FROM clicks WHERE timestamp > {AS_OF} - {_secs(C.BUFFER)}),\n"
            f"b AS (SELECT * FROM clicks WHERE timestamp <= {AS_OF} - INTERVAL 1 DAY AND timestamp > {AS_OF} - INTERVAL 1 DAY - {_secs(C.BUFFER)})")
    upserted = _upsert_ctes()
    versions = duckdb_ctes().replace("LEFT JOIN visitors v ON c.userId = v.userId",
                                     f"LEFT JOIN both_visitors v ON c.userId = v.userId AND v.late = coalesce(c.timestamp >= TIMESTAMP '{C.MERGE_SPLIT}', false)")
    versions = versions.replace("enriched AS (SELECT c.event_id", f"{upserted},\nboth_visitors AS (SELECT *, false AS late FROM visitors UNION ALL SELECT *, true FROM upserted),\nenriched AS (SELECT c.event_id")
    ipnum = "167772160 + TRY_CAST(split_part(ip, '.', 2) AS BIGINT) * 65536 + TRY_CAST(split_part(ip, '.', 3) AS BIGINT) * 256 + TRY_CAST(split_part(ip, '.', 4) AS BIGINT)"
    ranges = OVERLAPPING_SQL.format(nation_cols=", ".join(IP_RANGE_COLUMNS_NATION), region_cols=", ".join(IP_RANGE_COLUMNS_REGION),
                                    supplier_cols=", ".join(SUPPLIER_RANGE_COLUMNS), nation="nation", supplier="supplier")
    return {
        "snapshot_digest": _with(snap, "SELECT (SELECT count(*) FROM a) AS rows_a, (SELECT count(*) FROM b) AS rows_b, EXISTS (SELECT * FROM a EXCEPT ALL SELECT * FROM b) "
                                       "OR EXISTS (SELECT * FROM b EXCEPT ALL SELECT * FROM a) AS changed"),
        "overlapping_ranges": _with(f"overlapping AS ({ranges})", f"SELECT event_id, ip, code FROM (SELECT c.event_id, c.ip, r.code, row_number() OVER (PARTITION BY c.event_id "
                                    f"ORDER BY r.hi - r.lo, r.lo DESC, r.code) AS place FROM clicks c LEFT JOIN overlapping r ON ({ipnum}) BETWEEN r.lo AND r.hi) WHERE place = 1"),
        "stream_enrich_versions": f"WITH {versions}\nSELECT * FROM enriched",
        "log_file_order": _with("numbered AS (SELECT row_number() OVER (ORDER BY event_id) - 1 AS line, userId, " + _product_id("url") + " AS productId, _epoch FROM raw_clicks)",
                                "SELECT line, userId, productId, _epoch AS original_timestamp, CASE WHEN following IS NOT NULL THEN CAST(least(greatest(following - _epoch, 0), 10) AS DOUBLE) END AS delay "
                                "FROM (SELECT *, lead(_epoch) OVER (ORDER BY line) AS following FROM numbered)"),
        "topic_arrival": _with("", f"SELECT {relative_time_sql('timestamp', AS_OF)} AS \"Relative Time\", strftime(timestamp, '%Y-%m-%d %H:%M:%S') AS \"Date and Time\", ip, country "
                                   f"FROM (SELECT * FROM enriched ORDER BY timestamp + to_seconds(event_id % {C.TOPIC_DELAY_SECONDS}) DESC, event_id DESC LIMIT 10)"),
        "lookup_keys": _with("", "SELECT 'product:' || id AS key, 'shop-' || category AS topic FROM products UNION ALL SELECT 'visitor:' || userId, 'shop-visitors' FROM visitors"),
        "asset_paths": _with("", "SELECT id, 'assets/products/' || id || '.jpg' AS path FROM products UNION ALL "
                                 "SELECT userId, CASE WHEN gender = 'M' THEN 'assets/offer1.png' ELSE 'assets/offer2.png' END FROM visitors"),
        "text_cleanup": "SELECT 'document' AS kind, doc_id AS id, sha256(regexp_replace(text, '\n', '')) AS text_sha256 FROM documents UNION ALL "
                        f"SELECT 'page', page_id, sha256(coalesce(nullif(regexp_extract(url, '^https?://{C.HOST_SERVICE}\\.([a-zA-Z]+)\\.', 1), ''), 'platform')) FROM pages",
        "age_domain": _with("", f"SELECT userId, age, age BETWEEN 18 AND 65 AS valid FROM (SELECT userId, {_age_sql('birthDate', AS_OF)} AS age FROM visitors)"),
        "click_lag": _with("", "SELECT event_id, (epoch_us(timestamp) - original_timestamp * 1000000) / 1e6 AS lag FROM clicks WHERE original_timestamp IS NOT NULL"),
        "arrival_stamp": _with("", "SELECT count(*) AS stamped, count(*) FILTER (now()::TIMESTAMP > timestamp) AS later_than_click FROM clicks"),
        "stream_recovery": _with("", "SELECT CAST(timestamp AS DATE) AS day, count(*) AS clicks, count(DISTINCT event_id) AS ids FROM clicks GROUP BY 1"),
        "pane_marts": _pane_marts_sql(top),
        "stream_progress": _with("", f"SELECT 'progress' AS name, CAST({C.STREAM_SLICES} AS BIGINT) AS batches, count(*) AS rows FROM clicks"),
        "snapshot_json": _with(BUFFER_CTE + ",\n" + top, f"SELECT 'top_products' AS key, '{{' || {cols} || '}}}}' AS value FROM top"),
        "stream_odd_times": _with(ODD_CTE, "SELECT * FROM odd_buckets"),
        "odd_time_counts": _with(ODD_CTE, f"SELECT CAST(coalesce(sum(count) FILTER (datetime > {AS_OF}), 0) AS BIGINT) AS future, "
                                          f"CAST(coalesce(sum(count) FILTER (datetime < {AS_OF} - {_secs('8 hours 30 minutes')}), 0) AS BIGINT) AS late, "
                                          "CAST(coalesce(sum(count), 0) AS BIGINT) AS clicks FROM odd_buckets"),
        "catalogue_files": _with("", "SELECT id, category, title, price FROM products"),
        "visitor_files": _with("", "SELECT userId, birthDate, gender FROM visitors"),
        "keyed_messages": _with("", "SELECT userId AS key, '{' || array_to_string(list_filter(["
                                    "'\"event_id\":' || event_id, '\"userId\":' || to_json(userId)::VARCHAR, "
                                    "'\"productId\":' || to_json(productId)::VARCHAR], lambda x: x IS NOT NULL), ',') || '}' AS value, "
                                    "'parent' AS header, userId AS parent FROM clicks"),
        "offer_subscription": _with(seq, "SELECT 'special-offers' AS topicName, userId AS streamId, epoch_us(timestamp) * 1000 AS timestamp, "
                                         "'offer' AS id, offer AS value FROM fold WHERE entered = 'offer' "
                                         "AND userId = (SELECT min(userId) FROM fold WHERE entered = 'offer')", recursive=True),
        "product_detail": _with("", "SELECT id, category, title, price FROM products WHERE id = (SELECT max(id) FROM products)"),
        "offers_demographics": _with(known + ",\n" + demographics,
                                     "SELECT userId, event_id, timestamp, offer FROM fold WHERE entered = 'offer'", recursive=True),
    }


def stream_oracles(base: dict[str, str]) -> dict[str, str]:
    """Streaming forms must equal their batch forms on time-ordered input."""
    return {"snapshot_roundtrip": base["top_products"], "stream_enrich": base["enrich_clicks"], "stream_bucket_counts": base["user_bucket_counts"],
            "stream_visitors_per_bucket": base["visitors_per_bucket"], "stream_offers": base["offers"], "stream_expiry": base["offers"],
            "stream_bucket_compaction": base["user_bucket_counts"], "stream_detection": base["transition_log"]}


def _product_id(url: str) -> str:
    from ..sources.testbed import product_id_sql
    return product_id_sql(url, "duckdb")
