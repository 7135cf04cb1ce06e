"""Adapter: the supplied test tables -> the click / dimension schemas.

The reference reads a raw page-view log, a product catalogue, a visitor
file, an IP-range registry and an ISO country list. The test data has none
of these, so each is *derived* from a whole test table with deterministic
expressions -- no row is filtered out, so every derived table grows with its
source. The expressions are written once as SQL text and rendered for two
dialects (Spark and DuckDB), so the Spark plan and the DuckDB oracle read
exactly the same inputs.

Branch coverage comes from the data itself: error events point at a URL the
product pattern does not match (-> productId is the URL -> category
"Unknown"), click events are "live" shop rows carrying worded gender and
text age, some visitors lack birth date or gender, every nation's /16 block
has a sub-range whose code has no country name and one /16 with no range
at all, and the user-agent mix covers every device rung plus null.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.device import device_case_sql
from ..functions.temporal import time_literal
from ..functions.text import PRODUCT_URL_PATTERN

# dialect-specific snippets
_DIALECT = {
    "spark": {
        "k": "get_json_object(props, '$.k')",
        "epoch": "unix_timestamp(CAST(ts AS TIMESTAMP))",
        "regex": "rlike",
        "url_pattern": "(?U)" + PRODUCT_URL_PATTERN,
    },
    "duckdb": {
        "k": "json_extract_string(props, '$.k')",
        "epoch": "CAST(epoch(date_trunc('second', ts)) AS BIGINT)",
        "regex": "regexp_matches",
        "url_pattern": PRODUCT_URL_PATTERN,
    },
}

# Raw page-view log as the producer would publish it (before F2).
RAW_CLICK_COLUMNS = [
    "event_id",
    "ts AS timestamp",
    "CASE WHEN event_type = 'click' THEN NULL ELSE {epoch} END AS original_timestamp",
    "CAST(user_id AS STRING) AS userId",
    "CONCAT('10.', CAST(user_id % 256 AS STRING), '.', CAST(event_id % 200 AS STRING), '.', "
    "CAST(event_id % 256 AS STRING)) AS ip",
    "CASE WHEN event_id % 20 = 0 THEN NULL "
    "WHEN event_id % 7 = 0 THEN 'Mozilla/5.0 (iPad; CPU OS 16_0 like Mac OS X)' "
    "WHEN event_id % 5 = 0 THEN 'Googlebot/2.1 (+http://www.google.com/bot.html)' "
    "WHEN event_id % 3 = 0 THEN 'Mozilla/5.0 (iPhone; CPU iPhone OS 16_0 like Mac OS X) Mobile' "
    "WHEN event_id % 2 = 0 THEN 'Mozilla/5.0 (Windows NT 10.0; Win64; x64)' "
    "ELSE 'curl/8.0' END AS userAgent",
    "CASE WHEN event_type = 'error' THEN 'http://www.acme.com/404' "
    "ELSE CONCAT('http://www.acme.com/', event_type, '/', {k}) END AS url",
    "CASE WHEN event_type = 'click' THEN CAST(18 + user_id % 48 AS STRING) END AS age",
    "CASE WHEN event_type <> 'click' THEN NULL WHEN user_id % 3 = 0 THEN 'Male' "
    "WHEN user_id % 3 = 1 THEN 'Female' ELSE 'Unknown' END AS gender",
]

PRODUCT_COLUMNS = [
    "CAST(p_partkey AS STRING) AS id",
    "CASE WHEN p_size = 50 THEN '' WHEN p_type IN ('ECONOMY', 'MEDIUM', 'LARGE') THEN 'clothing' "
    "WHEN p_type IN ('SMALL', 'PROMO') THEN 'shoes' ELSE 'books' END AS category",
    "p_name AS title",
    "p_retailprice AS price",
]

VISITOR_COLUMNS = [
    "CAST(c_custkey AS STRING) AS userId",
    "CASE WHEN c_mktsegment = 'MACHINERY' AND c_custkey % 2 = 1 THEN NULL "
    "ELSE CAST(DATE '1960-02-29' + CAST((c_custkey * 137) % 18000 AS INT) AS STRING) END AS birthDate",
    "CASE WHEN c_custkey % 3 = 0 THEN 'M' WHEN c_custkey % 3 = 1 THEN 'F' END AS gender",
]

# Each nation owns ten /16 blocks of 10.0.0.0/8: eight map to its code, one
# to a code without a country name, the tenth is not covered at all.
IP_RANGE_COLUMNS_NATION = [
    "CAST(167772160 + CAST(n_nationkey AS BIGINT) * 655360 AS BIGINT) AS lo",
    "CAST(167772160 + CAST(n_nationkey AS BIGINT) * 655360 + 8 * 65536 - 1 AS BIGINT) AS hi",
    "CONCAT('N', CAST(n_nationkey AS STRING)) AS code",
]
IP_RANGE_COLUMNS_REGION = [
    "CAST(167772160 + CAST(n_nationkey AS BIGINT) * 655360 + 8 * 65536 AS BIGINT) AS lo",
    "CAST(167772160 + CAST(n_nationkey AS BIGINT) * 655360 + 9 * 65536 - 1 AS BIGINT) AS hi",
    "CONCAT('R', CAST(n_regionkey AS STRING)) AS code",
]
# Overlapping ranges, as SQL text for both dialects.
SUPPLIER_RANGE_COLUMNS = [
    "CAST(167772160 + (s_suppkey % 256) * 65536 + (s_suppkey % 200) * 256 AS BIGINT) AS lo",
    "CAST(167772160 + (s_suppkey % 256) * 65536 + (s_suppkey % 200) * 256 + 255 AS BIGINT) AS hi",
    "CONCAT('S', CAST(s_nationkey AS STRING)) AS code",
]
OVERLAPPING_SQL = """SELECT {nation_cols} FROM {nation}
UNION ALL SELECT {region_cols} FROM {nation}
UNION ALL SELECT CAST(167772160 + min(CAST(n_nationkey AS BIGINT)) * 655360 AS BIGINT) AS lo,
  CAST(167772160 + (max(CAST(n_nationkey AS BIGINT)) + 1) * 655360 - 1 AS BIGINT) AS hi, CONCAT('W', CAST(n_regionkey AS STRING)) AS code
  FROM {nation} GROUP BY n_regionkey
UNION ALL SELECT {supplier_cols} FROM {supplier}"""
COUNTRY_COLUMNS = [
    "CONCAT('N', CAST(n_nationkey AS STRING)) AS code",
    "n_name AS name",
]


def rendered_columns(cols: list[str], dialect: str) -> list[str]:
    d = _DIALECT[dialect]
    return [c.format(**d) for c in cols]


def product_id_sql(url: str, dialect: str) -> str:
    d = _DIALECT[dialect]
    pat = d["url_pattern"].replace("'", "''")
    if dialect == "spark":
        return f"CASE WHEN {url} RLIKE '{pat}' THEN regexp_extract({url}, '{pat}', 2) ELSE {url} END"
    return f"CASE WHEN regexp_matches({url}, '{pat}') THEN regexp_extract({url}, '{pat}', 2) ELSE {url} END"


# --------------------------------------------------------------------- Spark

def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def raw_clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw page views: ``url`` still unparsed, worded gender on live rows."""
    return read_table(spark, sf_dir, "events").selectExpr(*rendered_columns(RAW_CLICK_COLUMNS, "spark"))


def clicks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """click-data: raw rows with productId taken from the URL (F2)."""
    from ..functions.text import product_id_from_url
    raw = raw_clicks(spark, sf_dir)
    return raw.withColumn("productId", product_id_from_url("url")).drop("url")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "part").selectExpr(*rendered_columns(PRODUCT_COLUMNS, "spark"))


def visitors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "customer").selectExpr(*rendered_columns(VISITOR_COLUMNS, "spark"))


def ip_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = read_table(spark, sf_dir, "nation")
    return (nation.selectExpr(*IP_RANGE_COLUMNS_NATION)
            .unionByName(nation.selectExpr(*IP_RANGE_COLUMNS_REGION)))


def countries(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_table(spark, sf_dir, "nation").selectExpr(*COUNTRY_COLUMNS)


def load(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    return {
        "clicks": clicks(spark, sf_dir),
        "products": products(spark, sf_dir),
        "visitors": visitors(spark, sf_dir),
        "ip_ranges": ip_ranges(spark, sf_dir),
        "countries": countries(spark, sf_dir),
    }


REPLAY_ORIGIN_US = 1704067200000000  # 2024-01-01, from which a faster replay is counted


def faster(clicks: DataFrame, speed: int) -> DataFrame:
    """The clicks with the time since the origin divided by ``speed``."""
    us = F.unix_micros(F.col("timestamp").cast("timestamp")) - REPLAY_ORIGIN_US
    return clicks.withColumn("timestamp", F.timestamp_micros(F.lit(REPLAY_ORIGIN_US) + F.floor(us / speed)).cast("timestamp_ntz"))


def overlapping_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """IP ranges that overlap and nest: the nations' and regions' ranges, one range around all of a
    region's, and a /24 (some repeated with another code) per supplier."""
    return spark.sql(OVERLAPPING_SQL.format(nation_cols=", ".join(IP_RANGE_COLUMNS_NATION), region_cols=", ".join(IP_RANGE_COLUMNS_REGION),
                                            supplier_cols=", ".join(SUPPLIER_RANGE_COLUMNS), nation="{nation}", supplier="{supplier}"),
                     nation=read_table(spark, sf_dir, "nation"), supplier=read_table(spark, sf_dir, "supplier"))


def stage_time_slices(df: DataFrame, path: str, slices: int, files_per_slice: int,
                      ts: str = "timestamp") -> None:
    """Write ``df`` as ``slices`` consecutive event-time ranges, one write job
    per slice in time order, each range-partitioned on time into
    ``files_per_slice`` files. A file source with
    ``maxFilesPerTrigger=files_per_slice`` then replays the table as
    time-ordered micro-batches. Rows without a time go with the first slice. The frame is
    computed once, into a folder beside ``path`` that is partitioned by slice, so a slice's
    jobs read that slice alone. (Replay tooling for the registered
    streaming queries; production input is the broker.)"""
    whole = f"{path.rstrip('/')}-whole-{uuid.uuid4().hex}"
    b = df.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi")).first()
    lo, hi = b["lo"], b["hi"]
    if lo is None:
        return
    step, dtype = (hi - lo) / slices, df.schema[ts].dataType.simpleString()
    number = F.lit(0)
    for i in range(1, slices):
        number = number + F.coalesce((F.col(ts) >= time_literal(lo + step * i, dtype)).cast("int"), F.lit(0))
    df.withColumn("_slice", number).write.partitionBy("_slice").parquet(whole)
    staged = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField("_slice", T.IntegerType())])).parquet(whole)
    for i in range(slices):
        part = staged.where(F.col("_slice") == i).drop("_slice")
        part.repartitionByRange(files_per_slice, ts).write.mode("append").parquet(path)


# -------------------------------------------------------------------- DuckDB

def duckdb_ctes() -> str:
    """``WITH``-list body defining the same five tables (plus ``enriched``)."""
    raw = ",\n  ".join(rendered_columns(RAW_CLICK_COLUMNS, "duckdb"))
    pid = product_id_sql("url", "duckdb")
    prod = ",\n  ".join(rendered_columns(PRODUCT_COLUMNS, "duckdb"))
    vis = ",\n  ".join(rendered_columns(VISITOR_COLUMNS, "duckdb"))
    ipn = ", ".join(IP_RANGE_COLUMNS_NATION)
    ipr = ", ".join(IP_RANGE_COLUMNS_REGION)
    ctry = ", ".join(COUNTRY_COLUMNS)
    epoch = _DIALECT["duckdb"]["epoch"]
    ipnum = ("TRY_CAST(split_part(c.ip, '.', 1) AS BIGINT) * 16777216 + "
             "TRY_CAST(split_part(c.ip, '.', 2) AS BIGINT) * 65536 + "
             "TRY_CAST(split_part(c.ip, '.', 3) AS BIGINT) * 256 + "
             "TRY_CAST(split_part(c.ip, '.', 4) AS BIGINT)")
    dev = device_case_sql("c.userAgent")
    return f"""
raw_clicks AS (SELECT
  {raw},
  {epoch} AS _epoch
FROM events),
clicks AS (SELECT event_id, timestamp, original_timestamp, userId, ip, userAgent,
  {pid} AS productId, age, gender FROM raw_clicks),
products AS (SELECT
  {prod}
FROM part),
visitors AS (SELECT
  {vis}
FROM customer),
ip_ranges AS (SELECT {ipn} FROM nation UNION ALL SELECT {ipr} FROM nation),
countries AS (SELECT {ctry} FROM nation),
enriched AS (SELECT c.event_id, c.timestamp, c.original_timestamp, c.userId, c.ip, c.userAgent, c.productId,
  COALESCE(NULLIF(p.category, ''), 'Unknown') AS category,
  COALESCE(NULLIF(p.title, ''), 'Unknown') AS title,
  CAST(v.birthDate AS DATE) AS birthdate,
  COALESCE(NULLIF(k.name, ''), 'Unknown') AS country,
  {dev} AS deviceType,
  CAST(COALESCE(CAST(c.age AS INTEGER),
    year(CAST(c.timestamp AS DATE)) - year(CAST(v.birthDate AS DATE))
    - CAST(month(CAST(c.timestamp AS DATE)) * 100 + day(CAST(c.timestamp AS DATE))
         < month(CAST(v.birthDate AS DATE)) * 100 + day(CAST(v.birthDate AS DATE)) AS INTEGER)) AS INTEGER) AS age,
  CASE WHEN c.gender IS NOT NULL AND c.gender <> '' THEN substr(c.gender, 1, 1)
       ELSE COALESCE(NULLIF(v.gender, ''), 'U') END AS gender
FROM clicks c
LEFT JOIN products p ON c.productId = p.id
LEFT JOIN visitors v ON c.userId = v.userId
LEFT JOIN ip_ranges r ON ({ipnum}) BETWEEN r.lo AND r.hi
LEFT JOIN countries k ON r.code = k.code)"""
