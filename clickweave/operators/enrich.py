"""Click enrichment (J1-J6, J8, F3-F9) as joins, never per-row lookups.

Plan shape: plain left joins without hints. Spark broadcasts a dimension whose
size (file statistics, or measured at run time by AQE) is under
``spark.sql.autoBroadcastJoinThreshold``; a larger one is joined with a shuffle
on the key, where AQE splits partitions of hot visitors/products. A key that a
lookup table holds several times gives its last record (largest ``seq`` if the
table has one), as in a key-value store, and an IP that lies in several ranges gives the
narrowest, so lookups never repeat a click. ``prepare_lookups`` settles both for the
lookup tables alone; ``sources.dimensions`` keeps what it makes, and ``enrich_prepared``
joins it as it is.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.device import device_type
from ..functions.temporal import age_from_birthdate
from ..functions.visitors import UNKNOWN, UNKNOWN_GENDER, age_to_int, gender_letter, or_default
from ..streaming.sources import ARRIVAL
from .range_join import IP_BUCKET_BITS, disjoint_ranges, ip_to_long, interval_lookup, range_lookup

# fixed values: output columns and their order
ENRICHED_COLUMNS = ["event_id", "timestamp", "original_timestamp", "userId", "ip", "userAgent",
                    "productId", "category", "title", "birthdate", "country", "deviceType", "age", "gender"]


def last_per_key(table: DataFrame, key: str) -> DataFrame:
    """One row per key: the record with the largest ``seq`` (without such a column, the
    largest record), whole. Null keys are kept out: they match nothing."""
    rest = [c for c in table.columns if c != key]
    order = F.struct(*(["seq"] if "seq" in rest else []), *[c for c in rest if c != "seq"])
    last = table.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(order).alias("_last"))
    return last.select(key, *[F.col(f"_last.{c}").alias(c) for c in rest])


def prepare_lookups(products: DataFrame, visitors: DataFrame, ip_ranges: DataFrame, countries: DataFrame) -> dict[str, DataFrame]:
    """The lookup tables with one row a key, and disjoint IP intervals with country names."""
    return {
        "products": last_per_key(products, "id").select("id", "category", "title"),
        "visitors": last_per_key(visitors, "userId").select("userId", "birthDate", "gender"),
        "country_ranges": disjoint_ranges(country_table(ip_ranges, countries), ["country"]),
    }


def with_product(clicks: DataFrame, products: DataFrame, prepared: bool = False) -> DataFrame:
    """J1 + J2: category and title in one join; null or '' -> 'Unknown'. ``prepared``: one row a key."""
    p = (products if prepared else last_per_key(products, "id")).select(F.col("id").alias("_pid"), F.col("category").alias("_cat"),
                                                                        F.col("title").alias("_title"))
    out = clicks.join(p, clicks["productId"] == p["_pid"], "left")
    return (out.withColumn("category", or_default("_cat", UNKNOWN))
               .withColumn("title", or_default("_title", UNKNOWN))
               .drop("_pid", "_cat", "_title"))


def with_gender(clicks: DataFrame, visitors: DataFrame, prepared: bool = False) -> DataFrame:
    """J3, J4 + F7: the click's own gender, else the visitor's, else 'U'."""
    v = (visitors if prepared else last_per_key(visitors, "userId")).select(F.col("userId").alias("_vid"), F.col("gender").alias("_vgender"))
    out = clicks.join(v, clicks["userId"] == v["_vid"], "left")
    return out.withColumn("gender", _gender()).drop("_vid", "_vgender")


def _gender() -> Column:
    given = F.col("gender").isNotNull() & (F.col("gender") != "")
    return F.when(given, gender_letter("gender")).otherwise(or_default("_vgender", UNKNOWN_GENDER))


def country_table(ip_ranges: DataFrame, countries: DataFrame) -> DataFrame:
    """J6 folded into the range table: (lo, hi, country) with 'Unknown' names."""
    names = last_per_key(countries, "code").select(F.col("code").alias("_code"), F.col("name").alias("_name"))
    return (ip_ranges.join(names, ip_ranges["code"] == names["_code"], "left")
            .select("lo", "hi", or_default("_name", UNKNOWN).alias("country")))


def with_country(clicks: DataFrame, ip_ranges: DataFrame, countries: DataFrame,
                 ip_col: str = "ip") -> DataFrame:
    """J5 + J6: IP -> range -> country name; anything unmatched -> 'Unknown'."""
    ranges = country_table(ip_ranges, countries)
    out = range_lookup(clicks.withColumn("_ipnum", ip_to_long(ip_col)), "_ipnum", ranges, ["country"])
    return out.withColumn("country", F.coalesce("country", F.lit(UNKNOWN))).drop("_ipnum")


def with_prepared_country(clicks: DataFrame, country_ranges: DataFrame, ip_col: str = "ip") -> DataFrame:
    """J5 + J6 with the prepared interval table."""
    out = interval_lookup(clicks.withColumn("_ipnum", ip_to_long(ip_col)), "_ipnum", country_ranges, ["country"])
    return out.withColumn("country", F.coalesce("country", F.lit(UNKNOWN))).drop("_ipnum")


def enrich(clicks: DataFrame, products: DataFrame, visitors: DataFrame,
           ip_ranges: DataFrame, countries: DataFrame, as_of: Column | None = None,
           strict_age: bool = True) -> DataFrame:
    """Full enrichment with lookup tables as they come (see ``enrich_prepared``)."""
    return enrich_prepared(clicks, prepare_lookups(products, visitors, ip_ranges, countries), as_of, strict_age)


def enrich_prepared(clicks: DataFrame, lookups: dict[str, DataFrame], as_of: Column | None = None,
                    strict_age: bool = True, keep: Sequence[str] = ()) -> DataFrame:
    """Full enrichment of click-data into enriched-click-data, with prepared lookup tables.

    ``as_of`` is the "today" used for ages computed from birth dates; by
    default each click's own timestamp (the moment the reference would have
    enriched it live). Given age/gender on a row win over the lookup (F7).
    Arrival columns of a topic stay, and those named in ``keep``.
    Built as three left joins and one projection (few plan steps to analyse).
    """
    as_of = F.col("timestamp") if as_of is None else as_of
    prod = lookups["products"].select(F.col("id").alias("_pid"), F.col("category").alias("_cat"), F.col("title").alias("_title"))
    vis = lookups["visitors"].select(F.col("userId").alias("_vid"), F.col("birthDate").alias("_birth"), F.col("gender").alias("_vgender"))
    ranges = lookups["country_ranges"].select("_bucket", F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), F.col("country").alias("_country"))
    ipnum = ip_to_long("ip")
    c = clicks.withColumns({"_ipnum": ipnum, "_vbucket": F.shiftright(ipnum, IP_BUCKET_BITS)})
    j = (c.join(prod, c["productId"] == prod["_pid"], "left")
         .join(vis, c["userId"] == vis["_vid"], "left")
         .join(ranges, (c["_vbucket"] == ranges["_bucket"]) & (c["_ipnum"] >= ranges["_lo"])
               & (c["_ipnum"] <= ranges["_hi"]), "left"))
    out = {
        "category": or_default("_cat", UNKNOWN),
        "title": or_default("_title", UNKNOWN),
        "birthdate": F.to_date("_birth", "yyyy-MM-dd"),
        "country": F.coalesce("_country", F.lit(UNKNOWN)),
        "deviceType": device_type("userAgent"),
        "age": F.coalesce(age_to_int("age", strict_age), age_from_birthdate("_birth", as_of)),
        "gender": _gender(),
    }
    arrival = [c for c in ARRIVAL if c in clicks.columns]
    return j.select(*[out[c].alias(c) if c in out else F.col(c) for c in ENRICHED_COLUMNS], *arrival, *keep)


def known_product_clicks(clicks: DataFrame, products: DataFrame) -> DataFrame:
    """Keep only clicks whose product exists (left semi join)."""
    return clicks.join(products.select(F.col("id").alias("productId")), "productId", "left_semi")
