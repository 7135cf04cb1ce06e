"""K5: field-level upsert of a keyed dimension (lookup ingestion).

The reference writes each non-null field of each incoming record into a
key-value hash: a null field is skipped so the stored value survives, and
for duplicate keys the later record wins field by field. As a set
operation: per key and field, the value of the latest record whose field
is not null (``max_by`` over the arrival sequence, partial-aggregated
before the shuffle, so a hot key costs one small row per task), then a
full outer join with the stored table and ``coalesce(new, old)``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_non_null(updates: DataFrame, key: str, fields: list[str], seq: str = "seq") -> DataFrame:
    """Per key: each field's value from the latest update where it is set."""
    aggs = [F.max_by(f, F.when(F.col(f).isNotNull(), F.col(seq))).alias(f) for f in fields]
    return updates.filter(F.col(key).isNotNull()).groupBy(key).agg(*aggs)


def upsert_fields(stored: DataFrame, updates: DataFrame, key: str, fields: list[str],
                  seq: str = "seq") -> DataFrame:
    """New state of the stored table after applying ``updates`` (K5)."""
    new = latest_non_null(updates, key, fields, seq)
    s = stored.select(key, *[F.col(f).alias(f"_old_{f}") for f in fields])
    n = new.select(F.col(key).alias("_nkey"), *[F.col(f).alias(f"_new_{f}") for f in fields])
    j = s.join(n, s[key] == n["_nkey"], "full_outer")
    return j.select(F.coalesce(F.col(key), F.col("_nkey")).alias(key),
                    *[F.coalesce(f"_new_{f}", f"_old_{f}").alias(f) for f in fields])


# A second visitor load derived from the customer table: two records per
# customer (seq 1 and 2) with deliberately missing fields. Plain SQL text,
# valid in Spark and DuckDB.
UPDATE_COLUMNS_FIRST = [
    "CAST(c_custkey AS STRING) AS userId",
    "CASE WHEN c_custkey % 2 = 0 THEN NULL "
    "ELSE CAST(DATE '1970-01-01' + CAST((c_custkey * 71) % 15000 AS INT) AS STRING) END AS birthDate",
    "CASE WHEN c_custkey % 5 = 0 THEN 'F' END AS gender",
    "1 AS seq",
]
UPDATE_COLUMNS_SECOND = [
    "CAST(c_custkey AS STRING) AS userId",
    "NULL AS birthDate",
    "CASE WHEN c_mktsegment = 'BUILDING' THEN 'M' END AS gender",
    "2 AS seq",
]


def visitor_updates_from_customers(customer: DataFrame) -> DataFrame:
    """Update records for ``upsert_fields`` built from the customer table."""
    first = customer.selectExpr(*UPDATE_COLUMNS_FIRST)
    second = customer.selectExpr(*UPDATE_COLUMNS_SECOND).withColumn("birthDate", F.col("birthDate").cast("string"))
    return first.unionByName(second)
