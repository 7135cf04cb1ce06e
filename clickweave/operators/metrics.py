"""Dashboard metrics (G1-G13, J7, P6-P9, T1-T5, W4) as pure DataFrame functions.

Each function takes the enriched click table (or an aggregate of it) and an
explicit ``as_of`` Column, and returns a small result table. They run the
same on a batch table and inside ``foreachBatch``. Every aggregation is a
hash aggregate with map-side partial combine; every top-k is a
``TakeOrderedAndProject`` (no global sort of the input). Null group keys
are dropped, as the reference's grouping does.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.temporal import floor_hour, floor_minute, format_datetime, relative_time, step_seconds, time_literal

TS = "timestamp"


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def default_as_of(df: DataFrame, ts: str = TS) -> Column:
    """Batch default "now": the newest event time.

    Computed once (one small aggregate over the time column) and inlined as
    a literal, so every trailing filter built from it is pushed down to the
    Parquet scan (row-group / partition skipping) instead of being a
    scalar subquery evaluated after the scan.
    """
    dtype = df.schema[ts].dataType.simpleString()
    return time_literal(df.agg(F.max(ts)).first()[0], dtype)


def interval(text: str) -> Column:
    """A day-time interval literal from text such as ``"10 minutes"``."""
    return F.make_dt_interval(secs=F.lit(step_seconds(text)))


# ------------------------------------------------------------- filters

def trailing(df: DataFrame, as_of: Column, within: str, ts: str = TS,
             inclusive: bool = False) -> DataFrame:
    """P6 (strict ``ts > as_of - within``) / P7 (``>=``). No upper bound."""
    bound = as_of - interval(within)
    return df.filter(_c(ts) >= bound if inclusive else _c(ts) > bound)


def category_filter(df: DataFrame, selection: list[str], col: str = "category") -> DataFrame:
    """Multi-select; an empty selection keeps every row."""
    return df.filter(F.col(col).isin(selection)) if selection else df


# ----------------------------------------------------------- buckets

def bucket_start(ts, every: str) -> Column:
    """Epoch-aligned tumbling bucket start (X5), keeps the input's timestamp type."""
    return F.window(_c(ts), every).start


def user_bucket_counts(df: DataFrame, every: str = "30 minutes", ts: str = TS) -> DataFrame:
    """G1: views per (bucket, visitor); only observed groups."""
    return (df.filter(F.col("userId").isNotNull() & F.col(ts).isNotNull())
            .groupBy(bucket_start(ts, every).alias("datetime"), "userId")
            .agg(F.count(F.lit(1)).alias("count")))


def merge_partials(old: DataFrame, new: DataFrame) -> DataFrame:
    """Running totals = old partial counts + new partial counts."""
    return (old.unionByName(new, allowMissingColumns=True)
            .groupBy("datetime", "userId").agg(F.sum("count").cast("long").alias("count")))


def recent_visitors_per_bucket(clicks: DataFrame, as_of: Column, within: str = "8 hours 30 minutes", ts: str = TS) -> DataFrame:
    """G3 from clicks. A click is never before its bucket's start, so the clicks of the buckets
    asked for are all within the window: the filter reaches the scan."""
    return visitors_per_bucket(user_bucket_counts(trailing(clicks, as_of, within, ts, inclusive=True), ts=ts), as_of, within)


def visitors_per_bucket(buckets: DataFrame, as_of: Column, within: str = "8 hours 30 minutes") -> DataFrame:
    """G3 + P7: distinct visitors per 30-min bucket over the inclusive window.

    The reference counts rows of the (bucket, visitor) table per bucket and
    keeps both counted columns, so ``userId`` and ``count`` are equal.
    """
    b = trailing(buckets, as_of, within, ts="datetime", inclusive=True)
    return b.groupBy("datetime").agg(F.count("userId").alias("userId"), F.count("count").alias("count"))


# ------------------------------------------------------- per-minute

def visits_per_minute(df: DataFrame, as_of: Column, within: str = "15 minutes", ts: str = TS) -> DataFrame:
    """Views per minute over the trailing window; inner gaps filled with 0.

    A lone time grouper fills every minute between the first and the last
    observed one. The axis is built from the (at most ``within``/1 min)
    aggregated minutes, never from the click rows.
    """
    recent = trailing(df, as_of, within, ts)
    # date_trunc yields TIMESTAMP; keep the input's type (e.g. TIMESTAMP_NTZ)
    minute = floor_minute(ts).cast(df.schema[ts].dataType)
    return filled_minutes(recent.groupBy(minute.alias("datetime")).agg(F.count(F.lit(1)).alias("count")))


def filled_minutes(counts: DataFrame) -> DataFrame:
    """Counts per minute (datetime, count) with 0 for the minutes missing between the first and the last.

    The counts are one row a minute of the window; each is followed by the empty minutes up to
    the next one, so the clicks behind them are read once."""
    step = interval("1 minute")
    following = F.lead("datetime").over(Window.orderBy("datetime"))  # at most a row a minute of the window
    rows = counts.where(F.col("datetime").isNotNull()).select("datetime", "count", following.alias("_next"))
    return rows.select(F.explode(F.sequence("datetime", F.coalesce(F.col("_next") - step, "datetime"), step)).alias("_minute"), "datetime", "count").select(
        F.col("_minute").alias("datetime"), F.when(F.col("_minute") == F.col("datetime"), F.col("count")).otherwise(0).cast("long").alias("count"))


def dense_axis(like: DataFrame, end: Column, periods: int, step: str) -> DataFrame:
    """F14 as a table: ``periods`` points ending at ``end`` (one column)."""
    from ..functions.temporal import time_axis
    return like.sparkSession.range(1).select(F.explode(time_axis(end, periods, step)).alias("datetime"))


def densify(counts: DataFrame, end: Column, periods: int, step: str,
            value: str = "count") -> DataFrame:
    """Generated time axis left-joined with counts, missing -> 0."""
    axis = dense_axis(counts, end.cast(counts.schema["datetime"].dataType), periods, step)
    return (axis.join(counts.select("datetime", value), "datetime", "left")
            .select("datetime", F.coalesce(value, F.lit(0)).cast("long").alias(value)))


def visits_dense_15m(df: DataFrame, as_of: Column, ts: str = TS) -> DataFrame:
    """Dashboard chart: 15 one-minute points ending at floor(as_of, minute)."""
    return densify(visits_per_minute(df, as_of, "15 minutes", ts), floor_minute(as_of), 15, "1 minute")


def sessions_dense_8h(buckets: DataFrame, as_of: Column) -> DataFrame:
    """Dashboard chart: 16 half-hour points ending at floor(as_of, hour)."""
    return densify(visitors_per_bucket(buckets, as_of), floor_hour(as_of), 16, "30 minutes")


# ------------------------------------------------------ popularity

TOP_PRODUCTS = 10


def top_counts(partials: DataFrame, keys: list[str], n: int | None = None) -> DataFrame:
    """Sums of partial counts per key (null keys dropped), most first, ties by key."""
    out = partials.dropna(subset=keys).groupBy(*keys).agg(F.sum("count").alias("count")).orderBy(F.desc("count"), *keys)
    return out if n is None else out.limit(n)


def top_products(df: DataFrame, n: int = TOP_PRODUCTS) -> DataFrame:
    """Views per (product, category), top ``n``; ties by key."""
    return (df.filter(F.col("productId").isNotNull() & F.col("category").isNotNull())
            .groupBy("productId", "category").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "productId", "category").limit(n))


def category_popularity(df: DataFrame) -> DataFrame:
    """Views per category, most viewed first (ties by name)."""
    return (df.filter(F.col("category").isNotNull())
            .groupBy("category").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), "category"))


def device_counts(df: DataFrame, as_of: Column, within: str = "10 minutes", ts: str = TS) -> DataFrame:
    """Views per device type over the trailing window."""
    return (trailing(df, as_of, within, ts).filter(F.col("deviceType").isNotNull())
            .groupBy("deviceType").agg(F.count(F.lit(1)).alias("count")))


# fixed values: pivot rows in the reference's order, and its row label
DEVICE_PIVOT = ["Desktop", "Tablet", "Mobile"]
DEVICE_PIVOT_OTHER = "Other"
DEVICE_PIVOT_LABEL = "Device type"


def device_popularity(df: DataFrame, as_of: Column, within: str = "10 minutes", ts: str = TS,
                      with_share: bool = False) -> DataFrame:
    """G8/G9 (+G10/P9): fixed 4-row pivot Desktop/Tablet/Mobile/Other.

    Other = total minus the three named types. No rows in the window ->
    empty table. With ``with_share`` adds ``Percentage`` and drops 0 rows.
    One global aggregate (partial per task, one tiny final merge).
    """
    return device_pivot(trailing(df, as_of, within, ts).select("deviceType", F.lit(1).alias("count")), with_share)


def device_pivot(counts: DataFrame, with_share: bool = False) -> DataFrame:
    """The pivot of ``device_popularity`` from (deviceType, count) rows."""
    known = counts.filter(F.col("deviceType").isNotNull())
    sums = [F.coalesce(F.sum(F.when(F.col("deviceType") == d, F.col("count"))), F.lit(0)).cast("long").alias(d) for d in DEVICE_PIVOT]
    agg = known.agg(F.sum("count").cast("long").alias("_total"), *sums).filter(F.col("_total") > 0)
    agg = agg.withColumn(DEVICE_PIVOT_OTHER, F.col("_total") - sum(F.col(d) for d in DEVICE_PIVOT))
    labels = DEVICE_PIVOT + [DEVICE_PIVOT_OTHER]
    stacked = ", ".join(f"'{d}', `{d}`" for d in labels)
    out = agg.selectExpr("_total", f"stack({len(labels)}, {stacked}) AS (`Device type`, `Total`)")
    out = out.select(F.lit(DEVICE_PIVOT_LABEL).alias("Device"), "Device type",
                     F.col("Total").cast("long").alias("Total"), "_total")
    if with_share:
        out = (out.withColumn("Percentage", F.col("Total") / F.col("_total") * 100)
               .filter(F.col("Percentage") != 0))
    return out.drop("_total")


def grand_total(df: DataFrame, value: str = "count", name: str = "total") -> DataFrame:
    """Sum of a count column (one row; 0 for an empty table)."""
    return df.agg(F.coalesce(F.sum(value), F.lit(0)).cast("long").alias(name))


def axis_bound(counts: DataFrame, value: str = "count") -> DataFrame:
    """Chart upper bound ``max(1, max(count))``; 1 for an empty table."""
    return counts.agg(F.greatest(F.lit(1), F.coalesce(F.max(value), F.lit(1))).cast("long").alias("bound"))


def product_by_id(products: DataFrame, product_id: str) -> DataFrame:
    """The product with this id (at most one row)."""
    return products.filter(F.col("id") == product_id).limit(1)


def category_list(products: DataFrame) -> DataFrame:
    """Distinct categories, sorted."""
    return (products.filter(F.col("category").isNotNull())
            .select("category").distinct().orderBy("category"))


# --------------------------------------------------------- latest rows

LATEST, RAW_LATEST = 10, 100


def latest_visitors(df: DataFrame, as_of: Column, n: int = LATEST, arrival: str | list[str] = "event_id",
                    ts: str = TS) -> DataFrame:
    """The last ``n`` rows by arrival (one or more columns), newest event time first.

    Columns: Relative Time, Date and Time, ip, country.
    """
    by_arrival = [F.desc(c) for c in ([arrival] if isinstance(arrival, str) else arrival)]
    last = df.orderBy(*by_arrival).limit(n)
    return (last.orderBy(F.desc(ts), *by_arrival)
            .select(relative_time(ts, as_of).alias("Relative Time"),
                    format_datetime(ts).alias("Date and Time"), "ip", "country"))


def raw_latest(df: DataFrame, n: int = RAW_LATEST, ts: str = TS, tie: str = "event_id") -> DataFrame:
    """T4 + P3: newest ``n`` raw rows by time, without original_timestamp."""
    return df.orderBy(F.desc(ts), F.desc(tie)).limit(n).drop("original_timestamp")
