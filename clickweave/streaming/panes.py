"""Dashboard marts from per-minute panes.

Every micro-batch leaves two mergeable partial tables, kept as levelled runs (``commits.RunLog``):

* ``counts``: clicks per (minute, product, category, device); panes add up;
* ``newest``: of each minute the last ``LATEST`` rows by arrival and the newest ``RAW_LATEST`` by time; the
  best of several panes are among the best of each.

A mart over a trailing window sums the panes of the window's whole minutes. The minute in which the window
begins is cut by it, so its clicks, and only they, are read from the enriched table (day partition
and time filter reach the scan). The result equals the mart computed from all clicks of the window,
but a refresh reads a few panes, however many clicks the window holds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import metrics as M
from ..operators.enrich import ENRICHED_COLUMNS
from .commits import RunLog
from .sources import ENRICHED_SCHEMA

COUNTS_SCHEMA = "minute timestamp_ntz, productId string, category string, deviceType string, count long"
_ROWS = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in ENRICHED_SCHEMA if f.name in ENRICHED_COLUMNS)
NEWEST_SCHEMA = f"minute timestamp_ntz, best_by string, {_ROWS}"
KEYS = ["minute", "productId", "category", "deviceType"]


def _minute(ts: str = "timestamp") -> Column:
    return F.date_trunc("minute", F.col(ts)).cast("timestamp_ntz")


def count_panes(clicks: DataFrame) -> DataFrame:
    return clicks.where(F.col("timestamp").isNotNull()).groupBy(_minute().alias("minute"), *KEYS[1:]).agg(F.count(F.lit(1)).alias("count"))


def _merged_counts(panes: DataFrame) -> DataFrame:
    return panes.groupBy(*KEYS).agg(F.sum("count").alias("count"))


def newest_panes(clicks: DataFrame) -> DataFrame:
    rows = clicks.where(F.col("timestamp").isNotNull()).select(_minute().alias("minute"), *ENRICHED_COLUMNS)
    return _merged_newest(rows.withColumn("best_by", F.lit("arrival")).unionByName(rows.withColumn("best_by", F.lit("time"))))


def _merged_newest(panes: DataFrame) -> DataFrame:
    """Per minute the best rows of each kind. The rank filter is applied before the shuffle as well, so a
    minute that holds a whole batch sends few rows."""
    def best(kind: str, order: list[Column], n: int) -> DataFrame:
        w = Window.partitionBy("minute").orderBy(*order)
        return panes.where(F.col("best_by") == kind).withColumn("_rank", F.row_number().over(w)).where(F.col("_rank") <= n).drop("_rank")
    both = best("arrival", [F.desc("event_id")], M.LATEST).unionByName(best("time", [F.desc("timestamp"), F.desc("event_id")], M.RAW_LATEST))
    return both.select("minute", "best_by", *ENRICHED_COLUMNS)


def count_log(spark: SparkSession, path: str) -> RunLog:
    return RunLog(spark, f"{path.rstrip('/')}/counts", COUNTS_SCHEMA, _merged_counts)


def newest_log(spark: SparkSession, path: str) -> RunLog:
    return RunLog(spark, f"{path.rstrip('/')}/newest", NEWEST_SCHEMA, _merged_newest)


def start_panes(enriched_stream: DataFrame, out_path: str, checkpoint: str, trigger: dict | None = None) -> StreamingQuery:
    """Keep the panes of every micro-batch of the enriched stream."""
    def batch(df: DataFrame, batch_id: int) -> None:
        df.persist()
        try:
            count_log(df.sparkSession, out_path).commit(count_panes(df), batch_id)
            newest_log(df.sparkSession, out_path).commit(newest_panes(df), batch_id)
        finally:
            df.unpersist()

    w = enriched_stream.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return w.trigger(**(trigger or {"availableNow": True})).start()


class TrailingPanes:
    """The panes of trailing windows that end at ``as_of``; ``clicks(since)`` reads the enriched table from a time on."""

    def __init__(self, spark: SparkSession, path: str, clicks, as_of: Column):
        self.spark, self.path, self.clicks, self.as_of = spark, path, clicks, as_of

    def _cut(self, within: str) -> tuple[Column, DataFrame]:
        """The first whole minute of the window, and the clicks of the cut minute before it."""
        since = self.as_of - M.interval(within)
        whole = F.date_trunc("minute", since).cast("timestamp_ntz") + M.interval("1 minute")
        return whole, self.clicks(since).where((F.col("timestamp") > since) & (F.col("timestamp") < whole))

    def counts(self, within: str) -> DataFrame:
        whole, edge = self._cut(within)
        panes = count_log(self.spark, self.path).read(lambda df: df.where(F.col("minute") >= whole))
        return panes.unionByName(count_panes(edge))

    def newest(self, within: str, kind: str) -> DataFrame:
        whole, edge = self._cut(within)
        panes = newest_log(self.spark, self.path).read(lambda df: df.where((F.col("minute") >= whole) & (F.col("best_by") == kind)))
        return panes.select(*ENRICHED_COLUMNS).unionByName(edge.select(*ENRICHED_COLUMNS))


def pane_marts(spark: SparkSession, path: str, clicks, as_of: Column, buffer: str = "1 hour", minutes: str = "15 minutes",
               devices: str = "10 minutes") -> dict[str, DataFrame]:
    """The marts of ``jobs.refresh_marts`` from panes: same names, columns and rows."""
    panes = TrailingPanes(spark, path, clicks, as_of)
    hour = panes.counts(buffer).select("productId", "category", "count")
    return {
        "last_15_minutes": M.filled_minutes(panes.counts(minutes).groupBy(F.col("minute").alias("datetime")).agg(F.sum("count").alias("count"))),
        "products_last_hour": M.top_counts(hour, ["productId", "category"], M.TOP_PRODUCTS),
        "latest_visitors": M.latest_visitors(panes.newest(buffer, "arrival"), as_of),
        "category_popularity": M.top_counts(hour, ["category"]),
        "device_type_popularity": M.device_pivot(panes.counts(devices).groupBy("deviceType").agg(F.sum("count").alias("count"))),
        "raw_data": M.raw_latest(panes.newest(buffer, "time")),
    }
