"""Set operations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def align_union(*frames: DataFrame) -> DataFrame:
    """Append frames aligned by column name; missing columns become null."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


ROW_DIGEST_PARTS = 4


def multiset_digest(rows: DataFrame) -> list[Column]:
    """Aggregates that identify the multiset of rows, whatever their order: their number, and the sums of
    ``ROW_DIGEST_PARTS`` 32-bit pieces of each row's SHA-256. Partial sums add up, so two
    snapshots are compared with one row per task sent."""
    digest = F.sha2(F.to_json(F.struct(*rows.columns), {"ignoreNullFields": "false"}), 256)
    pieces = [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("decimal(20,0)") for i in range(ROW_DIGEST_PARTS)]
    return [F.count(F.lit(1)), *[F.coalesce(F.sum(p), F.lit(0)) for p in pieces]]


def table_digest(rows: DataFrame) -> DataFrame:
    """One row (rows, d0, d1, ..) that is equal for equal tables, for a state kept beside a table."""
    n, *sums = multiset_digest(rows)
    return rows.agg(n.alias("rows"), *[s.alias(f"d{i}") for i, s in enumerate(sums)])


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Whether two tables hold the same rows, by digest: rows_a, rows_b, changed. Neither table is shuffled."""
    x, y = table_digest(a), table_digest(b)
    sums = [f"d{i}" for i in range(ROW_DIGEST_PARTS)]
    both = x.select(F.lit("a").alias("_t"), *x.columns).unionByName(y.select(F.lit("b").alias("_t"), *y.columns))
    apart = F.greatest(*[(F.max(c) != F.min(c)) for c in ("rows", *sums)])
    return both.agg(F.max(F.when(F.col("_t") == "a", F.col("rows"))).alias("rows_a"), F.max(F.when(F.col("_t") == "b", F.col("rows"))).alias("rows_b"),
                    apart.alias("changed"))


def period_diff(rows: DataFrame, now: Column, before: Column) -> DataFrame:
    """U3 for two snapshots of one table: the rows for which exactly one of two conditions holds, marked +1 (``now``) or
    -1. Rows in both are the same rows, so only these can make a difference."""
    mark = F.coalesce(now.cast("int"), F.lit(0)) - F.coalesce(before.cast("int"), F.lit(0))
    return rows.withColumn("_d", mark).where(F.col("_d") != 0)


def marked_diff(marked: DataFrame) -> DataFrame:
    """``snapshot_diff`` of rows marked by ``period_diff`` (column ``_d``)."""
    cols = [c for c in marked.columns if c != "_d"]
    digest = F.unhex(F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)).alias("_row")
    return _net(marked.select(digest, "_d"))


def snapshot_diff(new: DataFrame, old: DataFrame) -> DataFrame:
    """Has a table changed? Exact multiset comparison in one aggregation.

    Rows of ``new`` count +1, rows of ``old`` -1; grouped by every column
    (nulls group together), the net count of a row is how many more times it
    occurs in ``new`` than in ``old``. Summing the positive / negative parts
    gives ``new.exceptAll(old).count()`` / ``old.exceptAll(new).count()`` with one
    shuffle of row digests (SHA-256 of the row as JSON, nulls kept apart), not of the
    rows; partial aggregation first, so a hot duplicated row costs one row per
    task. One row out: only_new, only_old, changed.
    """
    cols = new.columns
    digest = F.unhex(F.sha2(F.to_json(F.struct(*cols), {"ignoreNullFields": "false"}), 256)).alias("_row")
    return _net(new.select(digest, F.lit(1).alias("_d")).unionByName(old.select(digest, F.lit(-1).alias("_d"))))


def _net(tagged: DataFrame) -> DataFrame:
    net = tagged.groupBy("_row").agg(F.sum("_d").alias("_n"))
    return net.agg(F.coalesce(F.sum(F.when(F.col("_n") > 0, F.col("_n"))), F.lit(0)).cast("long").alias("only_new"),
                   F.coalesce(F.sum(F.when(F.col("_n") < 0, -F.col("_n"))), F.lit(0)).cast("long")
                   .alias("only_old")).select(
        "only_new", "only_old", ((F.col("only_new") + F.col("only_old")) > 0).alias("changed"))
