"""Line dedup over levelled sorted runs of line hashes.

A key (a line, stripped and ASCII-lower-cased, of at least ``MIN_CHARS`` code points) that
several documents hold stays only in the one with the smallest id. The documents come in
batches of ascending ids. The store of earlier batches is a set of runs: tables of
(128-bit line hash, owner), bucketed by hash and sorted in each bucket, in levels. For a
batch

1. its keys are counted, one row per key and task before the shuffle: smallest and largest
   id that holds it;
2. they merge-join the runs, bucket by bucket; neither side is dealt or the runs sorted
   again. A key found there belongs to an earlier document, so the whole batch loses it;
3. keys not found (the anti-join) are the batch's own run on level 0, the smallest id being
   the owner; keys with several ids are lost by all but that one;
4. ``fanout`` runs of a level are merged into one of the next: compaction.

Only lost keys go on. They meet the lines by hash (AQE splits a line that very many
documents hold, as both sides are plain scans), and the lost line numbers meet their
document by id and text hash. Texts are shuffled once, for that.

Rows: a null or empty text is one empty line. Rows with a null id count as one document
with the largest id. Rows that repeat an id are one document: what one of them holds
first, all keep. Lines of any number and length are kept whole. Extra columns are kept by
``dedup_lines``; an empty table gives an empty result.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from clickweave.llm.common import ascii_lower, aside, shuffle_partitions, written
from clickweave.session import shared_path

MIN_CHARS = 10
BLANK = " \t\n\x0b\x0c\r"
BATCHES, FANOUT = 4, 2
LAST_ID = 2**63 - 1
HASH = ["_h1", "_h2"]


def lines_of(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def line_key(line: Column) -> Column:
    return ascii_lower(F.btrim(line, F.lit(BLANK)))


def line_hash(key: Column) -> list[Column]:
    """128 bits: two 64-bit hashes, the second of the key in another order of parts."""
    return [F.xxhash64(key).alias("_h1"), F.xxhash64(F.lit("line"), key, F.octet_length(key)).alias("_h2")]


def keyed_lines(docs: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    """_id, _text (hash), _pos, _h1, _h2: the lines that dedup looks at."""
    lines = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"),
                        F.xxhash64(F.col(text_col)).alias("_text"), F.posexplode(lines_of(F.col(text_col))).alias("_pos", "_line"))
    return (lines.withColumn("_key", line_key(F.col("_line"))).where(F.char_length("_key") >= min_chars)
            .select("_id", "_text", "_pos", *line_hash(F.col("_key"))))


class Runs:
    """The levelled runs: bucketed, sorted tables of (_h1, _h2, _owner)."""

    def __init__(self, spark: SparkSession, fanout: int, buckets: int):
        self.spark, self.fanout, self.buckets = spark, fanout, buckets
        self.levels: list[list[str]] = []

    def _write(self, rows: DataFrame, level: int) -> None:
        while len(self.levels) <= level:
            self.levels.append([])
        name = f"line_run_{uuid.uuid4().hex}"
        (rows.write.bucketBy(self.buckets, *HASH).sortBy(*HASH)
         .option("path", shared_path(self.spark, "runs")).format("parquet").saveAsTable(name))
        self.levels[level].append(name)

    def add(self, rows: DataFrame) -> None:
        self._write(rows, 0)
        level = 0
        while len(self.levels[level]) >= self.fanout:
            old = self.levels[level]
            merged = self.spark.table(old[0])
            for name in old[1:]:
                merged = merged.unionByName(self.spark.table(name))
            self.levels[level] = []
            self._write(merged.repartition(self.buckets, *HASH), level + 1)
            self._drop(old)
            level += 1

    def find(self, keys: DataFrame) -> DataFrame:
        """``keys`` with _owner: of the run that holds the key, else null."""
        found = keys.withColumn("_owner", F.lit(None).cast("long"))
        for name in (n for level in reversed(self.levels) for n in level):
            run = self.spark.table(name).withColumnRenamed("_owner", "_here")
            found = (found.join(run.hint("merge"), HASH, "left")
                     .withColumn("_owner", F.coalesce("_owner", "_here")).drop("_here"))
        return found

    def _drop(self, names: list[str]) -> None:
        for name in names:
            place = next(r.data_type for r in self.spark.sql(f"DESCRIBE FORMATTED {name}").collect() if r.col_name == "Location")
            self.spark.sql(f"DROP TABLE {name}")
            path = self.spark._jvm.org.apache.hadoop.fs.Path(place)
            path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)

    def close(self) -> None:
        self._drop([n for level in self.levels for n in level])
        self.levels = []


def lost_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
               batches: int = BATCHES, fanout: int = FANOUT) -> DataFrame:
    """_id, _text, _lost: the sorted numbers of the lines that each document loses."""
    spark = docs.sparkSession
    ids = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)).alias("_id"))
    cuts = ids.select(F.percentile_approx("_id", [i / batches for i in range(1, batches)]).alias("c")).first().c or []
    cuts = sorted(set(cuts))
    lines = written(keyed_lines(docs, id_col, text_col, min_chars), "lines")
    runs = Runs(spark, fanout, shuffle_partitions(spark))
    lost: list[DataFrame] = []
    try:
        for low, high in zip([None, *cuts], [*cuts, None], strict=True):
            batch = lines
            if low is not None:
                batch = batch.where(F.col("_id") > low)
            if high is not None:
                batch = batch.where(F.col("_id") <= high)
            keys = batch.groupBy(*HASH).agg(F.min("_id").alias("_first"), F.max("_id").alias("_last"))
            keys = written(runs.find(keys), "batch")
            runs.add(keys.where("_owner is null").select(*HASH, F.col("_first").alias("_owner")).repartition(runs.buckets, *HASH))
            lost.append(keys.where("_owner is not null or _first < _last").select(*HASH, F.coalesce("_owner", "_first").alias("_owner")))
    finally:
        runs.close()
    # A key's owner is the same in every batch that loses it: one row per key.
    gone = lost[0]
    for x in lost[1:]:
        gone = gone.unionByName(x)
    gone = written(gone.groupBy(*HASH).agg(F.min("_owner").alias("_owner")), "lost")
    return (lines.join(gone, HASH).where("_id <> _owner")
            .groupBy("_id", "_text").agg(F.sort_array(F.collect_set("_pos")).alias("_lost")))


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **how) -> DataFrame:
    """The documents with _line_n (lines before), _line_lost (lines dropped) and
    _line_kept (the text that is left)."""
    columns = docs.columns
    docs, names = aside(docs, id_col, text_col)
    lost = lost_lines(docs, id_col, text_col, **how)
    lost = lost.select(F.col("_id").alias("_line_id"), F.col("_text").alias("_line_text"), F.col("_lost").alias("_line_gone"))
    here = docs.withColumns({"_line_key": F.coalesce(F.col(id_col).cast("long"), F.lit(LAST_ID)),
                             "_line_hash": F.xxhash64(F.col(text_col))})
    lines = lines_of(F.col(text_col))
    kept = F.when(F.col("_line_gone").isNull(), F.coalesce(F.col(text_col), F.lit(""))).otherwise(F.array_join(F.transform(
        F.array_except(F.sequence(F.lit(0), F.col("_line_n") - 1), F.col("_line_gone")), lambda i: F.get(F.col("_line_all"), i)), "\n"))
    return (here.join(lost, (F.col("_line_key") == F.col("_line_id")) & (F.col("_line_hash") == F.col("_line_text")), "left")
            .withColumn("_line_all", lines)
            .withColumn("_line_n", F.size("_line_all"))
            .withColumn("_line_lost", F.coalesce(F.size("_line_gone"), F.lit(0)))
            .withColumn("_line_kept", kept)
            .select(*names, "_line_n", "_line_lost", "_line_kept").toDF(*columns, "_line_n", "_line_lost", "_line_kept"))
