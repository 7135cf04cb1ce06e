"""Sharding by global byte-size prefix sums.

The rows are sorted by id over range partitions and checkpointed, so that every
partition keeps its rows and their order. One aggregate gives each partition's bytes
and rows (one row per partition, so as many as tasks). Their running sums give every
partition its offset; inside a partition a running sum of row sizes adds the rest.
A row goes to the shard into whose equal share of all bytes its middle byte falls:
shards are contiguous, and each is within one document of its share.

Rows: a null text has no bytes (size 1). Null ids sort first. Rows with the same id are
ordered by size, checksum and input position, so repeated rows each get their own slot
and a repeated id can be cut between shards. An empty table gives an empty result.
Extra columns are ignored unless named in ``carry``; a carried column whose name is one
of the result's columns is refused.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StructField, StructType

from clickweave.llm.common import checkpointed

RESULT = ("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")


def byte_shards(docs: DataFrame, n_shards: int = 8, carry: Sequence[str] = ()) -> DataFrame:
    """One row per document: doc_id, size, text_crc32, law, shard, slot, grown_shard and
    the carried columns, in shard order."""
    if set(carry) & set(RESULT):
        raise ValueError(f"carried columns clash with the result: {sorted(set(carry) & set(RESULT))}")
    raw = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    order = ["doc_id", "size", "text_crc32", "_position"]
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(raw) + 1).cast("long").alias("size"),
        F.crc32(raw).alias("text_crc32"),
        F.monotonically_increasing_id().alias("_position"),
        *carry,
    ).repartitionByRange(*order).sortWithinPartitions(*order)
    rows = checkpointed(rows).drop("_position")

    totals = {r.part: (r.bytes, r.rows) for r in
              rows.groupBy(F.spark_partition_id().alias("part"))
              .agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")).collect()}
    parts = sorted(totals)
    before = dict(zip(parts, accumulate((totals[p] for p in parts), lambda a, b: (a[0] + b[0], a[1] + b[1]),
                                        initial=(0, 0)), strict=False))
    all_bytes = sum(b for b, _ in totals.values())

    schema = StructType([*rows.schema.fields, StructField("shard", IntegerType()), StructField("_row", LongType())])

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        at, row = before.get(TaskContext.get().partitionId(), (0, 0))
        for batch in batches:
            if not batch.num_rows:
                continue
            sizes = batch.column("size").to_numpy()
            ends = at + np.cumsum(sizes)
            shard = np.minimum((2 * ends - sizes) * n_shards // (2 * all_bytes), n_shards - 1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(shard, pa.int32()), pa.array(np.arange(row, row + len(sizes)), pa.int64())],
                names=[*batch.schema.names, "shard", "_row"])
            at, row = int(ends[-1]), row + len(sizes)

    placed = rows.mapInArrow(place, schema)
    counts = {r.shard: r["count"] for r in placed.groupBy("shard").count().collect()}
    first = list(accumulate((counts.get(s, 0) for s in range(n_shards)), initial=0))[:n_shards]
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard",
        (F.col("_row") - F.element_at(F.array(*map(F.lit, first)), F.col("shard") + 1)).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), *carry)


def write_shards(docs: DataFrame, path: str, n_shards: int = 8) -> None:
    """Write the documents as one folder per shard, rows in slot order within each file."""
    (byte_shards(docs, n_shards, carry=[c for c in docs.columns if c not in RESULT])
     .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path))
