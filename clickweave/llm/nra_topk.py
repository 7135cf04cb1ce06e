"""Exact top-k inner products by no-random-access aggregation.

Vectors are held as integers. For a query q every dimension is a list of the vectors in
the order of their products with q's component: the sorted column, read from the top if
the component is positive, from the bottom if negative. The lists are read in step, to
a depth that grows each round. What has been read of a vector gives its score a lower
bound (unread products are at least their list's last) and an upper bound (at most the
list's current product). A query stops when no vector outside its k best lower bounds,
seen or unseen, can reach the k-th; only vectors whose upper bound reaches it get their
final score, and the best k of these are exact, ties included.

Candidates are cut into blocks of ``block_rows`` vectors, each with its own sorted lists;
queries into blocks of about ``query_rows``. Every candidate block meets every query
block once, keyed by the query block and one of as many salts as leave ``SALT_BLOCKS`` candidate
blocks a key, and gives each query its k best there; the k best of these are the result. Inside a task the bounds of all its queries come from
matrix products, in the narrowest number type that holds them exactly.

Rows: vectors that are null, empty, or hold null or non-finite components take no part,
nor do rows with a null id. Vectors of another length than the query's are not compared
with it. Rows with a query's own id are no candidates of it; if an id repeats, its
smallest vector is the query, while all its rows are candidates of others. Extra columns
are ignored; an empty table gives an empty result. Scores are 64-bit: vectors whose largest
component, squared and times the length, reaches 2**63 are refused.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from clickweave.llm.common import written

BLOCK_ROWS, QUERY_ROWS = 4096, 512
SALT_BLOCKS = 8
BLOCK = "dim int, n int, ids binary, values binary"
FOUND = "query_id long, vec_id long, score long"


def quantised(vectors: DataFrame, scale: int) -> DataFrame:
    """vec_id, v array<long>: floor(scale * x), of the vectors that take part."""
    x = F.col("embedding")
    good = F.col("vec_id").isNotNull() & (F.size(x) > 0) & F.forall(
        x, lambda e: e.isNotNull() & ~F.isnan(e) & (F.abs(e) != float("inf")))
    return vectors.where(F.coalesce(good, F.lit(False))).select(
        F.col("vec_id").cast("long").alias("vec_id"),
        F.transform(x, lambda e: F.floor(F.lit(float(scale)) * e.cast("double")).cast("long")).alias("v"))


def _blocks(rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[list, list]] = {}

        def out(dim: int) -> pa.RecordBatch:
            ids, values = held.pop(dim)
            return pa.RecordBatch.from_pydict({
                "dim": pa.array([dim], pa.int32()), "n": pa.array([len(ids)], pa.int32()),
                "ids": [np.array(ids, np.int64).tobytes()], "values": [np.array(values, np.int64).tobytes()]})

        for batch in batches:
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                ids, values = held.setdefault(len(v), ([], []))
                ids.append(i)
                values.append(v)
                if len(ids) >= rows:
                    yield out(len(v))
        for dim in list(held):
            yield out(dim)
    return run


def number_type(queries: np.ndarray, vectors: np.ndarray) -> type:
    """The narrowest type in which every sum of products of these is exact."""
    if not len(queries) or not len(vectors):
        return np.float32
    most = int(np.abs(queries).max()) * int(np.abs(vectors).max()) * queries.shape[1]
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else np.int64


def nra(queries: np.ndarray, vectors: np.ndarray, k: int) -> list[np.ndarray]:
    """For each query the positions of all vectors that may be among its k best: every
    vector that scores at least the k-th best score is among them."""
    n = len(vectors)
    if n <= k:
        return [np.arange(n) for _ in queries]
    kind = number_type(queries, vectors)
    x = vectors.astype(kind)
    rank = np.empty(vectors.shape, np.int32)  # place in the ascending list
    order = np.argsort(vectors, axis=0, kind="stable")
    np.put_along_axis(rank, order, np.arange(n, dtype=np.int32)[:, None], axis=0)
    ascending = np.take_along_axis(x, order, axis=0)
    up, down = np.maximum(queries, 0).astype(kind).T, np.minimum(queries, 0).astype(kind).T
    found: list[np.ndarray] = [np.empty(0, int)] * len(queries)
    open_ = np.arange(len(queries))
    depth = max(k, n // 4)
    while len(open_):
        depth = min(n, depth)
        top, bottom = rank >= n - depth, rank < depth  # read from the top, from the bottom
        a, b = up[:, open_], down[:, open_]
        at_top, at_bottom = ascending[n - depth], ascending[depth - 1]
        high = np.where(top, x, at_top) @ a + np.where(bottom, x, at_bottom) @ b
        low = high if depth == n else np.where(top, x, ascending[0]) @ a + np.where(bottom, x, ascending[-1]) @ b
        kth = np.partition(low, n - k, axis=0)[n - k]
        unseen = at_top @ a + at_bottom @ b
        may = high >= kth
        # Stop when nothing unread can tie the k-th, and few enough need their final score.
        done = (depth == n) | ((unseen < kth) & (may.sum(0) <= max(4 * k, n // 16)))
        for j in np.flatnonzero(done):
            found[open_[j]] = np.flatnonzero(may[:, j])
        open_ = open_[~done]
        depth *= 2
    return found


def best_in_block(query_ids: np.ndarray, queries: np.ndarray, ids: np.ndarray, vectors: np.ndarray, k: int) -> Iterator[tuple]:
    """(query_id, vec_id, score) of each query's k best vectors of the block, without its own."""
    own = np.isin(ids, query_ids)
    extra = int(np.unique(ids[own], return_counts=True)[1].max()) if own.any() else 0
    for q, v, rows in zip(query_ids, queries, nra(queries, vectors, k + extra), strict=True):
        rows = rows[ids[rows] != q]
        scores = vectors[rows] @ v
        for r in np.lexsort((ids[rows], -scores))[:k]:
            yield int(q), int(ids[rows[r]]), int(scores[r])


def top_k(vectors: DataFrame, is_query: Column, k: int = 5, scale: int = 256, block_rows: int = BLOCK_ROWS,
          query_rows: int = QUERY_ROWS) -> DataFrame:
    """query_id, rank, vec_id, score: the k highest integer inner products of each query."""
    rows = quantised(vectors, scale)
    asked = rows.where(is_query).groupBy("vec_id").agg(F.min("v").alias("v"))
    size = rows.agg(F.max(F.array_max(F.transform("v", F.abs))).alias("most"), F.max(F.size("v")).alias("dim")).first()
    if size.most is not None and size.most**2 * size.dim >= 2**63:
        raise ValueError("an inner product may exceed 64 bits")
    blocks = written(rows.mapInArrow(_blocks(block_rows), BLOCK).withColumn("_id", F.monotonically_increasing_id()), "vectors")
    salts = -(-blocks.count() // SALT_BLOCKS) or 1
    n_blocks = max(1, -(-asked.count() // query_rows))
    queries = written(asked.repartition(n_blocks).mapInArrow(_blocks(10**9), BLOCK)
                      .withColumn("_block", F.spark_partition_id()), "queries")
    salted = queries.select("_block", "dim", F.col("ids").alias("q_ids"), F.col("values").alias("q_values"),
                            F.explode(F.sequence(F.lit(0), F.lit(salts - 1))).alias("_salt"))
    pairs = (blocks.withColumn("_salt", F.pmod(F.xxhash64("_id"), F.lit(salts)).cast("int"))
             .withColumn("_block", F.explode(F.sequence(F.lit(0), F.lit(n_blocks - 1))))
             .join(salted, ["_block", "_salt", "dim"])
             .select("dim", "ids", "values", "q_ids", "q_values"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                dim, ids, values, q_ids, q_values = (c[i].as_py() for c in batch.columns)
                parts = [np.frombuffer(b, np.int64) for b in (q_ids, q_values, ids, values)]
                out = list(best_in_block(parts[0], parts[1].reshape(-1, dim), parts[2], parts[3].reshape(-1, dim), k))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["query_id", "vec_id", "score"])

    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (pairs.mapInArrow(run, FOUND).withColumn("rank", F.row_number().over(best).cast("int"))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
