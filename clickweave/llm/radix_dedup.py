"""Exact dedup by distributed MSD radix partitioning.

Texts (ASCII-lower-cased, as UTF-8 bytes) are split by successive runs of bytes, most
significant first, into a trie of groups. Equality is decided by the bytes alone:

1. Level by level, the next ``width`` bytes of each row still in a heavy group (one
   with more than its share of rows or bytes, or than a task is to hold) are counted, partially in each task. A group
   that has no bytes left consists of equal texts: its size and its largest id come from
   the count, and its rows need no shuffle, however many they are.
2. A smaller group is a leaf. Its rows meet in one task, sorted by leaf; the task holds one
   leaf at a time and goes on splitting it by successive bytes until each group is a singleton or ended.
3. A heavy group with bytes left goes to the next level, which reads only its rows.

Heavy groups hold more than a share each, one share being 1/``shares`` of all rows or
bytes, or ``TASK_ROWS`` or ``TASK_BYTES`` if that is less: a leaf has a fixed size however large
the input. So a level has at most 2 * ``shares`` of them (``shares`` grows with an input of more
than that many rows or bytes a share). Their keys of ``width`` bytes are a written table, of which the
driver sees the size alone. It is broadcast only if it measures ``BROADCAST_BYTES`` at most; a larger
one is joined by a shuffle on the key and a salt, so that a hot group spreads over ``SALTS`` tasks.
Widths double up to the width at which all keys of a level come to ``KEY_BYTES`` (at least
``LEAST_CAP``), so long copies take few levels. No text is cut or left out.

Rows: a null text counts as empty, and all empty texts are equal. The largest id of a
group stays; null ids rank below all others, and rows that repeat an id with the same
text are one document (all are kept, or none). Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import ascii_lower, shuffle_partitions, texts_of, written

WIDTH, LEAST_CAP, KEY_BYTES = 32, 4096, 64 << 20
LOCAL_WIDTH = 16
TASK_BYTES, TASK_ROWS = 64 << 20, 1 << 18
BROADCAST_BYTES, NODE_BYTES, SALTS = 128 << 20, 64, 32
OUT_ROWS = 10_000
FOUND = "doc_id long, keep_id long, group_size long, text_sha256 string"


def normalised(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit(""))).cast("binary")


def radix_groups(texts: list[bytes]) -> Iterator[list[int]]:
    """Positions of equal texts, by splitting on successive bytes in memory."""
    todo = [(0, list(range(len(texts))))]
    while todo:
        at, members = todo.pop()
        split: dict[bytes, list[int]] = {}
        ended: dict[bytes, list[int]] = {}
        for i in members:
            t = texts[i]
            (split if len(t) > at + LOCAL_WIDTH else ended).setdefault(t[at:at + LOCAL_WIDTH], []).append(i)
        yield from ended.values()
        for group in split.values():
            if len(group) == 1:
                yield group
            else:
                todo.append((at + LOCAL_WIDTH, group))


def _finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by leaf to their groups; only the leaf at hand is held."""
    now: tuple | None = None
    ids: list = []
    texts: list[bytes] = []
    shas: list[bytes] = []
    out: tuple[list, list, list, list] = ([], [], [], [])

    def close() -> None:
        for group in [[0]] if len(ids) == 1 else radix_groups(texts):
            keep = max((ids[i] for i in group if ids[i] is not None), default=None)
            out[0].extend(ids[i] for i in group)
            out[1].extend([keep] * len(group))
            out[2].extend([len(group)] * len(group))
            out[3].extend(shas[i].hex() for i in group)
        for held in (ids, texts, shas):
            held.clear()

    def flush() -> pa.RecordBatch:
        part = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, (pa.int64(), pa.int64(), pa.int64(), pa.string()), strict=True)],
                                          names=["doc_id", "keep_id", "group_size", "text_sha256"])
        for column in out:
            column.clear()
        return part

    for b in batches:
        level, group, head, own, rest, sha = b.columns
        leaves = zip(level.to_pylist(), group.to_pylist(), head.to_pylist(), strict=True)
        for leaf, i, t, s in zip(leaves, own.to_pylist(), texts_of(rest), sha.to_pylist(), strict=True):
            if leaf != now:
                if ids:
                    close()
                if len(out[0]) >= OUT_ROWS:
                    yield flush()
                now = leaf
            ids.append(i)
            texts.append(t)
            shas.append(s)
    if ids:
        close()
    if out[0]:
        yield flush()


def _routed(at: DataFrame, nodes: DataFrame, node_bytes: int) -> DataFrame:
    """``at`` with the heavy group that each row is in, or nulls."""
    key = ["_group", "_head", "_ended"]
    if node_bytes <= BROADCAST_BYTES:
        return at.join(F.broadcast(nodes), key, "left")
    salted = nodes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return at.withColumn("_salt", F.floor(F.rand(SALTS) * SALTS).cast("int")).join(salted, [*key, "_salt"], "left").drop("_salt")


def exact_groups(docs: DataFrame, shares: int | None = None) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256."""
    spark = docs.sparkSession
    shares = shares or max(2, shuffle_partitions(spark))
    raw = normalised(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), raw.alias("_rest")).select(
        "doc_id", F.unhex(F.sha2("_rest", 256)).alias("_sha"), F.lit(0).cast("long").alias("_group"), "_rest")
    whole = rows.agg(F.count("*").alias("n"), F.sum(F.octet_length("_rest")).alias("b")).first()
    all_rows, all_bytes = whole.n, whole.b or 0
    shares = max(shares, -(-all_bytes // TASK_BYTES), -(-all_rows // TASK_ROWS))
    most_rows, most_bytes = max(1, all_rows // shares), max(1, all_bytes // shares)
    done: list[DataFrame] = []
    leaves: list[DataFrame] = []
    level, width = 0, WIDTH
    while True:
        at = rows.select("doc_id", "_sha", "_group", F.substring("_rest", 1, width).alias("_head"),
                         (F.octet_length("_rest") <= width).alias("_ended"),
                         F.expr(f"substring(_rest, {width + 1})").alias("_tail"))
        counted = at.groupBy("_group", "_head", "_ended").agg(
            F.count("*").alias("group_size"), F.max("doc_id").alias("keep_id"), F.sum(F.octet_length("_tail")).alias("_bytes"))
        heavy = (F.col("group_size") > 1) & ((F.col("group_size") > most_rows) | (F.col("_bytes") > most_bytes))
        nodes = written(counted.where(heavy).select("_group", "_head", "_ended", F.monotonically_increasing_id().alias("_node"), "keep_id", "group_size"), "heavy")
        size = nodes.agg(F.sum(F.octet_length("_head") + NODE_BYTES).alias("bytes"), F.bool_or("_ended").alias("ended"),
                         F.bool_or(~F.col("_ended")).alias("open")).first()
        routed = _routed(at, nodes, size.bytes or 0)
        leaves.append(routed.where("_node is null").select(F.lit(level).alias("_level"), "_group", "_head", "doc_id", "_tail", "_sha"))
        if size.ended:
            done.append(routed.where("_node is not null and _ended")
                        .select("doc_id", "keep_id", "group_size", F.lower(F.hex("_sha")).alias("text_sha256")))
        if not size.open:
            break
        rows = written(routed.where("_node is not null and not _ended")
                       .select("doc_id", "_sha", F.col("_node").alias("_group"), F.col("_tail").alias("_rest")), "radix")
        level, width = level + 1, min(2 * width, max(LEAST_CAP, KEY_BYTES // (2 * shares)))
    tasks = max(shuffle_partitions(spark), -(-all_bytes // TASK_BYTES), -(-all_rows // TASK_ROWS))
    leaf = ["_level", "_group", "_head"]
    found = leaves[0]
    for x in leaves[1:]:
        found = found.unionByName(x)
    found = found.repartition(tasks, *leaf).sortWithinPartitions(*leaf).mapInArrow(_finish, FOUND)
    for x in done:
        found = found.unionByName(x)
    return found.select("doc_id", "keep_id", "group_size", F.col("doc_id").eqNullSafe(F.col("keep_id")).alias("kept"), "text_sha256")
