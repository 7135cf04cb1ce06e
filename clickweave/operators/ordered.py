"""Order-dependent row operators without single-partition windows.

``lag``/``lead``/running sums over one global order (W1, W2) or over a
visitor's clicks where one visitor may hold a third of the data (P11/W3)
would put everything into one task with a plain window. Here the rows are
range-partitioned on the order (the sampler splits hot keys over several
contiguous partitions), sorted inside each partition and checkpointed. A
fixed-size summary per partition (last row or row count from a JVM
aggregate; first/last value and a partial sum from a pandas pass where the
summary needs row-to-row differences) is combined on the driver -- P rows,
P = partition count, not data size -- into each partition's boundary
values; one more parallel pass computes the rows with vectorised pandas.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def layout_partitions(df: DataFrame, partitions: int | None = None) -> int:
    """Range partitions for a layout: sized by the data, not a fixed setting.

    At least as many as the input's own partitions (file splits of about
    ``spark.sql.files.maxPartitionBytes`` each, so a range partition stays a
    task-sized slice however large the input), and never fewer than
    ``spark.sql.shuffle.partitions``.
    """
    if partitions:
        return partitions
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), df.rdd.getNumPartitions())


def ordered_layout(df: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """Range-partition + sort on ``order``, checkpoint, tag partition ids."""
    n = layout_partitions(df, partitions)
    laid = df.repartitionByRange(n, *order).sortWithinPartitions(*order).checkpoint(eager=True)
    return laid.withColumn("_pid", F.spark_partition_id())


def _edges(layout: DataFrame, cols: list[str], schema: str, extra=None) -> dict:
    """Per partition: first and last row of ``cols`` (+ an optional partial)."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        first = last = None
        pid = None
        acc = None
        carry = None
        for pdf in batches:
            if pdf.empty:
                continue
            if pid is None:
                pid = int(pdf["_pid"].iloc[0])
                first = [pdf[c].iloc[0] for c in cols]
            if extra is not None:
                acc, carry = extra(pdf, acc, carry)
            last = [pdf[c].iloc[-1] for c in cols]
        if pid is not None:
            row = {"pid": pid}
            for i, c in enumerate(cols):
                row[f"first_{c}"] = first[i]
                row[f"last_{c}"] = last[i]
            if extra is not None:
                row["partial"] = acc
            yield pd.DataFrame([row])

    rows = layout.mapInPandas(run, schema).collect()
    return {r["pid"]: r for r in sorted(rows, key=lambda r: r["pid"])}


# ------------------------------------------------------------ P11 / W3 (lag)

def drop_refreshes(clicks: DataFrame, key: str = "userId", order: tuple = ("timestamp", "event_id"),
                   value: str = "productId", partitions: int | None = None) -> DataFrame:
    """Drop a click whose product equals the visitor's previous click's.

    Null equals null (a null product after a null product is a refresh).
    """
    cols = [key, *order, value]
    layout = ordered_layout(clicks.select(*cols).filter(F.col(key).isNotNull()), [key, *order], partitions)
    # last row of every partition = max of the sort key (JVM aggregate, P rows)
    sort_key = F.struct(key, *order)
    lasts = layout.groupBy("_pid").agg(F.max_by(F.struct(key, value), sort_key).alias("last")).collect()
    prev = {}
    last = None
    for r in sorted(lasts, key=lambda r: r["_pid"]):
        prev[r["_pid"]] = last
        last = (r["last"][key], r["last"][value])

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        before = None
        started = False
        for pdf in batches:
            if pdf.empty:
                continue
            if not started:
                before = prev.get(int(pdf["_pid"].iloc[0]))
                started = True
            k = pdf[key].astype(object)
            v = pdf[value].astype(object)
            pk = k.shift(1)
            pv = v.shift(1)
            if before is not None:
                pk.iloc[0], pv.iloc[0] = before
            else:
                pk.iloc[0], pv.iloc[0] = None, None
            same_user = (k == pk).to_numpy()
            both_null = (v.isna() & pv.isna()).to_numpy()
            same_val = ((v == pv).to_numpy() | both_null)
            if before is None:
                same_user[0] = False
            keep = ~(same_user & same_val)
            before = (k.iloc[-1], v.iloc[-1])
            yield pdf.loc[keep, cols]

    schema = clicks.select(*cols).schema
    return layout.mapInPandas(run, schema)


# ------------------------------------------------------ W1 / W2 (lead, cumsum)

# fixed values: replay delay clamp (seconds)
MAX_DELAY_S = 10.0
MIN_DELAY_S = 0.0


def replay_schedule(log: DataFrame, order: str = "event_id", t: str = "original_timestamp",
                    partitions: int | None = None) -> DataFrame:
    """W1 + W2: per row the delay to the next row (clamped to [0, 10] s; the
    last row has none) and its replay offset ``at`` = sum of all earlier
    delays, in file order. Output: ``order``, delay, at. A row whose own or next time is
    null has no delay, which the sum counts as 0.
    """
    layout = ordered_layout(log.select(order, t), [order], partitions)

    def partial(pdf, acc, carry):
        tt = pdf[t].to_numpy(dtype="float64")
        if carry is not None:
            tt = np.concatenate([[carry], tt])
        d = np.clip(np.diff(tt), MIN_DELAY_S, MAX_DELAY_S)
        return (acc or 0.0) + float(np.nansum(d)), tt[-1]

    edges = _edges(layout, [t], f"pid int, first_{t} double, last_{t} double, partial double", partial)
    pids = list(edges)
    tail_delay, offset = {}, {}
    running = 0.0
    for i, pid in enumerate(pids):
        nxt = edges[pids[i + 1]][f"first_{t}"] if i + 1 < len(pids) else None
        last_t = edges[pid][f"last_{t}"]
        tail = None if nxt is None or last_t is None or pd.isna(nxt) or pd.isna(last_t) else min(max(nxt - last_t, MIN_DELAY_S), MAX_DELAY_S)
        tail_delay[pid] = tail
        offset[pid] = running
        running += edges[pid]["partial"] + (tail or 0.0)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held = None  # last row of the previous batch, delay still unknown
        base = None
        pid = None
        for pdf in batches:
            if pdf.empty:
                continue
            if pid is None:
                pid = int(pdf["_pid"].iloc[0])
                base = offset[pid]
            if held is not None:
                pdf = pd.concat([held, pdf[[order, t]]], ignore_index=True)
            tt = pdf[t].to_numpy(dtype="float64")
            d = np.clip(np.diff(tt), MIN_DELAY_S, MAX_DELAY_S)
            at = base + np.concatenate([[0.0], np.nancumsum(d)])[:-1]
            delay = pd.array(d, dtype="Float64")
            delay[np.isnan(d)] = pd.NA
            out = pd.DataFrame({order: pdf[order].iloc[:-1].to_numpy(), "delay": delay, "at": at[:len(d)]})
            base = base + float(np.nansum(d))
            held = pdf[[order, t]].iloc[-1:].reset_index(drop=True)
            yield out
        if held is not None:
            yield pd.DataFrame({order: held[order].to_numpy(), "delay": [tail_delay[pid]], "at": [base]})

    return layout.mapInPandas(run, f"{order} long, delay double, at double")
