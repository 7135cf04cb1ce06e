"""Point-in-range lookup (IP address -> registry range) as an equi-join.

A plain ``ip BETWEEN lo AND hi`` join has no equality key, so Spark plans a
broadcast nested-loop join (every click against every range). Instead each
range is exploded into the fixed-width buckets it covers (``value >> bits``)
and the join runs on the bucket with the range check as a residual
condition -- a hash or sort-merge join. For non-overlapping ranges the
exploded table has at most ``ranges + 2**(32-bits)`` rows, a bound that does
not depend on the click volume.

Ranges may overlap or nest; a value then has the narrowest one (of equal widths the one
with the largest ``lo``, then the smallest payload). ``disjoint_ranges`` settles
that once for the range table: a sweep line over the ends of the ranges in a
bucket cuts it into intervals with one winner each, so a lookup never repeats a row.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

IP_BUCKET_BITS = 16


def ip_to_long(ip) -> Column:
    """Dotted IPv4 text -> 32-bit number; malformed (also an octet above 255) -> null."""
    c = F.col(ip) if isinstance(ip, str) else ip
    parts = F.split(c, r"\.")  # one split per row (common subexpression)
    octet = [F.try_element_at(parts, F.lit(i + 1)).try_cast("long") for i in range(4)]
    num = octet[0] * 16777216 + octet[1] * 65536 + octet[2] * 256 + octet[3]
    valid = F.size(parts) == 4
    for o in octet:
        valid = valid & o.between(0, 255)
    return F.when(valid, num)


def bucketed_ranges(ranges: DataFrame, bits: int = IP_BUCKET_BITS) -> DataFrame:
    """One row per (range, bucket it touches)."""
    return ranges.withColumn(
        "_bucket", F.explode(F.sequence(F.shiftright("lo", bits), F.shiftright("hi", bits))))


def disjoint_ranges(ranges: DataFrame, payload: list[str], bits: int = IP_BUCKET_BITS) -> DataFrame:
    """Intervals (_bucket, lo, hi, payload) that do not overlap, each with its winner's payload.

    Of ranges that cover the same part of a bucket only the winner is kept before the shuffle; a
    task then sweeps bucket after bucket, in order of the starts, and holds the ranges that
    are open at the sweep line in a heap. Ranges with a null end or ``lo > hi`` match nothing."""
    valid = ranges.where(F.col("lo") <= F.col("hi")).select("lo", "hi", *payload)
    base = F.shiftleft(F.col("_bucket"), bits)
    rank = F.struct((F.col("hi") - F.col("lo")).alias("width"), (-F.col("lo")).alias("start"), *payload)
    clipped = (bucketed_ranges(valid, bits)
               .groupBy("_bucket", F.greatest("lo", base).alias("lo"), F.least(F.col("hi"), base + ((1 << bits) - 1)).alias("hi"))
               .agg(F.min(rank).alias("rank"))
               .select("_bucket", "lo", "hi", F.col("rank.width").alias("_width"), F.col("rank.start").alias("_start"), *[F.col(f"rank.{c}").alias(c) for c in payload]))
    kept = ["_bucket", "lo", "hi", *payload]

    def sweep(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        bucket, line = None, 0
        open_: list[tuple] = []
        out: list[tuple] = []

        def cover(to: int | None) -> None:
            """Intervals from the sweep line up to ``to`` (None: until no range is open)."""
            nonlocal line
            while open_ and (to is None or line < to):
                _, _, end, values = open_[0]
                if end < line:
                    heapq.heappop(open_)
                    continue
                stop = end if to is None else min(end, to - 1)
                if out and out[-1][0] == bucket and out[-1][2] == line - 1 and out[-1][3:] == values:
                    out[-1] = (bucket, out[-1][1], stop, *values)
                else:
                    out.append((bucket, line, stop, *values))
                line = stop + 1

        serial = 0
        for pdf in batches:
            columns = [[None if pd.isna(v) else v for v in pdf[c]] if c in payload else pdf[c].tolist() for c in ["_bucket", "lo", "hi", "_width", "_start", *payload]]
            for b, lo, hi, width, start, *values in zip(*columns, strict=True):
                if b != bucket:
                    cover(None)
                    open_.clear()
                    if out:
                        yield pd.DataFrame(out, columns=kept)
                        out.clear()
                    bucket = b
                else:
                    cover(lo)
                line = lo
                order = tuple((v is not None, v) if v is not None else (False, 0) for v in values)
                heapq.heappush(open_, ((width, start, order), serial, hi, tuple(values)))
                serial += 1
        cover(None)
        if out:
            yield pd.DataFrame(out, columns=kept)

    schema = clipped.select(*kept).schema
    return clipped.repartition("_bucket").sortWithinPartitions("_bucket", "lo").mapInPandas(sweep, schema)


def range_lookup(df: DataFrame, value_col: str, ranges: DataFrame, payload: list[str], bits: int = IP_BUCKET_BITS) -> DataFrame:
    """Left join ``df`` to the range containing ``value_col`` (lo <= v <= hi); one row out per row in."""
    return interval_lookup(df, value_col, disjoint_ranges(ranges, payload, bits), payload, bits)


def interval_lookup(df: DataFrame, value_col: str, intervals: DataFrame, payload: list[str], bits: int = IP_BUCKET_BITS) -> DataFrame:
    """As ``range_lookup``, with intervals that ``disjoint_ranges`` made.

    A small interval table is broadcast by its statistics; otherwise both
    sides shuffle on the bucket (AQE splits hot buckets).
    """
    b = intervals.select(F.col("_bucket"), F.col("lo").alias("_lo"), F.col("hi").alias("_hi"), *payload)
    v = F.col(value_col)
    left = df.withColumn("_vbucket", F.shiftright(v, bits))
    cond = (left["_vbucket"] == b["_bucket"]) & (v >= b["_lo"]) & (v <= b["_hi"])
    return left.join(b, cond, "left").drop("_vbucket", "_bucket", "_lo", "_hi")
