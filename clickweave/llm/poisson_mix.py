"""Mixing sources to target weights by Poisson replication.

A source with target weight w (a share of all weights) and n documents has the mean
repetition rate w * total / n. The share of a source that the table does not have goes to
nobody, so the result is smaller by it, as in the query's SQL; with ``present_only`` the shares are
of the weights of the present sources, and the result has ``total`` rows on average. Every document draws its count by inverting the Poisson distribution of
its source's rate at a uniform number made from a hash of (seed, doc_id), is exploded
that many times, and all copies are sorted by a hash: a global shuffle that any re-run
repeats. Rates above ``RATE_STEP`` are drawn as a sum of equal smaller Poisson draws,
which has the same distribution, so no count is capped.

``weights`` names the target sources; all other sources and null share ``other_weight``
as one pool. Only the counts of the named sources and the pool reach the driver, and
only their rates are broadcast: as many rows as ``weights`` has entries, plus one.

Rows: a null doc_id draws by its text's md5 instead. Repeated rows draw the same count
each. A source that is missing or has weight 0 contributes nothing. Texts may be null or
empty. All columns are kept; an input column of the
name that the number of the copy gets is replaced. An empty table
gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import aside

RATE_STEP = 32.0
BITS = 52


def poisson_cdf(rate: float) -> list[float]:
    """P(X <= k) for k = 0, 1, ... until it no longer grows in double precision."""
    p = cdf = math.exp(-rate)
    out, k = [cdf], 0
    while k <= rate or cdf + p != cdf:
        k += 1
        p *= rate / k
        cdf += p
        out.append(cdf)
    return out


def uniform(*parts: Column) -> Column:
    """A number in [0, 1): the first 52 bits of the parts' md5."""
    return F.conv(F.substring(F.md5(F.concat_ws("|", *parts)), 1, BITS // 4), 16, 10).cast("double") / float(2**BITS)


def _pool(source: Column, weights: Mapping[str, float]) -> Column:
    """The source if it is named, else null."""
    return F.when(source.isin(*weights), source) if weights else F.lit(None).cast("string")


def rates(docs: DataFrame, weights: Mapping[str, float], other_weight: float, total: int | None, present_only: bool = False) -> DataFrame:
    """One row per present pool: _of, _draws, _cdf."""
    spark = docs.sparkSession
    counts = {r._pool: r["count"] for r in docs.groupBy(_pool(F.col("source"), weights).alias("_pool")).count().collect()}
    total = sum(counts.values()) if total is None else total
    shares = {**weights, None: other_weight}
    whole = sum(shares[pool] for pool in counts) if present_only else sum(weights.values()) + other_weight
    found = []
    for pool, n in counts.items():
        if shares[pool] > 0:
            rate = shares[pool] / whole * total / n
            draws = max(1, math.ceil(rate / RATE_STEP))
            found.append((pool, draws, poisson_cdf(rate / draws)))
    return spark.createDataFrame(found, "_of string, _draws int, _cdf array<double>")


def poisson_mix(docs: DataFrame, weights: Mapping[str, float], other_weight: float = 0.0, total: int | None = None,
                seed: str = "mix", number: str | None = "copy", present_only: bool = False) -> DataFrame:
    """The documents, each repeated by its draw, with a column ``number`` (None: without it)
    that counts a document's copies from 1, in a globally shuffled order. ``total`` is the wanted number of rows (default: as many as
    there are)."""
    if any(w < 0 for w in (*weights.values(), other_weight)) or sum(weights.values()) + other_weight <= 0:
        raise ValueError("weights must not be negative, and one must be positive")
    plan = rates(docs, weights, other_weight, total, present_only)
    key = F.coalesce(F.col("doc_id").cast("string"), F.md5(F.coalesce(F.col("text"), F.lit(""))))
    count = F.aggregate(
        F.transform(F.sequence(F.lit(1), F.col("_draws")), lambda j: uniform(F.lit(seed), F.col("_key"), j.cast("string"))),
        F.lit(0), lambda acc, u: acc + F.size(F.filter("_cdf", lambda c: c <= u)))
    kept = [c for c in docs.columns if c != number]
    docs, columns = aside(docs.select(*[F.col(f"`{c}`") for c in kept]), "doc_id", "text", "source")
    copies = (docs.select(*columns, _pool(F.col("source"), weights).alias("_pool"), key.alias("_key"),
                          F.monotonically_increasing_id().alias("_position"))
              .join(F.broadcast(plan), F.col("_pool").eqNullSafe(F.col("_of")))
              .withColumn("_n", count)
              .where("_n > 0")
              .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_n"))))
              .withColumn("_order", F.md5(F.concat_ws("|", F.lit(seed), F.lit("order"), F.col("_key"), F.col("_copy").cast("string")))))
    order = ["_order", "_position"]
    return copies.repartitionByRange(*order).sortWithinPartitions(*order).select(*columns, *(["_copy"] if number else [])).toDF(*kept, *([number] if number else []))
