"""URL filter: prefix rules first, then trust and distrust spread over the host graph.

Rules (host, path) fit a host and its subdomains when the url's path starts with the
rule's; the longest fitting rule decides. Urls that no rule fits get their host's
verdict from two personalised PageRank vectors, scaled so that a seed counts in full
wherever it has links or not (that is, divided by 1 - d):

* trust:    t = s+ + d * (what each linking host gives, split over its links)
* distrust: r = s- + d * (what each linked host gives back, split over its inlinks) - a
  host that links to blocked hosts is suspect.

The seed of a host is the share of its pages that an allow (s+) or block (s-) rule
decides. Edges are the absolute links of its pages to other hosts, with a scheme or from ``//`` on, weighted
by their number. Steps go on until what all further ones could add to any score is under
``TOLERANCE`` (each step passes on at most d of the last one's gain); scores are compared to ``DIGITS`` digits. A host is blocked when its distrust reaches ``threshold`` and exceeds its trust.

Everything is DataFrame expressions. Pages are pre-aggregated to one row per host and
per host edge before the first shuffle, so a host holding most pages is one row; each
PageRank step joins edges with scores (AQE splits a hub's edges) and sums partially.
The scores are checkpointed every few steps. The blocked hosts are written before they
meet the pages, so that AQE can split the host with most pages.

Rows: a null url or one without ``://`` has empty host and path, fits no rule and is
allowed, as nothing speaks against it. Null html has no links. Repeated rows count as
often as they occur. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import count
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import ascii_lower, checkpointed, written

LINK = r"""(?i)\bhref\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\s]*)"""
DAMPING, TOLERANCE, THRESHOLD, DIGITS = 0.85, 1e-4, 0.5, 3
CHECKPOINT_EVERY = 8


class Rule(NamedTuple):
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


def _after_scheme(url: Column) -> Column:
    """What follows the first ``://``; empty if there is none."""
    at = F.instr(url, "://")
    return F.coalesce(F.when(at > 0, F.substring(url, at + 3, F.length(url))), F.lit(""))


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    return F.regexp_extract(_after_scheme(url), r"(?s)^[^/?#]*([^?#]*)", 1)


def fits(rule: Rule, host: Column, path: Column) -> Column:
    return ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)


def longest_rule(rules: Sequence[Rule], host: Column, path: Column, give) -> Column:
    """``give(rule)`` of the longest rule that fits (ties: the first in ``rules``), else null."""
    ordered = sorted(rules, key=lambda r: -len(r.name))
    return F.coalesce(*[F.when(fits(r, host, path), F.lit(give(r))) for r in ordered], F.lit(None).cast("string"))


def judged_urls(pages: DataFrame, rules: Sequence[Rule], keep: Sequence[str]) -> DataFrame:
    return (pages.select(*keep, host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
            .withColumn("rule", longest_rule(rules, F.col("host"), F.col("path"), lambda r: r.name))
            .withColumn("_said", longest_rule(rules, F.col("host"), F.col("path"), lambda r: r.verdict)))


def host_edges(pages: DataFrame) -> DataFrame:
    """src, dst, links: absolute links between different hosts."""
    links = pages.select(host_of(F.col("url")).alias("src"),
                         F.explode(F.regexp_extract_all(F.col("html"), F.lit(LINK), F.lit(1))).alias("dst"))
    return (links.select("src", ascii_lower(F.col("dst")).alias("dst"))
            .where("src <> '' and dst <> '' and src <> dst")
            .groupBy("src", "dst").agg(F.count("*").cast("double").alias("links")))


def propagate(hosts: DataFrame, edges: DataFrame, seed: str, giver: str, taker: str, damping: float, tolerance: float) -> DataFrame:
    """host, score: the linear personalised PageRank along ``giver`` -> ``taker``, to ``tolerance``."""
    given = edges.groupBy(F.col(giver).alias("_giver")).agg(F.sum("links").alias("_all"))
    flows = checkpointed(edges.join(given, F.col(giver) == F.col("_giver"))
                         .select(F.col(giver).alias("_giver"), F.col(taker).alias("_taker"), (F.col("links") / F.col("_all")).alias("_part")))
    score = hosts.select("host", F.col(seed).alias("_seed"), F.col(seed).alias("score"))
    for step in count(1):
        got = (flows.join(score.select(F.col("host").alias("_giver"), "score"), "_giver")
               .groupBy(F.col("_taker").alias("host")).agg(F.sum(F.col("_part") * F.col("score")).alias("_got")))
        score = (score.join(got, "host", "left")
                 .select("host", "_seed", F.col("score").alias("_before"), (F.col("_seed") + damping * F.coalesce("_got", F.lit(0.0))).alias("score")))
        if step == 1 or step % CHECKPOINT_EVERY == 0:
            score = checkpointed(score)
            gain = score.agg(F.sum(F.col("score") - F.col("_before"))).first()[0] or 0.0
            if gain * damping / (1 - damping) < tolerance:
                break
    return score.select("host", F.round("score", DIGITS).alias("score"))


def host_scores(pages: DataFrame, rules: Sequence[Rule], damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """host, trust, distrust, for every host of a page or a link."""
    edges = checkpointed(host_edges(pages))
    seen = (judged_urls(pages, rules, []).where("host <> ''").groupBy("host")
            .agg(*[F.avg(F.when(F.col("_said") == v, 1.0).otherwise(0.0)).alias(c) for v, c in (("allow", "_good"), ("block", "_bad"))]))
    linked = edges.select(F.col("dst").alias("host"), F.lit(0.0).alias("_good"), F.lit(0.0).alias("_bad"))
    hosts = checkpointed(seen.unionByName(linked).groupBy("host").agg(F.max("_good").alias("_good"), F.max("_bad").alias("_bad")))
    trust = propagate(hosts, edges, "_good", "src", "dst", damping, tolerance).withColumnRenamed("score", "trust")
    distrust = propagate(hosts, edges, "_bad", "dst", "src", damping, tolerance).withColumnRenamed("score", "distrust")
    return trust.join(distrust, "host")


def judge_urls(pages: DataFrame, rules: Sequence[Rule], keep: Sequence[str] = ("page_id",), damping: float = DAMPING,
               tolerance: float = TOLERANCE, threshold: float = THRESHOLD) -> DataFrame:
    """``keep`` columns, host, path, rule and verdict of every page."""
    blocked = written(host_scores(pages, rules, damping, tolerance)
                      .where((F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust")))
                      .select(F.col("host").alias("_blocked")), "blocked")
    said = F.coalesce("_said", F.when(F.col("_blocked").isNotNull(), F.lit("block")).otherwise("allow"))
    return (judged_urls(pages, rules, keep).join(blocked, F.col("host") == F.col("_blocked"), "left")
            .select(*keep, "host", "path", "rule", said.alias("verdict")))
