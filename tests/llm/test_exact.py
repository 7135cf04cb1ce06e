"""Exact operators against brute force: radix dedup, line dedup, shards, top-k, mixing."""
import hashlib
import math
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest
from llm_fixtures import no_docs, odd_docs  # noqa: F401

from pyspark.sql import functions as F

from clickweave.llm import byte_shards, line_runs, nra_topk, poisson_mix, radix_dedup
from clickweave.llm.params import OTHER_SHARE, TARGETS
from clickweave.llm.radix_dedup import radix_groups

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def rows_of(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def some(a):
    return (a is not None, a or 0)


def test_radix_groups_in_memory():
    texts = [b"", b"a" * 16, b"a" * 17, b"a" * 16, b"", b"a" * 40 + b"b", b"a" * 40 + b"c", b"a" * 40 + b"b"]
    assert sorted(map(sorted, radix_groups(texts))) == [[0, 4], [1, 3], [2], [5, 7], [6]]


@pytest.mark.parametrize("shares", [2, 8, 1000])
def test_radix_dedup(odd_docs, shares):
    want, groups = [], defaultdict(list)
    rows = rows_of(odd_docs, "doc_id", "text")
    for i, t in rows:
        groups[(t or "").translate(LOWER)].append(i)
    for i, t in rows:
        norm = (t or "").translate(LOWER)
        keep = max((x for x in groups[norm] if x is not None), default=None)
        want.append((i, keep, len(groups[norm]), i == keep, hashlib.sha256(norm.encode()).hexdigest()))
    got = rows_of(radix_dedup.exact_groups(odd_docs, shares), "doc_id", "keep_id", "group_size", "kept", "text_sha256")
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_radix_dedup_large_group_of_copies(spark):
    # 400 copies and 200 texts that differ at the end only: many levels, both kinds of heavy groups
    body = "same beginning " * 300
    docs = spark.createDataFrame([(i, body + "copy" if i < 400 else body + str(i)) for i in range(600)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in radix_dedup.exact_groups(docs, 16).collect()}
    assert got == {i: (399, 400) if i < 400 else (i, 1) for i in range(600)}


def test_radix_leaves_have_a_fixed_size(spark, monkeypatch):
    finish = radix_dedup._finish

    def watched(batches):
        held, size = list(batches), Counter()
        for b in held:
            for *leaf, rest in zip(*(b.column(i).to_pylist() for i in (0, 1, 2, 4)), strict=True):
                size[tuple(leaf)] += len(rest)
        assert max(size.values(), default=0) <= 20_000, "a leaf is too large for a task"
        yield from finish(iter(held))

    monkeypatch.setattr(radix_dedup, "_finish", watched)
    monkeypatch.setattr(radix_dedup, "TASK_BYTES", 20_000)
    docs = spark.createDataFrame([(i, "abc"[i % 3] * 100 + f"{i // 6:04}" + "x" * 900) for i in range(300)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: (r.keep_id, r.group_size) for r in radix_dedup.exact_groups(docs, 2).collect()}
    assert got == {i: (i // 6 * 6 + 3 + i % 3, 2) for i in range(300)}


@pytest.mark.parametrize("limit", [0, 1 << 30])
def test_radix_heavy_keys_joined_by_a_salt(spark, monkeypatch, limit):
    monkeypatch.setattr(radix_dedup, "BROADCAST_BYTES", limit)
    monkeypatch.setattr(radix_dedup, "SALTS", 3)
    seen = []
    routed = radix_dedup._routed

    def watched(at, nodes, node_bytes):
        assert node_bytes == sum(len(r._head) + radix_dedup.NODE_BYTES for r in nodes.collect())
        seen.append(node_bytes)
        return routed(at, nodes, node_bytes)

    monkeypatch.setattr(radix_dedup, "_routed", watched)
    texts = {}
    rows = [(None if i == 7 else i, "A" * 80 + ("one" if i % 3 else f"{i}")) for i in range(200)] + [(3, None), (4, ""), (5, "")]
    for i, t in rows:
        texts.setdefault((t or "").lower(), Counter())[i] += 1
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = Counter((r.doc_id, r.keep_id, r.group_size, r.kept) for r in radix_dedup.exact_groups(docs, 50).collect())
    want = Counter()
    for i, t in rows:
        same = texts[(t or "").lower()]
        keep = max(x for x in same if x is not None)
        want[(i, keep, sum(same.values()), i == keep)] += 1
    assert got == want
    assert len(seen) > 1 and max(seen) > 0, "no heavy groups"


def test_radix_holds_one_leaf_at_a_time(monkeypatch):
    monkeypatch.setattr(radix_dedup, "OUT_ROWS", 4)
    groups, largest = radix_dedup.radix_groups, []
    monkeypatch.setattr(radix_dedup, "radix_groups", lambda texts: largest.append(len(texts)) or groups(texts))
    rows = [(0, n, b"h%d" % n, 10 * n + k, b"x" * (k // 2), b"s") for n in range(6) for k in range(n + 1)]
    batches = [pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*rows[i:i + 4], strict=True)], names=list("abcdef")) for i in range(0, len(rows), 4)]
    out = list(radix_dedup._finish(iter(batches)))
    assert max(largest) == 6 and len(out) > 2
    got = {i: (k, n) for b in out for i, k, n in zip(*(b.column(c).to_pylist() for c in range(3)), strict=True)}
    assert got == {10 * n + k: (10 * n + min(n, k | 1), 2 if k | 1 <= n else 1) for n in range(6) for k in range(n + 1)}


def brute_lines(rows):
    last = line_runs.LAST_ID
    holders = defaultdict(set)
    for i, t in rows:
        for line in (t or "").split("\n"):
            key = line.strip(line_runs.BLANK).translate(LOWER)
            if len(key) >= 10:
                holders[key].add(last if i is None else i)
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        keys = [x.strip(line_runs.BLANK).translate(LOWER) for x in lines]
        kept = [x for x, k in zip(lines, keys, strict=True) if len(k) < 10 or min(holders[k]) == (last if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


@pytest.mark.parametrize("batches", [1, 2, 5])
def test_line_dedup(odd_docs, batches):
    want = brute_lines(rows_of(odd_docs, "doc_id", "text"))
    got = line_runs.dedup_lines(odd_docs, batches=batches)
    assert got.columns == [*odd_docs.columns, "_line_n", "_line_lost", "_line_kept"]
    assert sorted(rows_of(got, "doc_id", "_line_n", "_line_lost", "_line_kept"), key=repr) == sorted(want, key=repr)


def test_line_runs_are_merged_and_dropped(spark):
    docs = spark.createDataFrame([(i, f"a line of its own {i}\nline number {i % 7} of a few\nshared by all of them") for i in range(120)], "doc_id long, text string")
    before = {t.name for t in spark.catalog.listTables()}
    got = line_runs.dedup_lines(docs, batches=8, fanout=2)
    assert sorted(rows_of(got, "doc_id", "_line_n", "_line_lost", "_line_kept")) == sorted(brute_lines(rows_of(docs, "doc_id", "text")))
    assert {t.name for t in spark.catalog.listTables()} == before


@pytest.mark.parametrize("n", [1, 3, 8])
def test_byte_shards(odd_docs, n):
    got = byte_shards.byte_shards(odd_docs, n).collect()
    rows = rows_of(odd_docs, "doc_id", "text")
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in got) == Counter(
        (i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in rows)
    total, at = sum(r.size for r in got), 0
    for r in sorted(got, key=lambda r: (r.shard, r.slot)):
        assert r.shard == min(n - 1, (2 * at + r.size) * n // (2 * total))
        assert r.law == "bytes" and r.grown_shard is None
        at += r.size
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    ids = [some(r.doc_id) for r in sorted(got, key=lambda r: (r.shard, r.slot))]
    assert ids == sorted(ids)


def test_shards_are_written(spark, tmp_path):
    docs = spark.createDataFrame([(i, "x" * i, "en") for i in range(50)], "doc_id long, text string, lang string")
    byte_shards.write_shards(docs, str(tmp_path / "out"), 4)
    back = spark.read.parquet(str(tmp_path / "out"))
    assert sorted(rows_of(back, "doc_id", "text", "lang")) == sorted(rows_of(docs, "doc_id", "text", "lang"))
    assert {r.shard for r in back.select("shard").distinct().collect()} == {0, 1, 2, 3}


def brute_topk(rows, k):
    vectors = [(i, [math.floor(256 * float(x)) for x in v]) for i, v in rows
               if i is not None and v and all(x is not None and math.isfinite(x) for x in v)]
    asked = {}
    for i, v in vectors:
        if i % 50 == 0:
            asked[i] = min(asked.get(i, v), v)
    out = []
    for q, v in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(v, c, strict=True)), i) for i, c in vectors if i != q and len(c) == len(v))
        out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scores[:k])]
    return sorted(out)


@pytest.mark.parametrize("scale", [1.0, 1e6])
def test_topk(spark, scale):
    rng = np.random.default_rng(3)
    rows = [(int(i), [float(np.float32(x * scale)) for x in rng.normal(size=8)]) for i in range(400)]
    rows += [(500 + i, rows[7][1]) for i in range(60)]  # many ties
    rows += [(50, rows[3][1]), (None, rows[4][1]), (900, None), (901, []), (902, [1.0, None] * 4), (903, [float("nan")] * 8), (904, [float("inf")] * 8),
             (950, [1.0, 2.0]), (951, [3.0, -1.0]), (1000, [0.0] * 8), (77, rows[8][1]), (77, rows[8][1])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 AS label", "'x' AS `rank`").repartition(3)
    got = nra_topk.top_k(df, df.vec_id % 50 == 0, 5, 256, block_rows=64, query_rows=3)
    assert sorted(rows_of(got, "query_id", "rank", "vec_id", "score")) == brute_topk(rows, 5)


def test_topk_fewer_than_k_and_none(spark):
    df = spark.createDataFrame([(0, [1.0]), (1, [2.0])], "vec_id long, embedding array<float>")
    assert rows_of(nra_topk.top_k(df, df.vec_id % 50 == 0), "query_id", "rank", "vec_id", "score") == [(0, 1, 1, 256 * 512)]
    assert nra_topk.top_k(df.limit(0), df.vec_id % 50 == 0).count() == 0


@pytest.mark.parametrize("rate", [0.3, 1.5, 100.0])
def test_poisson_counts(spark, rate):
    docs = spark.range(2000).selectExpr("id AS doc_id", "'t' AS text", "'a' AS source")
    n = Counter(r.doc_id for r in poisson_mix.poisson_mix(docs, {"a": 1.0}, total=int(2000 * rate)).collect())
    counts = np.array([n.get(i, 0) for i in range(2000)])
    assert abs(counts.mean() - rate) < 4 * math.sqrt(rate / 2000)
    assert abs(counts.var() - rate) < 0.2 * rate


def test_poisson_inverts_the_distribution():
    cdf = poisson_mix.poisson_cdf(2.5)
    exact = np.cumsum([math.exp(-2.5) * 2.5**k / math.factorial(k) for k in range(len(cdf))])
    assert np.allclose(cdf, exact) and 1 - cdf[-1] < 1e-12


def test_mix_weights_and_odd_rows(odd_docs):
    got = poisson_mix.poisson_mix(odd_docs, {"src0": 1.0, "src1": 0.0}, other_weight=1.0, total=400)
    assert got.columns == [*(c for c in odd_docs.columns if c != "copy"), "copy"]
    rows = got.collect()
    assert not any(r.source == "src1" for r in rows)
    share = sum(r.source == "src0" for r in rows) / len(rows)
    assert 0.4 < share < 0.6
    again = poisson_mix.poisson_mix(odd_docs, {"src0": 1.0, "src1": 0.0}, other_weight=1.0, total=400)
    assert sorted(map(repr, rows)) == sorted(map(repr, again.collect()))
    copies = defaultdict(Counter)
    for r in rows:
        copies[(r.doc_id, r.text)][r["copy"]] += 1
    for c in copies.values():
        assert sorted(c) == list(range(1, len(c) + 1)) and len(set(c.values())) == 1


@pytest.mark.parametrize("source", ["src5", "elsewhere"])
def test_mix_total_with_absent_sources(spark, source):
    import corpus_pipeline as P
    docs = spark.range(2000).selectExpr("id AS doc_id", "'t' AS text", f"'{source}' AS source")
    share = TARGETS.get(source, OTHER_SHARE)
    for df, want in ((dict(P.STAGES)["mix"](spark, docs, ""), 2000), (poisson_mix.poisson_mix(docs, TARGETS, OTHER_SHARE), 2000 * share)):
        assert abs(df.count() - want) < 4 * math.sqrt(want)


def test_empty_tables(spark, no_docs):
    assert radix_dedup.exact_groups(no_docs).count() == 0
    assert line_runs.dedup_lines(no_docs).count() == 0
    assert byte_shards.byte_shards(no_docs).count() == 0
    assert poisson_mix.poisson_mix(no_docs, {"a": 1.0}, 1.0).count() == 0


def test_topk_refuses_scores_beyond_64_bits(spark):
    big = spark.createDataFrame([(0, [1e9, 1e9]), (1, [1e9, 1e9])], "vec_id long, embedding array<double>")
    with pytest.raises(ValueError, match="64 bits"):
        nra_topk.top_k(big, big.vec_id == 0)


@pytest.mark.parametrize("salt_blocks", [1, 8])
def test_topk_over_salted_blocks(spark, monkeypatch, salt_blocks):
    monkeypatch.setattr(nra_topk, "SALT_BLOCKS", salt_blocks)
    rng = np.random.default_rng(6)
    vectors = rng.normal(size=(300, 5))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>").repartition(6)
    whole = np.floor(256 * vectors).astype(np.int64)
    want = []
    for q in range(0, 300, 10):
        scores = whole @ whole[q]
        best = sorted((i for i in range(300) if i != q), key=lambda i: (-scores[i], i))[:5]
        want += [(q, n, i, int(scores[i])) for n, i in enumerate(best, 1)]
    got = nra_topk.top_k(df, df.vec_id % 10 == 0, block_rows=16, query_rows=4)
    assert sorted(tuple(r) for r in got.collect()) == sorted(want)


def test_line_runs_leave_no_tables_behind(spark, monkeypatch, odd_docs):
    before = {t.name for t in spark.catalog.listTables()}
    monkeypatch.setattr(line_runs.Runs, "find", lambda self, keys: 1 / 0 if self.levels else keys.withColumn("_owner", F.lit(None).cast("long")))
    with pytest.raises(ZeroDivisionError):
        line_runs.lost_lines(odd_docs)
    assert {t.name for t in spark.catalog.listTables()} == before
