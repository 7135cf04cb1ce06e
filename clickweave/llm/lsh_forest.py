"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification.

A document is the set of its runs of ``SHINGLE`` words (letters and digits, lower-cased),
as 64-bit hashes; a shorter text is one run. Documents with the same set are one class
member from the start ("set"), so copies are never compared.

Forest: each of ``TREES`` trees is a sorted run of all sets' signatures, ``MAX_DEPTH`` minima
of its own one behind the other, over range partitions; a prefix trie read in order, where the sets
that share a prefix are neighbours. A prefix length per tree is fixed by the target recall:
shortened one level of one tree at a time, until a pair at the threshold shares a prefix in some
tree with at least that probability (pairs above it do so more often). From there a set's matched prefix is
shortened on, level by level, while the run of sets that share it has at most ``SMALL_RUN`` members: what
costs little is compared as well, so recall is above the target except in large runs. Sets of one run
are candidates. They are linked through the smallest set of their run, not pairwise, and the
components of these links are the units of verification. A run may cross partitions: a summary row per
partition (run lengths at its ends) gives every partition the whole length of such runs.

Verification: a component's sets are dealt into blocks by hash, of about ``BLOCK_SETS`` sets
and ``BLOCK_SHINGLES`` shingles. Every pair of blocks of a component meets in one task,
which counts the common shingles of all its pairs by sparse-to-dense matrix products and
gives exact similarities. A task returns a link count for each set and one edge that joins
it to its neighbours, never the pairs, so the output is linear in the sets. The links' own
components are the classes.

Result, one row per document: doc_id, class_id (smallest id of its class), set_id (smallest
id with the same set), copies (documents with that set), n_links (other sets at the
threshold or above), text_hash.

Rows: null texts and texts without words have no set: they link to nothing and are classes
of their own (copies 1). Null ids rank after all others; a class of null ids only has a
null class_id. Repeated rows are copies. Extra columns are ignored; an empty table gives
an empty result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from clickweave.llm.common import checkpointed, shuffle_partitions, text_slices, texts_of, written
from clickweave.llm.components import components

WORD = re.compile(r"\w+")
SHINGLE, THRESHOLD = 5, 0.8
TREES, MAX_DEPTH, TARGET_RECALL = 24, 6, 0.9995
MIN_DEPTH, SMALL_RUN = 4, 32
LEVEL_BITS = 10  # of each minimum; equal bits of different minima only add candidates
RUN_ROWS = 500_000
BLOCK_SETS, BLOCK_SHINGLES = 256, 1 << 21
COLUMNS = 4096
CACHE_WORDS = 300_000
SLICE_CHARS = 1_500_000
MIX = np.uint64(0x9E3779B97F4A7C15)


def prefix_depths(trees: int, max_depth: int, threshold: float, target: float) -> list[int]:
    """Each tree's prefix length: shortened in turn, the longest first, until a pair of the
    threshold's similarity is found with the target probability (or all are 1)."""
    depths = [max_depth] * trees
    while 1 - np.prod([1 - threshold**d for d in depths]) < target and max(depths) > 1:
        depths[depths.index(max(depths))] -= 1
    return depths


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(32))) * MIX
    return h ^ (h >> np.uint64(29))


class _Words(dict):
    def __init__(self) -> None:
        self.hashes: list[int] = []

    def __missing__(self, word: str) -> int:
        import xxhash
        self[word] = number = len(self)
        self.hashes.append(xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass")))
        return number


class Shingles:
    """Texts to (shingle hashes of all, their number per text), by text, not yet distinct."""

    def __init__(self, size: int = SHINGLE):
        self.size = size
        self.words = _Words()
        self.known = np.empty(0, np.uint64)

    def __call__(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.words) > CACHE_WORDS:
            self.words, self.known = _Words(), np.empty(0, np.uint64)
        flat: list[str] = []
        lengths = np.empty(len(texts), np.int64)
        for i, t in enumerate(texts):
            found = WORD.findall(t.lower())
            lengths[i] = len(found)
            flat += found
        at = np.fromiter(map(self.words.__getitem__, flat), np.int64, len(flat))
        if self.words.hashes:
            self.known = np.concatenate([self.known, np.array(self.words.hashes, np.uint64)])
            self.words.hashes = []
        h = self.known[at]
        n = self.size
        starts = np.cumsum(lengths) - lengths
        counts = np.where(lengths >= n, lengths - n + 1, np.minimum(lengths, 1))
        first = np.cumsum(counts) - counts
        begin = np.repeat(starts - first, counts) + np.arange(counts.sum())
        out = np.full(len(begin), n, np.uint64)
        short = np.repeat(lengths < n, counts)
        left = np.repeat(lengths, counts)
        for k in range(n):
            ok = (k < left) | ~short
            out[ok] = _mix(out[ok] ^ h[begin[ok] + k]) + np.uint64(k)
        return out, counts


def tree_keys(shingles: np.ndarray, counts: np.ndarray, trees: int, depth: int) -> np.ndarray:
    """texts x trees: the signature in each tree, ``depth`` minima of ``LEVEL_BITS`` bits, first one highest. No text is empty."""
    x = (shingles >> np.uint64(32)).astype(np.uint32)
    starts = np.cumsum(counts) - counts
    rng = np.random.default_rng(1)
    keys = np.zeros((len(counts), trees), np.int64)
    for t in range(trees):
        for _ in range(depth):
            a, b = rng.integers(0, 2**32, 2, dtype=np.uint32)
            least = np.minimum.reduceat((x ^ b) * (a | np.uint32(1)), starts)
            bits = _mix(least.astype(np.uint64) + np.uint64(1)) >> np.uint64(64 - LEVEL_BITS)
            keys[:, t] = keys[:, t] << LEVEL_BITS | bits.astype(np.int64)
    return keys


def _set_id(distinct: np.ndarray) -> bytes:
    """128 bits of a set of hashes, whatever their order."""
    a = _mix(distinct + np.uint64(1))
    b = _mix(a ^ (distinct << np.uint64(1)))
    return np.array([a.sum(dtype=np.uint64), b.sum(dtype=np.uint64)], np.uint64).tobytes()


def signed(docs: DataFrame, size: int, trees: int, depth: int) -> DataFrame:
    """doc_id, text_hash, set, n (shingles), keys, per document; set is null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            for at, texts in text_slices(texts_of(batch.column(2)), SLICE_CHARS):
                h, counts = shingles(texts)
                has = np.flatnonzero(counts)
                sets: list[bytes | None] = [None] * len(texts)
                keys: list[bytes | None] = [None] * len(texts)
                n = np.zeros(len(texts), np.int64)
                starts = np.cumsum(counts) - counts
                if len(has):
                    for i, row in zip(has, tree_keys(h, counts[has], trees, depth), strict=True):
                        own = np.unique(h[starts[i]:starts[i] + counts[i]])
                        sets[i], keys[i], n[i] = _set_id(own), row.tobytes(), len(own)
                part = batch.slice(at, len(texts))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sets, pa.binary()), pa.array(n, pa.int64()), pa.array(keys, pa.binary())],
                                                 names=["doc_id", "text_hash", "set", "n", "keys"])

    return (docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
            .mapInArrow(run, "doc_id long, text_hash long, set binary, n long, keys binary"))


def _by_tree(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(v, keys) to one row per tree."""
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            part = batch.slice(at, 4096)
            keys = np.frombuffer(b"".join(part.column(1).to_pylist()), np.int64)
            trees = len(keys) // part.num_rows
            v = np.repeat(part.column(0).to_numpy(), trees)
            tree = np.tile(np.arange(trees, dtype=np.int32), part.num_rows)
            yield pa.RecordBatch.from_arrays([pa.array(tree), pa.array(keys), pa.array(v)], names=["tree", "sig", "v"])


def _run_starts(tree: np.ndarray, sig: np.ndarray, level: int, max_depth: int) -> np.ndarray:
    """Where the runs of rows with one prefix of ``level`` minima begin, and the number of rows at the end."""
    prefix = sig >> (LEVEL_BITS * (max_depth - level))
    change = np.flatnonzero((prefix[1:] != prefix[:-1]) | (tree[1:] != tree[:-1])) + 1
    return np.concatenate([[0], change, [len(sig)]])


def _whole(batches: Iterator[pa.RecordBatch]) -> list[np.ndarray]:
    """A partition's columns (it has about ``RUN_ROWS`` rows of numbers)."""
    held = list(batches)
    return [np.concatenate([b.column(i).to_numpy() for b in held]) if held else np.empty(0, np.int64) for i in range(3)]


def runs_across(ends: list[tuple], levels: list[int], max_depth: int) -> dict[int, dict[int, tuple[int, int]]]:
    """partition -> level -> whole lengths of the runs that its first and its last row lie in. ``ends``, in
    order: (partition, first tree, first signature, last tree, last signature, rows, lengths of the first run by level, of the last)."""
    out: dict[int, dict[int, tuple[int, int]]] = {e[0]: {} for e in ends}
    for n, level in enumerate(levels):
        def prefix(tree: int, sig: int, level: int = level) -> tuple[int, int]:
            return tree, sig >> (LEVEL_BITS * (max_depth - level))

        # Chains of partitions that share a run: its parts add up.
        total: dict[tuple[int, tuple[int, int]], int] = {}
        chain = 0
        where: dict[int, tuple[tuple, tuple]] = {}
        before = None
        for p, ft, fs, lt, ls, rows, lead, trail in ends:
            first, last = prefix(ft, fs), prefix(lt, ls)
            if before != first:
                chain += 1
            head = (chain, first)
            total[head] = total.get(head, 0) + lead[n]
            if lead[n] == rows:
                tail = head
            else:
                chain += 1
                tail = (chain, last)
                total[tail] = total.get(tail, 0) + trail[n]
            where[p], before = (head, tail), last
        for p, (head, tail) in where.items():
            out[p][level] = (total[head], total[tail])
    return out


def candidate_runs(sets: DataFrame, depths: list[int], max_depth: int, min_depth: int, small_run: int, run_rows: int = RUN_ROWS) -> DataFrame:
    """(key, v) of every set in a run of two or more that is to be compared, from (v, keys)."""
    rows = sets.select("v", "keys").mapInArrow(_by_tree, "tree int, sig long, v long")
    parts = max(shuffle_partitions(sets.sparkSession), -(-sets.count() * len(depths) // run_rows))
    laid = checkpointed(rows.repartitionByRange(parts, "tree", "sig", "v").sortWithinPartitions("tree", "sig", "v"))
    levels = list(range(min(min_depth, *depths), max(depths) + 1))

    def summary(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        tree, sig, _ = _whole(batches)
        if not len(sig):
            return
        starts = [_run_starts(tree, sig, level, max_depth) for level in levels]
        yield pa.RecordBatch.from_pydict({
            "part": pa.array([TaskContext.get().partitionId()], pa.int32()), "ft": pa.array([int(tree[0])], pa.int32()), "fs": [int(sig[0])],
            "lt": pa.array([int(tree[-1])], pa.int32()), "ls": [int(sig[-1])], "n": [len(sig)],
            "lead": [[int(s[1]) for s in starts]], "trail": [[int(s[-1] - s[-2]) for s in starts]]})

    ends = sorted(tuple(r) for r in laid.mapInArrow(summary, "part int, ft int, fs long, lt int, ls long, n long, lead array<long>, trail array<long>").collect())
    across = runs_across(ends, levels, max_depth)

    def chosen(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        tree, sig, v = _whole(batches)
        if not len(sig):
            return
        whole = across[TaskContext.get().partitionId()]
        fixed = np.array(depths)[tree]
        level_of, size_of = fixed.copy(), np.zeros(len(sig), np.int64)
        for level in reversed(levels):
            starts = _run_starts(tree, sig, level, max_depth)
            sizes = np.diff(starts)
            sizes[0], sizes[-1] = whole[level][0], whole[level][1]
            size = np.repeat(sizes, np.diff(starts))
            take = (level == fixed) | ((level < fixed) & (level >= min_depth) & (size <= small_run))
            level_of, size_of = np.where(take, level, level_of), np.where(take, size, size_of)
        use = size_of > 1
        prefix = sig[use] >> (LEVEL_BITS * (max_depth - level_of[use]))
        key = _mix(_mix(prefix.astype(np.uint64)) + (tree[use].astype(np.uint64) * np.uint64(16) + level_of[use].astype(np.uint64)))
        yield pa.RecordBatch.from_arrays([pa.array(key.view(np.int64)), pa.array(v[use])], names=["key", "v"])

    return laid.mapInArrow(chosen, "key long, v long")


def common_counts(sets: list[np.ndarray]) -> np.ndarray:
    """sets x sets: how many elements each two sorted sets share."""
    if len(sets) == 2:
        n = len(np.intersect1d(*sets, assume_unique=True))
        return np.array([[len(sets[0]), n], [n, len(sets[1])]], np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, at, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times > 1
    column = np.cumsum(shared) - 1
    use = shared[at]
    column, owner = column[at[use]], owner[use]
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    out = np.zeros((len(sets), len(sets)), np.float32)
    total = int(column[-1]) + 1 if len(column) else 0
    for a in range(0, total, COLUMNS):
        lo, hi = np.searchsorted(column, [a, a + COLUMNS])
        m = np.zeros((len(sets), min(COLUMNS, total - a)), np.float32)
        m[owner[lo:hi], column[lo:hi] - a] = 1
        out += m @ m.T
    return out.astype(np.int64)


def block_links(vs: np.ndarray, blocks: np.ndarray, sets: list[np.ndarray], threshold: float, i: int, j: int) -> Iterator[tuple[int, int, int]]:
    """(v, links, root) of each set with a link between the blocks i and j."""
    if len(vs) < 2:
        return
    n = np.array([len(s) for s in sets], np.int64)
    common = common_counts(sets)
    union = n[:, None] + n[None, :] - common
    linked = (common >= threshold * union - 1e-9) & ~np.eye(len(vs), dtype=bool)
    if i != j:
        linked &= blocks[:, None] != blocks[None, :]
    links = linked.sum(1)
    root, reached = np.arange(len(vs)), links == 0
    for a in np.argsort(vs, kind="stable"):
        if reached[a]:
            continue
        seen = np.zeros(len(vs), bool)
        front = np.array([a])
        while len(front):
            seen[front] = True
            front = np.flatnonzero(linked[front].any(0) & ~seen)
        root[seen] = a
        reached |= seen
    for k in np.flatnonzero(links):
        yield int(vs[k]), int(links[k]), int(vs[root[k]])


def near_groups(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES, max_depth: int = MAX_DEPTH,
                target_recall: float = TARGET_RECALL, small_run: int = SMALL_RUN) -> DataFrame:
    """One row per document: doc_id, class_id, set_id, copies, n_links, text_hash."""
    return near_classes(docs, size, threshold, trees, max_depth, target_recall, small_run).drop("class")


def near_classes(docs: DataFrame, size: int = SHINGLE, threshold: float = THRESHOLD, trees: int = TREES, max_depth: int = MAX_DEPTH,
                 target_recall: float = TARGET_RECALL, small_run: int = SMALL_RUN) -> DataFrame:
    """``near_groups`` with the number of the class, null for a document without words."""
    depths = prefix_depths(trees, max_depth, threshold, target_recall)
    rows = written(signed(docs, size, trees, max_depth), "signed")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no"), F.col("doc_id").alias("id"), F.col("text_hash").alias("hash")))
    sets = written(rows.where("set is not null").groupBy("set").agg(first.alias("r"), F.count("*").alias("copies"), F.first("n").alias("n"), F.first("keys").alias("keys"))
                   .select("set", "copies", "n", "keys", F.col("r.id").alias("set_id"), F.col("r.hash").alias("set_hash"),
                           F.monotonically_increasing_id().alias("v")), "sets")

    prefixes = written(candidate_runs(sets, depths, max_depth, MIN_DEPTH, small_run), "prefixes")
    hubs = written(prefixes.groupBy("key").agg(F.count("*").alias("c"), F.min("v").alias("hub")).where("c > 1").select("key", "hub"), "hubs")
    near = components(prefixes.join(hubs, "key").select(F.col("v").alias("a"), F.col("hub").alias("b")))
    near = written(near.join(sets.select(F.col("v").alias("node"), "n", "set_id", "set_hash"), "node"), "members")
    sizes = written(near.groupBy("root").agg(F.count("*").alias("c"), F.sum("n").alias("s"))
                    .select("root", F.greatest(F.ceil(F.col("c") / BLOCK_SETS), F.ceil(F.col("s") / BLOCK_SHINGLES)).cast("int").alias("blocks")), "sizes")
    members = near.join(sizes, "root").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    members = members.select(F.col("node").alias("v"), "root", "blocks", "block", F.col("set_id").alias("m_id"), F.col("set_hash").alias("m_hash"))

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingles = Shingles(size)
        for batch in batches:
            for at, texts in text_slices(texts_of(batch.column(4)), SLICE_CHARS):
                h, counts = shingles(texts)
                starts = np.cumsum(counts) - counts
                part = batch.slice(at, len(texts))
                own = [np.unique(h[s:s + c]).tobytes() for s, c in zip(starts, counts, strict=True)]
                yield pa.RecordBatch.from_arrays([*part.columns[:4], pa.array(own, pa.binary())], names=["v", "root", "blocks", "block", "own"])

    texts = docs.select(F.col("doc_id").cast("long").alias("d_id"), F.xxhash64("text").alias("d_hash"), "text")
    sent = (texts.join(members, F.col("d_id").eqNullSafe(F.col("m_id")) & (F.col("d_hash") == F.col("m_hash")))
            .select("v", "root", "blocks", "block", "text")
            .mapInArrow(expand, "v long, root long, blocks int, block int, own binary"))
    # Block b meets the blocks b..last, and is met by the blocks before it.
    meets = F.transform(F.sequence(F.lit(0), F.col("blocks") - 1), lambda o: F.struct(F.least(o, F.col("block")).alias("i"), F.greatest(o, F.col("block")).alias("j")))
    pairs = sent.withColumn("p", F.explode(meets)).select("root", F.col("p.i").alias("i"), F.col("p.j").alias("j"), "block", "v", "own")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now: tuple | None = None
        held: dict[int, tuple[int, np.ndarray]] = {}
        out: list[tuple] = []

        def close() -> None:
            if now is not None and len(held) > 1:
                vs = np.array(list(held))
                out.extend(block_links(vs, np.array([b for b, _ in held.values()]), [s for _, s in held.values()], threshold, now[1], now[2]))
            held.clear()

        def flush() -> pa.RecordBatch:
            part = pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*out, strict=True)], names=["v", "links", "to"])
            out.clear()
            return part

        for batch in batches:
            for root, i, j, block, v, own in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (root, i, j) != now:
                    close()
                    now = (root, i, j)
                    if len(out) >= 10_000:
                        yield flush()
                held[v] = (block, np.frombuffer(own, np.uint64))
        close()
        if out:
            yield flush()

    links = written(pairs.repartition("root", "i", "j").sortWithinPartitions("root", "i", "j").mapInArrow(verify, "v long, links long, to long"), "links")
    n_links = links.groupBy(F.col("v").alias("l_v")).agg(F.sum("links").alias("n_links"))
    classes = components(links.select(F.col("v").alias("a"), F.col("to").alias("b")))
    linked = written(sets.select("v", "set", "copies", "set_id").join(classes, F.col("v") == F.col("node"), "left").join(n_links, F.col("v") == F.col("l_v"), "left")
                     .select("set", "copies", "set_id", F.coalesce("root", "v").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links")), "linked")
    named = written(linked.groupBy("class").agg(F.min("set_id").alias("class_id")), "named")
    known = linked.join(named, "class")
    return (rows.select("doc_id", "text_hash", "set").join(known, "set", "left")
            .select("doc_id", F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
                    F.when(F.col("copies").isNull(), F.col("doc_id")).otherwise(F.col("set_id")).alias("set_id"),
                    F.coalesce("copies", F.lit(1)).cast("long").alias("copies"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), "text_hash", "class"))
