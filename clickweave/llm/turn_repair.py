"""Conversation structure repair by Four-Russians block tables.

A conversation is valid if its roles' initials read ``(s?(ua)+)?``. Edits: Keep a turn (0),
Rerole it to user or assistant (2), Delete it (3; blank and duplicate turns must go), Insert an
empty user or assistant turn (2); a truncated turn that stays adds 1. The cheapest edits win,
of ties the ones whose initials are ASCII-least.

Method. What the cheapest repair of the rest costs depends on where in the pattern the
turns so far have come to: a vector of four costs. Less its minimum it takes few values
(``Tables.vectors``), so the step over every block of ``block`` turn symbols is precomputed:
normalised vector behind the block -> vector before it, and the place in the pattern
that each place is led to. A conversation goes through the table from its end, block by block;
then blocks are expanded, backward to the vector behind every turn and forward to the
least letter that keeps the cost, so ties are settled by the whole string.

Steps over blocks compose, so a conversation may span any number of tasks. Turns are sorted
by conversation over range partitions and checkpointed. A partition hands the driver one
row (bounded by the table: what its first and its last conversation do to every vector); the
driver chains them, and every partition then traces its turns alone. A task holds one
conversation's part of a partition at a time. ``digests`` streams each conversation's rows
through SHA-256, which takes them in order: conversations that span partitions are sent to one
task each, where rows are streamed, never held; the audit is held (a byte an edit, below 2 GB).

Order: conversations by id, turns by turn (nulls first), then role, then the text's SHA-256.
Of equal role and text all but the first are duplicates. Faults: the first of blank, duplicate, truncated.

Rows: a null role or text is one space. A null conv_id is a conversation. Roles of other initials (an empty role has
none) fit nowhere unless reroled. Repeated rows count as often as they occur. Texts of any length
are handled whole. An empty table gives an empty result. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache, lru_cache
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, IntegerType, LongType, StringType, StructField, StructType

from clickweave.llm.common import checkpointed, shuffle_partitions, written

SPACE = " \t\n\x0b\x0c\r"
ENDS = ".!?"
BLOCK = 4
PART_BYTES = 64 << 20
HEAVY = 1024

# Places in the pattern: nothing yet, after s, after u, after a. Symbols: 0 must go, 1 no turn
# (fills a block), 2 + 2 * role + truncated with roles s, u, a, other.
START, AFTER_S, AFTER_U, AFTER_A = range(4)
GO, NONE, FIRST = 0, 1, 2
SYMBOLS = 10
KEEP = ({START: AFTER_S}, {START: AFTER_U, AFTER_S: AFTER_U, AFTER_A: AFTER_U}, {AFTER_U: AFTER_A}, {})
# A rerole or insertion gives the one of user and assistant that can follow.
NEXT = (AFTER_U, AFTER_U, AFTER_A, AFTER_U)
DELETE_COST, REROLE_COST, INSERT_COST, TRUNCATED_COST = 3, 2, 2, 1
ROLE = {AFTER_U: "user", AFTER_A: "assistant"}
LEGAL = ("su", "ua", "au")

Vector = tuple[int, int, int, int]


def _inserting(base: list[float]) -> list[float]:
    """The least costs if turns may be inserted first."""
    v = list(base)
    for _ in range(2):
        v = [min(v[q], INSERT_COST + v[NEXT[q]]) for q in range(4)]
    return v


def _options(symbol: int, q: int) -> list[tuple[str, int, int]]:
    """(letter, cost, place after) of what may be done with a turn at place q, letters ascending."""
    if symbol == NONE:
        return [("", 0, q)]
    ways = [("D", DELETE_COST, q)]
    if symbol >= FIRST:
        role, truncated = divmod(symbol - FIRST, 2)
        if q in KEEP[role]:
            ways.append(("K", truncated * TRUNCATED_COST, KEEP[role][q]))
        ways.append(("R", REROLE_COST + truncated * TRUNCATED_COST, NEXT[q]))
    return ways


END: Vector = tuple(int(x) for x in _inserting([0, float("inf"), float("inf"), 0]))  # type: ignore[assignment]


def _before(symbol: int, after: Vector) -> list[float]:
    return _inserting([min(c + after[to] for _, c, to in _options(symbol, q)) for q in range(4)])


def _letters(symbol: int, after: Vector, q: int) -> tuple[str, int]:
    """The ASCII-least cheapest edits up to and with this turn, and the place after."""
    costs, done = _before(symbol, after), ""
    while True:
        for letter, c, to in sorted([*_options(symbol, q), ("I", INSERT_COST, -1)]):
            if to < 0 and costs[q] == c + costs[NEXT[q]] and symbol != NONE:
                q, done = NEXT[q], done + "I"
                break
            if to >= 0 and costs[q] == c + after[to]:
                return done + letter, to


def at_end(q: int) -> tuple[str, int]:
    """What is inserted behind the last turn."""
    return {AFTER_S: "II", AFTER_U: "I"}.get(q, ""), AFTER_A


class Tables:
    """Steps over all blocks of ``block`` symbols: ``prev[v, code]`` is the vector before the block if v is the one
    behind it, ``exits[v, code, q]`` the place that q is led to. Code: the symbols as digits, first one highest."""

    def __init__(self, block: int = BLOCK):
        self.block, self.vectors = block, [END]
        number = {END: 0}
        prev, exits, letters = [], [], []
        for v in self.vectors:  # grows
            rows = [_before(s, v) for s in range(SYMBOLS)]
            flat = [tuple(int(x - min(r)) for x in r) for r in rows]
            for n in flat:
                if n not in number:
                    number[n] = len(self.vectors)
                    self.vectors.append(n)  # type: ignore[arg-type]
            prev.append([number[n] for n in flat])
            traced = [[_letters(s, v, q) for q in range(4)] for s in range(SYMBOLS)]
            letters.append([[t[0] for t in row] for row in traced])
            exits.append([[t[1] for t in row] for row in traced])
        self.prev1, self.exits1, self.letters1 = np.array(prev, np.int16), np.array(exits, np.int8), letters
        codes = np.array(list(product(range(SYMBOLS), repeat=block)), np.int8)
        v = np.repeat(np.arange(len(self.vectors))[:, None], len(codes), axis=1)
        to = np.broadcast_to(np.arange(4, dtype=np.int8), (*v.shape, 4))
        for i in range(block - 1, -1, -1):
            step = self.exits1[v, codes[:, i]]
            to = np.take_along_axis(to, step.astype(np.int64), axis=2)
            v = self.prev1[v, codes[:, i]]
        self.prev, self.exits = v.astype(np.int16), to
        self.expand = lru_cache(1 << 16)(self._expand)

    def codes(self, symbols: bytes) -> np.ndarray:
        """Block codes of symbols; fillers stand before the first."""
        padded = np.frombuffer(bytes([NONE]) * (-len(symbols) % self.block) + symbols, np.uint8).reshape(-1, self.block)
        return padded.astype(np.int64) @ (SYMBOLS ** np.arange(self.block - 1, -1, -1))

    def run(self, codes: np.ndarray, v: int) -> list[int]:
        """The vector behind every block, by lookup from the end; the last entry is the one before the first block."""
        behind = []
        for code in codes[::-1].tolist():
            behind.append(v)
            v = int(self.prev[v, code])
        return [*behind[::-1], v]

    def effect(self, symbols: bytes) -> tuple[list[int], list[int]]:
        """What a run of symbols does to every vector behind it: the vector before, and the places led to (vectors x 4)."""
        v, to = np.arange(len(self.vectors)), np.broadcast_to(np.arange(4), (len(self.vectors), 4))
        for code in self.codes(symbols)[::-1].tolist():
            to = np.take_along_axis(to, self.exits[v, code].astype(np.int64), axis=1)
            v = self.prev[v, code]
        return v.tolist(), to.reshape(-1).tolist()

    def _expand(self, code: int, v: int, q: int) -> tuple[tuple[str, ...], int]:
        """The letters of each turn of a block, and the place after it: vectors backward, letters forward."""
        symbols = [code // SYMBOLS ** i % SYMBOLS for i in range(self.block - 1, -1, -1)]
        behind = []
        for s in reversed(symbols):
            behind.append(v)
            v = int(self.prev1[v, s])
        out = []
        for s, after in zip(symbols, reversed(behind), strict=True):
            if s != NONE:
                out.append(self.letters1[after][s][q])
            q = int(self.exits1[after, s, q])
        return tuple(out), q

    def trace(self, symbols: bytes, v: int, q: int) -> tuple[list[str], int]:
        """The letters of every turn (insertions before it first), and the last place."""
        codes, out = self.codes(symbols), []
        for code, after in zip(codes.tolist(), self.run(codes, v), strict=False):
            some, q = self.expand(code, after, q)
            out += some
        return out, q


@cache
def tables() -> Tables:
    """Built once a worker, from the costs alone."""
    return Tables()


# ---- damage, as the registered query does it ----

def damaged(turns: DataFrame) -> DataFrame:
    """The rows damaged by crc32(``conv_id:turn``) % 20: 0 dropped, 1 text emptied, 2 without its
    sentence ends, 3 twice, 4 role user."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    how = F.crc32(F.concat(text("conv_id"), F.lit(":"), text("turn")).cast("binary")) % 20
    rows = turns.select("conv_id", "turn", text("role").alias("role"), text("text").alias("text"), how.alias("how")).where("how <> 0")
    return rows.select("conv_id", "turn", F.when(F.col("how") == 4, "user").otherwise(F.col("role")).alias("role"),
                       F.when(F.col("how") == 1, "").when(F.col("how") == 2, F.translate("text", ENDS, "")).otherwise(F.col("text")).alias("text"),
                       F.explode(F.when(F.col("how") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy")).drop("copy")


# ---- layout ----

def layout(turns: DataFrame) -> DataFrame:
    """All turns in order over range partitions of about ``PART_BYTES`` of text, checkpointed: with ``base``
    (0 blank, else 2 + 2 * role + truncated) and ``seen`` (role and text at an earlier turn)."""
    def text(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    rows = turns.select("conv_id", F.col("turn").cast("long").alias("turn"), text("role").alias("role"), text("text").alias("text"))
    stripped = F.rtrim(F.col("text"), F.lit(SPACE))
    initial = F.substring("role", 1, 1)
    role = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(3)
    base = F.when(stripped == "", GO).otherwise(FIRST + 2 * role + F.when(F.right(stripped, F.lit(1)).isin(*ENDS), 0).otherwise(1))
    rows = rows.select("*", base.cast("int").alias("base"), F.unhex(F.sha2("text", 256)).alias("text_id"), F.monotonically_increasing_id().alias("row"))
    rows = rows.withColumn("key", F.sha2(F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), F.lit(" ")), F.hex("text_id"), "role"), 256))

    # First turns of role and text that a conversation holds at several turns. The most
    # frequent ones, at most HEAVY, are broadcast; their rows do not meet in the shuffle of the rest.
    first = written(rows.groupBy("key").agg(F.min(F.struct(F.col("turn").isNotNull().alias("late"), "turn")).alias("first"),
                                            F.max(F.struct(F.col("turn").isNotNull().alias("late"), "turn")).alias("last"), F.count("*").alias("copies"))
                    .where(~F.col("first").eqNullSafe(F.col("last"))).select("key", "first", "copies"), "first_turns")
    heavy = first.orderBy(F.desc("copies"), "key").limit(HEAVY).select("key", F.col("first").alias("first_h"))
    here = rows.join(F.broadcast(heavy), "key", "left")
    here = here.withColumn("meet", F.when(F.col("first_h").isNotNull(), F.concat(F.lit("row "), F.col("row").cast("string"))).otherwise(F.col("key")))
    here = here.join(first.select(F.col("key").alias("meet"), F.col("first").alias("first_l")), "meet", "left")
    earliest = F.coalesce("first_h", "first_l")
    seen = F.coalesce(~earliest["turn"].eqNullSafe(F.col("turn")), F.lit(False)) & earliest.isNotNull()

    size = rows.agg(F.sum(F.octet_length("text") + 64).alias("bytes")).first().bytes or 0
    parts = max(shuffle_partitions(turns.sparkSession), -(-int(size) // PART_BYTES))
    order = ["conv_id", "turn", "role", "text_id", "row"]
    return checkpointed(here.select("conv_id", "turn", "role", "text", "base", "text_id", seen.alias("seen"), "row")
                        .repartitionByRange(parts, *order).sortWithinPartitions(*order)).drop("row")


def _symbols(batch: pa.RecordBatch, last: tuple | None) -> tuple[np.ndarray, np.ndarray, list[str], list[tuple]]:
    """Per row: its symbol, whether it is a duplicate, its role's initial, and its key (conversation, turn, role, text id).
    ``last`` is the key of the row before the batch."""
    conv, turn, role, ids = (batch.column(n).to_pylist() for n in ("conv_id", "turn", "role", "text_id"))
    keys = list(zip(conv, turn, role, ids, strict=True))
    again = np.array([a == b for a, b in zip([last, *keys[:-1]], keys, strict=True)]) | batch.column("seen").to_numpy(zero_copy_only=False).astype(bool)
    base = batch.column("base").to_numpy()
    return np.where(again, GO, base).astype(np.uint8), again & (base != GO), [r[:1] for r in role], keys


SUMMARY = "part int, first_conv {c}, last_conv {c}, single boolean, head_prev array<int>, head_to array<int>, tail_prev array<int>, tail_to array<int>"


def _bounds(rows: DataFrame) -> dict[int, tuple]:
    """The last row's key of each partition, from the JVM."""
    order = F.struct(F.col("conv_id").isNotNull().alias("c"), "conv_id", F.col("turn").isNotNull().alias("t"), "turn", "role", "text_id")
    got = rows.groupBy(F.spark_partition_id().alias("part")).agg(F.max(order).alias("k")).collect()
    return {r.part: (r.k["conv_id"], r.k["turn"], r.k["role"], bytes(r.k["text_id"])) for r in got}


def _part_summaries(rows: DataFrame, before: dict[int, tuple | None]) -> dict[int, dict]:
    kind = rows.schema["conv_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        part, t = TaskContext.get().partitionId(), tables()
        last, n, head, first, current, held = before.get(part), 0, None, None, None, bytearray()
        for batch in batches:
            symbols, _, _, keys = _symbols(batch, last)
            for s, key in zip(symbols.tolist(), keys, strict=True):
                if not n:
                    first = current = key[0]
                elif key[0] != current:
                    if head is None:
                        head = t.effect(bytes(held))
                    current, held = key[0], bytearray()
                held.append(s)
                n += 1
            last = keys[-1] if keys else last
        if n:
            tail = t.effect(bytes(held))
            single = head is None
            head = head or tail
            yield pa.RecordBatch.from_pylist([{"part": part, "first_conv": first, "last_conv": current, "single": single,
                                               "head_prev": head[0], "head_to": head[1], "tail_prev": tail[0], "tail_to": tail[1]}], schema=arrow)

    from pyspark.sql.pandas.types import to_arrow_schema
    spark_schema = StructType.fromDDL(SUMMARY.format(c=kind))
    arrow = to_arrow_schema(spark_schema)
    return {r.part: r.asDict() for r in rows.select("conv_id", "turn", "role", "text_id", "base", "seen").mapInArrow(run, spark_schema).collect()}


# ---- repair ----

def _plan(rows: DataFrame) -> dict[int, tuple]:
    """For each partition of the layout: the key of the row before it, whether its first conversation began before, at which
    place it is then, whether its last one goes on, and the vector behind its last row."""
    ends = _bounds(rows)
    filled = sorted(ends)
    earlier = dict(zip(filled, [None, *filled], strict=False))
    later = dict(zip(filled, [*filled[1:], None], strict=False))
    before = {p: ends.get(earlier[p]) for p in filled}
    parts = _part_summaries(rows, before)
    goes_on = {p: later[p] is not None and parts[p]["last_conv"] == parts[later[p]]["first_conv"] for p in filled}
    behind: dict[int, int] = {}
    for p in reversed(filled):
        nxt = later[p]
        behind[p] = parts[nxt]["head_prev"][behind[nxt] if parts[nxt]["single"] else 0] if goes_on[p] else 0
    place: dict[int, int] = {}
    for p in filled:
        prv = earlier[p]
        place[p] = START if prv is None or not goes_on[prv] else parts[prv]["tail_to"][4 * behind[prv] + (place[prv] if parts[prv]["single"] else START)]
    return {p: (before[p], goes_on.get(earlier[p], False), place[p], goes_on[p], behind[p]) for p in filled}


def repair(turns: DataFrame) -> DataFrame:
    """One row per edit, in order of (part, pos): conv_id, turn, was_role, fault (blank, duplicate, truncated),
    illegal (the initials of this and the turn before may not follow each other), new_turn (another number
    than the turn before), edit (K, R, D, I), role and text after repair (null if deleted), and
    whole (the conversation lies in one partition). Inserted turns have no turn, was_role or fault."""
    rows = layout(turns)
    return _edits(rows, _plan(rows))


def _edits(rows: DataFrame, plan: dict[int, tuple], only: bool | None = None) -> DataFrame:
    """The edits; ``only`` those of conversations that lie in one partition, or do not."""
    conv = rows.schema["conv_id"].dataType
    schema = StructType([StructField("conv_id", conv), StructField("part", IntegerType()), StructField("pos", LongType()), StructField("turn", LongType()),
                         StructField("was_role", StringType()), StructField("fault", StringType()), StructField("illegal", BooleanType()),
                         StructField("new_turn", BooleanType()), StructField("edit", StringType()), StructField("role", StringType()),
                         StructField("text", StringType()), StructField("whole", BooleanType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow, t = to_arrow_schema(schema), tables()
        part = TaskContext.get().partitionId()
        if part not in plan:
            return
        key, cont, q0, more, v_end = plan[part]
        pos, out, size = 0, [], 0

        def emit(held: list[tuple], first: bool, last: bool) -> None:
            """The edits of a conversation's rows in this partition."""
            nonlocal pos, size
            symbols = bytes(h[0] for h in held)
            letters, q = t.trace(symbols, v_end if last and more else 0, q0 if first and cont else START)
            whole = not (first and cont) and not (last and more)
            if only is not None and whole != only:
                return
            q_now = q0 if first and cont else START
            for (s, fault, illegal, new, turn, was, text), some in zip(held, letters, strict=True):
                for letter in some:
                    if letter == "I":
                        q_now = NEXT[q_now]
                        row = (held_conv, part, pos, None, None, None, False, False, "I", ROLE[q_now], "", whole)
                    elif letter == "D":
                        row = (held_conv, part, pos, turn, was, fault, illegal, new, "D", None, None, whole)
                    else:
                        q_now = KEEP[(s - FIRST) // 2][q_now] if letter == "K" else NEXT[q_now]
                        row = (held_conv, part, pos, turn, was, fault, illegal, new, letter, was if letter == "K" else ROLE[q_now], text, whole)
                        size += len(text)
                    out.append(row)
                    pos += 1
            if not (last and more):
                for _ in at_end(q)[0]:
                    q_now = NEXT[q_now]
                    out.append((held_conv, part, pos, None, None, None, False, False, "I", ROLE[q_now], "", whole))
                    pos += 1

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

        held: list[tuple] = []
        held_conv, first = None, True
        for batch in batches:
            symbols, again, initials, keys = _symbols(batch, key)
            texts = batch.column("text").to_pylist()
            for s, dup, initial, now, text in zip(symbols.tolist(), again.tolist(), initials, keys, texts, strict=True):
                conv_id, turn, role, _ = now
                same = key is not None and key[0] == conv_id
                if held and conv_id != held_conv:
                    emit(held, first, False)
                    held, first = [], False
                    if size > 16_000_000 or len(out) > 20_000:
                        yield flush()
                        out, size = [], 0
                held_conv = conv_id
                fault = "duplicate" if dup else "blank" if s == GO else "truncated" if s % 2 else None
                held.append((s, fault, same and key[2][:1] + initial not in LEGAL, turn is not None and not (same and key[1] == turn), turn, role, text))
                key = now
        if held:
            emit(held, first, True)
        if out:
            yield flush()

    return rows.select("conv_id", "turn", "role", "text_id", "base", "seen", "text").mapInArrow(run, schema)


# ---- digests ----

def digests(turns: DataFrame) -> DataFrame:
    """Per conversation after repair: gaps, blank, duplicate, truncated, illegal, cost, audit (the edits' initials)
    and repaired_sha256 (of the lines ``role:text`` of the repaired conversation)."""
    rows = layout(turns)
    plan = _plan(rows)
    conv = rows.schema["conv_id"].dataType
    counts = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
    schema = StructType([StructField("conv_id", conv), *[StructField(c, LongType()) for c in counts], StructField("audit", StringType()), StructField("repaired_sha256", StringType())])
    costs = {"D": DELETE_COST, "R": REROLE_COST, "I": INSERT_COST, "K": 0}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(schema)
        out: list[tuple] = []
        current, open_ = None, False
        lo = hi = None
        distinct = 0
        faults: dict[str | None, int] = {}
        illegal = cost = 0
        audit, sha, lines = bytearray(), hashlib.sha256(), 0

        def close() -> None:
            gaps = hi - lo + 1 - distinct if lo is not None else 0
            out.append((current, gaps, faults.get("blank", 0), faults.get("duplicate", 0), faults.get("truncated", 0), illegal, cost, audit.decode(), sha.hexdigest()))

        def flush() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), arrow, strict=True)], schema=arrow)

        for batch in batches:
            for conv_id, turn, fault, bad, new, edit, role, text in zip(*(batch.column(i).to_pylist() for i in range(8)), strict=True):
                if not open_ or conv_id != current:
                    if open_:
                        close()
                    current, open_, lo, hi, distinct, faults, illegal, cost = conv_id, True, None, None, 0, {}, 0, 0
                    audit, sha, lines = bytearray(), hashlib.sha256(), 0
                if new:
                    lo, hi, distinct = turn if lo is None else lo, turn, distinct + 1
                faults[fault] = faults.get(fault, 0) + 1
                illegal += bad
                cost += costs[edit] + (fault == "truncated" and edit != "D")
                audit += edit.encode()
                if role is not None:
                    sha.update(f"{chr(10) if lines else ''}{role}:{text}".encode())
                    lines += 1
            if out:
                yield flush()
                out = []
        if open_:
            close()
            yield flush()

    cols = ["conv_id", "turn", "fault", "illegal", "new_turn", "edit", "role", "text"]
    done = _edits(rows, plan, True).select(*cols).mapInArrow(run, schema)
    if not any(goes_on for *_, goes_on, _ in plan.values()):
        return done
    split = _edits(rows, plan, False).repartition("conv_id").sortWithinPartitions("conv_id", "part", "pos")
    return done.unionByName(split.select(*cols).mapInArrow(run, schema))
