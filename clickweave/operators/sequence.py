"""Per-visitor click-sequence detector (batch form).

Rule (one configuration of a small ordered state machine per visitor):

* state ``init`` -> ``clothes_visited`` on a clothing click by a visitor in
  the target group (P16);
* ``clothes_visited`` -> ``shoes_visited`` on shoes, stays on clothing;
* ``shoes_visited`` -> **offer** on clothing of another product than the
  sequence's first click, back to ``clothes_visited`` on the same product;
* a click of the product accepted last is a page refresh and is skipped
  (checked before the time limit, so it never expires a sequence);
* every non-first transition also needs ``ts - first_ts < within``;
* no transition -> back to ``init`` and the click is consumed;
* an offer resets to ``init``; its code comes from the triggering click's
  gender (M -> offer1, else offer2).

Plan. The fold is sequential per visitor, so it cannot be a plain
aggregate; collecting one visitor's clicks into an array would put an
unbounded group into one task. Instead:

1. the needed columns are range-partitioned by ``(userId, ts, event_id)``
   and sorted inside each partition. The range partitioner samples the
   keys, so a visitor holding a third of all clicks is spread over many
   contiguous partitions instead of one;
2. that layout is checkpointed to the shared checkpoint folder (lineage
   cut, stable partition ids for the passes below);
3. a JVM aggregate gives each partition's first and last visitor (P rows,
   P = partition count, independent of data size). Where a visitor continues
   into the next partition, one pass over that visitor's rows summarises what
   they do to the state: the end state from ``init``, and, if the partition
   holds nobody else, a decision table for every state that may come in
   (below);
4. the driver walks the P partitions and looks up each one's incoming state;
5. one parallel pass folds every partition with its incoming state
   (constant memory: Arrow batches stream through, state is four scalars)
   and emits the accepted transitions (the trace); offers are the trace
   rows with ``state == 'offer'``.

So the number of passes is fixed, however many partitions a visitor fills.

Decision table of a run of rows. An open sequence that comes in is known by
its state, first time, first product and last product. The last product only
decides whether the run's leading rows are refreshes of it (two variants);
later refreshes are equal neighbours. The first product matters where a step
asks for it: one row for each such product and one for all others. The
first time decides at which row the limit ends the sequence: a step function
of it, whose pieces are labelled with what a fold that starts from ``init``
behind that row ends in. Those ends are found for all rows at once (sequences in
one state move together; one that ends joins the one that starts behind it), and
equal neighbouring pieces are one. A table of more than ``TABLE_ROWS`` pieces stays
in the shared folder, where the driver looks up one row; the others are collected.
"""

from __future__ import annotations

from collections import deque
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.visitors import in_target_group, offer_for_gender
from ..session import shared_path
from .ordered import layout_partitions

# fixed values: state names and the categories the rule reacts to
INIT, CLOTHES, SHOES, OFFER = "init", "clothes_visited", "shoes_visited", "offer"
CLOTHING, SHOES_CATEGORY = "clothing", "shoes"
DEFAULT_WINDOW_MINUTES = 30

_INIT_STATE = (INIT, None, None, None)  # (state, first_us, first_pid, last_pid)

# A visitor's stored state as a row before their clicks: marks = STORED, productId = last product,
# category = state, event_id = first time, code = first product, us = FIRST.
STORED = -1
FIRST = -(1 << 63)
EXPIRED = "expired"  # what is left of a sequence beyond its time limit: the next click but a refresh is lost
STATE_SCHEMA = "userId string, st string, first_us long, first_pid string, last_pid string"


class Step(NamedTuple):
    """In ``state``, a row with the label ``when`` goes to ``goes_to``; ``product`` says whether it
    must be the sequence's first product ("first"), another ("other") or any ("any")."""

    state: str
    when: str
    goes_to: str
    product: str = "any"


@dataclass(frozen=True)
class SequenceRule:
    """An ordered state machine per visitor, as a table.

    ``labels`` give each row its marks (Column conditions, evaluated in the JVM; null is
    false). Of a state's ``steps`` the first that fits is taken. Entering ``emits`` ends the
    sequence; ``code`` is what such a row carries. All machines start in ``init``.
    """

    labels: dict[str, Callable[[], Column]]
    steps: tuple[Step, ...]
    emits: str
    code: Callable[[], Column]

    def marks(self) -> Column:
        """The row's labels as bits."""
        out = F.lit(0)
        for i, condition in enumerate(self.labels.values()):
            out = out + F.when(condition(), 1 << i).otherwise(0)
        return out.cast("long")

    def by_state(self) -> dict[str, list[tuple[int, str, str]]]:
        bits = {name: 1 << i for i, name in enumerate(self.labels)}
        out: dict[str, list[tuple[int, str, str]]] = {}
        for step in self.steps:
            out.setdefault(step.state, []).append((bits[step.when], step.product, step.goes_to))
        return out


OFFER_RULE = SequenceRule(
    labels={
        "target_clothing": lambda: (F.col("category") == CLOTHING) & in_target_group("gender", "age"),
        "clothing": lambda: F.col("category") == CLOTHING,
        "shoes": lambda: F.col("category") == SHOES_CATEGORY,
    },
    steps=(
        Step(INIT, "target_clothing", CLOTHES),
        Step(CLOTHES, "shoes", SHOES),
        Step(CLOTHES, "clothing", CLOTHES),
        Step(SHOES, "clothing", OFFER, "other"),
        Step(SHOES, "clothing", CLOTHES, "first"),
    ),
    emits=OFFER,
    code=lambda: offer_for_gender("gender"),
)

FOLDED_SCHEMA = ("kind string, userId string, event_id long, us long, productId string, category string, state string, "
                 "offer string, live boolean, first_us long, first_pid string, last_pid string")
TRACE_SCHEMA = ("userId string, event_id long, us long, productId string, category string, "
                "state string, offer string, live boolean")
TABLE_SCHEMA = ("pid int, variant string, st string, known boolean, fp string, ft_hi long, "
                "kind string, to_st string, to_ft long, to_fp string, lead string, last string")
TABLE_ROWS = 4096  # of a partition's table on the driver; a larger one is looked up where it was written
MAX_FORKS = 64  # first products with a row of their own; a partition with more is folded again on its own


def _start_bits(steps: dict) -> int:
    """Marks that can open a sequence."""
    bits = 0
    for bit, _, _ in steps.get(INIT, ()):
        bits |= bit
    return bits


def _fold_rows(pdf: pd.DataFrame, state, current_user, window_us: int, trace: list | None, steps: dict, emits: str,
               ends: list | None = None):
    """Fold one batch of sorted rows; returns (state, current_user). Rows that come while no sequence
    is open and cannot open one are skipped without a look at each. ``ends`` takes the open state that each
    visitor but the last ends in, and ``init`` for each that comes with a stored state."""
    n = len(pdf)
    if not n:
        return state, current_user
    users, uss, pids, marks = (pdf[c].to_numpy() for c in ("userId", "us", "productId", "marks"))
    rest = [pdf[c].to_numpy() for c in ("event_id", "category", "code", "live")] if trace is not None else None
    starts = np.flatnonzero(marks & _start_bits(steps)).tolist()
    at, i = 0, 0
    if ends is not None and state[0] != INIT and users[0] != current_user:
        ends.append((current_user, *state))
    st, first_us, first_pid, last_pid = state if users[0] == current_user else _INIT_STATE
    while i < n:
        if st == INIT:
            while at < len(starts) and starts[at] < i:
                at += 1
            if at == len(starts):
                break
            i = starts[at]
        elif i and users[i] != users[i - 1]:
            if ends is not None:
                ends.append((users[i - 1], st, first_us, first_pid, last_pid))
            st, first_us, first_pid, last_pid = _INIT_STATE
            continue
        pid = pids[i]
        if marks[i] == STORED:
            st, first_us, first_pid, last_pid = pdf["category"].iloc[i], int(pdf["event_id"].iloc[i]), pdf["code"].iloc[i], pid
            if ends is not None:
                ends.append((users[i], *_INIT_STATE))
            i += 1
            continue
        if st != INIT and last_pid == pid:
            i += 1
            continue  # page refresh
        ts, mark, nxt = int(uss[i]), int(marks[i]), None
        if mark and (st == INIT or ts - first_us < window_us):
            nxt = _next_state(steps, st, mark, pid == first_pid)
        if nxt is not None and trace is not None:
            trace.append((users[i], rest[0][i], ts, pid, rest[1][i], nxt, rest[2][i], rest[3][i]))
        if nxt is None or nxt == emits:
            st, first_us, first_pid, last_pid = _INIT_STATE
        else:
            if st == INIT:
                first_us, first_pid = ts, pid
            st, last_pid = nxt, pid
        i += 1
    return (st, first_us, first_pid, last_pid), users[n - 1]


def _next_state(steps: dict, st: str, mark: int, is_first: bool) -> str | None:
    for bit, product, goes_to in steps.get(st, ()):
        if mark & bit and (product == "any" or (product == "first") == is_first):
            return goes_to
    return None


# ---- decision table of a run of one visitor's rows ----

def _ends_from_init(us: list, pids: list, marks: list, window_us: int, steps: dict, emits: str) -> list:
    """For every row k (and behind the last): what a fold that starts from ``init`` at row k ends in:
    None (``init``) or (state, row that opened the sequence)."""
    n = len(us)
    joins = [0] * n  # a sequence that ended at row i goes on as the fold that starts at i + 1
    groups: dict[str, dict] = {}  # state -> first product -> cell of open sequences
    home: dict[int, list] = {}  # open sequence -> its cell: [set of the rows that opened one]
    oldest: deque[int] = deque()

    def close(rows, i: int) -> None:
        for j in rows:
            joins[j] = i + 1
            del home[j]

    def move(group: dict, to: str | None, i: int) -> None:
        """All sequences of a group enter ``to``; the smaller of two groups or cells is moved."""
        if to is None or to == emits:
            for cell in group.values():
                close(cell[0], i)
            return
        there = groups.get(to)
        if there is None:
            groups[to] = group
            return
        small, large = (group, there) if len(group) < len(there) else (there, group)
        for product, cell in small.items():
            other = large.get(product)
            if other is not None:
                cell, other = sorted((cell, other), key=lambda c: len(c[0]))
                for j in cell[0]:
                    home[j] = other
                other[0] |= cell[0]
            large[product] = cell if other is None else other
        groups[to] = large

    for i in range(n):
        if home and not (i and pids[i] == pids[i - 1]):
            while oldest and (oldest[0] not in home or us[i] - us[oldest[0]] >= window_us):
                j = oldest.popleft()
                if j in home:
                    home[j][0].discard(j)
                    close([j], i)
            before, groups = groups, {}
            for state, group in before.items():
                first, other = (_next_state(steps, state, marks[i], same) if marks[i] else None for same in (True, False))
                cell = group.pop(pids[i], None) if first != other else None
                move(group, other, i)
                if cell is not None:
                    move({pids[i]: cell}, first, i)
        to = _next_state(steps, INIT, marks[i], pids[i] is None) if marks[i] else None
        if to is None or to == emits:
            joins[i] = i + 1
        else:
            home[i] = cell = [{i}]
            move({pids[i]: cell}, to, i)
            oldest.append(i)
    state_of: dict[int, str] = {}
    for state, group in groups.items():
        for cell in group.values():
            state_of.update(dict.fromkeys(cell[0], state))
    ends: list = [None] * (n + 1)
    for k in range(n - 1, -1, -1):
        ends[k] = (state_of[k], k) if k in state_of else ends[joins[k]]
    return ends


def _run_table(us: list, pids: list, marks: list, window_us: int, steps: dict, emits: str) -> list[tuple] | None:
    """Rows (variant, state, known, first product, largest first time, kind, to state, to first
    time, to first product) of the run's decision table; None if it would need too many products."""
    ends = _ends_from_init(us, pids, marks, window_us, steps, emits)
    n = len(us)
    lead = next((i for i in range(n) if pids[i] != pids[0]), n)

    def target(k: int) -> tuple:
        return ("init", None, None, None) if ends[k] is None else ("open", ends[k][0], us[ends[k][1]], pids[ends[k][1]])

    out: list[tuple] = [("init", INIT, False, None, None, *target(0))]

    def walk(variant: str, came: str, state: str, i: int, pieces: list, product, known: bool, forked: set) -> bool:
        """Follow a sequence that came in, its first product known or unlike all in ``forked``."""
        start = i
        while i < n:
            if i > start and pids[i] == pids[i - 1]:
                i += 1
                continue
            to = {same: _next_state(steps, state, marks[i], same) if marks[i] else None for same in (True, False)}
            if to[True] != to[False] and not known and pids[i] not in forked:
                forked.add(pids[i])
                if len(forked) > MAX_FORKS or not walk(variant, came, state, i, list(pieces), pids[i], True, forked):
                    return False
            nxt = to[known and pids[i] == product]
            if nxt is None or nxt == emits:
                break
            pieces.append((us[i] - window_us, target(i + 1)))
            state, i = nxt, i + 1
        last = target(i + 1) if i < n else ("through", state, None, None)
        for (hi, goes_to), (_, after) in zip(pieces, [*pieces[1:], (None, last)]):
            if goes_to != after:
                out.append((variant, came, known, product, hi, *goes_to))
        out.append((variant, came, known, product, None, *last))
        return True

    for came in [*steps, EXPIRED]:
        if came != INIT and not (walk("other", came, came, 0, [], None, False, set()) and walk("same", came, came, lead, [], None, False, set())):
            return None
    return out


def _tail_summary(incoming: dict, singles: set, window_us: int, steps: dict, emits: str):
    """mapInPandas body over the rows of each partition's last visitor: the decision table of a partition in
    ``singles``, else (or if it has none) the end state from ``init`` or from its incoming state."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid, state, user, lead, last = None, _INIT_STATE, None, None, None
        us: list = []
        pids: list = []
        marks: list = []
        for pdf in batches:
            if pdf.empty:
                continue
            if pid is None:
                pid, lead = int(pdf["_pid"].iloc[0]), pdf["productId"].iloc[0]
                if pid in incoming:
                    user, state = incoming[pid]
            last = pdf["productId"].iloc[-1]
            if pid in singles and pid not in incoming:
                for held, c in zip((us, pids, marks), ("us", "productId", "marks")):
                    held += pdf[c].tolist()
            else:
                state, user = _fold_rows(pdf, state, user, window_us, None, steps, emits)
        if pid is None:
            return
        rows = None
        if us:
            rows = _run_table(us, pids, marks, window_us, steps, emits)
        elif state == _INIT_STATE:
            rows = [("init", INIT, False, None, None, "init", None, None, None)]
        else:
            rows = [("init", INIT, False, None, None, "open", state[0], state[1], state[2])]
        if rows is None:
            rows = [("none", INIT, False, None, None, "init", None, None, None)]
        columns = [c.split()[0] for c in TABLE_SCHEMA.split(", ")]
        yield pd.DataFrame([(pid, *r, lead, last) for r in rows], columns=columns).astype({"ft_hi": "Int64", "to_ft": "Int64"})

    return run


def _partition_folder(incoming: dict, window_us: int, rule_steps: dict, emits: str):
    """mapInPandas body of the trace. ``incoming``: pid -> (user, state) for its first visitor."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = None
        state, user = _INIT_STATE, None
        for pdf in batches:
            if pdf.empty:
                continue
            if pid is None:
                pid = int(pdf["_pid"].iloc[0])
                if pid in incoming:
                    user, state = incoming[pid]
            trace: list = []
            state, user = _fold_rows(pdf, state, user, window_us, trace, rule_steps, emits)
            if trace:
                yield pd.DataFrame(trace, columns=["userId", "event_id", "us", "productId", "category", "state", "offer", "live"])

    return run


def _state_folder(incoming: dict, goes_on: set, window_us: int, rule_steps: dict, emits: str):
    """mapInPandas body: trace rows, and the state of every visitor who ends with an open sequence or came
    with one (kind ``state``). A visitor in ``goes_on`` ends in a later partition."""
    columns = [c.split()[0] for c in FOLDED_SCHEMA.split(", ")]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pid = None
        state, user = _INIT_STATE, None

        def frame(trace: list, ends: list) -> pd.DataFrame:
            rows = [("trace", *t, None, None, None) for t in trace]
            rows += [("state", u, None, None, None, None, st, None, None, us, fp, lp) for u, st, us, fp, lp in ends]
            out = pd.DataFrame(rows, columns=columns)
            return out.astype({"event_id": "Int64", "us": "Int64", "first_us": "Int64", "live": "boolean"})

        for pdf in batches:
            if pdf.empty:
                continue
            if pid is None:
                pid = int(pdf["_pid"].iloc[0])
                if pid in incoming:
                    user, state = incoming[pid]
            trace, ends = [], []
            state, user = _fold_rows(pdf, state, user, window_us, trace, rule_steps, emits, ends)
            if trace or ends:
                yield frame(trace, ends)
        if pid is not None and state[0] != INIT and pid not in goes_on:
            yield frame([], [(user, *state)])

    return run


def _bounds(layout: DataFrame) -> dict:
    """First / last visitor of every non-empty partition (JVM aggregate; the
    layout is sorted by visitor inside each partition, so min/max suffice)."""
    rows = layout.groupBy("_pid").agg(F.min("userId").alias("first_user"),
                                      F.max("userId").alias("last_user")).collect()
    return {r["_pid"]: r for r in rows}


def _tail_ends(layout: DataFrame, tails: dict, singles: set, incoming: dict, window_us: int, rule: SequenceRule) -> DataFrame:
    """Table rows of the last visitors in ``tails`` (pid -> visitor), from only their rows, as a written table."""
    keys = sorted(f"{pid}\u0001{user}" for pid, user in tails.items())
    rows = layout.filter(F.concat_ws("\u0001", F.col("_pid").cast("string"), "userId").isin(keys))
    path = shared_path(layout.sparkSession, "fold-tables")
    rows.mapInPandas(_tail_summary(incoming, singles, window_us, rule.by_state(), rule.emits), TABLE_SCHEMA).write.parquet(path)
    return layout.sparkSession.read.schema(TABLE_SCHEMA).parquet(path)


class _Tables:
    """The decision tables of the partitions: small ones in memory, large ones looked up."""

    def __init__(self, written: DataFrame):
        self.written = written
        sizes = {r["pid"]: r["count"] for r in written.groupBy("pid").count().collect()}
        self.large = {p for p, n in sizes.items() if n > TABLE_ROWS}
        some = written.where(~F.col("pid").isin(sorted(self.large)) | (F.col("variant") == "init")) if self.large else written
        self.rows: dict = {}
        for r in some.collect():
            self.rows.setdefault(r["pid"], {}).setdefault((r["variant"], r["st"]), []).append(r)

    def has_table(self, pid: int) -> bool:
        return ("none", INIT) not in self.rows[pid]

    def end(self, pid: int, state: tuple) -> tuple:
        """The state behind the partition's last visitor if ``state`` comes in."""
        any_row = next(iter(self.rows[pid].values()))[0]
        if state == _INIT_STATE:
            row = self.rows[pid]["init", INIT][0]
        else:
            st, first_us, first_pid, last_pid = state
            variant = "same" if last_pid == any_row["lead"] else "other"
            if pid in self.large:
                fits = (F.col("pid") == pid) & (F.col("variant") == variant) & (F.col("st") == st)
                found = self.written.where(fits & (~F.col("known") | F.col("fp").eqNullSafe(F.lit(first_pid)))
                                           & (F.col("ft_hi").isNull() | (F.col("ft_hi") >= first_us)))
                found = found.orderBy(F.desc("known"), F.asc_nulls_last("ft_hi")).limit(1).collect()
            else:
                found = [r for r in self.rows[pid][variant, st] if r["ft_hi"] is None or r["ft_hi"] >= first_us]
                found = ([r for r in found if r["known"] and r["fp"] == first_pid] or [r for r in found if not r["known"]])
                found = sorted(found, key=lambda r: (r["ft_hi"] is None, r["ft_hi"] or 0))
            row = found[0]
            if row["kind"] == "through":
                return (row["to_st"], first_us, first_pid, row["last"])
        return _INIT_STATE if row["kind"] == "init" else (row["to_st"], row["to_ft"], row["to_fp"], row["last"])


def _incoming_states(layout: DataFrame, bounds: dict, window_us: int, rule: SequenceRule) -> dict:
    """pid -> (visitor, state) of every partition that starts inside a visitor whose sequence is open."""
    pids = sorted(bounds)
    tails = {p: bounds[p]["last_user"] for p, q in zip(pids, pids[1:]) if bounds[q]["first_user"] == bounds[p]["last_user"]}
    if not tails:
        return {}
    singles = {q for p, q in zip(pids, pids[1:]) if p in tails and q in tails and bounds[q]["first_user"] == bounds[q]["last_user"]}
    tables = _Tables(_tail_ends(layout, tails, singles, {}, window_us, rule))
    incoming: dict = {}
    for p, q in zip(pids, pids[1:]):
        if p not in tails:
            continue
        state = incoming[p][1] if p in singles and p in incoming else _INIT_STATE
        if p in singles and not tables.has_table(p):
            # more first products than a table takes: this partition alone is folded from the state that comes in
            again = _tail_ends(layout, {p: tails[p]}, singles, {p: (tails[p], state)}, window_us, rule)
            end = _Tables(again).end(p, _INIT_STATE)
        else:
            end = tables.end(p, state)
        if end != _INIT_STATE:
            incoming[q] = (tails[p], end)
    return incoming


def eligible(clicks: DataFrame) -> DataFrame:
    """P10 as a filter: rows that carry both gender and age.

    Not the default: a row without age still refreshes, advances or resets
    a running sequence; dropping it up front changes the result.
    """
    return clicks.filter(F.col("gender").isNotNull() & F.col("age").isNotNull())


def fold_input(clicks: DataFrame, rule: SequenceRule) -> DataFrame:
    """The columns the fold needs: times as epoch micros, labels as bits."""
    return clicks.select(
        F.col("userId").cast("string").alias("userId"),
        F.unix_micros(F.col("timestamp").cast("timestamp")).alias("us"),
        F.col("event_id").cast("long").alias("event_id"),
        F.col("productId").cast("string").alias("productId"),
        F.col("category").cast("string").alias("category"),
        rule.marks().alias("marks"),
        rule.code().cast("string").alias("code"),
        F.col("original_timestamp").isNull().alias("live"),
    ).filter(F.col("userId").isNotNull() & F.col("us").isNotNull())


def stored_rows(state: DataFrame) -> DataFrame:
    """Open states (STATE_SCHEMA) as rows before their visitors' clicks."""
    return state.where(F.col("st") != INIT).select(
        "userId", F.lit(FIRST).cast("long").alias("us"), F.coalesce("first_us", F.lit(FIRST // 2)).alias("event_id"), F.col("last_pid").alias("productId"),
        F.col("st").alias("category"), F.lit(STORED).cast("long").alias("marks"), F.col("first_pid").alias("code"), F.lit(False).alias("live"))


def fold_layout(clicks: DataFrame, rule: SequenceRule, partitions: int | None = None, state: DataFrame | None = None) -> DataFrame:
    """Range-partitioned, sorted, checkpointed fold input with partition ids: the clicks of
    visitors that have one that can open a sequence (the others never leave ``init``)."""
    n = layout_partitions(clicks, partitions)
    cols = fold_input(clicks, rule)
    if state is not None:
        cols = cols.unionByName(stored_rows(state))
    # The range exchange samples its input in a separate job; persisting the
    # narrow projection first means the upstream plan (scan + enrichment
    # joins) runs once, not once for sampling and once for the shuffle.
    cols = cols.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        able = cols.where(F.col("marks").bitwiseAND(_start_bits(rule.by_state())) != 0).select("userId").distinct()
        laid = (cols.join(able, "userId", "left_semi").repartitionByRange(n, "userId", "us", "event_id")
                .sortWithinPartitions("userId", "us", "event_id"))
        laid = laid.checkpoint(eager=True)
    finally:
        cols.unpersist()
    return laid.withColumn("_pid", F.spark_partition_id())


def sequence_trace(clicks: DataFrame, within_minutes: int = DEFAULT_WINDOW_MINUTES,
                   partitions: int | None = None, require_demographics: bool = False,
                   rule: SequenceRule = OFFER_RULE) -> DataFrame:
    """Accepted transitions of every visitor (state entered per click) by any rule table.

    Input needs userId, timestamp, event_id, productId, category,
    original_timestamp (null = live row) and what the rule's conditions read. Output:
    userId, event_id, timestamp, productId, category, state, offer (the rule's code), live.
    """
    window_us = int(within_minutes) * 60 * 1_000_000
    if require_demographics:
        clicks = eligible(clicks)
    layout = fold_layout(clicks, rule, partitions)
    incoming = _incoming_states(layout, _bounds(layout), window_us, rule)
    trace = layout.mapInPandas(_partition_folder(incoming, window_us, rule.by_state(), rule.emits), TRACE_SCHEMA)
    return trace.select("userId", "event_id",
                        F.timestamp_micros("us").cast("timestamp_ntz").alias("timestamp"),
                        "productId", "category", "state", "offer", "live")


def fold_batch(clicks: DataFrame, state: DataFrame, within_minutes: int = DEFAULT_WINDOW_MINUTES, partitions: int | None = None,
               rule: SequenceRule = OFFER_RULE) -> DataFrame:
    """The clicks folded on from stored states (STATE_SCHEMA), in one pass: rows of FOLDED_SCHEMA, of kind
    ``trace`` (as ``sequence_trace``, time in epoch micros) and ``state`` (what visitors end in; of several rows of a visitor the open one holds).

    ``state`` must hold the visitors of these clicks, others come back as they are. As in the batch form a visitor's
    clicks are spread over as many partitions as they fill."""
    window_us = int(within_minutes) * 60 * 1_000_000
    layout = fold_layout(clicks, rule, partitions, state)
    bounds = _bounds(layout)
    pids = sorted(bounds)
    goes_on = {p for p, q in zip(pids, pids[1:]) if bounds[q]["first_user"] == bounds[p]["last_user"]}
    incoming = _incoming_states(layout, bounds, window_us, rule)
    return layout.mapInPandas(_state_folder(incoming, goes_on, window_us, rule.by_state(), rule.emits), FOLDED_SCHEMA)


def detect_sequence(clicks: DataFrame, rule: SequenceRule, within_minutes: int = DEFAULT_WINDOW_MINUTES,
                    partitions: int | None = None) -> DataFrame:
    """One row per completed sequence of ``rule``: userId, event_id, timestamp, code."""
    t = sequence_trace(clicks, within_minutes, partitions, rule=rule)
    return t.filter(F.col("state") == rule.emits).select("userId", "event_id", "timestamp", F.col("offer").alias("code"))


def detect_offers(clicks: DataFrame, within_minutes: int = DEFAULT_WINDOW_MINUTES,
                  partitions: int | None = None, require_demographics: bool = False) -> DataFrame:
    """X1 + X10: one row per offer: userId, event_id, timestamp, offer."""
    t = sequence_trace(clicks, within_minutes, partitions, require_demographics=require_demographics)
    return t.filter(F.col("state") == OFFER).select("userId", "event_id", "timestamp", "offer")
