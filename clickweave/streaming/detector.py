"""X1 streaming form: the sequence detector as keyed state.

``transformWithStateInPandas`` hands the rows of a micro-batch to ``handleInputRows``, a group of
visitors at a time: a call per visitor costs some milliseconds, whatever it does, so
visitors are dealt over ``VISITOR_GROUPS`` groups by a hash of their id, and a batch makes at most so many
calls. Each visitor with an open sequence has a value of their own (four scalars, the
same as the batch fold) in the group's map state, read and written only when they click. It
is kept in the RocksDB state store and checkpointed with the query, so it survives executor loss and
restarts. Rows of a batch are folded in (event time, event_id) order; across batches
the order is arrival order, as in the reference. No TTL by default: an
expired sequence must still consume the next click (see the batch module).
"""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.sequence import DEFAULT_WINDOW_MINUTES, FIRST, INIT, OFFER_RULE, STORED, SequenceRule, _fold_rows, _INIT_STATE, fold_input

KEY_SCHEMA = "userId string"
STATE_SCHEMA = "st string, first_us long, first_pid string, last_pid string"
OUTPUT_SCHEMA = ("userId string, event_id long, us long, productId string, category string, "
                 "state string, offer string, live boolean")
# Part of a checkpoint's key: another number needs a fresh checkpoint. A task holds the rows that a group has in a batch.
VISITOR_GROUPS = 4096


class SequenceProcessor(StatefulProcessor):
    """Fold of a group of visitors; emits every accepted transition (offers included)."""

    def __init__(self, within_minutes: int = DEFAULT_WINDOW_MINUTES, rule: SequenceRule = OFFER_RULE):
        self.window_us = int(within_minutes) * 60 * 1_000_000
        self.steps, self.emits = rule.by_state(), rule.emits

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.states = handle.getMapState("sequences", KEY_SCHEMA, STATE_SCHEMA)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[pd.DataFrame]:
        pdf = pd.concat(list(rows), ignore_index=True)
        if pdf.empty:
            return
        before = {}
        for user in pdf["userId"].unique():
            st = self.states.getValue((user,))
            if st is not None:
                before[user] = (st[0], None if pd.isna(st[1]) else int(st[1]), st[2], st[3])
        if before:
            # as ``stored_rows``: a visitor's state is a row before their clicks
            stored = [(user, FIRST, first_us, last_pid, st, STORED, first_pid, False) for user, (st, first_us, first_pid, last_pid) in before.items()]
            pdf = pd.concat([pd.DataFrame(stored, columns=["userId", "us", "event_id", "productId", "category", "marks", "code", "live"]), pdf], ignore_index=True)
        pdf = pdf.sort_values(["userId", "us", "event_id"], kind="stable").reset_index(drop=True)
        trace: list = []
        ends: list = []
        last, user = _fold_rows(pdf, _INIT_STATE, None, self.window_us, trace, self.steps, self.emits, ends)
        after = {u: tuple(end) for u, *end in [*ends, (user, *last)] if end[0] != INIT}
        for user in before.keys() - after.keys():
            self.states.removeKey((user,))
        for user, end in after.items():
            if before.get(user) != end:
                self.states.updateValue((user,), end)
        if trace:
            yield pd.DataFrame(trace, columns=["userId", "event_id", "us", "productId", "category",
                                               "state", "offer", "live"])

    def close(self) -> None:
        pass


def sequence_trace_stream(enriched_stream: DataFrame,
                          within_minutes: int = DEFAULT_WINDOW_MINUTES, rule: SequenceRule = OFFER_RULE) -> DataFrame:
    """Streaming trace of accepted transitions (append mode)."""
    group = F.pmod(F.xxhash64("userId"), F.lit(VISITOR_GROUPS)).cast("int").alias("_group")
    traced = (fold_input(enriched_stream, rule).select("*", group).groupBy("_group")
              .transformWithStateInPandas(SequenceProcessor(within_minutes, rule), OUTPUT_SCHEMA, "Append", "None"))
    return traced.select("userId", "event_id",
                         F.timestamp_micros("us").cast("timestamp_ntz").alias("timestamp"),
                         "productId", "category", "state", "offer", "live")


def offers_stream(enriched_stream: DataFrame, within_minutes: int = DEFAULT_WINDOW_MINUTES) -> DataFrame:
    """X1 + X10 streaming: one row per offer (userId, event_id, timestamp, offer)."""
    t = sequence_trace_stream(enriched_stream, within_minutes)
    return t.filter(F.col("state") == "offer").select("userId", "event_id", "timestamp", "offer")
