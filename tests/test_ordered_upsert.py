import datetime as dt
import random

import numpy as np

from clickweave.operators import ordered as O
from clickweave.operators.upsert import upsert_fields

T0 = dt.datetime(2024, 1, 1)


def test_drop_refreshes_many_partitions(spark):
    rnd = random.Random(3)
    rows = [(i, T0 + dt.timedelta(seconds=i), "hot" if rnd.random() < 0.5 else f"u{rnd.randrange(5)}",
             rnd.choice(["a", "b", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "event_id long, timestamp timestamp_ntz, userId string, productId string")
    got = sorted(r.event_id for r in O.drop_refreshes(df, partitions=23).collect())
    last, expect = {}, []
    for e, _, u, p in sorted(rows, key=lambda r: (r[2], r[1], r[0])):
        if u not in last or last[u] != p:
            expect.append(e)
        last[u] = p
    assert got == sorted(expect)


def test_replay_schedule_many_partitions(spark):
    rnd = random.Random(5)
    t = np.cumsum([rnd.choice([0, 1, 3, 12, -2]) for _ in range(2500)]).astype(float) + 1e9
    rows = [(i, float(v)) for i, v in enumerate(t)]
    df = spark.createDataFrame(rows, "event_id long, original_timestamp double")
    got = {r.event_id: (r.delay, r.at) for r in O.replay_schedule(df, partitions=17).collect()}
    d = np.clip(np.diff(t), 0, 10)
    at = np.concatenate([[0.0], np.cumsum(d)])
    for i in range(len(t)):
        exp_delay = d[i] if i < len(d) else None
        assert got[i] == (exp_delay, at[i])


def test_replay_schedule_with_null_times(spark):
    times = [1.0, None, 4.0, 6.0, None, None, 7.0, 9.0, None]
    df = spark.createDataFrame(list(enumerate(times)), "event_id long, original_timestamp double")
    want, at = {}, 0.0
    for i, t in enumerate(times):
        nxt = times[i + 1] if i + 1 < len(times) else None
        delay = None if t is None or nxt is None else min(max(nxt - t, 0.0), 10.0)
        want[i] = (delay, at)
        at += delay or 0.0
    for n in (1, 2, 4, 9):
        assert {r.event_id: (r.delay, r.at) for r in O.replay_schedule(df, partitions=n).collect()} == want


def test_upsert_null_keeps_old_and_last_wins(spark):
    stored = spark.createDataFrame([("1", "1990-01-01", "M"), ("2", None, "F")], "userId string, b string, g string")
    upd = spark.createDataFrame([("1", None, "F", 1), ("1", "1991-01-01", None, 2), ("1", "1992-01-01", None, 3),
                                 ("3", None, "U", 1)], "userId string, b string, g string, seq int")
    got = {r.userId: (r.b, r.g) for r in upsert_fields(stored, upd, "userId", ["b", "g"]).collect()}
    assert got == {"1": ("1992-01-01", "F"), "2": (None, "F"), "3": (None, "U")}
