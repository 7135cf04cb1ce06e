"""Randomised check: the parallel fold equals the recursive-CTE formulation."""
import datetime as dt
import random

import duckdb
import pandas as pd
import pytest

from clickweave.operators import sequence as S
from clickweave.plans.oracle import _sequence_ctes

T0 = dt.datetime(2024, 1, 1, 8, 0, 0)
COLS = ["userId", "event_id", "timestamp", "productId", "category", "gender", "age", "original_timestamp"]
SCHEMA = ("userId string, event_id long, timestamp timestamp_ntz, productId string, category string, "
          "gender string, age int, original_timestamp long")


def random_rows(seed, n_users=4, n_rows=160):
    rnd = random.Random(seed)
    rows, t = [], T0
    for i in range(n_rows):
        t = t + dt.timedelta(minutes=rnd.choice([0, 1, 3, 10, 29, 30, 31, 45]))
        u = rnd.choice(["a", "b", "c", "d"][:n_users] + ["a"] * 3)  # "a" is hot
        rows.append((u, i, t, rnd.choice(["p1", "p2", "p3", "p4"]), rnd.choice(["clothing", "shoes", "books", None]),
                     rnd.choice(["M", "F", "U"]), rnd.choice([None, 24, 25, 35, 36, 45, 46]),
                     rnd.choice([None, 1])))
    return rows


@pytest.mark.parametrize("seed,window,parts", [(1, 30, 3), (2, 60, 11), (3, 30, 29), (4, 1440, 5)])
def test_fold_equals_recursive_cte(spark, seed, window, parts):
    rows = random_rows(seed)
    got = sorted((r.userId, r.event_id, r.offer) for r in
                 S.detect_offers(spark.createDataFrame(rows, SCHEMA), window, parts).collect())
    con = duckdb.connect()
    con.register("enriched", pd.DataFrame(rows, columns=COLS))
    sql = ("WITH RECURSIVE " + _sequence_ctes(window) +
           " SELECT userId, event_id, offer FROM fold WHERE entered = 'offer'")
    expect = sorted(tuple(r) for r in con.execute(sql).fetchall())
    assert got == expect
