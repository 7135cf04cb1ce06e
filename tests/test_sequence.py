import datetime as dt
import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from clickweave.operators import sequence as S

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
SCHEMA = ("userId string, event_id long, timestamp timestamp_ntz, productId string, category string, "
          "gender string, age int, original_timestamp long")


def clicks(spark, rows):
    """rows: (user, minute offset, product, category, gender, age)."""
    data = [(u, i, T0 + dt.timedelta(minutes=m), p, c, g, a, 1) for i, (u, m, p, c, g, a) in enumerate(rows)]
    return spark.createDataFrame(data, SCHEMA)


def offers(spark, rows, within=30, partitions=4):
    return sorted((r.userId, r.event_id, r.offer) for r in
                  S.detect_offers(clicks(spark, rows), within, partitions).collect())


def test_basic_offer_and_same_product_return(spark):
    # A, B, shoes, B fires (B != first A); A, shoes, A goes back to clothes
    fire = [("u", 0, "A", "clothing", "F", 30), ("u", 1, "B", "clothing", "F", 30),
            ("u", 2, "S", "shoes", "F", 30), ("u", 3, "B", "clothing", "F", 30)]
    assert offers(spark, fire) == [("u", 3, "offer2")]
    back = [("v", 0, "A", "clothing", "M", 40), ("v", 1, "S", "shoes", "M", 40), ("v", 2, "A", "clothing", "M", 40)]
    assert offers(spark, back) == []


def test_refresh_skipped_inside_and_after_limit(spark):
    rows = [("u", 0, "A", "clothing", "M", 40), ("u", 1, "A", "clothing", "M", 40),  # refresh
            ("u", 2, "S", "shoes", "M", 40), ("u", 100, "S", "shoes", "M", 40),      # refresh after limit
            ("u", 3, "C", "clothing", "M", 40)]
    # rows are ordered by time: A(0) A(1) S(2) C(3) S(100) -> offer at C
    assert offers(spark, rows) == [("u", 4, "offer1")]


def test_exact_window_resets_and_row_is_consumed(spark):
    rows = [("u", 0, "A", "clothing", "F", 30), ("u", 10, "S", "shoes", "F", 30),
            ("u", 30, "B", "clothing", "F", 30),   # exactly 30 min after the first: reset, consumed
            ("u", 31, "S2", "shoes", "F", 30), ("u", 32, "C", "clothing", "F", 30)]
    assert offers(spark, rows) == []


def test_anchor_does_not_slide(spark):
    rows = [("u", 0, "A", "clothing", "F", 30), ("u", 20, "B", "clothing", "F", 30),
            ("u", 29, "S", "shoes", "F", 30), ("u", 31, "C", "clothing", "F", 30)]
    assert offers(spark, rows) == []  # 31 - 0 >= 30


def test_demographics_only_on_first_step_and_null_age(spark):
    rows = [("u", 0, "A", "clothing", "F", 36), ("u", 1, "B", "clothing", "F", None),
            ("w", 0, "A", "clothing", "F", 25), ("w", 1, "S", "shoes", "U", None), ("w", 2, "B", "clothing", "U", None)]
    assert offers(spark, rows) == [("w", 4, "offer2")]


def test_shoes_to_other_resets(spark):
    rows = [("u", 0, "A", "clothing", "M", 35), ("u", 1, "S", "shoes", "M", 35), ("u", 2, "S2", "shoes", "M", 35),
            ("u", 3, "B", "clothing", "M", 35)]
    assert offers(spark, rows) == []


def brute(pdf, within):
    pdf = pdf.sort_values(["userId", "us", "event_id"]).reset_index(drop=True)
    target = [(g == "M" and 35 <= a <= 45) or (g == "F" and 25 <= a <= 35) for g, a in zip(pdf["gender"], pdf["age"].fillna(-1))]
    pdf["marks"] = [(c == "clothing" and t) + 2 * (c == "clothing") + 4 * (c == "shoes") for c, t in zip(pdf["category"], target)]
    pdf["code"] = ["offer1" if g == "M" else "offer2" for g in pdf["gender"]]
    trace = []
    S._fold_rows(pdf, S._INIT_STATE, None, within * 60_000_000, trace, S.OFFER_RULE.by_state(), S.OFFER)
    return sorted((t[0], t[1], t[6]) for t in trace if t[5] == S.OFFER)


def random_clicks(n_users, n_rows, hot_share, seed):
    rnd = random.Random(seed)
    rows = []
    for i in range(n_rows):
        u = "hot" if rnd.random() < hot_share else f"u{rnd.randrange(n_users)}"
        cat = rnd.choice(["clothing", "clothing", "shoes", "books"])
        rows.append((u, i, T0 + dt.timedelta(seconds=7 * i + rnd.randrange(5)), f"p{rnd.randrange(6)}", cat,
                     rnd.choice(["M", "F", "U"]), rnd.choice([None, 25, 30, 40, 50]), None))
    return rows


@pytest.mark.parametrize("partitions", [1, 7, 40])
def test_partition_count_independent_with_hot_visitor(spark, partitions):
    rows = random_clicks(20, 6000, 0.4, 7)
    df = spark.createDataFrame(rows, SCHEMA)
    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    pdf["us"] = (pdf["timestamp"] - pd.Timestamp(0)) // pd.Timedelta(microseconds=1)
    pdf["live"] = True
    expect = brute(pdf, 30)
    got = sorted((r.userId, r.event_id, r.offer) for r in S.detect_offers(df, 30, partitions).collect())
    assert got == expect and len(expect) > 0


def test_sf_offers_stable_across_partitions(spark):
    from tests.conftest import SF_MID
    from clickweave.plans.catalog import _enriched
    e = _enriched(spark, SF_MID)
    a = sorted(tuple(r) for r in S.detect_offers(e, 1440, 3).collect())
    b = sorted(tuple(r) for r in S.detect_offers(e, 1440, 64).collect())
    assert a == b and len(a) == 26


def test_sequence_spanning_every_partition(spark):
    """One visitor's sequence stays open across all partitions (a long run of
    refreshes of its first product), so every partition's speculative start
    is wrong and the chain must be verified partition by partition."""
    rows = [("h", 0, T0, "A", "clothing", "F", 30, 1)]
    rows += [("h", i, T0 + dt.timedelta(milliseconds=100 * i), "A", "clothing", "F", 30, 1) for i in range(1, 3000)]
    rows += [("h", 3000, T0 + dt.timedelta(minutes=6), "S", "shoes", "F", 30, 1),
             ("h", 3001, T0 + dt.timedelta(minutes=7), "B", "clothing", "F", 30, 1),
             ("x", 3002, T0, "A", "clothing", "M", 40, 1)]
    df = spark.createDataFrame(rows, SCHEMA)
    got = sorted((r.userId, r.event_id, r.offer) for r in S.detect_offers(df, 30, 25).collect())
    assert got == [("h", 3001, "offer2")]
    # the init-anchored speculation would have restarted the sequence mid-run;
    # with the anchor at T0, a 31-minute window still holds, a 5-minute one does not
    assert sorted((r.userId, r.event_id) for r in S.detect_offers(df, 5, 25).collect()) == []


def test_few_passes_for_a_hot_visitor(spark, monkeypatch):
    """A visitor over many partitions with an open sequence: the passes do not grow with the partitions."""
    rows = []
    for i in range(4000):
        cat, pid = [("clothing", "A"), ("shoes", "S"), ("books", "X"), ("books", "Y"), ("clothing", "A")][i % 5]
        rows.append(("hot", i, T0 + dt.timedelta(seconds=i), pid, cat, "M", 40, None))
    df = spark.createDataFrame(rows, SCHEMA)
    calls = []
    real = S._tail_ends
    monkeypatch.setattr(S, "_tail_ends", lambda *a: (calls.append(1), real(*a))[1])
    results = []
    for n in (4, 8, 16):
        calls.clear()
        results.append(sorted(tuple(r) for r in S.sequence_trace(df, 30, n).collect()))
        assert len(calls) == 1
    assert results[0] == results[1] == results[2] and results[0]


@pytest.mark.parametrize("table_rows,forks", [(4096, 64), (2, 64), (4096, 0)])
def test_few_passes_for_labelled_clicks_only(spark, monkeypatch, table_rows, forks):
    """One visitor fills every partition and no click resets all sequences: still one pass of
    summaries, whether tables are collected, looked up, or (too many products) cannot be made."""
    rnd = random.Random(11)
    rows, cats = [], ["clothing"] * 7 + ["shoes"]
    for i in range(3000):
        rows.append(("hot", i, T0 + dt.timedelta(seconds=11 * i), f"p{rnd.randrange(5)}" if i % 900 > 300 else f"q{i}", rnd.choice(cats), "M", 40, None))
    df = spark.createDataFrame(rows, SCHEMA)
    pdf = pd.DataFrame(rows, columns=[c.split()[0] for c in SCHEMA.split(", ")])
    pdf["us"] = (pdf["timestamp"] - pd.Timestamp(0)) // pd.Timedelta(microseconds=1)
    pdf["live"] = True
    expect = brute(pdf, 30)
    calls = []
    real = S._tail_ends
    monkeypatch.setattr(S, "_tail_ends", lambda *a: (calls.append(1), real(*a))[1])
    monkeypatch.setattr(S, "TABLE_ROWS", table_rows)
    if not forks:
        made = S._run_table
        monkeypatch.setattr(S, "_run_table", lambda *a: made(*a) if len(a[0]) < 250 else None)
    for n in (4, 8, 16):
        calls.clear()
        got = sorted((r.userId, r.event_id, r.offer) for r in S.detect_offers(df, 30, n).collect())
        assert got == expect and expect
        assert len(calls) == 1 or not forks


RULE_2 = S.SequenceRule(
    {"a": None, "b": None, "c": None},
    (S.Step("init", "a", "x"), S.Step("x", "b", "y", "other"), S.Step("x", "b", "x", "first"), S.Step("x", "a", "x"),
     S.Step("y", "c", "x", "other"), S.Step("y", "c", "offer", "first"), S.Step("y", "a", "y", "first"), S.Step("y", "b", "x", "other")), "offer", None)


@pytest.mark.parametrize("rule", [S.OFFER_RULE, RULE_2])
def test_decision_tables_equal_the_fold(rule):
    rnd, steps = random.Random(3), rule.by_state()
    names = [c.split()[0] for c in S.TABLE_SCHEMA.split(", ")]
    products = ["p1", "p2", "p3", None, "zz"]
    for t in range(600):
        n = rnd.randrange(1, 25)
        us = sorted(rnd.randrange(0, 40) for _ in range(n))
        pids = [rnd.choice(products[:4]) for _ in range(n)]
        marks = [rnd.choice([0, 3, 2, 4, 1, 7] if t % 2 else [3, 2, 4, 1]) for _ in range(n)]
        tables = S._Tables.__new__(S._Tables)
        tables.large, tables.rows = set(), {0: {}}
        for r in S._run_table(us, pids, marks, 10, steps, "offer"):
            row = dict(zip(names, (0, *r, pids[0], pids[-1]), strict=True))
            tables.rows[0].setdefault((row["variant"], row["st"]), []).append(row)
        pdf = pd.DataFrame({"userId": ["u"] * n, "us": us, "productId": pd.Series(pids, dtype=object), "marks": marks})
        open_states = [(st, us[0] - rnd.randrange(0, 15), rnd.choice(products), rnd.choice(products)) for st in steps if st != "init" for _ in range(4)]
        for state in [S._INIT_STATE, *open_states]:
            assert tuple(tables.end(0, state)) == S._fold_rows(pdf, state, "u", 10, None, steps, "offer")[0]


def test_another_rule_table(spark):
    rule = S.SequenceRule(labels={"a": lambda: F.col("category") == "a", "b": lambda: F.col("category") == "b"},
                          steps=(S.Step("init", "a", "one"), S.Step("one", "b", "done", "other"), S.Step("one", "a", "one")),
                          emits="done", code=lambda: F.lit("x"))
    rows = [("u", 0, T0, "P", "a", None, None, None), ("u", 1, T0 + dt.timedelta(minutes=1), "P2", "b", None, None, None),
            ("v", 2, T0, "P", "a", None, None, None), ("v", 3, T0 + dt.timedelta(minutes=1), "Q", "c", None, None, None),
            ("v", 4, T0 + dt.timedelta(minutes=2), "R", "b", None, None, None)]
    got = S.detect_sequence(spark.createDataFrame(rows, SCHEMA), rule, 30).collect()
    assert [(r.userId, r.event_id, r.code) for r in got] == [("u", 1, "x")]
