import os
import sys

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "tools"))

from conftest import SF_SMALL  # noqa: E402


def test_entry_runs(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["offer", "offers", "visitors"]
    assert sum(r.offers for r in rows) >= 1


def test_every_query_has_an_oracle(spark):
    import __spark_entry__ as E
    from clickweave.plans.catalog import QUERIES
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_all_queries_match_oracle_small(spark):
    from oracle_check import check
    from clickweave.plans.catalog import QUERIES
    res = check(spark, SF_SMALL, list(QUERIES), verbose=False)
    bad = {k: v for k, v in res.items() if v[0] not in ("match", "rows-only")}
    assert not bad, bad
