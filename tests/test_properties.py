"""Property tests (hypothesis): merging partial bucket counts from any split of
the clicks equals counting them whole (G2 = G1), and the dense axis always
has its fixed length (J7)."""
import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from clickweave.operators import metrics as M

T0 = dt.datetime(2024, 1, 1)
clicks_st = st.lists(st.tuples(st.integers(0, 3), st.integers(0, 600)), min_size=1, max_size=40)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=clicks_st, cut=st.integers(0, 600))
def test_merge_of_any_split_equals_whole(spark, rows, cut):
    data = [(i, T0 + dt.timedelta(minutes=m), f"u{u}") for i, (u, m) in enumerate(rows)]
    df = spark.createDataFrame(data, "event_id long, timestamp timestamp_ntz, userId string")
    split = F.lit(T0 + dt.timedelta(minutes=cut)).cast("timestamp_ntz")
    merged = M.merge_partials(M.user_bucket_counts(df.filter(F.col("timestamp") < split)),
                              M.user_bucket_counts(df.filter(F.col("timestamp") >= split)))
    assert sorted(map(tuple, merged.collect())) == sorted(map(tuple, M.user_bucket_counts(df).collect()))


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(minute=st.integers(0, 24 * 60 - 1), second=st.integers(0, 59))
def test_dense_axes_have_fixed_length(spark, minute, second):
    as_of = F.lit(T0 + dt.timedelta(minutes=minute, seconds=second)).cast("timestamp_ntz")
    empty = spark.createDataFrame([], "event_id long, timestamp timestamp_ntz, userId string")
    assert M.visits_dense_15m(empty, as_of).count() == 15
    assert M.sessions_dense_8h(M.user_bucket_counts(empty), as_of).count() == 16
