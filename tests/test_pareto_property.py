"""Pareto share (histogram method) against sorting every key in Python."""

import math

from hypothesis import HealthCheck, given, settings, strategies as st

from eventide.operators.profile import pareto


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.integers(1, 6), min_size=1, max_size=25), st.sampled_from([1.0, 10.0, 20.0, 33.3, 50.0, 100.0]))
def test_pareto_matches_sort(spark, counts, pct):
    rows = [(f"k{i}",) for i, n in enumerate(counts) for _ in range(n)]
    r = pareto(spark.createDataFrame(rows, "user_id string"), "user_id", pct).collect()[0]
    k = math.ceil(len(counts) * pct / 100)
    top = sum(sorted(counts, reverse=True)[:k])
    assert (r.top_keys, r.total_keys, r.top_rows, r.total_rows) == (k, len(counts), top, sum(counts))
