"""Funnel against a per-user scan in Python on random event sequences."""

from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings, strategies as st

from eventide.operators.funnel import funnel

T0 = datetime(2024, 1, 1)
STEPS = ["view", "click", "buy"]
events = st.lists(st.tuples(st.sampled_from(["u1", "u2", "u3"]), st.integers(0, 48),
                            st.sampled_from(STEPS + ["other"])), min_size=1, max_size=30)


def brute(rows, horizon_h):
    users = {}
    for u, h, t in rows:
        users.setdefault(u, []).append((h, t))
    reached = [0] * len(STEPS)
    for evs in users.values():
        prev = None
        for k, step in enumerate(STEPS):
            cands = [h for h, t in evs if t == step and (prev is None or (h > prev and
                     (horizon_h is None or h - prev <= horizon_h)))]
            if not cands:
                break
            prev = min(cands)
            reached[k] += 1
    return reached


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(events, st.sampled_from([None, 6, 24]))
def test_funnel_matches_scan(spark, rows, horizon_h):
    df = spark.createDataFrame([(u, T0 + timedelta(hours=h), t) for u, h, t in rows],
                               "user_id string, event_time timestamp_ntz, event_type string")
    out = funnel(df, STEPS, f"{horizon_h} hours" if horizon_h else None)
    got = [r.users for r in out.orderBy("step").collect()]
    assert got == brute(rows, horizon_h)
