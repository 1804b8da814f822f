from datetime import datetime, timedelta

from pyspark.sql import Window, functions as F

from eventide.operators import sessions as S
from tests.conftest import events_df

T0 = datetime(2024, 1, 1, 23, 0, 0)


def _rows(spec):
    """spec: list of (user, offset seconds[, id])"""
    out = []
    for i, s in enumerate(spec):
        user, off = s[0], s[1]
        rid = s[2] if len(s) > 2 else i
        out.append((rid, T0 + timedelta(seconds=off), user, "view", "{}", T0))
    return out


def _naive(df, gap_s):
    w = Window.partitionBy("user_id").orderBy("event_time", "id")
    prev = F.lag("event_time").over(w)
    flag = F.when(prev.isNull() | (F.timestamp_diff("MICROSECOND", prev, F.col("event_time")) > gap_s * 1_000_000), 1).otherwise(0)
    x = df.withColumn("f", flag)
    return x.withColumn("n", F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0)))


def test_gap_equal_merges_and_one_microsecond_more_splits(spark):
    gap = 1800
    rows = _rows([("u", 0), ("u", gap)])
    rows.append((9, T0 + timedelta(seconds=2 * gap, microseconds=1), "u", "view", "{}", T0))
    out = S.sessionize(events_df(spark, rows), "30 minutes", number_col="n").orderBy("id").collect()
    assert [r.n for r in out] == [1, 1, 2]
    assert out[2].session_id == "u-2"


def test_equal_timestamps_tie_by_id(spark):
    rows = _rows([("u", 0, 2), ("u", 0, 1), ("u", 5000, 3)])
    out = S.sessionize(events_df(spark, rows), "1 hour", number_col="n").orderBy("id").collect()
    assert [r.n for r in out] == [1, 1, 2]


def test_sessions_cross_midnight_and_hours(spark):
    # 23:00 .. 01:10 in 20-minute steps: one session across the day border
    rows = _rows([("u", 1200 * k) for k in range(7)])
    for bucket in ("minute", "hour", "day"):
        out = S.sessionize(events_df(spark, rows), "30 minutes", bucket=bucket, number_col="n").collect()
        assert {r.n for r in out} == {1}, bucket


def test_matches_plain_window_for_every_bucket(spark):
    import random
    rnd = random.Random(7)
    spec = []
    for u in ("a", "b", "c"):
        t = 0
        for _ in range(60):
            t += rnd.choice([1, 30, 300, 1799, 1800, 1801, 4000, 20000, 90000])
            spec.append((u, t))
    df = events_df(spark, _rows(spec))
    want = {r.id: r.n for r in _naive(df, 1800).collect()}
    for bucket in ("minute", "hour", "day"):
        got = {r.id: r.n for r in S.sessionize(df, "30 minutes", bucket=bucket, number_col="n").collect()}
        assert got == want, bucket


def test_session_dimension_and_users(spark):
    rows = [
        (1, T0, "u1", "page_view", "{}", T0, "/a?utm_source=google&utm_campaign=x", "desktop", "US"),
        (2, T0 + timedelta(minutes=5), "u1", "click", "{}", T0, "/b", "mobile", "GB"),
        (3, T0 + timedelta(minutes=9), "u1", "form_submit", "{}", T0, "not a url ::", "desktop", None),
        (4, T0 + timedelta(hours=5), "u1", "page_view", "{}", T0, None, "desktop", "US"),
    ]
    df = events_df(spark, rows, ["page_url string", "device_type string", "country_code string"])
    df = S.sessionize(df, "30 minutes")
    s = {r.id: r for r in S.sessions(df).collect()}
    a = s["u1-1"]
    assert (a.page_views, a.clicks, a.form_submits, a.events_count) == (1, 1, 1, 3)
    assert a.landing_page.startswith("/a") and a.exit_page == "not a url ::"
    assert a.utm_source == "google" and a.utm_campaign == "x" and a.utm_medium is None
    assert a.duration_seconds == 540 and a.device_type == "desktop" and a.country_code == "US"
    u = S.users(df).collect()[0]
    assert (u.total_events, u.total_sessions, u.country_code) == (4, 2, "US")


def test_upsert_both_directions(spark):
    old = spark.createDataFrame([("a", T0, T0, 5, 1, "US", T0, T0), ("b", T0, T0, 2, 1, "DE", T0, T0)],
                                "id string, first_seen timestamp_ntz, last_seen timestamp_ntz, total_events long, "
                                "total_sessions long, country_code string, created_at timestamp_ntz, updated_at timestamp_ntz")
    later = T0 + timedelta(days=1)
    new = spark.createDataFrame([("b", later, later, 3, 1, "FR"), ("c", later, later, 1, 1, None)],
                                "id string, first_seen timestamp_ntz, last_seen timestamp_ntz, total_events long, "
                                "total_sessions long, country_code string")
    out = {r.id: r for r in S.upsert_users(old, new, "2024-01-05 00:00:00").collect()}
    assert out["a"].total_events == 5 and out["a"].updated_at == T0            # stored only: untouched
    assert out["b"].total_events == 5 and out["b"].country_code == "FR"        # merged
    assert out["b"].first_seen == T0 and out["b"].last_seen == later
    assert out["c"].created_at == datetime(2024, 1, 5)                         # new only: inserted
    rep = {r.id: r for r in S.upsert_users(old, new, "2024-01-05 00:00:00", mode="replace").collect()}
    assert rep["b"].total_events == 3


def test_incremental_sessionize_equals_full(spark):
    from tests.conftest import SF_CHECK
    from eventide.sources import driver as D
    ev = D.events(spark, SF_CHECK)
    full = {r.id: r.session_id for r in S.sessionize(ev, "4 hours").collect()}
    cuts = ["2024-01-10 00:00:00", "2024-01-20 13:00:00"]
    state, got = None, {}
    bounds = [None] + cuts + [None]
    for lo, hi in zip(bounds[:-1], bounds[1:]):
        part = ev
        if lo:
            part = part.where(F.col("event_time") >= F.lit(lo).cast("timestamp_ntz"))
        if hi:
            part = part.where(F.col("event_time") < F.lit(hi).cast("timestamp_ntz"))
        lab = S.sessionize(part, "4 hours", number_col="n", state=state)
        got.update({r.id: r.session_id for r in lab.collect()})
        state = S.session_state(lab, "n", state)
    assert got == full
