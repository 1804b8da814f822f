from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eventide.operators import queries as Q
from eventide.operators import rollups as R
from eventide.sources import driver as D
from tests.conftest import SF_SMALL, events_df

T0 = datetime(2024, 1, 30, 22, 15, 0)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _fixture(spark):
    rows = [
        # id, time, user, type, props, created_at, session, country
        (1, T0, "a", "page_view", "{}", T0 + timedelta(seconds=2), "a-1", "US"),
        (2, T0 + timedelta(minutes=50), "a", "click", "{}", T0 + timedelta(minutes=50, seconds=1), "a-1", "US"),
        (3, T0 + timedelta(hours=2), "a", "click", "{}", T0 + timedelta(hours=2) - timedelta(seconds=3), "a-2", "DE"),
        (4, T0, "b", "page_view", "{}", T0, "b-1", None),
        (5, T0 + timedelta(minutes=1), "b", "page_view", "{}", T0 + timedelta(minutes=1, seconds=5), "b-1", None),
    ]
    return events_df(spark, rows, ["session_id string", "country_code string"])


def test_strategies_agree(spark):
    df = _fixture(spark)
    for preset in (R.stats_hourly, R.stats_geo_events, R.mv_hourly_stats):
        a = _rows(preset(df, strategy="expand"))
        b = _rows(preset(df, strategy="nested"))
        assert a == b, preset.__name__


def test_rollups_from_cube_equal_raw(spark):
    df = _fixture(spark)
    cube = R.base_cube(df)
    for name in ("stats_hourly", "stats_daily_users", "stats_geo_events", "mv_hourly_stats"):
        fn = R.PRESETS[name]
        assert _rows(fn(df)) == _rows(fn(cube)), name
    a = R.stats_totals(df).collect()[0]
    b = R.stats_totals(cube).collect()[0]
    assert a == b and a.total_events == 5 and a.total_sessions == 3


def test_null_country_group_and_negative_delay(spark):
    out = {(r.hour, r.event_type, r.country_code): r for r in R.stats_hourly(_fixture(spark)).collect()}
    null_row = out[(datetime(2024, 1, 30, 22), "page_view", None)]
    assert null_row.event_count == 2 and null_row.unique_users == 1
    neg = out[(datetime(2024, 1, 31, 0), "click", "DE")]
    assert neg.avg_processing_delay == -3.0


def test_delay_rounding_is_decimal_half_up(spark):
    rows = [(1, T0, "a", "x", "{}", T0 + timedelta(seconds=1.01), "s", "US"),
            (2, T0, "a", "x", "{}", T0 + timedelta(seconds=1.02), "s", "US")]
    df = events_df(spark, rows, ["session_id string", "country_code string"])
    r = R.stats_geo_events(df, ["x"]).collect()[0]
    assert r.avg_delay_seconds == 1.02  # 1.015 rounds up, as NUMERIC does


def test_sum_of_hourly_counts_equals_total(spark):
    ev = D.events(spark, SF_SMALL, country=True, sessions=True)
    total = Q.q1_total(ev).collect()[0][0]
    s = R.stats_hourly(ev).agg(F.sum("event_count")).collect()[0][0]
    assert s == total


def test_rollup_q3_equals_raw_q3_when_hour_aligned(spark):
    ev = D.events(spark, SF_SMALL, country=True, sessions=True)
    raw = {r.event_type: r["count"] for r in Q.q3_by_type(ev, D.AS_OF, "24 hours").collect()}
    rolled = {r.event_type: r["count"] for r in R.rq3_by_type(R.stats_hourly(ev), D.AS_OF, 24).collect()}
    assert raw == rolled


def test_sketch_merge_close_to_exact(spark):
    ev = D.events(spark, "/root/testdata/sf0.01")
    hourly = R.mv_hourly_stats(ev, sketch="users_sketch")
    est = R.merge_uniques(hourly, []).collect()[0][0]
    exact = ev.select("user_id").distinct().count()
    assert abs(est - exact) <= 0.05 * exact


def test_densify_fills_zero(spark):
    df = _fixture(spark)
    counts = df.groupBy(F.to_date("event_time").alias("date"), "event_type").agg(F.count(F.lit(1)).alias("count"))
    out = R.densify(counts, df, "2024-01-29", "2024-01-31").collect()
    assert len(out) == 3 * 2
    assert sum(r["count"] for r in out) == 5
    assert any(r["count"] == 0 for r in out)
