from datetime import datetime, timedelta

from eventide.operators import queries as Q
from eventide.operators import rollups as R
from eventide.operators import sessions as S
from tests.conftest import events_df


def test_url_forms(spark):
    urls = [("https://x.example/a?utm_source=g&utm_medium=cpc#frag",), ("/pricing?utm_source=news",),
            ("https://x.example/no-query",), ("http://[bad",), (None,), ("/p?utm_source=&ref=1",)]
    df = spark.createDataFrame(urls, "url string")
    got = [(r.utm_source, r.utm_medium) for r in S.utm(df, "url", ["utm_source", "utm_medium"]).collect()]
    assert got == [("g", "cpc"), ("news", None), (None, None), (None, None), (None, None), (None, None)]


def test_ties_at_the_limit_edge(spark):
    t = datetime(2024, 1, 30, 12)
    rows = [(i, t, u, "view", "{}", t) for i, u in enumerate(["c", "b", "a", "a", "b", "c", "d"])]
    df = events_df(spark, rows)
    top2 = [r.user_id for r in Q.q4_top_users(df, "2024-01-31 00:00:00", "30 days", 2).collect()]
    assert top2 == ["a", "b"]  # a, b, c tie at 2 events: the key decides, every run
    geo = events_df(spark, [(i, t - timedelta(days=i % 2), "u", "view", "{}", t, c)
                            for i, c in enumerate(["DE", "US", "FR", None])], ["country_code string"])
    top = [(str(r.date), r.country_code) for r in Q.q6_daily_country(geo, "2024-01-31 00:00:00", "7 days", 3).collect()]
    assert top == [("2024-01-30", "DE"), ("2024-01-30", "FR"), ("2024-01-29", None)]


def test_session_crossing_midnight_counts_once_per_day(spark):
    t = datetime(2024, 1, 29, 23, 50)
    rows = [(1, t, "u", "view", "{}", t), (2, t + timedelta(minutes=20), "u", "view", "{}", t)]
    ev = S.sessionize(events_df(spark, rows), "30 minutes")
    assert ev.select("session_id").distinct().count() == 1
    daily = R.stats_daily_users(ev)
    top = R.rq4_top_users(daily, "2024-01-31 00:00:00", 30, 10).collect()[0]
    assert (top.total_events, top.session_days) == (2, 2)  # one session, present on two days
    totals = R.stats_totals(ev).collect()[0]
    assert totals.total_sessions == 1
