"""Late events, null users, versioned parts: stored state against one pass over everything."""

import os
import random
from datetime import datetime, timedelta

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from eventide.operators import parts, refresh as M, sessions as S
from eventide.session import scratch_dir
from tests.conftest import events_df

T0 = datetime(2024, 1, 10, 8, 0, 0)


def event(i, user, minutes, kind="view"):
    return (i, T0 + timedelta(minutes=minutes), user, kind, "{}", T0)


def labels(df):
    return {r.id: (r.session_id, r.number) for r in df.collect()}


def loads_in_any_order(spark, loads, gap):
    stored = S.sessionize(events_df(spark, loads[0]), gap, number_col="number")
    intervals = S.session_intervals(stored, "number")
    for rows in loads[1:]:
        new, intervals, moved = S.repair_sessions(intervals, events_df(spark, rows), gap)
        stored = S.relabel(stored, moved).unionByName(new.select(*stored.columns))
    return stored, intervals


def test_late_event_before_between_and_inside(spark):
    first = [event(1, "u", 0), event(2, "u", 100), event(3, "u", 200), event(4, "v", 0), event(5, "v", 300)]
    late = [event(6, "u", -60), event(7, "u", 50), event(8, "u", 120), event(9, "u", 130)]
    stored, intervals = loads_in_any_order(spark, [first, late], "70 minutes")
    want = labels(S.sessionize(events_df(spark, first + late), "70 minutes", number_col="number"))
    assert labels(stored) == want
    assert want[6][1] == want[1][1] == want[7][1] == want[2][1] == want[3][1] == 1     # the late ones join all three sessions
    assert {r.number for r in intervals.where("user_id = 'v'").collect()} == {1, 2}


@pytest.mark.parametrize("seed", range(3))
def test_loads_in_any_order_equal_one_pass(spark, seed):
    rng = random.Random(seed)
    rows = [event(i, rng.choice(["a", "b", "c", None]), rng.randrange(0, 4000)) for i in range(240)]
    loads = [[] for _ in range(3)]
    for r in rows:
        rng.choice(loads).append(r)
    stored, intervals = loads_in_any_order(spark, loads, "30 minutes")
    whole = S.sessionize(events_df(spark, rows), "30 minutes", number_col="number")
    assert labels(stored) == labels(whole)
    want = S.session_intervals(whole, "number")
    assert sorted(map(tuple, intervals.select(*want.columns).collect())) == sorted(map(tuple, want.collect()))


def test_only_users_of_the_load_are_renumbered(spark):
    rows = [event(i, f"u{i % 9}", 100 * i) for i in range(90)]
    intervals = S.session_intervals(S.sessionize(events_df(spark, rows), "30 minutes", number_col="number"), "number")
    _, _, moved = S.repair_sessions(intervals, events_df(spark, [event(900, "u3", -500)]), "30 minutes")
    assert {r.user_id for r in moved.collect()} == {"u3"} and moved.count() == 10


def test_continuing_refuses_earlier_events(spark):
    first = S.sessionize(events_df(spark, [event(1, "u", 0), event(2, "u", 700)]), "30 minutes", number_col="n")
    state = S.session_state(first, "n")
    same = S.sessionize(events_df(spark, [event(3, "u", 700)]), "30 minutes", number_col="n", state=state)
    assert [r.n for r in same.collect()] == [2]
    for minutes in (200, 690):
        with pytest.raises(PySparkException, match="repair_sessions"):
            S.sessionize(events_df(spark, [event(3, "u", minutes)]), "30 minutes", number_col="n", state=state).collect()


def test_events_without_user_make_no_session(spark):
    rows = [event(1, None, 0), event(2, None, 2000), event(3, "u", 0)]
    df = S.sessionize(events_df(spark, rows, ()), "30 minutes")
    assert {r.id: r.session_id for r in df.collect()} == {1: None, 2: None, 3: "u-1"}
    df = df.withColumn("page_url", F.lit("/a"))
    assert [r.id for r in S.sessions(df).collect()] == ["u-1"]
    assert [r.session_id for r in S.landing_exit(df).collect()] == ["u-1"]
    assert sum(r.sessions for r in S.campaign_report(S.sessions(df)).collect()) == 1


def test_sessionize_reads_the_events_twice_and_no_more(spark):
    """Once for the labels, once (three columns) for the state of the buckets; null users need no branch of their own."""
    from eventide.plans.inspect import plan_text
    from eventide.sources import driver as D
    from tests.conftest import SF_SMALL
    plan = plan_text(S.sessionize(D.events(spark, SF_SMALL), "4 hours"), "simple")
    assert plan.count("FileScan parquet") == 2 and "Union" not in plan


# ---- versioned parts ---------------------------------------------------------

def hourly(rows):
    return [(i, T0 + timedelta(hours=h), u, t, "{}", T0) for i, (h, u, t) in enumerate(rows)]


def folders(spark, store, name, version):
    return {r["part"]: r["path"] for r in parts.version_rows(spark, store, name, version)[1:]}


def test_refresh_writes_only_the_changed_day(spark):
    store = scratch_dir(spark, "t-days")
    rows = hourly([(24 * d + h, f"u{h}", "view") for d in range(31) for h in (0, 3)])
    M.write_days(spark, store, "mv_hourly_stats", events_df(spark, rows), "2024-02-20 00:00:00")
    old = sorted(map(tuple, parts.read(spark, store, "mv_hourly_stats").collect()))
    fixed = [r if r[0] != 20 else (*r[:3], "click", *r[4:]) for r in rows]
    days = [str((T0 + timedelta(days=d)).date()) for d in (9, 10, 11)]
    report = {r.day: r for r in M.refresh_changed(spark, store, "mv_hourly_stats", events_df(spark, fixed), days, "2024-02-20 00:00:00").collect()}
    day = str((T0 + timedelta(days=10)).date())
    assert {d: (r.new, r.changed, r.gone, r.same, r.written) for d, r in report.items()} == {
        days[0]: (0, 0, 0, 2, False), day: (1, 0, 1, 1, True), days[2]: (0, 0, 0, 2, False)}
    before, after = folders(spark, store, "mv_hourly_stats", 1), folders(spark, store, "mv_hourly_stats", 2)
    assert set(before) == set(after) and [d for d in before if before[d] != after[d]] == [day]
    written = {os.path.dirname(p).removeprefix("file:") for p in after.values()} - {os.path.dirname(p).removeprefix("file:") for p in before.values()}
    assert [sorted(x for x in os.listdir(w) if x.startswith("__part")) for w in written] == [[f"__part={day}"]]
    assert sorted(map(tuple, parts.read(spark, store, "mv_hourly_stats", version=1).collect())) == old      # an old reader
    got = sorted(map(tuple, parts.read(spark, store, "mv_hourly_stats").collect()))
    from eventide.operators import rollups as R
    assert got == sorted(map(tuple, R.mv_hourly_stats(events_df(spark, fixed)).collect()))


def test_refresh_without_change_writes_nothing_and_gone_days_leave(spark):
    store = scratch_dir(spark, "t-days")
    rows = hourly([(24 * d, "u", "view") for d in range(3)])
    M.write_days(spark, store, "mv_hourly_stats", events_df(spark, rows), "2024-02-20 00:00:00")
    days = [str((T0 + timedelta(days=d)).date()) for d in range(3)]
    M.refresh_changed(spark, store, "mv_hourly_stats", events_df(spark, rows), days, "2024-02-21 00:00:00")
    assert folders(spark, store, "mv_hourly_stats", 1) == folders(spark, store, "mv_hourly_stats", 2)
    M.refresh_changed(spark, store, "mv_hourly_stats", events_df(spark, rows[:2]), days, "2024-02-22 00:00:00")
    assert set(folders(spark, store, "mv_hourly_stats", 3)) == set(days[:2])
    M.refresh_changed(spark, store, "mv_hourly_stats", events_df(spark, []), days, "2024-02-23 00:00:00")
    empty = parts.read(spark, store, "mv_hourly_stats")
    assert empty.count() == 0 and empty.columns == ["hour", "event_type", "event_count", "unique_users"]


def test_sliding_rollup_lets_expired_days_go(spark):
    store = scratch_dir(spark, "t-days")
    rows = [(*r, "US", f"s{r[0]}") for r in hourly([(24 * d, "u", "view") for d in range(20)])]
    df = events_df(spark, rows, ["country_code string", "session_id string"])
    M.write_days(spark, store, "user_engagement_summary", df, "2024-01-30 00:00:00")
    before = folders(spark, store, "user_engagement_summary", 1)
    M.refresh_changed(spark, store, "user_engagement_summary", df, ["2024-01-29"], "2024-02-14 00:00:00")
    after = folders(spark, store, "user_engagement_summary", 2)
    assert len(before) == 20 and sorted(after) == [d for d in sorted(before) if d >= "2024-01-15"]
    assert all(after[d] == before[d] for d in after)


def test_row_changes_with_null_keys(spark):
    schema = "k string, v int"
    old = spark.createDataFrame([(None, 1), ("a", 1), ("b", 2), ("c", None)], schema)
    new = spark.createDataFrame([(None, 2), ("a", 1), ("c", None), ("d", 5)], schema)
    got = {r.k: r.change for r in parts.row_changes(old, new, ["k"]).collect()}
    assert got == {None: "changed", "a": "same", "b": "gone", "c": "same", "d": "new"}


def test_stored_users_touch_only_their_buckets(spark):
    store = scratch_dir(spark, "t-users")
    schema = "id string, first_seen timestamp_ntz, last_seen timestamp_ntz, total_events long, total_sessions long, country_code string"
    user = lambda i, n: (i, T0, T0 + timedelta(days=n), n, 1, "US")
    S.store_users(spark, store, spark.createDataFrame([user(f"u{i}", 1) for i in range(200)] + [user(None, 4)], schema),
                  "2024-01-11 00:00:00", buckets=32)
    before = folders(spark, store, S.USERS, 1)
    touched = S.store_users(spark, store, spark.createDataFrame([user("u7", 2), user("new", 3), user(None, 1)], schema),
                            "2024-01-12 00:00:00", buckets=32)
    after = folders(spark, store, S.USERS, 2)
    assert len(before) == 32 and 1 <= len(touched) <= 3 and {p for p in after if after[p] != before.get(p)} == set(touched)
    got = {r.id: r for r in parts.read(spark, store, S.USERS).collect()}
    assert len(got) == 202 and got["u7"].total_events == 3 and got["new"].total_events == 3 and got[None].total_events == 5
    assert got["u7"].created_at == datetime(2024, 1, 11) and got["u7"].updated_at == datetime(2024, 1, 12)
    assert got["new"].created_at == datetime(2024, 1, 12) and got["u8"].updated_at == datetime(2024, 1, 11)
    assert {r.id: r.total_events for r in parts.read(spark, store, S.USERS, version=1).collect()}[None] == 4


def test_later_writer_of_one_version_wins_whole(spark):
    store = scratch_dir(spark, "t-race")
    df = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    parts.write(spark, store, "t", df, F.col("k"), "2024-01-01 00:00:00")
    for v, at in ((10, "2024-01-02 00:00:00"), (20, "2024-01-03 00:00:00")):       # both saw version 1
        new = parts.write_parts(spark.createDataFrame([("a", v)], "k string, v int"), store, "t", F.col("k"), 2)
        parts.publish(spark, store, "t", 2, new, df.schema, at)
    assert [tuple(r) for r in parts.read(spark, store, "t").collect()] == [("a", 20)]
