"""Exact mergeable distincts and the one-pass funnel, against plain Python."""

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from eventide.operators import distinct as X, parts, rollups as R
from eventide.operators.funnel import chains, funnel
from eventide.plans.inspect import plan_text
from eventide.session import scratch_dir
from eventide.sources import driver as D
from tests.conftest import SF_SMALL, events_df

T0 = datetime(2024, 1, 10, 8, 0, 0)


def event(i, user, seconds, kind):
    return (i, T0 + timedelta(seconds=seconds), user, kind, "{}", T0)


# ---- numbers and bitmaps -----------------------------------------------------

def test_numbers_are_unique_stable_and_dense(spark):
    store, k = scratch_dir(spark, "t-numbers"), 8
    load = lambda lo, hi: events_df(spark, [event(i, f"u{i % hi}" if i % 11 else None, i, "view") for i in range(lo, hi)])
    first = {r.id: r.number for r in X.number_users(spark, store, load(0, 500), buckets=k).collect()}
    again = {r.id: r.number for r in X.number_users(spark, store, load(0, 500), buckets=k).collect()}
    assert again == first and parts.version_rows(spark, store, X.NUMBERS)[0]["version"] == 1
    more = {r.id: r.number for r in X.number_users(spark, store, load(400, 900), buckets=k).collect()}
    assert {u: more[u] for u in first} == first and len(more) > len(first)
    assert len(set(more.values())) == len(more) and min(more.values()) >= 1
    assert max(more.values()) <= 1.6 * len(more) + 8 * k
    one = X.number_users(spark, store, events_df(spark, [event(1, "late", 1, "view")]), buckets=k)
    before, after = parts.version_rows(spark, store, X.NUMBERS, 2)[1:], parts.version_rows(spark, store, X.NUMBERS, 3)[1:]
    assert one.count() == len(more) + 1 and len({r["path"] for r in after} - {r["path"] for r in before}) == 1


def test_bitmaps_merge_exactly_over_pieces(spark):
    """Numbers over several pieces of 32,768, users in many keys, null users and null keys."""
    rng = random.Random(2)
    users = [f"u{i}" for i in range(300)]
    numbers = spark.createDataFrame([(u, 1 + 997 * i) for i, u in enumerate(users)], "id string, number long")
    rows = [(rng.choice([1, 2, 3, None]), rng.choice(["x", "y"]), rng.choice([*users, None])) for _ in range(4000)]
    ev = spark.createDataFrame(rows, "day int, kind string, user_id string")
    maps = X.user_bitmaps(ev, ["day", "kind"], numbers)
    assert maps.select("piece").distinct().count() > 5
    for keys in (["day"], ["kind"], [], ["day", "kind"]):
        want = {}
        for d, t, u in rows:
            want.setdefault(tuple({"day": d, "kind": t}[c] for c in keys), set()).add(u)
        got = {tuple(r[c] for c in keys): r.unique_users for r in X.merge_bitmaps(maps, keys).collect()}
        assert got == {c: len(s - {None}) for c, s in want.items()}
    assert X.merge_bitmaps(maps, [], where=F.col("day") > 7).first().unique_users == 0


# ---- funnel --------------------------------------------------------------------

def plain_chain(events, steps):
    times = []
    for step in steps:
        later = [t for t, kind in events if kind == step and (not times or t > times[-1])]
        if not later:
            break
        times.append(min(later))
    return times


@pytest.mark.parametrize("steps", [["a", "b", "c"], ["a", "a", "b"], ["a"], ["b", "a", "b", "a"]])
def test_chains_equal_plain_scan(spark, steps):
    rng = random.Random(len(steps))
    rows = [event(i, rng.choice(["u", "v", "w", None]), rng.choice([0, 1, 59, 60, 61, 3600, 90_000, 200_000]) + rng.randrange(3) * 30, rng.choice("abcd"))
            for i in range(120)]
    df = events_df(spark, rows)
    want = {}
    for _, t, u, kind, *_ in rows:
        want.setdefault(u, []).append((t, kind))
    want = {u: c for u, e in want.items() if (c := plain_chain(e, steps))}
    for bucket, group in (("second", "day"), ("minute", "hour"), ("hour", "day")):
        got = {r.user_id: r.times for r in chains(df, steps, bucket=bucket, group=group).collect() if r.times}
        assert got == want
    for horizon, micros in ((None, None), ("1 minute", 60), ("1 day", 86_400)):
        reached = []
        for c in want.values():
            n = 1
            while n < len(c) and (micros is None or (c[n] - c[n - 1]).total_seconds() <= micros):
                n += 1
            reached.append(n)
        got = [(r.step, r.users) for r in funnel(df, steps, horizon).orderBy("step").collect()]
        assert got == [(i, sum(n >= i for n in reached)) for i in range(1, len(steps) + 1)]


def test_funnel_scans_the_events_once(spark):
    plan = plan_text(funnel(D.events(spark, SF_SMALL), ["view", "click", "purchase"], "24 hours"), "simple")
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


def test_funnel_of_nothing(spark):
    got = funnel(events_df(spark, []), ["a", "b"]).orderBy("step").collect()
    assert [(r.step, r.event_type, r.users, r.conversion) for r in got] == [(1, "a", 0, None), (2, "b", 0, None)]


# ---- densified series ------------------------------------------------------------

def test_densify_takes_its_calendar_from_the_data(spark):
    rows = [("2024-02-27", "x"), ("2024-03-02", "y"), ("2024-03-02", None)]
    ev = spark.createDataFrame(rows, "d string, event_type string").withColumn("date", F.to_date("d"))
    counts = ev.groupBy("date", "event_type").agg(F.count(F.lit(1)).alias("count"))
    got = R.densify(counts, ev).collect()
    assert len(got) == 5 * 3 and sum(r["count"] for r in got) == 3
    assert {r.event_type for r in got} == {"x", "y", None}
