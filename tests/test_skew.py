"""One user holds a third of all events: results stay exact and whole."""

import pytest
from pyspark.sql import Window, functions as F

from eventide.operators import profile as V
from eventide.operators import rollups as R
from eventide.operators import sessions as S
from eventide.operators.funnel import funnel
from eventide.sources import driver as D
from eventide.sources import ingest as I
from tests.conftest import SF_CHECK


@pytest.fixture(scope="module")
def skewed(spark):
    ev = D.events(spark, SF_CHECK, country=True)
    # Every third event is re-assigned to one hot user.
    return ev.withColumn("user_id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))


def test_hot_user_sessionize_exact(spark, skewed):
    w = Window.partitionBy("user_id").orderBy("event_time", "id")
    prev = F.lag("event_time").over(w)
    gap = 30 * 60 * 10 ** 6
    f = F.when(prev.isNull() | (F.timestamp_diff("MICROSECOND", prev, F.col("event_time")) > gap), 1).otherwise(0)
    want = {r.id: r.n for r in skewed.withColumn("f", f)
            .withColumn("n", F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0))).collect()}
    for bucket in ("minute", "hour"):
        got = {r.id: r.n for r in S.sessionize(skewed, "30 minutes", bucket=bucket, number_col="n").collect()}
        assert got == want


def test_hot_user_rollups_and_reports(spark, skewed):
    ev = S.sessionize(skewed, "4 hours")
    a = sorted(map(tuple, R.stats_hourly(ev, strategy="expand").collect()), key=repr)
    b = sorted(map(tuple, R.stats_hourly(ev, strategy="nested").collect()), key=repr)
    assert a == b
    top = V.top_n(ev, "user_id", 1).collect()[0]
    assert top.user_id == -1 and top.event_count == ev.where("id % 3 = 0").count()
    p = V.pareto(ev, "user_id", 1.0).collect()[0]
    assert p.top_keys == 2 and p.top_rows >= top.event_count
    steps = {r.step: r.users for r in funnel(ev, ["view", "click"]).collect()}
    assert steps[1] >= steps[2] > 0


def test_hot_key_duplicates_all_rejected(spark, skewed):
    load = skewed.select(F.lit(1).cast("long").alias("id"), "event_time", F.col("user_id").cast("string").alias("user_id"),
                         F.lit("s").alias("session_id"), "event_type", "properties", "created_at")
    load = load.withColumn("event_time", F.when(F.col("user_id") == "-1", F.lit("2024-01-05 00:00:00").cast("timestamp_ntz"))
                           .otherwise(F.col("event_time")))
    ok, bad = I.validate(load)
    hot = skewed.where("user_id = -1").count()
    assert bad.where(F.array_contains("reasons", "duplicate_key")).count() >= hot
    assert ok.count() + bad.count() == skewed.count()


def test_hot_user_session_windows_match_the_built_in(spark, skewed):
    ev = skewed.withColumn("user_id", F.when(F.col("id") % 7 != 0, F.col("user_id")))
    want = (ev.groupBy("user_id", F.session_window("event_time", "4 hours").alias("w")).agg(F.count(F.lit(1)).alias("n"))
            .select("user_id", F.col("w.start").cast("timestamp_ntz"), F.col("w.end").cast("timestamp_ntz"), "n"))
    got = S.session_windows(ev, "4 hours").select("user_id", "started_at", "window_end", "events_count")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
