"""Property checks: streaming = batch on closed windows; bucketed
sessionization = plain per-user window for random gap patterns."""

from datetime import datetime, timedelta

from hypothesis import given, settings, HealthCheck, strategies as st
from pyspark.sql import Window, functions as F

from eventide.operators import rollups as R
from eventide.operators import sessions as S
from eventide.session import scratch_dir
from eventide.sources import driver as D
from eventide.sources import ingest as I
from eventide.streaming import jobs as St
from tests.conftest import SF_SMALL

T0 = datetime(2024, 1, 1, 22, 0, 0)


def test_stream_closed_windows_equal_batch_rollup(spark):
    ev = D.events(spark, SF_SMALL)
    src = scratch_dir(spark, "prop-in")
    bound = I.bind(ev, {"id": "id", "event_time": "event_time", "user_id": "user_id", "event_type": "event_type",
                        "properties": "properties", "created_at": "created_at", "session_id": F.lit("s")})
    bound.write.parquet(src)
    out, ck = scratch_dir(spark, "prop-out"), scratch_dir(spark, "prop-ck")
    St.stream_hourly(spark, src, out, ck)
    got = {(r.hour.replace(tzinfo=None), r.event_type): r.event_count
           for r in spark.read.parquet(out).select(F.col("hour").cast("timestamp_ntz").alias("hour"),
                                                    "event_type", "event_count").collect()}
    wm = ev.agg(F.max("event_time")).collect()[0][0] - timedelta(hours=1)
    batch = {(r.hour, r.event_type): r.event_count for r in R.mv_hourly_stats(ev).collect()
             if r.hour + timedelta(hours=1) <= wm}
    assert got == batch and len(got) > 0


def _naive(df, gap_us):
    w = Window.partitionBy("user_id").orderBy("event_time", "id")
    prev = F.lag("event_time").over(w)
    f = F.when(prev.isNull() | (F.timestamp_diff("MICROSECOND", prev, F.col("event_time")) > gap_us), 1).otherwise(0)
    return df.withColumn("f", f).withColumn("n", F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0)))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b"]), st.integers(min_value=0, max_value=3 * 3600 * 10 ** 6)),
                min_size=1, max_size=40),
       st.sampled_from(["minute", "hour", "day"]))
def test_sessionize_matches_plain_window(spark, gaps, bucket):
    rows, clock = [], {"a": 0, "b": 0}
    for i, (u, g) in enumerate(gaps):
        clock[u] += g
        rows.append((i, T0 + timedelta(microseconds=clock[u]), u, "view", "{}", T0))
    df = spark.createDataFrame(rows, "id long, event_time timestamp_ntz, user_id string, event_type string, "
                                     "properties string, created_at timestamp_ntz")
    gap_us = 30 * 60 * 10 ** 6
    want = {r.id: r.n for r in _naive(df, gap_us).collect()}
    got = {r.id: r.n for r in S.sessionize(df, "30 minutes", bucket=bucket, number_col="n").collect()}
    assert got == want
