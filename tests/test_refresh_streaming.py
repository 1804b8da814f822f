from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eventide.operators import refresh as M
from eventide.operators import rollups as R
from eventide.session import scratch_dir
from eventide.sources import driver as D
from eventide.streaming import jobs as St
from tests.conftest import SF_SMALL

T0 = datetime(2024, 1, 10, 10, 0, 0)


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def test_incremental_refresh_equals_full(spark):
    ev = D.events(spark, SF_SMALL, country=True, sessions=True)
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    store = scratch_dir(spark, "t-roll")
    M.refresh_all(spark, ev.where(F.col("event_time") < cut), store, D.AS_OF,
                  names=["stats_geo_events", "user_engagement_summary"])
    v1 = M.current_version(spark, store, "stats_geo_events")
    dates = [f"2024-01-{d}" for d in range(20, 31)]
    inc = M.refresh_dates(spark, store, "stats_geo_events", ev, dates, D.AS_OF)
    assert M.current_version(spark, store, "stats_geo_events")[0] == v1[0] + 1
    assert _rows(inc) == _rows(R.stats_geo_events(ev))
    # the old version is still readable as it was
    assert spark.read.parquet(v1[1]).count() < inc.count()
    inc2 = M.refresh_dates(spark, store, "user_engagement_summary", ev, dates, D.AS_OF)
    assert _rows(inc2) == _rows(R.user_engagement_summary(ev, D.AS_OF, 30))


def test_freshness_and_inventory(spark):
    store = scratch_dir(spark, "t-fresh")
    ev = D.events(spark, SF_SMALL, country=True, sessions=True)
    M.refresh_all(spark, ev, store, "2024-01-31 00:00:00", names=["stats_totals", "stats_hourly"])
    f = {r.view_name: r for r in M.freshness(M.refresh_log(spark, store), "2024-01-31 00:10:00").collect()}
    assert f["stats_totals"].status == "STALE" and f["stats_hourly"].status == "FRESH"
    assert f["stats_totals"].age_seconds == 600
    inv = {r.rollup: r for r in M.inventory(spark, store).collect()}
    assert inv["stats_totals"].rows == 1 and inv["stats_hourly"].bytes > 0
    assert M.duplicate_keys(M.read_rollup(spark, store, "stats_hourly"),
                            ["hour", "event_type", "country_code"]).count() == 0


def test_stream_drops_late_rows_and_matches_batch(spark):
    schema = "id long, event_time timestamp, user_id string, event_type string"
    src = scratch_dir(spark, "t-stream-in")
    batch1 = [(1, T0, "a", "view"), (2, T0 + timedelta(minutes=30), "b", "view"),
              (3, T0 + timedelta(hours=3, minutes=10), "a", "click")]
    batch2 = [(4, T0 + timedelta(minutes=20), "c", "view"),            # older than the watermark: dropped
              (5, T0 + timedelta(hours=5), "a", "view")]
    out, ck = scratch_dir(spark, "t-stream-out"), scratch_dir(spark, "t-stream-ck")
    spark.createDataFrame(batch1, schema).coalesce(1).write.parquet(f"{src}/b1")
    from pyspark.sql import types as T
    sch = T._parse_datatype_string(schema)
    St.stream_hourly(spark, f"{src}/*", out, ck, schema=sch)
    spark.createDataFrame(batch2, schema).coalesce(1).write.parquet(f"{src}/b2")
    St.stream_hourly(spark, f"{src}/*", out, ck, schema=sch)
    got = {(r.hour, r.event_type): r.event_count for r in spark.read.parquet(out).collect()}
    # watermark after batch 2 = 15:00 - 1h = 14:00: windows ending by then are closed
    assert got == {(T0, "view"): 2, (T0 + timedelta(hours=3), "click"): 1}


def test_stream_ingest_round_trip(spark):
    src = scratch_dir(spark, "t-ingest-in")
    ev = D.events(spark, SF_SMALL)
    from eventide.sources import ingest as I
    bound = I.bind(ev, {"id": "id", "event_time": "event_time", "user_id": "user_id", "event_type": "event_type",
                        "properties": "properties", "created_at": "created_at",
                        "session_id": F.lit("s")})
    bound.repartition(3).write.parquet(src)
    out, bad, ck = scratch_dir(spark, "t-i-out"), scratch_dir(spark, "t-i-bad"), scratch_dir(spark, "t-i-ck")
    St.stream_ingest(spark, src, out, ck, max_files_per_trigger=1, rejected_path=bad,
                     time_range=("2024-01-01 00:00:00", "2024-01-15 00:00:00"))
    n_ok, n_bad = spark.read.parquet(out).count(), spark.read.parquet(bad).count()
    assert n_ok + n_bad == ev.count()
    assert n_ok == ev.where("event_time < timestamp_ntz'2024-01-15 00:00:00'").count()


def test_in_place_refresh_replaces_only_touched_days(spark):
    ev = D.events(spark, SF_SMALL, country=True, sessions=True)
    cut = F.lit("2024-01-20 00:00:00").cast("timestamp_ntz")
    path = scratch_dir(spark, "t-inplace")
    M.write_partitioned(R.stats_daily_users(ev.where(F.col("event_time") < cut)), path, "date")
    dates = [f"2024-01-{d}" for d in range(20, 31)]
    out = M.refresh_dates_in_place(spark, path, "stats_daily_users", ev, dates, D.AS_OF).drop("day")
    assert _rows(out.select(*R.stats_daily_users(ev).columns)) == _rows(R.stats_daily_users(ev))


def test_stream_ingest_restart_is_exactly_once(spark):
    from eventide.sources import ingest as I
    ev = D.events(spark, SF_SMALL)
    bound = I.bind(ev, {"id": "id", "event_time": "event_time", "user_id": "user_id", "event_type": "event_type",
                        "properties": "properties", "created_at": "created_at", "session_id": F.lit("s")})
    src = scratch_dir(spark, "t-restart-in")
    out, ck = scratch_dir(spark, "t-restart-out"), scratch_dir(spark, "t-restart-ck")
    first = bound.where("id % 2 = 0")
    first.write.parquet(f"{src}/part1")
    St.stream_ingest(spark, f"{src}/*", out, ck, max_files_per_trigger=2)
    St.stream_ingest(spark, f"{src}/*", out, ck, max_files_per_trigger=2)  # nothing new: no duplicates
    assert spark.read.parquet(out).count() == first.count()
    bound.where("id % 2 = 1").write.parquet(f"{src}/part2")
    St.stream_ingest(spark, f"{src}/*", out, ck, max_files_per_trigger=2)
    back = spark.read.parquet(out)
    assert back.count() == bound.count() and back.select("id").distinct().count() == bound.count()


def test_manifest_has_row_counts_empty_input_too(spark):
    from eventide.operators import refresh as M
    from eventide.session import scratch_dir
    from eventide.sources import driver as D
    from tests.conftest import SF_SMALL
    ev = D.events(spark, SF_SMALL, country=True, sessions=True)
    for part in (ev, ev.where("id < 0")):
        store = scratch_dir(spark, "rollup-rows")
        said = {r.rollup: r.rows for r in M.refresh_all(spark, part, store, D.AS_OF).collect()}
        assert said == {n: M.read_rollup(spark, store, n).count() for n in said} and said["stats_totals"] == 1
    assert M.read_rollup(spark, store, "stats_totals").collect()[0].total_events == 0


def test_refresh_of_dates_prunes_months_and_pushes_times(spark):
    from eventide.operators import refresh as M
    from eventide.plans.inspect import plan_text
    from eventide.session import scratch_dir
    from eventide.sources import driver as D
    from eventide.sources import ingest as I
    from tests.conftest import SF_SMALL
    path = scratch_dir(spark, "refresh-store")
    I.append_events(D.events(spark, SF_SMALL), path)
    text = plan_text(M.on_dates(I.read_store(spark, path), ["2024-01-05", "2024-01-07"]))
    assert "PartitionFilters: [isnotnull(event_month" in text and "GreaterThanOrEqual(event_time" in text
