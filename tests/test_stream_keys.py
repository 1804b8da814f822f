"""Stream ingest: one query, one reading, replays and late duplicates; the stream rollup completed from its state."""

from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eventide.schema import EVENT_SCHEMA
from eventide.session import scratch_dir
from eventide.sources import ingest as I
from eventide.streaming import jobs as St

T0 = datetime(2024, 1, 10, 8, 0, 0)


def rows_of(spark, *spec):
    """(id, minutes after T0[, event type])"""
    rows = [(i, T0 + timedelta(minutes=m), "u", "s", kind[0] if kind else "view", "{}") for i, m, *kind in spec]
    df = spark.createDataFrame(rows, "id long, event_time timestamp, user_id string, session_id string, event_type string, properties string")
    return I.bind(df, {c: c for c in df.columns} | {"created_at": "event_time"})


def store(spark):
    out = scratch_dir(spark, "t-stream")
    return out, St.batch_writer(out, out + "_rejected")


def found(spark, out):
    return (sorted(r.id for r in St.read_ingested(spark, out).collect()),
            sorted((r.id, r.reasons) for r in St.read_ingested(spark, out + "_rejected", rejected=True).collect()))


def test_a_replayed_batch_does_not_double_rows(spark):
    out, write = store(spark)
    batch = rows_of(spark, (1, 0), (2, 5), (3, 6, "x" * 60), (2, 5))
    for _ in range(3):
        write(batch, 0)
    want = ([1], [(2, "duplicate_key"), (2, "duplicate_key"), (3, "too_long:event_type")])
    assert found(spark, out) == want
    write(rows_of(spark, (1, 0), (4, 0)), 1)
    write(rows_of(spark, (1, 0), (4, 0)), 1)              # its own rows are not held against it
    assert found(spark, out) == ([1, 4], sorted([*want[1], (1, "duplicate_key")]))


def test_a_duplicate_is_found_however_late(spark):
    out, write = store(spark)
    write(rows_of(spark, (1, 0), (2, 0)), 0)
    for b in range(1, 4):
        write(rows_of(spark, (10 * b, b * 60 * 24 * 40)), b)
    write(rows_of(spark, (1, 0), (1, 1), (2, 60 * 24 * 40)), 4)      # the key is id and time: only the first repeats one
    ok, bad = found(spark, out)
    assert ok == [1, 1, 2, 2, 10, 20, 30] and bad == [(1, "duplicate_key")]


def test_null_keys_and_empty_batches(spark):
    out, write = store(spark)
    assert found(spark, out) == ([], [])
    write(rows_of(spark).limit(0), 0)
    write(rows_of(spark, (None, 0), (1, 0)), 1)
    write(rows_of(spark, (None, 0)), 2)
    ok, bad = found(spark, out)
    assert ok == [1] and [r for _, r in bad] == ["null:id", "null:id"]


def test_one_query_reads_each_row_once(spark):
    src, out, ck = (scratch_dir(spark, f"t-once-{x}") for x in ("in", "out", "ck"))
    rows_of(spark, *[(i, i) for i in range(100)]).repartition(4).write.parquet(src)
    q = St.stream_ingest(spark, src, out, ck, max_files_per_trigger=1)
    assert sum(p["numInputRows"] for p in q.recentProgress) == 100 and len([p for p in q.recentProgress if p["numInputRows"]]) == 4
    assert found(spark, out) == (list(range(100)), [])
    assert St.read_ingested(spark, out).select(St.BATCH).distinct().count() == 4


def test_validate_once_gives_the_same_sides(spark):
    df = rows_of(spark, (1, 0), (1, 0), (2, 0), (None, 1), (3, 0, "y" * 99))
    for once in (False, True):
        ok, bad = I.validate(df, once=once)
        assert [r.id for r in ok.collect()] == [2] and bad.count() == 4 and "reasons" in bad.columns and "reasons" not in ok.columns


def test_open_windows_are_read_from_the_state(spark):
    src, out, ck = (scratch_dir(spark, f"t-open-{x}") for x in ("in", "out", "ck"))
    rows_of(spark, (1, 0), (2, 1), (3, 200, "click"), (4, 260), (5, 290)).write.parquet(src)
    St.stream_hourly(spark, src, out, ck, schema=EVENT_SCHEMA)
    hour = lambda h: T0 + timedelta(hours=h)
    got = {(r.hour, r.event_type): (r.event_count, r.unique_users_est) for r in St.hourly_so_far(spark, out, ck).collect()}
    assert got == {(hour(0), "view"): (2, 1), (hour(3), "click"): (1, 1), (hour(4), "view"): (2, 1)}
    assert spark.read.parquet(out).count() < 3
    merged = St.hourly_so_far(spark, out, ck).agg(F.hll_sketch_estimate(F.hll_union_agg("users_sketch")).alias("n")).first().n
    assert merged == 1
