from datetime import date, datetime

from pyspark.sql import functions as F

from eventide.operators import partitions as P
from eventide.session import scratch_dir
from eventide.sources import ingest as I


def _canon(spark, rows):
    # (id, event_time, user_id, session_id, event_type, properties)
    df = spark.createDataFrame(rows, "id long, event_time timestamp_ntz, user_id string, session_id string, "
                                     "event_type string, properties string")
    return I.bind(df, {c: c for c in df.columns})


def test_month_boundaries_route_to_the_right_partition(spark):
    rows = [(1, datetime(2024, 1, 1, 0, 0, 0, 0), "u", "s", "view", "{}"),
            (2, datetime(2024, 1, 31, 23, 59, 59, 999999), "u", "s", "view", "{}"),
            (3, datetime(2024, 2, 1, 0, 0, 0, 0), "u", "s", "view", "{}")]
    path = scratch_dir(spark, "t-store")
    I.append_events(I.with_defaults(_canon(spark, rows), "2024-03-01 00:00:00"), path)
    back = I.read_store(spark, path)
    got = {r.id: r.event_month for r in back.collect()}
    assert got == {1: "2024_01", 2: "2024_01", 3: "2024_02"}
    inv = {r.partition_name: r.row_count for r in P.list_partitions(back, with_bytes=True).collect()}
    assert inv == {"events_2024_01": 2, "events_2024_02": 1}
    sizes = P.list_partitions(back, with_bytes=True).collect()
    assert all(r.total_size > 0 for r in sizes)
    # retention rewrites the kept months to a new version, old one untouched
    kept = P.drop_expired(back, scratch_dir(spark, "t-kept"), "2025-01-15", keep_months=12)
    assert {r.event_month for r in kept.select("event_month").distinct().collect()} == {"2024_02"}
    assert I.read_store(spark, path).count() == 3


def test_calendar_missing_expired(spark):
    cal = P.default_calendar(spark, "2024-06-15")
    names = [r.partition_name for r in cal.orderBy("start_date").collect()]
    assert len(names) == 13 and names[0] == "events_2023_12" and names[-1] == "events_2024_12"
    present = spark.createDataFrame([("events_2024_01",), ("events_2023_01",), ("events_2022_12",)], "partition_name string")
    missing = {r.partition_name for r in P.missing_months(cal, present).collect()}
    assert "events_2024_01" not in missing and len(missing) == 12
    expired = {r.partition_name for r in P.expired_months(present, "2024-01-15", 12).collect()}
    # cutoff 2023-01-15: a month expires when it starts before the cutoff
    assert expired == {"events_2022_12", "events_2023_01"}
    assert {r.partition_name for r in P.expired_months(present, "2024-01-01", 12).collect()} == {"events_2022_12"}


def test_partition_name_inverse(spark):
    df = spark.createDataFrame([(datetime(2024, 3, 9, 12),)], "t timestamp_ntz")
    r = df.select(P.partition_name("t").alias("n")).select("n", P.partition_start("n").alias("d")).collect()[0]
    assert r.n == "events_2024_03" and r.d == date(2024, 3, 1)


def test_validate_reasons(spark):
    long_type = "x" * 51
    rows = [(1, datetime(2024, 1, 5), "u", "s", "view", "{}"),
            (2, datetime(2024, 1, 5), None, "s", "view", "{}"),          # missing user
            (3, datetime(2024, 1, 5), "u", "s", long_type, "{}"),        # 51 chars
            (4, datetime(2024, 1, 5), "u", "s", "view", "{}"),
            (4, datetime(2024, 1, 5), "u", "s", "view", "{}"),           # repeated key
            (5, datetime(2023, 12, 31, 23, 59, 59), "u", "s", "view", "{}"),  # before first partition
            (6, datetime(2024, 3, 1), "u", "s", "view", "{}")]           # after last
    df = I.with_defaults(_canon(spark, rows), "2024-01-10 00:00:00")
    ok, bad = I.validate(df, time_range=("2024-01-01 00:00:00", "2024-03-01 00:00:00"))
    assert sorted(r.id for r in ok.collect()) == [1]
    reasons = {}
    for r in bad.collect():
        reasons.setdefault(r.id, set()).update(r.reasons)
    assert reasons[2] == {"null:user_id"}
    assert reasons[3] == {"too_long:event_type"}
    assert reasons[4] == {"duplicate_key"}
    assert reasons[5] == {"no_partition"} and reasons[6] == {"no_partition"}
    assert bad.count() + ok.count() == len(rows)


def test_defaults_and_partial_insert(spark):
    rows = spark.createDataFrame([(10, "u", "click")], "id long, user_id string, event_type string")
    path = scratch_dir(spark, "t-insert")
    I.insert_rows(rows, path, "2024-01-31 12:00:00")
    r = I.read_store(spark, path).collect()[0]
    assert r.properties == "{}" and r.event_month == "2024_01"
    assert r.event_time == r.created_at
    assert r.session_id is None and r.page_url is None


def test_typed_csv_read(spark):
    df = _canon(spark, [(1, datetime(2024, 1, 2, 3, 4, 5, 678901), "u", "s", "view", '{"a":1}')])
    path = scratch_dir(spark, "t-csv")
    df.write.option("header", "true").option("timestampFormat", I.TS_FORMAT).csv(path)
    back = I.read_events(spark, path, fmt="csv")
    r = back.collect()[0]
    assert back.columns[0] == "id" and r.properties == '{"a":1}'
    assert r.event_time.microsecond == 678901


def test_enrich_inherits_from_session(spark):
    ev = spark.createDataFrame([(1, "s1", "view", None), (2, "s2", "click", "CA")],
                               "id long, session_id string, event_type string, country_code string")
    sess = spark.createDataFrame([("s1", "u1", "mobile", "US")], "id string, user_id string, device_type string, country_code string")
    out = {r.id: r for r in I.enrich(ev, sess, derived={"k": F.upper("event_type")}, payload=("event_type",)).collect()}
    assert out[1].country_code == "US" and out[1].device_type == "mobile" and out[1].user_id == "u1"
    assert out[2].country_code == "CA" and out[2].device_type is None
    assert out[1].properties == '{"event_type":"view"}' and out[2].k == "CLICK"


def test_month_reload_is_idempotent(spark):
    rows = [(1, datetime(2024, 1, 5), "u", "s", "view", "{}"), (2, datetime(2024, 2, 5), "u", "s", "view", "{}")]
    df = I.with_defaults(_canon(spark, rows), "2024-03-01 00:00:00")
    path = scratch_dir(spark, "t-reload")
    I.append_events(df, path)
    jan = df.where(F.col("event_time") < F.lit("2024-02-01 00:00:00").cast("timestamp_ntz"))
    I.append_events(jan, path, overwrite_months=True)
    I.append_events(jan, path, overwrite_months=True)
    back = I.read_store(spark, path)
    assert sorted(r.id for r in back.collect()) == [1, 2]
