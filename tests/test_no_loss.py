"""Cases that must not lose or change rows: keys and numbers in JSON, null users, zoned bounds, text loads."""

import json
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from conftest import events_df
from eventide.functions.jsonmatch import json_contains
from eventide.functions.timefns import month_key
from eventide.operators import queries as Q, refresh as M, rollups as R, sessions as S
from eventide.schema import EVENT_SCHEMA
from eventide.session import input_size
from eventide.sources import ingest as I

T0 = datetime(2024, 1, 1)


@pytest.mark.parametrize("doc, pattern, want", [
    ('{"é":1}', {"é": 1}, True), ('{"a\\\\b":1}', {"a\\b": 1}, True), ('{"q\\"q":[1]}', {'q"q': [1]}, True),
    ('{"k":1e-11}', {"k": 0}, False), ('{"k":1e30}', {"k": 1e30}, True), ('{"k":9223372036854775808}', {"k": 2**63}, True),
    ('{"k":1.50}', {"k": 1.5}, True), ('{"k":100}', {"k": 1e2}, True), ('{"k":-0.0}', {"k": 0}, True),
    ('{"k":0.10000000000000000001}', {"k": 0.1}, False), ('{"$":{"x.y":2}}', {"$": {"x.y": 2}}, True)])
def test_json_keys_and_numbers(spark, doc, pattern, want):
    df = spark.createDataFrame([(doc,)], "d string")
    assert df.select(json_contains("d", json.dumps(pattern)).alias("m")).first()["m"] is want


def test_null_users_and_times_keep_their_rows(spark):
    rows = [(1, T0, "u", "c", "{}", T0), (2, T0, None, "c", "{}", T0), (3, None, "u", "c", "{}", T0)]
    out = {r.id: r.session_id for r in S.sessionize(events_df(spark, rows), "1 hour").collect()}
    assert out == {1: "u-1", 2: None, 3: None}


def test_zoned_bound_on_month_store(spark):
    df = spark.createDataFrame([("2023-12-31 20:00:00",), ("2024-01-01 00:00:00",), ("2023-12-31 18:00:00",)], "t string")
    df = df.select(F.to_timestamp("t").alias("event_time")).withColumn("event_month", month_key("event_time"))
    assert Q.in_window(df, "2024-01-01 00:00:00+05:00").count() == 2
    assert Q.in_window(df.drop("event_month"), "2024-01-01 00:00:00+05:00").count() == 2


def test_text_load(spark, tmp_path):
    base = {"id": 1, "user_id": "u", "session_id": "s", "event_type": "c", "properties": "{}"}
    lines = [json.dumps({**base, "event_time": t}) for t in ("2024-01-01T00:00:00Z", "2024-01-01T00:00:00.250Z",
                                                            "2024-01-01T00:00:00.000001Z")]
    good, bad = tmp_path / "good", tmp_path / "bad"
    good.write_text("\n".join(lines))
    bad.write_text("\n".join([lines[0], "not json"]))
    assert I.read_events(spark, str(good), "json").where("event_time IS NULL").count() == 0
    with pytest.raises(Exception):
        I.read_events(spark, str(bad), "json").collect()
    kept = I.read_events(spark, str(bad), "json", corrupt="_corrupt").cache()
    assert [r["_corrupt"] for r in kept.orderBy("id").collect()] == ["not json", None]


def test_empty_totals_from_cube(spark):
    empty = spark.createDataFrame([], "id long, event_time timestamp_ntz, user_id string, event_type string, "
                                      "session_id string, country_code string, created_at timestamp_ntz")
    cube = R.base_cube(empty)
    assert R.stats_totals(cube, "2024-01-02 00:00:00").first()["total_events"] == 0


def test_touched_dates_and_pruned_range(spark):
    rows = [(i, T0 + timedelta(days=d), "u", "c", "{}", T0) for i, d in enumerate((0, 3, 3))]
    df = events_df(spark, rows)
    assert M.touched_dates(df) == ["2024-01-01", "2024-01-04"]
    assert M.on_dates(df, ["2024-01-04"]).count() == 2 and M.on_dates(df, []).count() == 0


def test_upsert_keeps_other_columns(spark):
    schema = "id string, first_seen timestamp_ntz, last_seen timestamp_ntz, total_events long, email string"
    old = spark.createDataFrame([("a", T0, T0, 1, "a@x"), ("b", T0, T0, 1, "b@x")], schema)
    new = spark.createDataFrame([("b", T0, T0, 2), ("c", T0, T0, 1)], schema.rsplit(",", 1)[0])
    got = {r.id: (r.total_events, r.email) for r in S.upsert_users(old, new, "2024-01-02 00:00:00").collect()}
    assert got == {"a": (1, "a@x"), "b": (3, "b@x"), "c": (1, None)}


def test_input_size_through_spark(spark, tmp_path):
    (tmp_path / "x").write_bytes(b"12345")
    assert input_size(f"file://{tmp_path}", spark) == input_size(str(tmp_path)) == 5
    assert len(EVENT_SCHEMA.fields) > 5
