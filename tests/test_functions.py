from datetime import datetime

import pytest

from eventide.functions.keys import stable_uuid
from eventide.functions.timefns import exact_pct, interval_micros, round_dec, size_pretty, trunc_ts
from eventide.operators import partitions as P
from eventide.sources import ingest as I


def test_size_pretty_units_and_rounding(spark):
    vals = [0, 812, 10239, 10240, 10751, 10752, 10485247, 10485248, 5 * 1024 ** 3, 40 * 1024 ** 5, -20000, None]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in vals], "b long").select(size_pretty("b")).collect()]
    assert got == ["0 bytes", "812 bytes", "10239 bytes", "10 kB", "10 kB", "11 kB", "10239 kB", "10 MB",
                   "5120 MB", "40 PB", "-20 kB", None]


def test_exact_percent_and_decimal_round(spark):
    df = spark.createDataFrame([(1, 8, 1.005), (1, 3, 2.675), (0, 0, -1.005)], "p long, w long, x double")
    got = [(r[0], r[1]) for r in df.select(exact_pct(df.p, df.w, 2), round_dec(df.x, 2)).collect()]
    assert got == [(12.5, 1.01), (33.33, 2.68), (None, -1.01)]


def test_interval_parsing():
    assert interval_micros("4 hours") == 4 * 3600 * 10 ** 6
    assert interval_micros("1 day 30 minutes") == (86400 + 1800) * 10 ** 6
    assert interval_micros(1.5) == 1_500_000
    with pytest.raises(ValueError):
        interval_micros("3 fortnights")


def test_trunc_keeps_ntz(spark):
    df = spark.createDataFrame([(datetime(2024, 1, 1, 10, 59, 59, 999999),)], "t timestamp_ntz")
    out = df.select(trunc_ts("hour", "t", df.schema["t"].dataType).alias("h"))
    assert out.schema["h"].dataType.typeName() == "timestamp_ntz"
    assert out.collect()[0].h == datetime(2024, 1, 1, 10)


def test_stable_uuid_is_deterministic(spark):
    df = spark.createDataFrame([(1, "a"), (1, "a"), (1, None)], "x long, y string")
    ids = [r[0] for r in df.select(stable_uuid("x", "y")).collect()]
    assert ids[0] == ids[1] != ids[2] and len(ids[0]) == 36 and ids[0].count("-") == 4


def test_months_to_create_and_known_partition_check(spark):
    present = spark.createDataFrame([("events_2024_02",)], "partition_name string")
    todo = [r.partition_name for r in P.months_to_create(spark, present, "2024-01-20").collect()]
    assert todo == ["events_2024_03"]
    cal = P.month_calendar(spark, "2024-01-01", "2024-02-29")
    rows = spark.createDataFrame([(1, datetime(2024, 2, 29, 23, 59, 59)), (2, datetime(2024, 3, 1))],
                                 "id long, event_time timestamp_ntz")
    load = I.with_defaults(I.bind(rows, {"id": "id", "event_time": "event_time", "user_id": "id",
                                         "session_id": "id", "event_type": "id"}), "2024-03-02 00:00:00")
    ok, bad = I.validate(load, partitions=cal)
    assert [r.id for r in ok.collect()] == [1]
    assert [(r.id, r.reasons) for r in bad.collect()] == [(2, ["no_partition"])]


def test_partition_sizing(spark):
    from eventide.session import tune_for_input
    old = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        assert tune_for_input(spark, 10, min_partitions=8)["spark.sql.shuffle.partitions"] == "8"
        assert tune_for_input(spark, 10 * (256 << 20))["spark.sql.shuffle.partitions"] == str(
            max(10, spark.sparkContext.defaultParallelism))
        assert tune_for_input(spark, 100 * 10 ** 12)["spark.sql.shuffle.partitions"] == "100000"
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.initialPartitionNum", old)


def test_lineage_cuts_write_to_the_shared_folder(spark):
    from eventide.plans.inspect import plan_text
    from eventide.plans.lineage import cut_lineage, materialize
    df = spark.range(100).selectExpr("id", "id % 7 AS k")
    cut = cut_lineage(df.groupBy("k").count())
    assert cut.count() == 7 and "HashAggregate" not in plan_text(cut)  # lineage replaced by the checkpoint
    m = materialize(df.where("k = 3"), "t-mat")
    assert m.count() == len([i for i in range(100) if i % 7 == 3])
    assert "Scan parquet" in plan_text(m)
