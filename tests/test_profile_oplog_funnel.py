from datetime import datetime, timedelta

from pyspark.sql import functions as F

from eventide.operators import oplog as L
from eventide.operators import profile as V
from eventide.operators.funnel import funnel
from eventide.sources import driver as D
from tests.conftest import SF_CHECK, SF_SMALL


def test_shares_sum_to_100(spark):
    ev = D.events(spark, SF_CHECK, country=True)
    s = V.share(ev, "country_code", 2).agg(F.sum("pct")).collect()[0][0]
    assert abs(s - 100.0) <= 0.005 * 25 + 1e-9


def test_pareto_matches_brute_force(spark):
    ev = D.events(spark, SF_CHECK)
    counts = sorted((r["count"] for r in ev.groupBy("user_id").count().collect()), reverse=True)
    for p in (1.0, 20.0, 50.0, 100.0):
        import math
        k = math.ceil(len(counts) * p / 100)
        r = V.pareto(ev, "user_id", p).collect()[0]
        assert r.top_keys == k and r.top_rows == sum(counts[:k]) and r.total_rows == sum(counts)


def test_pareto_ties_at_the_border(spark):
    df = spark.createDataFrame([(u,) for u, n in [("a", 3), ("b", 2), ("c", 2), ("d", 1)] for _ in range(n)], "user_id string")
    r = V.pareto(df, "user_id", 50.0).collect()[0]
    assert (r.top_keys, r.top_rows, r.total_rows, r.top_share_pct) == (2, 5, 8, 62.5)


def test_top_n_ties_broken_by_key(spark):
    df = spark.createDataFrame([("b",), ("a",), ("c",), ("c",)], "user_id string")
    assert [r.user_id for r in V.top_n(df, "user_id", 2).collect()] == ["c", "a"]


def test_time_share_and_hist(spark):
    rows = [(datetime(2024, 1, 6, 9, 0),), (datetime(2024, 1, 8, 17, 59),), (datetime(2024, 1, 8, 18, 0),),
            (datetime(2024, 1, 7, 3, 0),)]
    df = spark.createDataFrame(rows, "event_time timestamp_ntz")
    r = V.time_share(df).collect()[0]
    assert (r.business_hours, r.weekend, r.business_hours_pct, r.weekend_pct) == (2, 2, 50.0, 50.0)
    assert {x.hour: x["count"] for x in V.hour_histogram(df).collect()} == {9: 1, 17: 1, 18: 1, 3: 1}


def test_usage_tier_with_zero_and_ratio_with_zero_parts(spark):
    dim = spark.createDataFrame([(1,), (2,), (3,)], "k long")
    facts = spark.createDataFrame([(1,)] * 150 + [(2,)] * 5, "k long")
    tiers = [(r.id, r.uses, r.usage_status) for r in L.usage_tier(dim, facts, dim_key="k", fact_key="k").collect()]
    assert tiers == [(3, 0, "UNUSED"), (2, 5, "RARELY_USED"), (1, 150, "ACTIVE")]
    empty = spark.createDataFrame([], "h long, r long")
    out = {r.metric: r.ratio for r in L.hit_ratio({
        "zero": (empty, F.col("h"), F.col("r")),
        "half": (spark.createDataFrame([(1, 1)], "h long, r long"), F.col("h"), F.col("r"))}).collect()}
    assert out == {"zero": None, "half": 50.0}


def test_slow_ops_and_classes(spark):
    stats = spark.createDataFrame([
        ("SELECT 1", 10, 100.0, 10.0, 20.0, 1.0, 10, 99, 1),
        ("INSERT INTO t", 5, 50.0, 10.0, 11.0, 0.5, 5, 0, 0),
        ("select * from pg_stat_statements", 1, 9e9, 9e9, 9e9, 0.0, 1, 0, 0),
        ("VACUUM", 1, 1.005, 1.005, 1.005, 0.0, 0, 1, 1)], "query string, calls long, total_exec_time double, "
        "mean_exec_time double, max_exec_time double, stddev_exec_time double, rows long, shared_blks_hit long, "
        "shared_blks_read long")
    slow = L.slow_operations(stats).collect()
    assert [r.query_preview for r in slow] == ["INSERT INTO t", "SELECT 1", "VACUUM"]  # tie on mean: by text
    assert slow[1].cache_hit_ratio == 99.0 and slow[0].cache_hit_ratio is None
    assert slow[2].avg_time_ms == 1.01  # decimal rounding of 1.005
    cls = {r.query_type: r.query_count for r in L.stats_by_class(stats).collect()}
    assert cls == {"SELECT": 1, "INSERT": 1, "OTHER": 1}


def test_funnel_matches_brute_force(spark):
    t0 = datetime(2024, 1, 1)
    rows = []
    spec = {"a": ["view", "click", "purchase"], "b": ["click", "view", "click"], "c": ["view", "purchase", "click"],
            "d": ["view"]}
    for u, types in spec.items():
        for i, t in enumerate(types):
            rows.append((u, t0 + timedelta(hours=i), t))
    rows.append(("e", t0, "view"))
    rows.append(("e", t0 + timedelta(hours=30), "click"))  # beyond a 24 h horizon
    df = spark.createDataFrame(rows, "user_id string, event_time timestamp_ntz, event_type string")
    out = {r.step: (r.users, r.conversion) for r in funnel(df, ["view", "click", "purchase"], "24 hours").collect()}
    assert out == {1: (5, 100.0), 2: (3, 60.0), 3: (1, 20.0)}
    no_h = {r.step: r.users for r in funnel(df, ["view", "click"]).collect()}
    assert no_h == {1: 5, 2: 4}


def test_report_sections(spark):
    ev = D.events(spark, SF_SMALL)
    rep = V.report(ev, {"events": ev})
    secs = {(r.section, r.metric): r.value for r in rep.collect()}
    assert secs[("ROW COUNTS", "Total events")] == str(ev.count())
    assert secs[("PARTITIONS", "Total partitions")] == "1"


def test_report_with_sizes_section(spark):
    ev = D.events(spark, SF_SMALL)
    sizes = spark.createDataFrame([("Events table size", 10752), ("Total size", 5 * 1024 ** 3)], "name string, bytes long")
    rep = {(r.section, r.metric): r.value for r in V.report(ev, {"events": ev}, sizes=sizes).collect()}
    assert rep[("DATA SIZE", "Events table size")] == "11 kB"
    assert rep[("DATA SIZE", "Total size")] == "5120 MB"
