"""Registry: rollups R1-R8, queries over rollups RQ*, X9, M7."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import rollups as R
from eventide.registry import register, ts, cte, D, AS_OF, LO_24H, LO_7D

# Event types of the driver data standing in for page_view, click, form_submit.
GEO_TYPES = ["view", "click", "signup"]
RQ6_TYPES = ["view", "click"]

def exact_avg_sql(digits: int) -> str:
    """Oracle twin of functions.avg_seconds: exact half-away-from-zero average."""
    us = "CAST(date_diff('microsecond', event_time, created_at) AS HUGEINT)"
    sc = 10 ** digits
    return (f"CASE WHEN count({us}) > 0 THEN sign(sum({us})) * CAST((abs(sum({us})) * {2 * sc} + count({us}) * 1000000) "
            f"// (count({us}) * 2000000) AS DOUBLE) / {float(sc)} END")

R1_SQL = (f"WITH {cte(sessions=True)} SELECT count(*) AS total_events, count(DISTINCT user_id) AS total_users, "
          "count(DISTINCT session_id) AS total_sessions, min(event_time) AS first_event, "
          f"max(event_time) AS last_event, {ts(AS_OF)} AS updated_at FROM ev")
R2_SQL = (f"WITH {cte(country=True, sessions=True)} SELECT date_trunc('hour', event_time) AS hour, event_type, "
          "country_code, count(*) AS event_count, count(DISTINCT user_id) AS unique_users, "
          f"count(DISTINCT session_id) AS sessions, {exact_avg_sql(6)} AS avg_processing_delay "
          "FROM ev GROUP BY 1, 2, 3")
R3_SQL = (f"WITH {cte(sessions=True)} SELECT CAST(event_time AS DATE) AS date, user_id, count(*) AS event_count, "
          "count(DISTINCT session_id) AS session_count, count(DISTINCT event_type) AS event_types, "
          "min(event_time) AS first_event, max(event_time) AS last_event FROM ev GROUP BY 1, 2")
R4_SQL = (f"WITH {cte(country=True, sessions=True)} SELECT CAST(event_time AS DATE) AS date, country_code, "
          "event_type, count(*) AS events, count(DISTINCT user_id) AS unique_users, "
          f"count(DISTINCT session_id) AS sessions, {exact_avg_sql(2)} AS avg_delay_seconds FROM ev "
          f"WHERE event_type IN ({', '.join(repr(t) for t in GEO_TYPES)}) GROUP BY 1, 2, 3")
R5_SQL = (f"WITH {cte(country=True, sessions=True)} SELECT CAST(event_time AS DATE) AS date, event_type, "
          "country_code, count(*) AS event_count, count(DISTINCT user_id) AS unique_users, "
          "count(DISTINCT session_id) AS unique_sessions FROM ev "
          "WHERE event_time >= TIMESTAMP '2023-11-02 00:00:00' GROUP BY 1, 2, 3")
R6_SQL = (f"WITH {cte(sessions=True)} SELECT user_id, CAST(event_time AS DATE) AS date, count(*) AS events_count, "
          "count(DISTINCT session_id) AS sessions_count, min(event_time) AS first_event, "
          "max(event_time) AS last_event FROM ev WHERE event_time >= TIMESTAMP '2024-01-01 00:00:00' GROUP BY 1, 2")
R7_SQL = (f"SELECT count(*) AS total_events, count(DISTINCT user_id) AS total_users, {ts(AS_OF)} AS refreshed_at "
          "FROM events")
R8_SQL = ("SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS event_count, "
          "count(DISTINCT user_id) AS unique_users FROM events GROUP BY 1, 2")


def _ev(spark, sf, **kw):
    return D.events(spark, sf, **kw)


REFRESH_OPTIONS = {"stats_hourly": {"delay_digits": 6}, "stats_geo_events": {"event_types": GEO_TYPES}}


def stored(spark, sf, name):
    """The rollup ``name`` read back from a store that a full refresh has just written."""
    from eventide.operators import refresh as M
    from eventide.session import scratch_dir
    store = scratch_dir(spark, "rollups")
    M.refresh_all(spark, _ev(spark, sf, country=True, sessions=True), store, AS_OF, names=[name],
                  options=REFRESH_OPTIONS)
    return M.read_rollup(spark, store, name)


@register("r1_stats_totals", R1_SQL)
def r1(spark, sf):
    return R.stats_totals(_ev(spark, sf, sessions=True), AS_OF)


@register("r2_stats_hourly", R2_SQL)
def r2(spark, sf):
    return R.stats_hourly(_ev(spark, sf, country=True, sessions=True), delay_digits=6)


@register("r3_stats_daily_users", R3_SQL)
def r3(spark, sf):
    return R.stats_daily_users(_ev(spark, sf, sessions=True))


@register("r4_stats_geo_events", R4_SQL)
def r4(spark, sf):
    return R.stats_geo_events(_ev(spark, sf, country=True, sessions=True), GEO_TYPES)


@register("r5_daily_event_stats_90d", R5_SQL)
def r5(spark, sf):
    return R.daily_event_stats(_ev(spark, sf, country=True, sessions=True), AS_OF, 90)


@register("r6_user_engagement_30d", R6_SQL)
def r6(spark, sf):
    return R.user_engagement_summary(_ev(spark, sf, sessions=True), AS_OF, 30)


@register("r7_mv_stats_total", R7_SQL)
def r7(spark, sf):
    return R.mv_stats_total(_ev(spark, sf), AS_OF)


@register("r8_mv_hourly_stats", R8_SQL)
def r8(spark, sf):
    return R.mv_hourly_stats(_ev(spark, sf))


@register("rq1_totals", R1_SQL)
def rq1(spark, sf):
    return R.rq1_totals(stored(spark, sf, "stats_totals"))


@register("rq2_recent_7d",
          f"WITH h AS ({R2_SQL}) SELECT CAST(sum(event_count) AS BIGINT) AS total_events, "
          f"CAST(sum(unique_users) AS BIGINT) AS user_hours FROM h WHERE hour >= {ts(LO_7D)}")
def rq2(spark, sf):
    return R.rq2_recent(stored(spark, sf, "stats_hourly"), AS_OF, 7)


@register("rq3_by_type_24h",
          f"WITH h AS ({R2_SQL}) SELECT event_type, CAST(sum(event_count) AS BIGINT) AS count, "
          f"CAST(sum(unique_users) AS BIGINT) AS user_hours FROM h WHERE hour >= {ts(LO_24H)} GROUP BY event_type")
def rq3(spark, sf):
    return R.rq3_by_type(stored(spark, sf, "stats_hourly"), AS_OF, 24)


@register("rq4_top_users_30d",
          f"WITH d AS ({R3_SQL}) SELECT user_id, CAST(sum(event_count) AS BIGINT) AS total_events, "
          "CAST(sum(session_count) AS BIGINT) AS session_days FROM d WHERE date >= DATE '2024-01-01' "
          "GROUP BY user_id ORDER BY total_events DESC, user_id LIMIT 100")
def rq4(spark, sf):
    return R.rq4_top_users(stored(spark, sf, "stats_daily_users"), AS_OF, 30, 100)


@register("rq6_geo_7d",
          f"WITH g AS ({R4_SQL}) SELECT country_code, event_type, CAST(sum(events) AS BIGINT) AS total_events, "
          "CAST(sum(unique_users) AS BIGINT) AS user_days FROM g WHERE date >= DATE '2024-01-24' "
          f"AND event_type IN ({', '.join(repr(t) for t in RQ6_TYPES)}) GROUP BY 1, 2 "
          "ORDER BY total_events DESC, country_code NULLS FIRST, event_type LIMIT 50")
def rq6(spark, sf):
    return R.rq6_geo(stored(spark, sf, "stats_geo_events"), AS_OF, 7, RQ6_TYPES, 50)


@register("x9_densified_daily_types",
          "WITH c AS (SELECT CAST(ts AS DATE) AS date, event_type, count(*) AS count FROM events GROUP BY 1, 2), "
          "b AS (SELECT min(date) AS lo, max(date) AS hi FROM c), d AS (SELECT unnest(generate_series(lo, hi, INTERVAL 1 DAY)) AS d FROM b), "
          "g AS (SELECT CAST(d AS DATE) AS date, t.event_type FROM d, (SELECT DISTINCT event_type FROM events) t) "
          "SELECT g.date, g.event_type, CAST(coalesce(c.count, 0) AS BIGINT) AS count FROM g "
          "LEFT JOIN c ON c.date = g.date AND c.event_type = g.event_type")
def x9(spark, sf):
    ev = _ev(spark, sf)
    counts = ev.groupBy(F.to_date("event_time").alias("date"), "event_type").agg(F.count(F.lit(1)).alias("count"))
    return R.densify(counts, ev)


@register("m7_merged_unique_users",
          "SELECT event_type, count(DISTINCT user_id) AS unique_users, TRUE AS within_5_pct FROM events GROUP BY 1")
def m7(spark, sf):
    """Distinct users merged from the hourly sketches, held against the exact count."""
    ev = _ev(spark, sf)
    merged = R.merge_uniques(R.mv_hourly_stats(ev, sketch="users_sketch"), ["event_type"])
    exact = ev.groupBy(F.col("event_type").alias("t")).agg(F.count_distinct("user_id").alias("unique_users"))
    off = F.abs(F.col("unique_users_est") - F.col("unique_users"))
    return (exact.join(merged, F.col("t").eqNullSafe(F.col("event_type")), "left")
            .select(F.col("t").alias("event_type"), "unique_users",
                    F.coalesce(off <= F.col("unique_users") * 0.05, F.lit(False)).alias("within_5_pct")))


@register("x7_first50_users_events",
          "WITH s AS (SELECT DISTINCT user_id FROM events ORDER BY user_id LIMIT 50) "
          "SELECT e.user_id, count(*) AS events, min(e.ts) AS first_event FROM events e "
          "WHERE e.user_id IN (SELECT user_id FROM s) GROUP BY e.user_id")
def x7(spark, sf):
    from eventide.operators.subsets import first_keys, restrict_to
    ev = _ev(spark, sf)
    sub = restrict_to(ev, first_keys(ev, "user_id", 50), "user_id", bounded=True)
    return sub.groupBy("user_id").agg(F.count(F.lit(1)).alias("events"), F.min("event_time").alias("first_event"))


def _hourly_bitmaps(spark, sf):
    """Hourly bitmaps per type and country, of users numbered in two loads (stored and read back)."""
    from eventide.operators import distinct as X
    from eventide.plans.lineage import materialize
    from eventide.session import scratch_dir
    store, ev = scratch_dir(spark, "user-numbers"), _ev(spark, sf, country=True)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    X.number_users(spark, store, ev.where(F.col("event_time") < cut), AS_OF, buckets=16)
    numbers = X.number_users(spark, store, ev, AS_OF, buckets=16)
    keys = {"hour": F.date_trunc("hour", "event_time").cast("timestamp_ntz"), "event_type": F.col("event_type"),
            "country_code": F.col("country_code")}
    return materialize(X.user_bitmaps(ev, keys, numbers), "hourly-bitmaps")


@register("m7_exact_unique_users_7d",
          f"SELECT count(DISTINCT user_id) AS unique_users FROM events WHERE ts >= {ts(LO_7D)}")
def m7_exact_7d(spark, sf):
    """True users of a week from the hourly rows alone."""
    from eventide.operators import distinct as X
    return X.merge_bitmaps(_hourly_bitmaps(spark, sf), [], where=F.col("hour") >= F.lit(LO_7D).cast("timestamp_ntz"))


@register("m7_exact_daily_types",
          "SELECT CAST(ts AS DATE) AS date, event_type, count(DISTINCT user_id) AS unique_users FROM events GROUP BY 1, 2")
def m7_exact_daily(spark, sf):
    """True users per day and type from the hourly rows."""
    from eventide.operators import distinct as X
    days = _hourly_bitmaps(spark, sf).withColumn("date", F.to_date("hour"))
    return X.merge_bitmaps(days, ["date", "event_type"])


@register("m7_exact_countries",
          f"WITH {cte(country=True)} SELECT country_code, count(DISTINCT user_id) AS unique_users FROM ev GROUP BY 1")
def m7_exact_countries(spark, sf):
    """True users per country over all time."""
    from eventide.operators import distinct as X
    return X.merge_bitmaps(_hourly_bitmaps(spark, sf), ["country_code"])
