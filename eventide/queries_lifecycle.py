"""Registry: ingest S1-S8, partition lifecycle P1-P7, refresh M1-M5.

Round-trip entries write to a fresh directory under the session's shared
checkpoint folder and return the data read back.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import partitions as P
from eventide.operators import queries as Q
from eventide.operators import refresh as M
from eventide.operators import rollups as R
from eventide.operators import sessions as S
from eventide.queries_sessions import SESSIONS_BODY
from eventide.registry import register, ts, cte, D, AS_OF
from eventide.session import scratch_dir
from eventide.sources import ingest as I

ORDERS_AS_OF = "2001-08-31"


def _orders_as_events(spark, sf):
    """Orders bound onto the canonical schema: the month logic needs data
    spanning many months (events cover one)."""
    o = D.table(spark, sf, "orders")
    return I.bind(o, {"id": "o_orderkey", "event_time": F.col("o_orderdate").cast("timestamp"),
                      "user_id": "o_custkey", "session_id": "o_orderkey", "event_type": "o_orderstatus",
                      "properties": F.to_json(F.struct(F.col("o_orderpriority").alias("priority"))),
                      "created_at": F.col("o_orderdate").cast("timestamp")})


# ---- partition lifecycle -------------------------------------------------

@register("p1_month_calendar",
          "WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) AS hi FROM orders), "
          "m AS (SELECT unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS d FROM b) "
          "SELECT 'events_' || strftime(d, '%Y_%m') AS partition_name, CAST(d AS DATE) AS start_date, "
          "CAST(d + INTERVAL 1 MONTH AS DATE) AS end_date FROM m")
def p1(spark, sf):
    b = D.table(spark, sf, "orders").agg(F.min("o_orderdate").alias("lo"), F.max("o_orderdate").alias("hi"))
    return P.month_calendar(b, F.col("lo"), F.col("hi"))


@register("p2_partition_names",
          "SELECT DISTINCT 'events_' || strftime(o_orderdate, '%Y_%m') AS partition_name, "
          "CAST(date_trunc('month', o_orderdate) AS DATE) AS start_date FROM orders")
def p2(spark, sf):
    names = P.present_months(D.table(spark, sf, "orders"), ts="o_orderdate")
    return names.withColumn("start_date", P.partition_start("partition_name"))


@register("p3_missing_months",
          "WITH b AS (SELECT min(o_orderdate) AS lo, max(o_orderdate) + INTERVAL 6 MONTH AS hi FROM orders), "
          "m AS (SELECT unnest(generate_series(date_trunc('month', lo), hi, INTERVAL 1 MONTH)) AS d FROM b), "
          "cal AS (SELECT 'events_' || strftime(d, '%Y_%m') AS partition_name, CAST(d AS DATE) AS start_date, "
          "CAST(d + INTERVAL 1 MONTH AS DATE) AS end_date FROM m) "
          "SELECT * FROM cal WHERE NOT EXISTS (SELECT 1 FROM orders o WHERE "
          "'events_' || strftime(o.o_orderdate, '%Y_%m') = cal.partition_name)")
def p3(spark, sf):
    o = D.table(spark, sf, "orders")
    b = o.agg(F.min("o_orderdate").alias("lo"), F.add_months(F.max("o_orderdate"), 6).alias("hi"))
    cal = P.month_calendar(b, F.col("lo"), F.col("hi"))
    return P.missing_months(cal, P.present_months(o, ts="o_orderdate"))


@register("p4_expired_months",
          "SELECT DISTINCT 'events_' || strftime(o_orderdate, '%Y_%m') AS partition_name, "
          "CAST(date_trunc('month', o_orderdate) AS DATE) AS start_date FROM orders "
          f"WHERE CAST(date_trunc('month', o_orderdate) AS DATE) < DATE '{ORDERS_AS_OF}' - INTERVAL 12 MONTH")
def p4(spark, sf):
    present = P.present_months(D.table(spark, sf, "orders"), ts="o_orderdate")
    return P.expired_months(present, ORDERS_AS_OF, 12)


_P5_SQL = ("SELECT 'events_' || strftime(o_orderdate, '%Y_%m') AS partition_name, count(*) AS row_count, "
           "min(o_orderdate) AS first_event, max(o_orderdate) AS last_event FROM orders GROUP BY 1")


@register("p5_list_partitions", _P5_SQL)
def p5(spark, sf):
    return P.list_partitions(D.table(spark, sf, "orders"), ts="o_orderdate")


@register("p6_partition_ranking",
          f"WITH inv AS ({_P5_SQL}) SELECT *, row_number() OVER (ORDER BY row_count DESC, partition_name) AS rank, "
          "count(*) OVER () AS partitions FROM inv WHERE row_count > 0")
def p6(spark, sf):
    return P.partition_ranking(P.list_partitions(D.table(spark, sf, "orders"), ts="o_orderdate"))


def _stored_orders(spark, sf):
    path = scratch_dir(spark, "orders-store")
    I.append_events(_orders_as_events(spark, sf), path)
    return I.read_store(spark, path)


@register("p7_pruned_window_count",
          "SELECT count(*) AS count FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-15 00:00:00'")
def p7(spark, sf):
    return Q.count_rows(Q.in_window(_stored_orders(spark, sf), "2001-01-15 00:00:00"))


@register("p5_partition_bytes", f"SELECT *, TRUE AS has_bytes FROM ({_P5_SQL})")
def p5b(spark, sf):
    found = P.list_partitions(_stored_orders(spark, sf), with_bytes=True)
    at = lambda c: F.col(c).cast("timestamp_ntz").alias(c)
    return found.select("partition_name", "row_count", at("first_event"), at("last_event"),
                        (F.col("total_size") > 0).alias("has_bytes"))


# ---- ingest ---------------------------------------------------------------

_BOUND_SQL = ("SELECT event_id AS id, ts AS event_time, CAST(user_id AS VARCHAR) AS user_id, event_type, "
              "props AS properties FROM events")


@register("s1_typed_json_roundtrip", _BOUND_SQL)
def s1(spark, sf):
    raw = D.table(spark, sf, "events")
    bound = I.bind(raw, {"id": "event_id", "event_time": "ts", "user_id": "user_id",
                         "event_type": "event_type", "properties": "props"})
    path = scratch_dir(spark, "json-load")
    bound.write.mode("errorifexists").option("timestampFormat", I.TS_FORMAT).json(path)
    back = I.read_events(spark, path, fmt="json")
    return back.select("id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "user_id",
                       "event_type", "properties")


@register("s2_bind_canonical",
          "SELECT event_id AS id, ts AS event_time, CAST(user_id AS VARCHAR) AS user_id, "
          "CAST(NULL AS VARCHAR) AS session_id, event_type, props AS properties, CAST(NULL AS VARCHAR) AS page_url, "
          "CAST(NULL AS VARCHAR) AS referrer, CAST(NULL AS VARCHAR) AS device_type, CAST(NULL AS VARCHAR) AS browser, "
          "CAST(NULL AS VARCHAR) AS os, CAST(NULL AS VARCHAR) AS country_code, CAST(NULL AS VARCHAR) AS city, "
          "ts + to_microseconds(CAST(round(value * 1000000) AS BIGINT)) AS created_at FROM events")
def s2(spark, sf):
    from eventide.functions.timefns import add_seconds
    raw = D.table(spark, sf, "events")
    out = I.bind(raw, {"id": "event_id", "event_time": "ts", "user_id": "user_id", "event_type": "event_type",
                       "properties": "props", "created_at": add_seconds("ts", F.col("value"))})
    return (out.withColumn("event_time", F.col("event_time").cast("timestamp_ntz"))
            .withColumn("created_at", F.col("created_at").cast("timestamp_ntz")))


@register("s3_ingest_defaults",
          f"SELECT event_id AS id, ts AS event_time, {ts(AS_OF)} AS created_at, "
          "CASE WHEN event_id % 2 = 0 THEN props ELSE '{}' END AS properties FROM events")
def s3(spark, sf):
    raw = D.table(spark, sf, "events")
    # odd ids arrive without payload; no row carries created_at
    df = raw.select(F.col("event_id").alias("id"), F.col("ts").alias("event_time"),
                    F.lit(None).cast("timestamp_ntz").alias("created_at"),
                    F.when(F.col("event_id") % 2 == 0, F.col("props")).alias("properties"))
    return I.with_defaults(df, AS_OF).select("id", "event_time", "created_at", "properties")


def _load_to_validate(spark, sf):
    o = D.table(spark, sf, "orders")
    return o.select(F.col("o_custkey").alias("id"), F.col("o_orderdate").alias("event_time"),
                    F.col("o_custkey").cast("string").alias("user_id"),
                    F.col("o_orderkey").cast("string").alias("session_id"),
                    F.col("o_orderpriority").alias("event_type"), F.lit("{}").alias("properties"),
                    F.col("o_orderpriority").alias("device_type"),
                    F.col("o_orderstatus").alias("country_code"),
                    F.col("o_orderdate").alias("created_at"))


_S4_SQL = ("WITH d AS (SELECT o_custkey, o_orderdate FROM orders GROUP BY 1, 2 HAVING count(*) > 1), "
           "r AS (SELECT o.o_custkey AS id, o.o_orderdate AS event_time, concat_ws(',', "
           "CASE WHEN length(o.o_orderpriority) > 10 THEN 'too_long:event_type' END, "
           "CASE WHEN o.o_orderdate < TIMESTAMP '1996-01-01 00:00:00' OR o.o_orderdate >= TIMESTAMP "
           "'2001-01-01 00:00:00' THEN 'no_partition' END, "
           "CASE WHEN d.o_custkey IS NOT NULL THEN 'duplicate_key' END) AS reasons "
           "FROM orders o LEFT JOIN d ON d.o_custkey = o.o_custkey AND d.o_orderdate = o.o_orderdate) ")


def _validated(spark, sf):
    return I.validate(_load_to_validate(spark, sf), max_lengths={"event_type": 10, "device_type": 20,
                                                                 "country_code": 2},
                      time_range=("1996-01-01 00:00:00", "2001-01-01 00:00:00"))


@register("s4_validate_rejected", _S4_SQL + "SELECT * FROM r WHERE reasons <> ''")
def s4(spark, sf):
    _, bad = _validated(spark, sf)
    return bad.select("id", "event_time", F.array_join("reasons", ",").alias("reasons"))


@register("s4_validate_accepted_count", _S4_SQL + "SELECT count(*) AS count FROM r WHERE reasons = ''")
def s4ok(spark, sf):
    ok, _ = _validated(spark, sf)
    return Q.count_rows(ok)


@register("s5_append_partitioned",
          "SELECT strftime(o_orderdate, '%Y_%m') AS event_month, count(*) AS rows, min(o_orderdate) AS first_event "
          "FROM orders GROUP BY 1")
def s5(spark, sf):
    back = _stored_orders(spark, sf)
    return back.groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"),
                                           F.min("event_time").cast("timestamp_ntz").alias("first_event"))


@register("s7_enrich_from_sessions",
          "WITH " + cte(country=True, device=True, page=True, sessions=True) + ", " + SESSIONS_BODY +
          " SELECT e.id, e.session_id, s.device_type, s.country_code, "
          "CASE WHEN e.event_type IN ('purchase', 'signup') THEN 'conversion' ELSE 'engagement' END AS kind, "
          "CAST(to_json({'event_type': e.event_type, 'user_id': e.user_id}) AS VARCHAR) AS properties "
          "FROM ev e LEFT JOIN sess s ON s.id = e.session_id")
def s7(spark, sf):
    ev = D.events(spark, sf, country=True, device=True, page=True, sessions=True)
    sess = S.sessions(ev, page_view="view", click="click", form_submit="signup")
    base = ev.select("id", "session_id", "event_type", "user_id")
    kind = F.when(F.col("event_type").isin("purchase", "signup"), "conversion").otherwise("engagement")
    out = I.enrich(base, sess, inherit=("device_type", "country_code"), derived={"kind": kind},
                   payload=("event_type", "user_id"))
    return out.select("id", "session_id", "device_type", "country_code", "kind", "properties")


@register("s8_insert_partial_rows",
          "SELECT '2024_01' AS event_month, count(*) AS rows, count(*) AS default_properties, "
          "count(*) AS default_time FROM events")
def s8(spark, sf):
    raw = D.table(spark, sf, "events")
    rows = raw.select(F.col("event_id").alias("id"), F.col("user_id").cast("string").alias("user_id"),
                      "event_type")
    path = scratch_dir(spark, "insert")
    I.insert_rows(rows, path, AS_OF)
    back = I.read_store(spark, path)
    asof = F.lit(AS_OF).cast("timestamp")
    return back.groupBy("event_month").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(F.col("properties") == "{}").alias("default_properties"),
        F.count_if(F.col("event_time") == asof).alias("default_time"))


# ---- refresh --------------------------------------------------------------

from eventide.queries_rollup import R1_SQL, R2_SQL, R3_SQL, R4_SQL, REFRESH_OPTIONS, stored  # noqa: E402

_SCRIPTED = {"stats_totals": R1_SQL, "stats_hourly": R2_SQL, "stats_daily_users": R3_SQL, "stats_geo_events": R4_SQL}


def _refreshed(spark, sf):
    store = scratch_dir(spark, "rollups")
    ev = D.events(spark, sf, country=True, sessions=True)
    return store, M.refresh_all(spark, ev, store, AS_OF, options=REFRESH_OPTIONS)


@register("m1_refresh_all_hourly", R2_SQL)
def m1(spark, sf):
    return M.read_rollup(spark, _refreshed(spark, sf)[0], "stats_hourly")


@register("m1_refresh_totals", R1_SQL)
def m1_totals(spark, sf):
    return stored(spark, sf, "stats_totals")


@register("m1_refresh_daily_users", R3_SQL)
def m1_daily(spark, sf):
    return stored(spark, sf, "stats_daily_users")


@register("m1_refresh_geo", R4_SQL)
def m1_geo(spark, sf):
    return stored(spark, sf, "stats_geo_events")


@register("m1_refresh_rows",
          " UNION ALL ".join(f"SELECT '{n}' AS rollup, 1 AS version, (SELECT count(*) FROM ({q})) AS rows"
                             for n, q in _SCRIPTED.items()))
def m1_rows(spark, sf):
    """Rows of every rollup as counted by the refresh."""
    return _refreshed(spark, sf)[1].select("rollup", F.col("version").cast("int").alias("version"), "rows")


@register("m2_refresh_dates_daily_users", R3_SQL)
def m2(spark, sf):
    store = scratch_dir(spark, "rollups")
    ev = D.events(spark, sf, sessions=True)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    M.refresh_all(spark, ev.where(F.col("event_time") < cut), store, AS_OF, names=["stats_daily_users"])
    dates = M.touched_dates(ev.where(F.col("event_time") >= cut))
    return M.refresh_dates(spark, store, "stats_daily_users", ev, dates, AS_OF)


@register("m3_duplicate_keys",
          "SELECT o_custkey, CAST(o_orderdate AS DATE) AS date, count(*) AS count FROM orders GROUP BY 1, 2 HAVING count(*) > 1")
def m3(spark, sf):
    """Customers with several orders on one day: a table that does have duplicate keys."""
    orders = D.table(spark, sf, "orders").select("o_custkey", F.to_date("o_orderdate").alias("date"))
    return M.duplicate_keys(orders, ["o_custkey", "date"])


@register("m4_freshness",
          "WITH l AS (SELECT 'mv_stats_total' AS view_name, max(ts) AS last_refresh, 3600 AS allowance FROM events "
          "UNION ALL SELECT 'mv_hourly_stats', max(ts), 86400 FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00'), "
          "a AS (SELECT *, date_diff('microsecond', last_refresh, (SELECT max(ts) FROM events)) // 1000000 AS age FROM l) "
          "SELECT view_name, last_refresh, CAST(age AS BIGINT) AS age_seconds, CAST(allowance AS BIGINT) AS allowance_seconds, "
          "CASE WHEN age > allowance THEN 'STALE' ELSE 'FRESH' END AS status FROM a")
def m4(spark, sf):
    """Two rollups refreshed as of the last event they saw; the log read from the manifest."""
    store, ev = scratch_dir(spark, "rollups"), D.events(spark, sf)
    latest = {}
    for name, part in (("mv_hourly_stats", ev.where(F.col("event_time") < F.lit("2024-01-16 00:00:00").cast("timestamp_ntz"))),
                       ("mv_stats_total", ev)):
        latest[name] = part.agg(F.max("event_time")).collect()[0][0]
        M.refresh_all(spark, part, store, str(latest[name]), names=[name], use_cube=False)
    return M.freshness(M.refresh_log(spark, store), str(latest["mv_stats_total"]),
                       {"mv_stats_total": 3600, "mv_hourly_stats": 86400})


@register("m5_rollup_inventory",
          " UNION ALL ".join(f"SELECT '{n}' AS rollup, (SELECT count(*) FROM ({q})) AS rows, TRUE AS has_bytes"
                             for n, q in _SCRIPTED.items()))
def m5(spark, sf):
    found = M.inventory(spark, _refreshed(spark, sf)[0])
    return found.select("rollup", "rows", (F.col("bytes") > 0).alias("has_bytes"))


# ---- operator variants over whole tables ---------------------------------

@register("p3_months_to_create",
          "WITH m AS (SELECT max(o_orderdate) AS hi FROM orders), "
          "cal AS (SELECT unnest(generate_series(date_trunc('month', hi) + INTERVAL 1 MONTH, "
          "date_trunc('month', hi) + INTERVAL 2 MONTH, INTERVAL 1 MONTH)) AS d FROM m) "
          "SELECT 'events_' || strftime(d, '%Y_%m') AS partition_name, CAST(d AS DATE) AS start_date, "
          "CAST(d + INTERVAL 1 MONTH AS DATE) AS end_date FROM cal WHERE NOT EXISTS (SELECT 1 FROM orders o "
          "WHERE 'events_' || strftime(o.o_orderdate, '%Y_%m') = 'events_' || strftime(cal.d, '%Y_%m'))")
def p3b(spark, sf):
    o = D.table(spark, sf, "orders")
    present = P.present_months(o, ts="o_orderdate")
    latest = o.agg(F.max("o_orderdate").alias("hi"))  # maintenance date = the latest order
    return P.months_to_create(latest, present, F.col("hi"), ahead=2)


@register("p4_drop_expired_rewrite",
          "SELECT strftime(o_orderdate, '%Y_%m') AS event_month, count(*) AS rows FROM orders "
          f"WHERE CAST(date_trunc('month', o_orderdate) AS DATE) >= DATE '{ORDERS_AS_OF}' - INTERVAL 12 MONTH "
          "GROUP BY 1")
def p4b(spark, sf):
    kept = P.drop_expired(_stored_orders(spark, sf), scratch_dir(spark, "orders-kept"), ORDERS_AS_OF, 12)
    return kept.groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"))


@register("p4_unexpired_months",
          "SELECT strftime(o_orderdate, '%Y_%m') AS event_month, count(*) AS rows FROM orders "
          f"WHERE CAST(date_trunc('month', o_orderdate) AS DATE) >= DATE '{ORDERS_AS_OF}' - INTERVAL 12 MONTH "
          "GROUP BY 1")
def p4c(spark, sf):
    kept = P.unexpired(_stored_orders(spark, sf), ORDERS_AS_OF, 12)
    return kept.groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"))


@register("p4_maintain_partitions",
          "WITH m AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS d FROM orders), "
          f"c AS (SELECT CAST(unnest(generate_series(date_trunc('month', DATE '{ORDERS_AS_OF}') + INTERVAL 1 MONTH, "
          f"date_trunc('month', DATE '{ORDERS_AS_OF}') + INTERVAL 2 MONTH, INTERVAL 1 MONTH)) AS DATE) AS d), "
          "a AS (SELECT 'create' AS action, d FROM c WHERE d NOT IN (SELECT d FROM m) UNION ALL "
          f"SELECT 'drop', d FROM m WHERE d < DATE '{ORDERS_AS_OF}' - INTERVAL 12 MONTH) "
          "SELECT action, 'events_' || strftime(d, '%Y_%m') AS partition_name, d AS start_date FROM a")
def p4d(spark, sf):
    present = P.present_months(D.table(spark, sf, "orders"), ts="o_orderdate")
    return P.maintain_partitions(spark, present, ORDERS_AS_OF, 12, 2)


@register("fn_stable_uuid",
          "WITH h AS (SELECT event_id AS id, sha256(event_id::VARCHAR || chr(1) || event_type) AS h FROM events) "
          "SELECT id, substr(h, 1, 8) || '-' || substr(h, 9, 4) || '-' || substr(h, 13, 4) || '-' || substr(h, 17, 4) "
          "|| '-' || substr(h, 21, 12) AS key FROM h")
def fn_uuid(spark, sf):
    from eventide.functions.keys import stable_uuid
    return D.table(spark, sf, "events").select(F.col("event_id").alias("id"),
                                               stable_uuid("event_id", "event_type").alias("key"))


@register("s6_stream_rejected",
          "SELECT event_id AS id, 'no_partition' AS reasons FROM events "
          "WHERE ts >= TIMESTAMP '2024-01-15 00:00:00'")
def s6b(spark, sf):
    from eventide.queries_streaming import _canonical_files
    from eventide.streaming import jobs as St
    src = _canonical_files(spark, sf)
    out, bad, ck = scratch_dir(spark, "stream-ok"), scratch_dir(spark, "stream-bad"), scratch_dir(spark, "stream-ck")
    St.stream_ingest(spark, src, out, ck, max_files_per_trigger=2, rejected_path=bad,
                     time_range=("2024-01-01 00:00:00", "2024-01-15 00:00:00"))
    return spark.read.parquet(bad).select("id", "reasons")


@register("m2_refresh_dates_in_place", R3_SQL)
def m2b(spark, sf):
    path = scratch_dir(spark, "rollup-days")
    ev = D.events(spark, sf, sessions=True)
    cut = F.lit("2024-01-16 00:00:00").cast("timestamp_ntz")
    M.write_partitioned(R.stats_daily_users(ev.where(F.col("event_time") < cut)), path, "date")
    dates = M.touched_dates(ev.where(F.col("event_time") >= cut))
    return M.refresh_dates_in_place(spark, path, "stats_daily_users", ev, dates, AS_OF).drop("day")


# Hourly counts whose day 10 was first loaded with some events under a wrong type; day 11 is refreshed without a change.
_WRONG = "CASE WHEN CAST(ts AS DATE) = DATE '2024-01-10' AND event_id % 3 = 0 THEN 'mistyped' ELSE event_type END"
_HOURLY = ("SELECT date_trunc('hour', ts) AS hour, {t} AS event_type, count(*) AS event_count, "
           "count(DISTINCT user_id) AS unique_users FROM events {w} GROUP BY 1, 2")
_TWO_DAYS = "WHERE CAST(ts AS DATE) IN (DATE '2024-01-10', DATE '2024-01-11')"


def _corrected(spark, sf):
    store, ev = scratch_dir(spark, "rollup-days"), D.events(spark, sf)
    wrong = (F.to_date("event_time") == F.lit("2024-01-10").cast("date")) & (F.col("id") % 3 == 0)
    first = ev.withColumn("event_type", F.when(wrong, "mistyped").otherwise(F.col("event_type")))
    M.write_days(spark, store, "mv_hourly_stats", first, AS_OF)
    return store, M.refresh_changed(spark, store, "mv_hourly_stats", ev, ["2024-01-10", "2024-01-11"], AS_OF)


@register("m2_refresh_changed_days",
          f"WITH o AS ({_HOURLY.format(t=_WRONG, w=_TWO_DAYS)}), n AS ({_HOURLY.format(t='event_type', w=_TWO_DAYS)}), "
          "j AS (SELECT strftime(coalesce(n.hour, o.hour), '%Y-%m-%d') AS day, o.hour AS ok, n.hour AS nk, "
          "o.event_count = n.event_count AND o.unique_users = n.unique_users AS eq FROM o FULL JOIN n "
          "ON o.hour = n.hour AND o.event_type = n.event_type) "
          "SELECT day, count_if(ok IS NULL) AS new, count_if(ok IS NOT NULL AND nk IS NOT NULL AND NOT eq) AS changed, "
          "count_if(nk IS NULL) AS gone, count_if(eq) AS same, count_if(eq IS NOT TRUE) > 0 AS written FROM j GROUP BY day")
def m2_changed(spark, sf):
    """Rows that a refresh of two days found new, changed, gone and the same."""
    return _corrected(spark, sf)[1]


@register("m2_refresh_changed_rows", _HOURLY.format(t="event_type", w=""))
def m2_changed_rows(spark, sf):
    """The whole rollup after the correction."""
    from eventide.operators import parts
    return parts.read(spark, _corrected(spark, sf)[0], "mv_hourly_stats")


@register("m2_refresh_changed_folders",
          "SELECT 2 AS version, count(DISTINCT CAST(ts AS DATE)) AS days, 1 AS days_written, count(*) AS rows FROM ("
          + _HOURLY.format(t="event_type", w="") + ") h(ts, event_type, event_count, unique_users)")
def m2_changed_folders(spark, sf):
    """Of all days of the new version one is in a folder of its own; the others keep the first version's."""
    from eventide.operators import parts
    store = _corrected(spark, sf)[0]
    m = parts.published(spark, store)
    now = m.where("part IS NOT NULL AND version = 2")
    before = m.where("part IS NOT NULL AND version = 1").select("path").withColumn("kept", F.lit(True))
    return now.join(before, "path", "left").agg(
        F.max("version").cast("int").alias("version"), F.count(F.lit(1)).alias("days"),
        F.count_if(F.col("kept").isNull()).cast("int").alias("days_written"), F.sum("rows").alias("rows"))


@register("s7_enrich_inner_subscript",
          "WITH " + cte(sessions=True) + ", s AS (SELECT DISTINCT session_id AS id, user_id FROM ev WHERE id % 3 <> 0) "
          "SELECT ev.id, ev.session_id, s.user_id, (['google', 'facebook', 'twitter'])[CAST(ev.id % 5 AS INTEGER) + 1] AS utm_source "
          "FROM ev JOIN s ON s.id = ev.session_id")
def s7_inner(spark, sf):
    """Only events of known sessions; a column picked from a constant array by subscript (null outside it)."""
    ev = D.events(spark, sf, sessions=True)
    known = ev.where(F.col("id") % 3 != 0).select(F.col("session_id").alias("id"), "user_id").distinct()
    out = I.enrich(ev.select("id", "session_id"), known, inherit=("user_id",), how="inner",
                   derived={"utm_source": I.pick(["google", "facebook", "twitter"], F.col("id") % 5 + 1)})
    return out.select("id", "session_id", "user_id", "utm_source")


@register("s1_typed_csv_parquet", _BOUND_SQL + " UNION ALL " + _BOUND_SQL)
def s1_formats(spark, sf):
    """The same load from CSV and from Parquet files."""
    raw = D.table(spark, sf, "events")
    bound = I.bind(raw, {"id": "event_id", "event_time": "ts", "user_id": "user_id", "event_type": "event_type", "properties": "props"})
    csv, parquet = scratch_dir(spark, "csv-load"), scratch_dir(spark, "parquet-load")
    bound.write.mode("errorifexists").option("header", True).option("timestampFormat", I.TS_FORMAT).option("escape", '"').csv(csv)
    bound.write.mode("errorifexists").parquet(parquet)
    both = I.read_events(spark, csv, fmt="csv", escape='"').unionByName(I.read_events(spark, parquet))
    return both.select("id", F.col("event_time").cast("timestamp_ntz").alias("event_time"), "user_id", "event_type", "properties")


_BROKEN = "'{\"id\": \"x' || event_id || '\", \"event_type\": 1'"


@register("s1_corrupt_records",
          f"SELECT CASE WHEN event_id % 50 = 0 THEN 'none' ELSE CAST(event_id AS VARCHAR) END AS id, "
          f"CASE WHEN event_id % 50 = 0 THEN {_BROKEN} ELSE '' END AS broken FROM events")
def s1_corrupt(spark, sf):
    """Records that do not fit keep their text; the others load."""
    raw = D.table(spark, sf, "events")
    line = F.when(F.col("event_id") % 50 == 0, F.concat(F.lit('{"id": "x'), F.col("event_id").cast("string"), F.lit('", "event_type": 1'))
                  ).otherwise(F.to_json(F.struct(F.col("event_id").alias("id"), "event_type")))
    path = scratch_dir(spark, "json-broken")
    raw.select(line.alias("value")).write.mode("errorifexists").text(path)
    back = I.read_events(spark, path, fmt="json", corrupt="broken")
    return back.select(F.coalesce(F.col("id").cast("string"), F.lit("none")).alias("id"), F.coalesce("broken", F.lit("")).alias("broken"))


@register("p7_zoned_bound", "SELECT count(*) AS count FROM orders WHERE o_orderdate >= TIMESTAMP '2001-01-31 23:00:00'")
def p7_zoned(spark, sf):
    """A bound with a zone is an instant: one o'clock in its zone on the first of a month prunes from the month before."""
    return Q.count_rows(Q.in_window(_stored_orders(spark, sf), "2001-02-01T00:00:00+01:00"))


@register("p7_subquery_bound",
          "SELECT count(*) AS count FROM orders WHERE o_orderdate >= (SELECT max(o_orderdate) - INTERVAL 12 MONTH FROM orders)")
def p7_subquery(spark, sf):
    """The last twelve months before the latest order: a bound known only when the query runs prunes months too."""
    latest = D.table(spark, sf, "orders").agg(F.add_months(F.to_date(F.max("o_orderdate")), -12).cast("timestamp").alias("lo")).scalar()
    return Q.count_rows(Q.in_window(_stored_orders(spark, sf), latest))


@register("p5_bytes_from_listing",
          "SELECT DISTINCT 'events_' || strftime(o_orderdate, '%Y_%m') AS partition_name, TRUE AS has_files, TRUE AS has_bytes FROM orders")
def p5_listing(spark, sf):
    """Partitions of the store with their size, from the file listing."""
    path = scratch_dir(spark, "orders-store")
    I.append_events(_orders_as_events(spark, sf), path)
    found = P.partition_bytes(spark, path)
    return found.select("partition_name", (F.col("files") > 0).alias("has_files"), (F.col("total_size") > 0).alias("has_bytes"))
