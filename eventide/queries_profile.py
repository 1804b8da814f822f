"""Registry: distribution profiling V1-V10 and operation-log reports L1-L4."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import oplog as L
from eventide.operators import profile as V
from eventide.registry import register, cte, D


def pct_sql(part: str, whole: str, digits: int = 2) -> str:
    """Oracle twin of functions.exact_pct."""
    sc = 10 ** digits
    return (f"CASE WHEN ({whole}) > 0 THEN CAST((CAST({part} AS HUGEINT) * {200 * sc} + ({whole})) "
            f"// (CAST({whole} AS HUGEINT) * 2) AS DOUBLE) / {float(sc)} END")


def round_sql(x: str, digits: int = 2) -> str:
    """Oracle twin of functions.round_dec."""
    return f"CAST(round(CAST({x} AS DECIMAL(38,10)), {digits}) AS DOUBLE)"


def _share_sql(key: str, source: str = "events", digits: int = 2, prefix: str = "") -> str:
    return (f"{prefix} SELECT {key}, count(*) AS count, "
            f"{pct_sql('count(*)', f'sum(count(*)) OVER ()', digits)} AS pct FROM {source} GROUP BY {key}")


@register("v1_share_by_type", _share_sql("event_type"))
def v1(spark, sf):
    return V.share(D.events(spark, sf), "event_type", 2)


@register("v2_share_by_country", _share_sql("country_code", "ev", 2, f"WITH {cte(country=True)}"))
def v2(spark, sf):
    return V.share(D.events(spark, sf, country=True), "country_code", 2)


@register("v3_count_by_device",
          f"WITH {cte(device=True)} SELECT device_type, count(*) AS count FROM ev GROUP BY device_type")
def v3(spark, sf):
    return V.counts(D.events(spark, sf, device=True), "device_type")


@register("v4_hour_histogram", "SELECT hour(ts) AS hour, count(*) AS count FROM events GROUP BY 1")
def v4(spark, sf):
    return V.hour_histogram(D.events(spark, sf))


@register("v5_top20_users",
          "SELECT user_id, count(*) AS event_count FROM events GROUP BY user_id "
          "ORDER BY event_count DESC, user_id LIMIT 20")
def v5(spark, sf):
    return V.top_n(D.events(spark, sf), "user_id", 20)


@register("v6_pareto_top20pct",
          "WITH u AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id), "
          "r AS (SELECT n, row_number() OVER (ORDER BY n DESC, user_id) AS rk, count(*) OVER () AS total_keys FROM u), "
          "k AS (SELECT CAST(ceil(CAST(max(total_keys) AS DECIMAL(38,10)) * 20.0 / 100) AS BIGINT) AS top_keys, "
          "max(total_keys) AS total_keys FROM r) "
          "SELECT k.top_keys, k.total_keys, CAST(sum(CASE WHEN r.rk <= k.top_keys THEN r.n ELSE 0 END) AS BIGINT) AS top_rows, "
          "CAST(sum(r.n) AS BIGINT) AS total_rows, "
          f"{pct_sql('sum(CASE WHEN r.rk <= k.top_keys THEN r.n ELSE 0 END)', 'sum(r.n)')} AS top_share_pct "
          "FROM r, k GROUP BY k.top_keys, k.total_keys")
def v6(spark, sf):
    return V.pareto(D.events(spark, sf), "user_id", 20.0)


@register("v7_time_share",
          "SELECT count(*) AS total, CAST(count_if(hour(ts) BETWEEN 9 AND 17) AS BIGINT) AS business_hours, "
          "CAST(count_if(isodow(ts) IN (6, 7)) AS BIGINT) AS weekend, "
          f"{pct_sql('count_if(hour(ts) BETWEEN 9 AND 17)', 'count(*)')} AS business_hours_pct, "
          f"{pct_sql('count_if(isodow(ts) IN (6, 7))', 'count(*)')} AS weekend_pct FROM events")
def v7(spark, sf):
    return V.time_share(D.events(spark, sf))


_COUNTED = ["events", "customer", "nation", "orders", "pages"]


@register("v8_row_counts",
          " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS rows FROM {t}" for t in _COUNTED))
def v8(spark, sf):
    return V.row_counts({t: D.table(spark, sf, t) for t in _COUNTED})


@register("v9_report",
          " UNION ALL ".join(f"SELECT 'ROW COUNTS' AS section, 'Total {t}' AS metric, CAST(count(*) AS VARCHAR) AS value "
                             f"FROM {t}" for t in _COUNTED)
          + " UNION ALL SELECT 'PARTITIONS', 'Total partitions', CAST(count(DISTINCT strftime(ts, '%Y_%m')) AS VARCHAR) "
            "FROM events"
          + " UNION ALL SELECT 'DATA RANGE', 'First event', strftime(min(ts), '%Y-%m-%d %H:%M:%S.%f') FROM events"
          + " UNION ALL SELECT 'DATA RANGE', 'Last event', strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') FROM events")
def v9(spark, sf):
    return V.report(D.events(spark, sf), {t: D.table(spark, sf, t) for t in _COUNTED})


# Published event-type weights, mapped through the binding
# (page_view -> view, form_submit -> signup); the other published types
# have no counterpart in the driver data and expect 0 observed.
EXPECTED_TYPES = {"view": 0.60, "click": 0.25, "signup": 0.10, "video_play": 0.03, "download": 0.02}


@register("v10_observed_vs_expected",
          "WITH o AS (" + _share_sql("event_type") + "), "
          "e(event_type, expected_pct) AS (VALUES " +
          ", ".join(f"('{k}', {round(w * 100, 6)})" for k, w in EXPECTED_TYPES.items()) + ") "
          "SELECT coalesce(o.event_type, e.event_type) AS event_type, coalesce(o.pct, 0.0) AS observed_pct, "
          "CAST(coalesce(e.expected_pct, 0.0) AS DOUBLE) AS expected_pct, "
          "round(abs(coalesce(o.pct, 0.0) - CAST(coalesce(e.expected_pct, 0.0) AS DOUBLE)), 2) AS abs_deviation "
          "FROM o FULL JOIN e ON o.event_type = e.event_type")
def v10(spark, sf):
    exp = V.expectation(spark, "event_type", EXPECTED_TYPES)
    return V.compare_share(D.events(spark, sf), "event_type", exp)


# Operation log: event_type stands for the statement, value for its time in ms.
def _stats(spark, sf):
    return L.statement_stats(D.events(spark, sf, keep_value=True), op="event_type", ms="value")


_STATS_SQL = ("st AS (SELECT event_type AS query, count(*) AS calls, sum(value) AS total_exec_time, "
              "avg(value) AS mean_exec_time, max(value) AS max_exec_time, stddev_pop(value) AS stddev_exec_time, "
              "count(*) AS rows, CAST(0 AS BIGINT) AS shared_blks_hit, CAST(0 AS BIGINT) AS shared_blks_read "
              "FROM events GROUP BY event_type)")


@register("l1_slow_operations",
          f"WITH {_STATS_SQL} SELECT left(query, 100) AS query_preview, calls, "
          f"{round_sql('total_exec_time')} AS total_time_ms, {round_sql('mean_exec_time')} AS avg_time_ms, "
          f"{round_sql('max_exec_time')} AS max_time_ms, {round_sql('stddev_exec_time')} AS stddev_time_ms, "
          "rows AS rows_returned, "
          f"{round_sql('100.0 * shared_blks_hit / nullif(shared_blks_hit + shared_blks_read, 0)')} AS cache_hit_ratio "
          "FROM st WHERE query NOT LIKE '%pg_stat_statements%' ORDER BY mean_exec_time DESC, query LIMIT 20")
def l1(spark, sf):
    return L.slow_operations(_stats(spark, sf), 20)


# Fixed binding values: statement classes of the stand-in operation log.
OP_CLASSES = {"PURCHASE": "purchase%", "VIEW": "view%", "CLICK": "click%"}


@register("l2_stats_by_class",
          f"WITH {_STATS_SQL} SELECT CASE " +
          " ".join(f"WHEN query LIKE '{p}' THEN '{c}'" for c, p in OP_CLASSES.items()) +
          " ELSE 'OTHER' END AS query_type, count(*) AS query_count, CAST(sum(calls) AS BIGINT) AS total_calls, "
          f"{round_sql('sum(total_exec_time)')} AS total_time_ms, {round_sql('avg(mean_exec_time)')} AS avg_time_ms, "
          "CAST(sum(rows) AS BIGINT) AS total_rows FROM st WHERE query NOT LIKE '%pg_stat%' GROUP BY 1")
def l2(spark, sf):
    return L.stats_by_class(_stats(spark, sf), OP_CLASSES)


@register("l3_customer_usage_tier",
          "WITH n AS (SELECT user_id, count(*) AS n FROM events GROUP BY user_id) "
          "SELECT c.c_custkey AS id, CAST(coalesce(n.n, 0) AS BIGINT) AS uses, "
          "CASE WHEN coalesce(n.n, 0) = 0 THEN 'UNUSED' WHEN coalesce(n.n, 0) < 70 THEN 'RARELY_USED' "
          "ELSE 'ACTIVE' END AS usage_status FROM customer c LEFT JOIN n ON n.user_id = c.c_custkey")
def l3(spark, sf):
    return L.usage_tier(D.table(spark, sf, "customer"), D.table(spark, sf, "events"),
                        dim_key="c_custkey", fact_key="user_id", lo=70)


@register("l4_hit_ratios",
          "SELECT 'fast operation rate' AS metric, "
          f"{round_sql('100.0 * count_if(value < 10) / nullif(count(*), 0)')} AS ratio FROM events "
          "UNION ALL SELECT 'fulfilled order rate', "
          f"{round_sql(chr(39).join(['100.0 * count_if(o_orderstatus = ', 'F', ') / nullif(count(*), 0)']))} FROM orders "
          "UNION ALL SELECT 'future order rate', "
          f"{round_sql('100.0 * count_if(o_orderdate > TIMESTAMP ' + chr(39) + '2100-01-01' + chr(39) + ') / nullif(count_if(o_orderdate > TIMESTAMP ' + chr(39) + '2100-01-01' + chr(39) + '), 0)')} FROM orders")
def l4(spark, sf):
    ev = D.table(spark, sf, "events")
    orders = D.table(spark, sf, "orders")
    far = F.col("o_orderdate") > F.lit("2100-01-01 00:00:00").cast("timestamp_ntz")
    return L.hit_ratio({
        "fast operation rate": (ev, (F.col("value") < 10).cast("int"), (F.col("value") >= 10).cast("int")),
        "fulfilled order rate": (orders, (F.col("o_orderstatus") == "F").cast("int"),
                                 (F.col("o_orderstatus") != "F").cast("int")),
        # both parts zero: the guarded ratio is NULL, not an error
        "future order rate": (orders, far.cast("int"), F.lit(0)),
    })


_HALF = "((b // {d} + 1) // 2)"
_PRETTY = ("CASE WHEN b < 10240 THEN b || ' bytes' " + " ".join(
    f"WHEN b // {512 * 1024 ** i} < 20479 THEN {_HALF.format(d=512 * 1024 ** i)} || ' {u}'" for i, u in enumerate(["kB", "MB", "GB"]))
    + f" ELSE {_HALF.format(d=512 * 1024 ** 3)} || ' TB' END")


@register("v9_report_sizes",
          "WITH s AS (SELECT event_type AS metric, sum(octet_length(encode(props)) * event_id)::BIGINT AS b FROM events GROUP BY 1) "
          f"SELECT 'DATA SIZE' AS section, metric, {_PRETTY} AS value FROM s")
def v9_sizes(spark, sf):
    """The report's size section (payload bytes per type, weighted so that several units occur)."""
    ev = D.events(spark, sf)
    sizes = ev.groupBy(F.col("event_type").alias("name")).agg(F.sum(F.octet_length("properties") * F.col("id")).alias("bytes"))
    return V.report(ev, {"events": ev}, sizes=sizes).where(F.col("section") == "DATA SIZE")
