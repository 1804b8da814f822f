"""Registry: raw event queries Q1-Q6, F1, U1-U6, J1."""

from __future__ import annotations

from eventide.operators import queries as Q
from eventide.operators.funnel import funnel
from eventide.registry import register, ts, cte, D, AS_OF, LO_24H, LO_7D, LO_30D

JSON_PATTERN = {"k": 69}


@register("q1_total_count", "SELECT count(*) AS count FROM events")
def q1(spark, sf):
    return Q.q1_total(D.events(spark, sf))


@register("q2_count_7d", f"SELECT count(*) AS count FROM events WHERE ts >= {ts(LO_7D)}")
def q2(spark, sf):
    return Q.q2_recent_count(D.events(spark, sf), AS_OF, "7 days")


@register("q3_events_by_type_24h",
          f"SELECT event_type, count(*) AS count FROM events WHERE ts >= {ts(LO_24H)} GROUP BY event_type")
def q3(spark, sf):
    return Q.q3_by_type(D.events(spark, sf), AS_OF, "24 hours")


@register("q4_top_users_30d",
          f"SELECT user_id, count(*) AS events FROM events WHERE ts >= {ts(LO_30D)} "
          "GROUP BY user_id ORDER BY events DESC, user_id LIMIT 100")
def q4(spark, sf):
    return Q.q4_top_users(D.events(spark, sf), AS_OF, "30 days", 100)


@register("q5_json_contains", "SELECT count(*) AS count FROM events WHERE json_contains(props, '{\"k\": 69}')")
def q5(spark, sf):
    return Q.q5_json_count(D.events(spark, sf), JSON_PATTERN)


@register("q5_json_contains_test_true",
          "SELECT count(*) AS count FROM events WHERE json_contains(props, '{\"test\": true}')")
def q5t(spark, sf):
    # The benchmark's own pattern (no driver row carries it: the count is 0,
    # and the text pre-check rejects every row without parsing it).
    return Q.q5_json_count(D.events(spark, sf), {"test": True})


@register("q6_daily_country_7d",
          f"WITH {cte(country=True)} SELECT CAST(event_time AS DATE) AS date, country_code, count(*) AS count "
          f"FROM ev WHERE event_time >= {ts(LO_7D)} GROUP BY 1, 2 ORDER BY date DESC, country_code NULLS FIRST LIMIT 50")
def q6(spark, sf):
    return Q.q6_daily_country(D.events(spark, sf, country=True), AS_OF, "7 days", 50)


@register("f1_count_event_type", "SELECT count(*) AS count FROM events WHERE event_type = 'purchase'")
def f1(spark, sf):
    return Q.f1_count_eq(D.events(spark, sf), "event_type", "purchase")


@register("u1_user_journey_7d",
          f"WITH {cte()} SELECT * FROM ev WHERE user_id = 7 AND event_time >= {ts(LO_7D)}")
def u1(spark, sf):
    return Q.u1_user_journey(D.events(spark, sf), 7, AS_OF, "7 days")


@register("u2_session_events",
          f"WITH {cte(sessions=True)} SELECT * FROM ev WHERE session_id = '7-3'")
def u2(spark, sf):
    return Q.u2_session_events(D.events(spark, sf, sessions=True), "7-3")


@register("u3_type_count_7d",
          f"SELECT count(*) AS count FROM events WHERE event_type = 'purchase' AND ts >= {ts(LO_7D)}")
def u3(spark, sf):
    return Q.u3_type_count(D.events(spark, sf), "purchase", AS_OF, "7 days")


FUNNEL_STEPS = ["view", "click", "purchase"]
_FUNNEL_SQL = f"""
WITH s1 AS (SELECT user_id, min(ts) AS t FROM events WHERE event_type = 'view' GROUP BY user_id),
s2 AS (SELECT e.user_id, min(e.ts) AS t FROM events e JOIN s1 ON e.user_id = s1.user_id
       WHERE e.event_type = 'click' AND e.ts > s1.t AND e.ts <= s1.t + INTERVAL 24 HOUR GROUP BY e.user_id),
s3 AS (SELECT e.user_id, min(e.ts) AS t FROM events e JOIN s2 ON e.user_id = s2.user_id
       WHERE e.event_type = 'purchase' AND e.ts > s2.t AND e.ts <= s2.t + INTERVAL 24 HOUR GROUP BY e.user_id),
c AS (SELECT 1 AS step, 'view' AS event_type, count(*) AS users FROM s1
      UNION ALL SELECT 2, 'click', count(*) FROM s2
      UNION ALL SELECT 3, 'purchase', count(*) FROM s3)
SELECT step, event_type, users,
       round(100.0 * users / nullif(first_value(users) OVER (ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING
             AND UNBOUNDED FOLLOWING), 0), 2) AS conversion
FROM c
"""


@register("u4_funnel_24h", _FUNNEL_SQL)
def u4(spark, sf):
    return funnel(D.events(spark, sf), FUNNEL_STEPS, "24 hours")


@register("u5_dau_by_country",
          f"WITH {cte(country=True)} SELECT CAST(event_time AS DATE) AS date, country_code, "
          "count(DISTINCT user_id) AS dau FROM ev GROUP BY 1, 2")
def u5(spark, sf):
    return Q.u5_dau_by_country(D.events(spark, sf, country=True))


@register("u6_property_eq",
          f"WITH {cte()} SELECT * FROM ev WHERE properties->>'$.k' = '69'")
def u6(spark, sf):
    return Q.u6_property_eq(D.events(spark, sf), "k", "69")


@register("j1_contains_documents",
          "SELECT event_id AS id FROM events WHERE event_type IN ('view', 'click') AND event_id % 5 = 3")
def j1_documents(spark, sf):
    """Containment in documents with members, arrays and objects in arrays, built from columns."""
    from pyspark.sql import functions as F

    from eventide.functions.jsonmatch import json_contains
    n, kind = F.col("id") % 5, F.col("event_type")
    doc = F.to_json(F.struct(
        F.struct(n.alias("n"), F.lit(True).alias("on")).alias("in it"),
        F.array(kind, F.lit("all")).alias("tags"),
        F.array(F.struct(kind.alias("k"), n.cast("double").alias("v")), F.struct(F.lit("z").alias("k"), F.lit(0.5).alias("v"))).alias("list")))
    ev = D.events(spark, sf).withColumn("doc", doc)
    common = json_contains("doc", {"in it": {"n": 3, "on": True}, "tags": ["all"]})
    either = json_contains("doc", {"tags": ["view"], "list": [{"v": 3}]}) | json_contains("doc", {"list": [{"v": 0.5, "k": "z"}, {"k": "click"}]})
    return ev.where(common & either).select("id")


@register("u6_stored_variant", "SELECT count(*) AS count, count(DISTINCT user_id) AS users FROM events WHERE props->>'$.k' = '69'")
def u6_variant(spark, sf):
    """The payload stored as Variant: the lookup reads one field of a parsed column."""
    from pyspark.sql import functions as F

    from eventide.functions.jsonmatch import member_eq, to_payload
    from eventide.plans.lineage import materialize
    stored = materialize(to_payload(D.events(spark, sf), "properties"), "variant-store")
    return stored.where(member_eq("properties", "k", 69)).agg(F.count(F.lit(1)).alias("count"), F.count_distinct("user_id").alias("users"))
