"""Canonical schemas of the event store (fixed column order, explicit types)."""

from __future__ import annotations

from pyspark.sql import types as T

# Column order and limits of the canonical events table.
EVENT_SCHEMA = T.StructType([
    T.StructField("id", T.LongType(), False),
    T.StructField("event_time", T.TimestampType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("session_id", T.StringType(), False),
    T.StructField("event_type", T.StringType(), False),
    T.StructField("properties", T.StringType(), False),
    T.StructField("page_url", T.StringType(), True),
    T.StructField("referrer", T.StringType(), True),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("browser", T.StringType(), True),
    T.StructField("os", T.StringType(), True),
    T.StructField("country_code", T.StringType(), True),
    T.StructField("city", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), False),
])

EVENT_COLUMNS = [f.name for f in EVENT_SCHEMA.fields]

# Maximum lengths of the bounded text columns.
MAX_LENGTHS = {
    "event_type": 50,
    "device_type": 20,
    "browser": 50,
    "os": 50,
    "country_code": 2,
    "city": 100,
}

NOT_NULL = [f.name for f in EVENT_SCHEMA.fields if not f.nullable]

PRIMARY_KEY = ["id", "event_time"]

SESSION_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("user_id", T.StringType(), False),
    T.StructField("started_at", T.TimestampType(), False),
    T.StructField("ended_at", T.TimestampType(), True),
    T.StructField("duration_seconds", T.IntegerType(), True),
    T.StructField("page_views", T.IntegerType(), True),
    T.StructField("clicks", T.IntegerType(), True),
    T.StructField("form_submits", T.IntegerType(), True),
    T.StructField("events_count", T.IntegerType(), True),
    T.StructField("landing_page", T.StringType(), True),
    T.StructField("exit_page", T.StringType(), True),
    T.StructField("device_type", T.StringType(), True),
    T.StructField("browser", T.StringType(), True),
    T.StructField("country_code", T.StringType(), True),
    T.StructField("utm_source", T.StringType(), True),
    T.StructField("utm_medium", T.StringType(), True),
    T.StructField("utm_campaign", T.StringType(), True),
    T.StructField("created_at", T.TimestampType(), False),
])

USER_SCHEMA = T.StructType([
    T.StructField("id", T.StringType(), False),
    T.StructField("email", T.StringType(), True),
    T.StructField("first_seen", T.TimestampType(), False),
    T.StructField("last_seen", T.TimestampType(), True),
    T.StructField("total_sessions", T.IntegerType(), True),
    T.StructField("total_events", T.IntegerType(), True),
    T.StructField("country_code", T.StringType(), True),
    T.StructField("signup_date", T.DateType(), True),
    T.StructField("created_at", T.TimestampType(), False),
    T.StructField("updated_at", T.TimestampType(), False),
])

# Input of the operation-log reports (one row per statement class).
STATEMENT_STATS_SCHEMA = T.StructType([
    T.StructField("query", T.StringType(), True),
    T.StructField("calls", T.LongType(), True),
    T.StructField("total_exec_time", T.DoubleType(), True),
    T.StructField("mean_exec_time", T.DoubleType(), True),
    T.StructField("max_exec_time", T.DoubleType(), True),
    T.StructField("stddev_exec_time", T.DoubleType(), True),
    T.StructField("rows", T.LongType(), True),
    T.StructField("shared_blks_hit", T.LongType(), True),
    T.StructField("shared_blks_read", T.LongType(), True),
])

# The event types the rollup of geographic stats keeps.
GEO_EVENT_TYPES = ["page_view", "click", "form_submit", "video_play", "download"]
