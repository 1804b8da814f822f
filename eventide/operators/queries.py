"""Raw event queries over a time window anchored at ``as_of``.

Windows have a lower bound only (like ``event_time >= NOW() - interval``);
``until`` adds an optional upper bound.  When the frame carries the month
partition column, the matching partition predicate is added explicitly:
Spark does not derive it from the event_time predicate, and with it the
scan lists only the needed month directories (PartitionFilters).
"""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

from eventide.functions.jsonmatch import json_contains, json_text_eq
from eventide.functions.timefns import day_of, ts_literal, interval_micros

MONTH_COL = "event_month"


def _as_dt(as_of) -> datetime:
    if isinstance(as_of, datetime):
        return as_of
    return datetime.fromisoformat(str(as_of))


def window_start(as_of, span: str) -> datetime:
    """as_of minus a fixed span ('7 days', '24 hours', ...), on the driver."""
    return _as_dt(as_of) - timedelta(microseconds=interval_micros(span))


def _month_of(bound, typ: T.DataType) -> str:
    """Month key of a bound; instants are keyed by their UTC month, like the store."""
    at = _as_dt(bound)
    if at.tzinfo is not None and isinstance(typ, T.TimestampType):
        at = at.astimezone(timezone.utc)
    return at.strftime("%Y_%m")


def in_window(df: DataFrame, lo, hi=None, *, ts: str = "event_time", month_col: str = MONTH_COL) -> DataFrame:
    """Rows with lo <= ts (< hi), pruning month partitions when present."""
    typ = df.schema[ts].dataType
    cond = F.col(ts) >= ts_literal(lo, typ)
    if hi is not None:
        cond = cond & (F.col(ts) < ts_literal(hi, typ))
    if month_col in df.columns:
        cond = cond & (F.col(month_col) >= _month_bound(lo, typ))
        if hi is not None:
            cond = cond & (F.col(month_col) <= _month_bound(hi, typ))
    return df.where(cond)


def _month_bound(bound, typ: T.DataType) -> Column:
    """Month key of a bound.  That of a Column, e.g. a scalar subquery, is computed when the query runs: the
    scan then prunes its months by the subquery's result, before it lists files."""
    if isinstance(bound, Column):
        return F.date_format(bound.cast(typ), "yyyy_MM")
    return F.lit(_month_of(bound, typ))


def trailing(df: DataFrame, as_of, span: str, until=None, **kw) -> DataFrame:
    return in_window(df, window_start(as_of, span), until, **kw)


def count_rows(df: DataFrame, name: str = "count") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def q1_total(df: DataFrame) -> DataFrame:
    """Q1: total row count."""
    return count_rows(df)


def q2_recent_count(df: DataFrame, as_of, span: str = "7 days") -> DataFrame:
    """Q2: count in the trailing span."""
    return count_rows(trailing(df, as_of, span))


def q3_by_type(df: DataFrame, as_of, span: str = "24 hours") -> DataFrame:
    """Q3: events per event_type in the trailing span."""
    return trailing(df, as_of, span).groupBy("event_type").agg(F.count(F.lit(1)).alias("count"))


def q4_top_users(df: DataFrame, as_of, span: str = "30 days", n: int = 100) -> DataFrame:
    """Q4: top-n users by events; ties broken by user_id (TakeOrderedAndProject)."""
    agg = trailing(df, as_of, span).groupBy("user_id").agg(F.count(F.lit(1)).alias("events"))
    return agg.orderBy(F.desc("events"), F.asc("user_id")).limit(n)


def q5_json_count(df: DataFrame, pattern, col: str = "properties") -> DataFrame:
    """Q5: count of rows whose JSON payload contains ``pattern``."""
    return count_rows(df.where(json_contains(col, pattern)))


def q6_daily_country(df: DataFrame, as_of, span: str = "7 days", n: int = 50) -> DataFrame:
    """Q6: count per (date, country), newest first, top n (tie: country)."""
    agg = (trailing(df, as_of, span)
           .groupBy(day_of("event_time").alias("date"), "country_code")
           .agg(F.count(F.lit(1)).alias("count")))
    return agg.orderBy(F.desc("date"), F.asc_nulls_first("country_code")).limit(n)


def f1_count_eq(df: DataFrame, col: str, value) -> DataFrame:
    """count with an equality predicate."""
    return count_rows(df.where(F.col(col) == F.lit(value)))


def u1_user_journey(df: DataFrame, user_id, as_of, span: str = "7 days") -> DataFrame:
    """One user's events in the trailing span, newest first."""
    return (trailing(df, as_of, span).where(F.col("user_id") == F.lit(user_id))
            .orderBy(F.desc("event_time"), F.desc("id")))


def u2_session_events(df: DataFrame, session_id) -> DataFrame:
    """All events of one session in time order."""
    return df.where(F.col("session_id") == F.lit(session_id)).orderBy("event_time", "id")


def u3_type_count(df: DataFrame, event_type: str, as_of, span: str = "7 days") -> DataFrame:
    """Count of one event type in the trailing span."""
    return count_rows(trailing(df, as_of, span).where(F.col("event_type") == F.lit(event_type)))


def u5_dau_by_country(df: DataFrame) -> DataFrame:
    """Daily active users per country (exact distinct)."""
    return (df.groupBy(day_of("event_time").alias("date"), "country_code")
            .agg(F.count_distinct("user_id").alias("dau")))


def u6_property_eq(df: DataFrame, key: str, value: str, col: str = "properties") -> DataFrame:
    """Events whose payload property equals a text value (->> semantics)."""
    return df.where(json_text_eq(col, key, value))
