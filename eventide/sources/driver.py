"""Binding of the driver's Parquet tables onto the canonical event schema.

The driver's ``events`` table has (event_id, ts, user_id, event_type,
value, props).  The remaining canonical columns come from dimensions:

* country_code  <- customer(c_custkey = user_id) -> nation.n_name
* device_type   <- customer.c_mktsegment
* page_url      <- pages.url at page_id = event_id mod count(pages)
* created_at    <- ts + value seconds
* session_id    <- sessionize(gap = 4 hours)

Only the columns a query asks for are joined in, so a count over events
reads one Parquet file and zero dimension tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from eventide.functions.timefns import add_seconds
from eventide.plans.broadcast import bounded_broadcast

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations")

SESSION_GAP = "4 hours"
AS_OF = "2024-01-31 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def user_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(user_id, country_code, device_type) from customer and nation."""
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    cust = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    dim = cust.join(bounded_broadcast(nation), cust.c_nationkey == nation.n_nationkey, "left")
    return dim.select(F.col("c_custkey").alias("user_id"), F.col("n_name").alias("country_code"),
                      F.col("c_mktsegment").alias("device_type"))


def page_dimension(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "pages").select(F.col("page_id").alias("_page_id"), F.col("url").alias("page_url"))


def events(spark: SparkSession, sf_dir: str, *, country: bool = False, device: bool = False,
           page: bool = False, sessions: bool = False, session_gap: str = SESSION_GAP,
           keep_value: bool = False) -> DataFrame:
    """Canonical events from the driver tables, with only the asked-for joins."""
    raw = table(spark, sf_dir, "events")
    cols = [F.col("event_id").alias("id"), F.col("ts").alias("event_time"), "user_id", "event_type",
            F.col("props").alias("properties"), add_seconds("ts", F.col("value")).alias("created_at")]
    if keep_value:
        cols.append("value")
    df = raw.select(*cols)
    if country or device:
        dim = user_dimension(spark, sf_dir)
        keep = ["user_id"] + (["country_code"] if country else []) + (["device_type"] if device else [])
        df = df.join(bounded_broadcast(dim.select(*keep)), "user_id", "left")
    if page:
        pages = table(spark, sf_dir, "pages")
        n_pages = pages.select(F.count(F.lit(1))).scalar()
        df = df.withColumn("_page_id", F.pmod(F.col("id"), n_pages))
        df = df.join(bounded_broadcast(page_dimension(spark, sf_dir)), "_page_id", "left").drop("_page_id")
    if sessions:
        from eventide.operators.sessions import sessionize
        df = sessionize(df, session_gap)
    return df


# ---------------------------------------------------------------------------
# The same binding as SQL text, for the DuckDB oracle.

def oracle_events_cte(*, country: bool = False, device: bool = False, page: bool = False,
                      sessions: bool = False, session_gap_hours: int = 4, keep_value: bool = False,
                      name: str = "ev") -> str:
    sel = ["e.event_id AS id", "e.ts AS event_time", "e.user_id", "e.event_type", "e.props AS properties",
           "e.ts + to_microseconds(CAST(round(e.value * 1000000) AS BIGINT)) AS created_at"]
    if keep_value:
        sel.append("e.value")
    joins = []
    if country or device:
        joins.append("LEFT JOIN customer c ON c.c_custkey = e.user_id LEFT JOIN nation n ON n.n_nationkey = c.c_nationkey")
        if country:
            sel.append("n.n_name AS country_code")
        if device:
            sel.append("c.c_mktsegment AS device_type")
    if page:
        joins.append("LEFT JOIN pages p ON p.page_id = e.event_id % (SELECT count(*) FROM pages)")
        sel.append("p.url AS page_url")
    base = f"SELECT {', '.join(sel)} FROM events e {' '.join(joins)}"
    if not sessions:
        return f"{name} AS ({base})"
    return (f"{name}_b AS ({base}), "
            f"{name}_f AS (SELECT *, CASE WHEN lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, id) IS NULL "
            f"OR event_time - lag(event_time) OVER (PARTITION BY user_id ORDER BY event_time, id) > INTERVAL {session_gap_hours} HOUR "
            f"THEN 1 ELSE 0 END AS _f FROM {name}_b), "
            f"{name} AS (SELECT * EXCLUDE (_f), CAST(user_id AS VARCHAR) || '-' || CAST(CAST(sum(_f) OVER "
            f"(PARTITION BY user_id ORDER BY event_time, id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS VARCHAR) "
            f"AS session_id FROM {name}_f)")
