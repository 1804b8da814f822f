"""Registry: streaming ingest S6 and streaming hourly rollup M6 (round trips)."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.registry import register, D
from eventide.session import scratch_dir
from eventide.sources import ingest as I
from eventide.streaming import jobs as St


def _canonical_files(spark, sf):
    """Driver events written as canonical Parquet files: the stream's input."""
    raw = D.table(spark, sf, "events")
    from eventide.functions.timefns import add_seconds
    bound = I.bind(raw, {"id": "event_id", "event_time": "ts", "user_id": "user_id", "event_type": "event_type",
                         "properties": "props", "session_id": F.concat_ws("-", "user_id", F.lit("0")),
                         "created_at": add_seconds("ts", F.col("value"))})
    path = scratch_dir(spark, "stream-in")
    bound.repartitionByRange("event_time").write.mode("errorifexists").parquet(path)
    return path


@register("s6_stream_ingest",
          "SELECT strftime(ts, '%Y_%m') AS event_month, count(*) AS rows FROM events GROUP BY 1")
def s6(spark, sf):
    src = _canonical_files(spark, sf)
    out, ck = scratch_dir(spark, "stream-out"), scratch_dir(spark, "stream-ckpt")
    St.stream_ingest(spark, src, out, ck, max_files_per_trigger=4)
    back = spark.read.parquet(out)
    return back.groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"))


@register("m6_stream_hourly_closed_windows",
          "WITH m AS (SELECT max(ts) - INTERVAL 1 HOUR AS wm FROM events) "
          "SELECT date_trunc('hour', e.ts) AS hour, e.event_type, count(*) AS event_count FROM events e, m "
          "WHERE date_trunc('hour', e.ts) + INTERVAL 1 HOUR <= m.wm GROUP BY 1, 2")
def m6(spark, sf):
    src = _canonical_files(spark, sf)
    out, ck = scratch_dir(spark, "hourly-out"), scratch_dir(spark, "hourly-ckpt")
    St.stream_hourly(spark, src, out, ck)
    back = spark.read.parquet(out)
    return back.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "event_type", "event_count")


@register("s6_stream_total",
          "SELECT count_if(ts < TIMESTAMP '2024-01-15 00:00:00') AS accepted, "
          "count_if(ts >= TIMESTAMP '2024-01-15 00:00:00') AS rejected, count(*) AS total FROM events")
def s6_total(spark, sf):
    """No row is lost: accepted and rejected add up to the input, without a rejects path given."""
    src = _canonical_files(spark, sf)
    out, ck = scratch_dir(spark, "stream-all"), scratch_dir(spark, "stream-all-ck")
    St.stream_ingest(spark, src, out, ck, max_files_per_trigger=4,
                     time_range=("2024-01-01 00:00:00", "2024-01-15 00:00:00"))
    n = lambda path, name, **kw: St.read_ingested(spark, path, **kw).agg(F.count(F.lit(1)).alias(name))
    ok, bad = n(out, "accepted"), n(out + "_rejected", "rejected", rejected=True)
    one = ok.withColumn("k", F.lit(1)).join(bad.withColumn("k", F.lit(1)), "k")
    return one.select("accepted", "rejected", (F.col("accepted") + F.col("rejected")).alias("total"))


def _two_arrivals(spark, sf):
    """Every tenth event arrives again in a later file, and the stream is started once for each arrival."""
    src = _canonical_files(spark, sf)
    out, ck = scratch_dir(spark, "stream-keys"), scratch_dir(spark, "stream-keys-ck")
    again = spark.read.parquet(src).where(F.col("id") % 10 == 0)
    St.stream_ingest(spark, src, out, ck, max_files_per_trigger=4)
    again.coalesce(1).write.mode("append").parquet(src)
    St.stream_ingest(spark, src, out, ck, max_files_per_trigger=4)
    return out


@register("s6_stream_duplicate_keys", "SELECT event_id AS id, 'duplicate_key' AS reasons FROM events WHERE event_id % 10 = 0")
def s6_duplicates(spark, sf):
    """Keys that an earlier micro-batch has brought are rejected, with the reason."""
    return St.read_ingested(spark, _two_arrivals(spark, sf) + "_rejected", rejected=True).select("id", "reasons")


@register("s6_stream_unique_keys", "SELECT event_id AS id, ts AS event_time FROM events")
def s6_unique(spark, sf):
    """The accepted rows: every key once."""
    rows = St.read_ingested(spark, _two_arrivals(spark, sf))
    return rows.select("id", F.col("event_time").cast("timestamp_ntz").alias("event_time"))


@register("m6_stream_hourly_complete",
          "SELECT date_trunc('hour', ts) AS hour, event_type, count(*) AS event_count, TRUE AS near FROM events GROUP BY 1, 2")
def m6_complete(spark, sf):
    """All hours after the stream: those written and those still open; estimated users within 5 % (or one) of the exact number."""
    src = _canonical_files(spark, sf)
    out, ck = scratch_dir(spark, "hourly-out"), scratch_dir(spark, "hourly-ckpt")
    St.stream_hourly(spark, src, out, ck)
    exact = (spark.read.parquet(src).groupBy(F.date_trunc("hour", "event_time").alias("h"), F.col("event_type").alias("t"))
             .agg(F.count_distinct("user_id").alias("users")))
    found = St.hourly_so_far(spark, out, ck).join(exact, (F.col("hour") == F.col("h")) & (F.col("event_type") == F.col("t")), "left")
    near = F.abs(F.col("unique_users_est") - F.col("users")) <= F.greatest(F.lit(1.0), F.col("users") * 0.05)
    return found.select(F.col("hour").cast("timestamp_ntz").alias("hour"), "event_type", "event_count", near.alias("near"))
