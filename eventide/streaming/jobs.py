"""Structured Streaming versions of ingest and the hourly rollup.

Both read Spark's file source and continue from a checkpoint in the shared folder.  The rollup uses the file sink, whose
commit log makes each micro-batch exactly-once; ingest writes each batch to partitions of its own and replaces
them if the batch is replayed.
"""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from eventide.functions.timefns import month_key
from eventide.plans.lineage import materialize
from eventide.schema import EVENT_SCHEMA, PRIMARY_KEY
from eventide.sources.ingest import MONTH_COL, checked, with_defaults


def _as_ltz(df: DataFrame, cols=("event_time", "created_at")) -> DataFrame:
    # Event-time watermarks need TIMESTAMP (with time zone semantics).
    for c in cols:
        if c in df.columns and isinstance(df.schema[c].dataType, T.TimestampNTZType):
            df = df.withColumn(c, F.col(c).cast("timestamp"))
    return df


BATCH = "ingest_batch"


def batch_writer(out_path: str, rejected_path: str, *, as_of=None, key=tuple(PRIMARY_KEY), time_range: tuple | None = None):
    """What S6 does with a micro-batch: ``write(batch, batch_id)`` for ``foreachBatch``.

    The batch is read once, into the shared folder; its checks run once over that, and accepted and rejected rows
    are written from their result.  Both stores are partitioned by batch id and a batch replaces its own partitions, so one that is
    replayed after a failure does not double its rows.

    Keys are unique across all batches: those of the batch are held against the accepted rows of other batches in
    the same months and time range (only the key columns of those are read).  The store itself is the memory, so a
    duplicate is found however late it comes, and no state grows with the stream.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = with_defaults(batch, as_of) if as_of is not None else batch
        rows = materialize(rows, "ingest-batch")
        keys = [k for k in key if k in rows.columns]
        taken = earlier_rows(spark, out_path, rows, batch_id) if keys else None
        marked = materialize(checked(rows, key=key, time_range=time_range, taken=taken), "ingest-checked")
        put = lambda df, path, *by: (df.withColumn(BATCH, F.lit(int(batch_id)).cast("long")).write.mode("overwrite")
                                     .option("partitionOverwriteMode", "dynamic").partitionBy(*by, BATCH).parquet(path))
        ok = marked.where(F.size("reasons") == 0).drop("reasons")
        put(ok.withColumn(MONTH_COL, month_key("event_time")).sortWithinPartitions("event_time"), out_path, MONTH_COL)
        put(marked.where(F.size("reasons") > 0).withColumn("reasons", F.array_join("reasons", ",")), rejected_path)
    return write


def earlier_rows(spark: SparkSession, out_path: str, rows: DataFrame, batch_id: int, ts: str = "event_time") -> DataFrame | None:
    """Accepted rows of other batches whose months and times the rows' keys can be in; None if there are none."""
    r = rows.agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"), F.min(month_key(ts)).alias("first"), F.max(month_key(ts)).alias("last")).first()
    if r["lo"] is None:
        return None
    schema = T.StructType([*rows.schema.fields, T.StructField(MONTH_COL, T.StringType()), T.StructField(BATCH, T.LongType())])
    try:
        stored = spark.read.schema(schema).parquet(out_path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":      # the first batch
            return None
        raise
    return stored.where(F.col(MONTH_COL).between(r["first"], r["last"]) & F.col(ts).between(r["lo"], r["hi"]) & (F.col(BATCH) != int(batch_id)))


def stream_ingest(spark: SparkSession, in_path: str, out_path: str, checkpoint: str, *,
                  schema: T.StructType = EVENT_SCHEMA, fmt: str = "parquet", as_of=None,
                  max_files_per_trigger: int | None = None, time_range: tuple | None = None,
                  rejected_path: str | None = None, key=tuple(PRIMARY_KEY), wait: bool = True):
    """Ingest files as they arrive, in micro-batches of at most
    ``max_files_per_trigger`` files, until the input available now is done.

    One query reads the input once.  Each batch gets the ingest defaults and the checks (NOT NULL, lengths, known
    partitions, key unique in the batch and among all rows accepted before); accepted rows go to the month-partitioned
    store, rejected rows (with reasons) to ``rejected_path`` (default: the
    store's path with ``_rejected`` appended), so no row is lost (see :func:`batch_writer`).
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    rejected_path = rejected_path or out_path.rstrip("/") + "_rejected"
    write = batch_writer(out_path, rejected_path, as_of=as_of, key=key, time_range=time_range)
    q = (reader.load(in_path).writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
         .trigger(availableNow=True).start())
    if wait:
        q.awaitTermination()
    return q


def read_ingested(spark: SparkSession, path: str, schema: T.StructType = EVENT_SCHEMA, *, rejected: bool = False) -> DataFrame:
    """The accepted (or rejected) rows of a stream's store, also before the first of them came."""
    extra = [T.StructField("reasons", T.StringType())] if rejected else []
    by = [] if rejected else [T.StructField(MONTH_COL, T.StringType())]
    whole = T.StructType([*schema.fields, *extra, *by, T.StructField(BATCH, T.LongType())])
    try:
        return spark.read.schema(whole).parquet(path)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], whole)
        raise


def hourly_stream_frame(events: DataFrame, lateness: str = "1 hour", *, ts: str = "event_time") -> DataFrame:
    """The M6 aggregation on a streaming (or static) events frame:
    per (hour window, event_type) count and an HLL sketch of users (exact
    distinct counts are not supported on streams; the sketch is mergeable)."""
    ev = _as_ltz(events).withWatermark(ts, lateness)
    agg = (ev.groupBy(F.window(ts, "1 hour").alias("w"), "event_type")
           .agg(F.count(F.lit(1)).alias("event_count"), F.hll_sketch_agg("user_id").alias("users_sketch")))
    return agg.select(F.col("w.start").alias("hour"), "event_type", "event_count", "users_sketch",
                      F.hll_sketch_estimate("users_sketch").alias("unique_users_est"))


def stream_hourly(spark: SparkSession, in_path: str, out_path: str, checkpoint: str, *,
                  schema: T.StructType = EVENT_SCHEMA, fmt: str = "parquet", lateness: str = "1 hour",
                  max_files_per_trigger: int | None = None, wait: bool = True):
    """M6: streaming hourly rollup with a late-data cutoff.

    Append mode: a window is written once, when the watermark (max event
    time seen minus ``lateness``) passes its end; rows older than the
    watermark are dropped.  Windows still open when the input ends stay in
    the checkpointed state until later data closes them.
    """
    reader = spark.readStream.schema(schema).format(fmt)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    out = hourly_stream_frame(reader.load(in_path), lateness)
    q = (out.writeStream.format("parquet").option("checkpointLocation", checkpoint).outputMode("append")
         .trigger(availableNow=True).start(out_path))
    if wait:
        q.awaitTermination()
    return q


def hourly_so_far(spark: SparkSession, out_path: str, checkpoint: str) -> DataFrame:
    """M6 completed: the windows that :func:`stream_hourly` has written and those still open, read from its state.

    The state holds one row per open (hour, event type), with the count and the sketch so far; nothing is recounted.
    """
    closed = spark.read.parquet(out_path)
    state = spark.read.format("statestore").load(checkpoint)
    window, kind = (F.col("key")[f.name] for f in state.schema["key"].dataType.fields)
    count, sketch = (F.col("value")[f.name] for f in state.schema["value"].dataType.fields)
    still = state.select(window["start"].alias("hour"), kind.alias("event_type"), count.alias("event_count"),
                         sketch.alias("users_sketch"), F.hll_sketch_estimate(sketch).alias("unique_users_est"))
    return closed.unionByName(still.select(*closed.columns))
