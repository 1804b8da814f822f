"""Month-partition lifecycle: calendar, names, missing/expired months,
inventory and ranking.

Partitions are directories ``event_month=YYYY_MM`` of a Parquet table (see
``sources.ingest.append_events``).  The partition *name* of the reference
(``events_YYYY_MM``) is kept as a label; deleting months never removes
files in place: the kept months are rewritten to a new version directory.
"""

from __future__ import annotations

from datetime import date, datetime

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventide.functions.timefns import month_key, month_of_key

PREFIX = "events_"
MONTH_COL = "event_month"


def _date_col(v) -> Column:
    if isinstance(v, Column):
        return v.cast("date")
    if isinstance(v, (date, datetime)):
        v = v.strftime("%Y-%m-%d")
    return F.lit(str(v)[:10]).cast("date")


def month_calendar(spark_or_df, start, end, prefix: str = PREFIX) -> DataFrame:
    """One row per month from month(start) to end inclusive:
    (partition_name, start_date, end_date) with end_date exclusive.

    ``start``/``end`` may be Columns of a one-row DataFrame passed as the
    first argument (e.g. min/max of the data); otherwise literals.
    """
    if isinstance(spark_or_df, SparkSession):
        base = spark_or_df.range(1)
    else:
        base = spark_or_df
    months = F.explode(F.sequence(F.trunc(_date_col(start), "MM"), _date_col(end), F.expr("INTERVAL 1 MONTH")))
    cal = base.select(months.alias("start_date"))
    return cal.select(F.concat(F.lit(prefix), month_key("start_date")).alias("partition_name"),
                      "start_date", F.add_months("start_date", 1).alias("end_date"))


def default_calendar(spark: SparkSession, as_of, back: int = 6, ahead: int = 6, prefix: str = PREFIX) -> DataFrame:
    """P1 default: as_of - back months .. as_of + ahead months (13 rows)."""
    d = _date_col(as_of)
    return month_calendar(spark, F.add_months(d, -back), F.add_months(d, ahead), prefix)


def present_months(df: DataFrame, ts: str = "event_time", month_col: str = MONTH_COL,
                   prefix: str = PREFIX) -> DataFrame:
    """Distinct partition names present in a table (partition column if
    there is one, so that no other column is read, else derived)."""
    m = F.col(month_col) if month_col in df.columns else month_key(ts)
    return df.select(F.concat(F.lit(prefix), m).alias("partition_name")).distinct()


def partition_name(ts: Column | str, prefix: str = PREFIX) -> Column:
    """P2: 'events_YYYY_MM' of a timestamp."""
    return F.concat(F.lit(prefix), month_key(ts))


def partition_start(name: Column | str, prefix: str = PREFIX) -> Column:
    """P2 inverse: first day of the month named by a partition."""
    return month_of_key(name, prefix)


def missing_months(calendar: DataFrame, present: DataFrame) -> DataFrame:
    """Calendar months without a partition (NOT EXISTS)."""
    return calendar.join(present.select("partition_name"), "partition_name", "left_anti")


def months_to_create(spark_or_df, present: DataFrame, as_of, ahead: int = 2,
                     prefix: str = PREFIX) -> DataFrame:
    """P3 maintenance: the months of as_of + 1 .. as_of + ``ahead`` that
    have no partition yet (the monthly "create the next months" job).

    ``as_of`` may be a Column of a one-row DataFrame passed first (e.g. the
    latest event date), as in :func:`month_calendar`."""
    d = _date_col(as_of)
    cal = month_calendar(spark_or_df, F.add_months(d, 1), F.add_months(d, ahead), prefix)
    return missing_months(cal, present)


def expired_months(present: DataFrame, as_of, keep_months: int = 12, prefix: str = PREFIX) -> DataFrame:
    """Partitions whose month starts before as_of - keep_months."""
    cutoff = F.add_months(_date_col(as_of), -keep_months)
    return (present.withColumn("start_date", partition_start("partition_name", prefix))
            .where(F.col("start_date") < cutoff))


def unexpired(df: DataFrame, as_of, keep_months: int = 12, month_col: str = MONTH_COL) -> DataFrame:
    """P4 without copying: the kept months of a partitioned store.  The
    predicate is on the partition column alone, so expired months are not
    read; their folders can be deleted later, when nobody reads them."""
    cutoff = F.add_months(_date_col(as_of), -keep_months)
    return df.where(F.to_date(F.col(month_col), "yyyy_MM") >= cutoff)


def maintain_partitions(spark_or_df, present: DataFrame, as_of, keep_months: int = 12, ahead: int = 2,
                        prefix: str = PREFIX) -> DataFrame:
    """One maintenance call: the months to create ahead and the present ones
    to drop, as (action, partition_name, start_date)."""
    create = months_to_create(spark_or_df, present, as_of, ahead, prefix)
    drop = expired_months(present, as_of, keep_months, prefix)
    cols = ["partition_name", "start_date"]
    return (create.select(F.lit("create").alias("action"), *cols)
            .unionByName(drop.select(F.lit("drop").alias("action"), *cols)))


def drop_expired(df: DataFrame, out_path: str, as_of, keep_months: int = 12,
                 month_col: str = MONTH_COL) -> DataFrame:
    """P4 delete: write the kept months to ``out_path`` (a new version
    directory) and return the kept table read back.  The old version is
    never modified, so readers of it are not disturbed."""
    unexpired(df, as_of, keep_months, month_col).write.mode("errorifexists").partitionBy(month_col).parquet(out_path)
    return df.sparkSession.read.parquet(out_path)


def list_partitions(df: DataFrame, ts: str = "event_time", month_col: str = MONTH_COL,
                    prefix: str = PREFIX, with_bytes: bool = False) -> DataFrame:
    """P5: (partition_name, row_count, first_event, last_event[, total_size])
    ordered by name.  Bytes come from the file metadata of a file source:
    each file counted once."""
    m = F.col(month_col) if month_col in df.columns else month_key(ts)
    name = F.concat(F.lit(prefix), m).alias("partition_name")
    measures = [F.count(F.lit(1)).alias("row_count"), F.min(ts).alias("first_event"), F.max(ts).alias("last_event")]
    if with_bytes:
        # One scan: a row per file, then the files per partition.
        files = df.groupBy(name, F.col("_metadata.file_path").alias("f")).agg(
            *measures, F.first("_metadata.file_size").alias("s"))
        inv = files.groupBy("partition_name").agg(
            F.sum("row_count").cast("long").alias("row_count"), F.min("first_event").alias("first_event"),
            F.max("last_event").alias("last_event"), F.sum("s").cast("long").alias("total_size"))
    else:
        inv = df.groupBy(name).agg(*measures)
    # One row per month: sorted in one task, no global sort needed.
    return inv.coalesce(1).sortWithinPartitions("partition_name")


def partition_bytes(spark: SparkSession, path: str, month_col: str = MONTH_COL, prefix: str = PREFIX) -> DataFrame:
    """P5 from the listing alone: (partition_name, files, total_size) of a stored table; no data file is opened."""
    from eventide.operators.refresh import folder_bytes
    month = F.regexp_extract("path", f"/{month_col}=([^/]+)/", 1)
    inv = (folder_bytes(spark, path).where(month != "").groupBy(F.concat(F.lit(prefix), month).alias("partition_name"))
           .agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("total_size")))
    return inv.coalesce(1).sortWithinPartitions("partition_name")


def partition_ranking(inventory: DataFrame) -> DataFrame:
    """Non-empty partitions ranked by rows (the inventory has one row
    per month, so the ranking window is over a tiny table)."""
    w = Window.orderBy(F.desc("row_count"), F.asc("partition_name"))
    return (inventory.where(F.col("row_count") > 0)
            .withColumn("rank", F.row_number().over(w).cast("long"))
            .withColumn("partitions", F.count(F.lit(1)).over(Window.partitionBy())))
