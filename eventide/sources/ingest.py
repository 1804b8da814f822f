"""Typed load, binding, defaults, validation and partitioned append."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from eventide.functions.timefns import month_key, ts_literal
from eventide.schema import EVENT_SCHEMA, MAX_LENGTHS, NOT_NULL, PRIMARY_KEY

MONTH_COL = "event_month"
# Text timestamps keep microseconds (the default JSON/CSV format keeps millis).
TS_FORMAT = "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"
# On reading, the fraction may be absent or have three or six digits.
TS_READ_FORMAT = "yyyy-MM-dd'T'HH:mm:ss[.SSSSSS][.SSS]XXX"


def read_events(spark: SparkSession, path: str, fmt: str = "parquet",
                schema: T.StructType = EVENT_SCHEMA, corrupt: str | None = None, **options) -> DataFrame:
    """Read with the fixed canonical schema (no inference, fixed order).

    A text record that does not fit fails the load; with ``corrupt`` (a column name) it is kept
    instead, its text in that column and the fields that fit.
    """
    read_as = T.StructType([*schema.fields, T.StructField(corrupt, T.StringType())]) if corrupt else schema
    reader = spark.read.schema(read_as)
    if fmt in ("json", "csv"):
        reader = reader.option("timestampFormat", TS_READ_FORMAT).option("mode", "PERMISSIVE" if corrupt else "FAILFAST")
        if corrupt:
            reader = reader.option("columnNameOfCorruptRecord", corrupt)
    reader = reader.options(**options)
    if fmt == "csv":
        reader = reader.option("header", options.get("header", "true"))
    df = reader.format(fmt).load(path)
    if corrupt and fmt not in ("json", "csv"):
        df = df.withColumn(corrupt, F.lit(None).cast("string"))
    return df.select(*[f.name for f in read_as.fields])


def bind(df: DataFrame, mapping: Mapping[str, str | Column], schema: T.StructType = EVENT_SCHEMA,
         keep_extra: Sequence[str] = ()) -> DataFrame:
    """Project source columns onto the canonical schema (rename + cast);
    canonical columns without a source become typed NULLs."""
    cols = []
    for f in schema.fields:
        src = mapping.get(f.name)
        if src is None:
            c = F.lit(None)
        else:
            c = F.col(src) if isinstance(src, str) else src
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols, *keep_extra)


def with_defaults(df: DataFrame, as_of, properties_default: str = "{}") -> DataFrame:
    """S3: event_time/created_at default to the load time, properties to '{}'."""
    out = df
    for c in ("event_time", "created_at"):
        if c in df.columns:
            out = out.withColumn(c, F.coalesce(F.col(c), ts_literal(as_of, df.schema[c].dataType)))
    if "properties" in df.columns:
        out = out.withColumn("properties", F.coalesce(F.col("properties"), F.lit(properties_default)))
    return out


def checked(df: DataFrame, *, not_null: Sequence[str] = tuple(NOT_NULL),
            max_lengths: Mapping[str, int] = MAX_LENGTHS, key: Sequence[str] = tuple(PRIMARY_KEY),
            time_range: tuple | None = None, partitions: DataFrame | None = None,
            ts: str = "event_time", taken: DataFrame | None = None) -> DataFrame:
    """S4 as one frame: every row of ``df`` with ``reasons`` (array of strings, empty if it is accepted).

    Rules: NOT NULL columns, maximum text lengths, key unique within the
    load (every copy of a repeated key is rejected), event time inside the
    known partitions — a range ``time_range=(lo, hi)`` or a ``partitions``
    calendar (``partition_name`` column, one row per month, broadcast) — and key not among ``taken``
    (rows with the key columns that were accepted before).  Key counts come from an aggregation
    (map-side combined) joined back, so a heavily repeated key is not
    funnelled through a window in one task.
    """
    cols = set(df.columns)
    checks = [F.when(F.col(c).isNull(), F.lit(f"null:{c}")) for c in not_null if c in cols]
    checks += [F.when(F.length(F.col(c)) > n, F.lit(f"too_long:{c}")) for c, n in max_lengths.items() if c in cols]
    if time_range is not None and ts in cols:
        lo, hi = time_range
        typ = df.schema[ts].dataType
        checks.append(F.when((F.col(ts) < ts_literal(lo, typ)) | (F.col(ts) >= ts_literal(hi, typ)),
                             F.lit("no_partition")))
    out = df
    if partitions is not None and ts in cols:
        # One row per month: a calendar, broadcast after its size check.
        from eventide.plans.broadcast import bounded_broadcast
        known = partitions.select(F.col("partition_name").alias("_known")).distinct()
        out = out.join(bounded_broadcast(known), F.concat(F.lit("events_"), month_key(ts)) == F.col("_known"),
                       "left")
        checks.append(F.when(F.col("_known").isNull() & F.col(ts).isNotNull(), F.lit("no_partition")))
    key = [k for k in key if k in cols]
    if key:
        alias = {k: f"_key{i}" for i, k in enumerate(key)}
        keys = df.select(*[F.col(k).alias(a) for k, a in alias.items()], F.lit(1).alias("_here"))
        if taken is not None:
            keys = keys.unionByName(taken.select(*[F.col(k).alias(a) for k, a in alias.items()], F.lit(0).alias("_here")))
        n = F.count(F.lit(1))
        # Keys of this load that occur more than once, or are taken.
        dup = keys.groupBy(*alias.values()).agg(n.alias("_copies"), F.sum("_here").alias("_mine")).where("_copies > 1 AND _mine > 0")
        # Null-safe join so rows with a NULL key part match their copies too.
        cond = [F.col(k).eqNullSafe(F.col(a)) for k, a in alias.items()]
        out = out.join(dup, cond, "left").drop(*alias.values(), "_mine")
        checks.append(F.when(F.col("_copies").isNotNull(), F.lit("duplicate_key")))
    reasons = F.array_compact(F.array(*checks)) if checks else F.array().cast("array<string>")
    out = out.withColumn("reasons", reasons)
    return out.drop(*[c for c in ("_copies", "_known") if c in out.columns])


def validate(df: DataFrame, *, once: bool = False, **rules) -> tuple[DataFrame, DataFrame]:
    """Split a load into (accepted, rejected) by the rules of :func:`checked`; rejected rows carry
    ``reasons``.

    Both sides evaluate the load when they are used.  With ``once`` the checked load is first written to the
    shared folder, so that the load and its checks run one time for both.
    """
    out = checked(df, **rules)
    if once:
        from eventide.plans.lineage import materialize
        out = materialize(out, "checked")
    return out.where(F.size("reasons") == 0).drop("reasons"), out.where(F.size("reasons") > 0)


# Point lookups by user (journey) and by session (session replay) skip row
# groups through Parquet bloom filters on these columns.
BLOOM_COLUMNS = ("user_id", "session_id")


def append_events(df: DataFrame, path: str, *, ts: str = "event_time", month_col: str = MONTH_COL,
                  cluster: int | None = None, mode: str = "append",
                  bloom: tuple[str, ...] = BLOOM_COLUMNS, overwrite_months: bool = False) -> None:
    """Append to a month-partitioned Parquet table (routing by month).

    By default no shuffle is added: each task sorts its rows by (month,
    time) and writes one file per month it holds, so rows inside every file
    are time-ordered and Parquet min/max statistics prune row groups on
    time predicates (what a block-range index gives a row store); skew of
    the input is not concentrated anywhere.  ``cluster=n`` range-partitions
    by (month, time) into n tasks first — fewer, time-disjoint files, at
    the cost of a sampling pass over the input.

    ``overwrite_months=True`` makes a load idempotent per month: the months
    present in ``df`` are replaced (dynamic partition overwrite), others
    are untouched, so re-running a failed or repeated load of whole months
    does not duplicate rows.  Plain append is for new rows only.
    """
    out = df.withColumn(month_col, month_key(ts))
    if cluster:
        out = out.repartitionByRange(int(cluster), month_col, ts)
    out = out.sortWithinPartitions(month_col, ts)
    w = out.write.partitionBy(month_col)
    if overwrite_months:
        w = w.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    else:
        w = w.mode(mode)
    for c in bloom:
        if c in df.columns:
            w = w.option(f"parquet.bloom.filter.enabled#{c}", "true")
    w.parquet(path)


def read_store(spark: SparkSession, path: str, *, footer_aggregates: bool = False) -> DataFrame:
    """Read a table written by append_events (partition column included).

    ``footer_aggregates=True`` reads through the DSv2 Parquet reader, so
    ``count(*)`` — also under a filter on the month column only — is
    answered from file footers without reading any data page (the
    index-only count of a row store).  The switch is scoped to building
    the relation; the session keeps its reader settings.
    """
    if not footer_aggregates:
        return spark.read.parquet(path)
    key = "spark.sql.sources.useV1SourceList"
    old = spark.conf.get(key)
    spark.conf.set(key, ",".join(x for x in old.split(",") if x.strip().lower() != "parquet"))
    try:
        return spark.read.parquet(path)
    finally:
        spark.conf.set(key, old)


def insert_rows(rows: DataFrame, path: str, as_of, schema: T.StructType = EVENT_SCHEMA) -> DataFrame:
    """Append a few rows that carry only some columns: align to the
    canonical schema, fill defaults, append.  Returns the aligned rows."""
    aligned = bind(rows, {c: c for c in rows.columns if c in schema.fieldNames()}, schema)
    aligned = with_defaults(aligned, as_of)
    append_events(aligned, path)
    return aligned


def pick(values: Sequence[str], by: Column) -> Column:
    """Element of a constant array at a one-based subscript; null outside it, as an array subscript gives."""
    return F.get(F.array(*[F.lit(v) for v in values]), by.cast("int") - 1)


def enrich(events: DataFrame, sessions: DataFrame, *, inherit: Sequence[str] = ("user_id", "device_type", "country_code"),
           derived: Mapping[str, Column] | None = None, payload: Sequence[str] = (), how: str = "left") -> DataFrame:
    """Events take user/device/country from their session (session value
    wins when present), gain derived columns (CASE, :func:`pick`) and a JSON payload built
    from columns.  One join on session_id: the sessions side has one row per
    session, so Catalyst/AQE pick broadcast or a shuffle join by its size.
    ``how='inner'`` leaves out events whose session is unknown.
    """
    s_cols = [c for c in inherit if c in sessions.columns]
    s = sessions.select(F.col("id").alias("_sid"), *[F.col(c).alias(f"_s_{c}") for c in s_cols])
    j = events.join(s, events["session_id"] == s["_sid"], how)
    out = j
    for c in s_cols:
        base = F.col(c) if c in events.columns else F.lit(None)
        out = out.withColumn(c, F.coalesce(F.col(f"_s_{c}"), base))
    out = out.drop("_sid", *[f"_s_{c}" for c in s_cols])
    for name, expr in (derived or {}).items():
        out = out.withColumn(name, expr)
    if payload:
        out = out.withColumn("properties", F.to_json(F.struct(*[F.col(c) for c in payload])))
    return out
