"""Rollup store: versioned full/incremental refresh, key check, freshness
and inventory (M1-M5).

Layout under ``store``:
    <name>/v000001-<id>/…parquet one directory per version (never modified)
    _manifest/…parquet           append-only rows (rollup, version, path,
                                  rows, refreshed_at)

A version becomes visible when its manifest row is committed, which
happens after its data files are committed, so readers always see a
complete version and never a half-written one; nothing is overwritten or
deleted in place.  A full refresh publishes all its rollups in one
manifest append, so they switch together.  All paths live in the shared store (on a cluster: the
folder named by ``spark.checkpoint.dir`` or a table location), never in a
machine-local folder.
"""

from __future__ import annotations

import time
import uuid
from collections.abc import Mapping, Sequence
from datetime import date, datetime, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession, functions as F

from eventide.functions.timefns import ts_literal
from eventide.operators import parts
from eventide.operators import rollups as R
from eventide.operators.queries import in_window
from eventide.plans.broadcast import bounded_broadcast
from eventide.plans.lineage import materialize

MANIFEST = "_manifest"
MANIFEST_SCHEMA = "rollup string, version long, path string, rows long, refreshed_at timestamp_ntz"

# Rollups keyed by a day (or hour) column: those can be refreshed per date.
DATE_KEY = {
    "stats_hourly": "hour", "stats_daily_users": "date", "stats_geo_events": "date",
    "daily_event_stats": "date", "user_engagement_summary": "date", "mv_hourly_stats": "hour",
}
# Rows of each version are sorted by its time key inside every file (the
# ORDER BY of a materialized view as a physical hint): Parquet min/max then
# prunes row groups for the time-window queries over the rollup.
SORT_KEYS = {
    "stats_hourly": ("hour", "event_type"), "stats_daily_users": ("date", "user_id"),
    "stats_geo_events": ("date", "country_code"), "daily_event_stats": ("date", "event_type"),
    "user_engagement_summary": ("date", "user_id"), "mv_hourly_stats": ("hour", "event_type"),
}
# Sliding rollups drop dates older than as_of - days on every refresh.
SLIDING_DAYS = {"daily_event_stats": 90, "user_engagement_summary": 30}


def _manifest(spark: SparkSession, store: str) -> DataFrame | None:
    try:
        return spark.read.schema(MANIFEST_SCHEMA).parquet(f"{store}/{MANIFEST}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":     # no manifest yet
            return None
        raise


def current_version(spark: SparkSession, store: str, name: str):
    """(version, path) of the newest committed version, or None."""
    m = _manifest(spark, store)
    if m is None:
        return None
    row = (m.where(F.col("rollup") == name).orderBy(F.desc("version"), F.desc("refreshed_at"), F.desc("path")).select("version", "path").limit(1).collect())
    return (row[0][0], row[0][1]) if row else None


def read_rollup(spark: SparkSession, store: str, name: str) -> DataFrame:
    cur = current_version(spark, store, name)
    if cur is None:
        raise FileNotFoundError(f"rollup {name} has no committed version in {store}")
    return spark.read.parquet(cur[1])


def _write_version(store: str, name: str, df: DataFrame, version: int, sort_cols=()) -> tuple[str, int]:
    """Write one version directory (invisible until published); its path and
    its rows, counted while they are written.

    The directory name carries a unique suffix: if a refresh dies after
    writing data but before publishing, the orphan stays invisible and a
    rerun writes a fresh directory for the same version number.
    """
    path = f"{store}/{name}/v{version:06d}-{uuid.uuid4().hex[:8]}"
    out = df.sortWithinPartitions(*sort_cols) if sort_cols else df
    seen = Observation()
    out.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode("errorifexists").parquet(path)
    return path, int(seen.get.get("rows") or 0)


def _publish(spark: SparkSession, store: str, entries, as_of) -> None:
    """Append one manifest row per (name, version, path, rows) in one small write:
    all listed versions become visible together."""
    ts = str(as_of) if as_of is not None else datetime.utcnow().strftime("%Y-%m-%d %H:%M:%S")
    when = datetime.fromisoformat(ts)
    rows = [(name, version, path, n, when) for name, version, path, n in entries]
    spark.createDataFrame(rows, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(f"{store}/{MANIFEST}")


def _versions(spark: SparkSession, store: str) -> dict[str, int]:
    """Newest version per rollup (the manifest has one row per version)."""
    m = _manifest(spark, store)
    if m is None:
        return {}
    return {r[0]: r[1] for r in m.groupBy("rollup").agg(F.max("version")).collect()}


def _build(name: str, src: DataFrame, as_of, options: Mapping) -> DataFrame:
    fn = R.PRESETS[name]
    kw = dict(options.get(name, {}))
    if name in ("stats_totals", "mv_stats_total"):
        return fn(src, as_of, **kw)
    if name in SLIDING_DAYS:
        return fn(src, as_of, kw.pop("days", SLIDING_DAYS[name]), **kw)
    return fn(src, **kw)


def refresh_all(spark: SparkSession, events: DataFrame, store: str, as_of,
                names: Sequence[str] = ("stats_totals", "stats_hourly", "stats_daily_users", "stats_geo_events"),
                options: Mapping[str, Mapping] | None = None, use_cube: bool = True,
                parallel: int = 8) -> DataFrame:
    """M1: full refresh of ``names`` in order; returns (rollup, version, rows, seconds)
    (bytes per rollup: :func:`inventory`).  The new versions are
    published together by one manifest append after all are written.

    With ``use_cube`` the raw events are scanned once into the hourly base
    cube, which is written as Parquet to the shared folder (a lost executor
    does not lose it; later scans are columnar) and from which every rollup
    is derived.
    """
    options = options or {}
    src = materialize(R.base_cube(events), "cube") if use_cube else events
    versions = _versions(spark, store)

    def one(name):
        t0 = time.time()
        version = versions.get(name, 0) + 1
        path, n = _write_version(store, name, _build(name, src, as_of, options), version, SORT_KEYS.get(name, ()))
        return (name, version, path, n), (name, version, n, round(time.time() - t0, 3))

    if parallel > 1 and len(names) > 1:
        # Independent jobs over the same cube: submitted concurrently, the
        # scheduler interleaves their tasks, so small rollups do not wait
        # behind big ones and per-job latency overlaps.
        from concurrent.futures import ThreadPoolExecutor
        with ThreadPoolExecutor(max_workers=min(parallel, len(names))) as pool:
            done = list(pool.map(one, names))
    else:
        done = [one(n) for n in names]
    entries = [d[0] for d in done]
    report = [d[1] for d in done]
    _publish(spark, store, entries, as_of)
    return spark.createDataFrame(report, "rollup string, version long, rows long, seconds double")


def touched_dates(load: DataFrame, ts: str = "event_time") -> list[str]:
    """The dates a load touched (one short row per date reaches the driver)."""
    days = load.select(F.to_date(ts).alias("d")).where("d IS NOT NULL").distinct()
    return sorted(str(r["d"]) for r in days.collect())


def on_dates(events: DataFrame, dates: Sequence[str], ts: str = "event_time") -> DataFrame:
    """Events of the given dates; the time range and months reach the scan."""
    if not dates:
        return events.where(F.lit(False))
    last = date.fromisoformat(max(dates)) + timedelta(days=1)
    return (in_window(events, f"{min(dates)} 00:00:00", f"{last} 00:00:00", ts=ts)
            .where(F.to_date(ts).isin(*[F.lit(d).cast("date") for d in dates])))


def refresh_dates(spark: SparkSession, store: str, name: str, events: DataFrame, dates: Sequence[str],
                  as_of, options: Mapping[str, Mapping] | None = None) -> DataFrame:
    """M2: incremental refresh of the given dates of a date-keyed rollup.

    Distinct counts cannot be added, so touched dates are recomputed in
    full from the events of those dates; the new version = old rows of the
    untouched (and, for sliding rollups, unexpired) dates plus the
    recomputed rows.  Readers of the old version are undisturbed.
    """
    options = options or {}
    if name not in DATE_KEY:
        raise ValueError(f"{name} has no date key; use refresh_all")
    key = DATE_KEY[name]
    dates = sorted(set(str(d)[:10] for d in dates))
    date_lits = [F.lit(d).cast("date") for d in dates]
    old = read_rollup(spark, store, name)
    old_day = F.to_date(F.col(key))
    kept = old.where(~old_day.isin(*date_lits))
    if name in SLIDING_DAYS:
        days = options.get(name, {}).get("days", SLIDING_DAYS[name])
        lo = F.date_sub(F.lit(str(as_of)[:10]).cast("date"), days)
        kept = kept.where(old_day >= lo)
    fresh = _build(name, on_dates(events, dates), as_of, options)
    new = kept.unionByName(fresh.select(*old.columns))
    version = current_version(spark, store, name)[0] + 1
    _publish(spark, store, [(name, version, *_write_version(store, name, new, version, SORT_KEYS.get(name, ())))],
             as_of)
    return read_rollup(spark, store, name)


# Unique keys of the date-keyed rollups.
UNIQUE_KEYS = {
    "stats_hourly": ("hour", "event_type", "country_code"), "stats_daily_users": ("date", "user_id"),
    "stats_geo_events": ("date", "country_code", "event_type"), "daily_event_stats": ("date", "event_type", "country_code"),
    "user_engagement_summary": ("user_id", "date"), "mv_hourly_stats": ("hour", "event_type"),
}


def write_days(spark: SparkSession, store: str, name: str, events: DataFrame, as_of,
               options: Mapping[str, Mapping] | None = None) -> int:
    """A date-keyed rollup published by day (see :mod:`eventide.operators.parts`), for :func:`refresh_changed`."""
    df = _build(name, events, as_of, options or {})
    return parts.write(spark, store, name, df, parts.day_part(F.col(DATE_KEY[name])), as_of, SORT_KEYS.get(name, ()))


def refresh_changed(spark: SparkSession, store: str, name: str, events: DataFrame, dates: Sequence[str], as_of,
                    options: Mapping[str, Mapping] | None = None) -> DataFrame:
    """M2, copy-on-write by day: only days whose rows changed are written.

    The given dates are recomputed in full (distinct counts do not add up) and compared with their stored rows
    on the rollup's unique key.  Days without a change keep their folder in the next version, as do all
    other days; sliding rollups let go of expired days without writing.  Returns one row per date
    that has rows: day, new, changed, gone, same, written.
    """
    key, dates = DATE_KEY[name], sorted(set(str(d)[:10] for d in dates))
    part = parts.day_part(F.col(key))
    fresh = materialize(_build(name, on_dates(events, dates), as_of, options or {}), "refresh-days")
    known = parts.version_rows(spark, store, name)
    old = parts.read(spark, store, name, parts=dates, rows=known)
    diff = parts.row_changes(old, fresh.select(*old.columns), UNIQUE_KEYS[name])
    kinds = ("new", "changed", "gone", "same")
    report = diff.groupBy(part.alias("day")).agg(*[F.count_if(F.col("change") == k).alias(k) for k in kinds]).collect()
    touched = [r["day"] for r in report if r["new"] or r["changed"] or r["gone"]]
    expired = []
    if name in SLIDING_DAYS:
        days = (options or {}).get(name, {}).get("days", SLIDING_DAYS[name])
        lo = str(date.fromisoformat(str(as_of)[:10]) - timedelta(days=days))
        expired = [r["part"] for r in known[1:] if r["part"] != parts.NONE and r["part"] < lo]
    counts = {r["day"]: r["new"] + r["changed"] + r["same"] for r in report if r["day"] in touched and r["day"] not in expired}
    parts.replace(spark, store, name, fresh.where(part.isin(list(counts))), [*touched, *expired], part, as_of, SORT_KEYS.get(name, ()),
                  counts=counts, old=known)
    return spark.createDataFrame([(r["day"], *[r[k] for k in kinds], r["day"] in touched) for r in report],
                                 "day string, new long, changed long, gone long, same long, written boolean")


def refresh_dates_in_place(spark: SparkSession, path: str, name: str, events: DataFrame, dates: Sequence[str],
                           as_of, options: Mapping[str, Mapping] | None = None,
                           partition_col: str = "day") -> DataFrame:
    """M2, in-place variant for a rollup table stored partitioned by day.

    Recomputes the touched dates and replaces exactly those day partitions
    (dynamic partition overwrite); the cost is proportional to the touched
    dates, not to the table.  Only for tables nobody reads during the
    refresh — readers could see a day between delete and rewrite.  Use
    :func:`refresh_dates` (new version) otherwise.
    """
    if name not in DATE_KEY:
        raise ValueError(f"{name} has no date key")
    key = DATE_KEY[name]
    dates = sorted(set(str(d)[:10] for d in dates))
    fresh = _build(name, on_dates(events, dates), as_of, options or {}).withColumn(partition_col, F.to_date(F.col(key)))
    (fresh.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy(partition_col).parquet(path))
    return spark.read.parquet(path)


def write_partitioned(df: DataFrame, path: str, key: str, partition_col: str = "day") -> None:
    """Store a date-keyed rollup partitioned by day (for the in-place refresh)."""
    df.withColumn(partition_col, F.to_date(F.col(key))).write.partitionBy(partition_col).parquet(path)


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """M3: key combinations that occur more than once (should be empty)."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("count")).where(F.col("count") > 1)


# Refresh allowances per rollup (5 minutes, hourly, daily, hourly).
ALLOWANCES = {"stats_totals": 300, "stats_hourly": 3600, "stats_daily_users": 86400, "stats_geo_events": 3600}


def freshness(refreshed: DataFrame, as_of, allowances: Mapping[str, int] = ALLOWANCES) -> DataFrame:
    """M4: age since the last refresh against each rollup's allowance.

    ``refreshed`` has (view_name, last_refresh); e.g. from :func:`refresh_log`.
    """
    typ = refreshed.schema["last_refresh"].dataType
    allow = F.create_map(*[x for k, v in allowances.items() for x in (F.lit(k), F.lit(int(v)))])
    age = F.timestamp_diff("SECOND", F.col("last_refresh"), ts_literal(as_of, typ))
    a = allow[F.col("view_name")]
    return refreshed.select("view_name", "last_refresh", age.alias("age_seconds"),
                            a.cast("long").alias("allowance_seconds"),
                            F.when(a.isNull(), "UNKNOWN").when(age > a, "STALE").otherwise("FRESH").alias("status"))


def refresh_log(spark: SparkSession, store: str) -> DataFrame:
    """Latest refresh time per rollup, from the manifest."""
    m = _manifest(spark, store)
    return m.groupBy(F.col("rollup").alias("view_name")).agg(F.max("refreshed_at").alias("last_refresh"))


def file_stats(df: DataFrame) -> DataFrame:
    """(rows, bytes, files) of a file-source DataFrame in one pass: rows are
    counted per file, then files are summed (each file's size once)."""
    per_file = df.groupBy(F.col("_metadata.file_path").alias("f")).agg(
        F.count(F.lit(1)).alias("n"), F.first("_metadata.file_size").alias("s"))
    return per_file.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("rows"),
                        F.coalesce(F.sum("s"), F.lit(0)).cast("long").alias("bytes"),
                        F.count(F.lit(1)).alias("files"))


def _current(m: DataFrame) -> DataFrame:
    """(rollup, version, path, rows) of every rollup's current version, by the rule of :func:`current_version`."""
    newest = F.struct("version", "refreshed_at", "path")
    return m.groupBy("rollup").agg(F.max_by(F.struct("version", "path", "rows"), newest).alias("v")).select("rollup", "v.*")


def folder_bytes(spark: SparkSession, path: str) -> DataFrame:
    """(path, bytes) of the data files under ``path``, from the listing alone: no file is opened.

    The binary file source is pruned to its listing columns, so contents are not read.
    """
    files = (spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path))
    return files.select("path", F.col("length").alias("bytes"))


def inventory(spark: SparkSession, store: str, names: Sequence[str] | None = None) -> DataFrame:
    """M5: rows and bytes of the current version of each rollup, largest first.

    Rows come from the manifest, bytes from the file listing: no rollup is scanned.
    """
    schema, m = "rollup string, rows long, bytes long", _manifest(spark, store)
    if m is None:
        return spark.createDataFrame([], schema)
    latest = _current(m)
    if names:
        latest = latest.where(F.col("rollup").isin(list(names)))
    # One row per rollup (a handful): its version's folder name is in the path of its files.
    folders = latest.select("rollup", "rows", F.element_at(F.split("path", "/"), -1).alias("folder"))
    files = folder_bytes(spark, store).select(F.element_at(F.split("path", "/"), -2).alias("folder"),
                                              F.element_at(F.split("path", "/"), -3).alias("rollup"), "bytes")
    sizes = files.groupBy("rollup", "folder").agg(F.sum("bytes").alias("bytes"))
    out = bounded_broadcast(folders).join(sizes, ["rollup", "folder"], "left")
    return out.select("rollup", "rows", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")).orderBy(F.desc("bytes"), "rollup")
