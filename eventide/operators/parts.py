"""Tables published in versions of parts: unchanged parts keep their folder.

A version of a table names one folder per part (a day of a rollup, a bucket of a dimension).  A refresh writes
only the parts that change into a fresh folder and publishes the next version, whose other parts point to the folders of
earlier versions.  Nothing is overwritten, so a reader of an older version keeps seeing it, and the cost of a
refresh goes by the parts touched, not by the table.

    <name>/v000002-<id>/__part=<part>/…parquet     the parts written by version 2
    _parts/…parquet                                  append-only rows (name, version, token, part, path, rows, published_at)

A version is one append of its rows to ``_parts``, after its files are there.  One row without a part heads every
version (its path column holds the schema), so an empty version is one too.  Of two writers of the same version number the
later one wins (time, then token); both leave whole versions.
The driver handles one row per part; parts are few by design (days, buckets).
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterable, Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

MANIFEST = "_parts"
SCHEMA = ("name string, version long, token string, part string, path string, rows long, "
          "published_at timestamp_ntz")
PART = "__part"
#: The part of rows without a value to part by.
NONE = "none"


def day_part(day: Column) -> Column:
    """Part of a date (or timestamp): its day."""
    return F.coalesce(F.date_format(day, "yyyy-MM-dd"), F.lit(NONE))


def bucket_part(key: str, buckets: int) -> Column:
    """Part of a key: one of ``buckets`` by hash (null keys have one too)."""
    return F.lpad(F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("string"), 5, "0")


def published(spark: SparkSession, store: str) -> DataFrame | None:
    try:
        return spark.read.schema(SCHEMA).parquet(f"{store}/{MANIFEST}")
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def version_rows(spark: SparkSession, store: str, name: str, version: int | None = None) -> list:
    """Manifest rows of one version (default: the newest), head first; empty if there is none."""
    m = published(spark, store)
    if m is None:
        return []
    m = m.where(F.col("name") == name)
    if version is not None:
        m = m.where(F.col("version") == version)
    # A row per part of every version: the newest token is looked up in the same job.
    newest = m.agg(F.max(F.struct("version", "published_at", "token")).alias("v")).select("v.token").scalar()
    return sorted(m.where(F.col("token") == newest).collect(), key=lambda r: (r["part"] is not None, r["part"] or ""))


def schema_of(rows: list) -> T.StructType:
    return T.StructType.fromJson(json.loads(rows[0]["path"]))


def read(spark: SparkSession, store: str, name: str, version: int | None = None,
         parts: Iterable[str] | None = None, rows: list | None = None) -> DataFrame:
    """The table at a version (default: the newest), or some parts of it.  ``rows``: its manifest rows, if known."""
    rows = version_rows(spark, store, name, version) if rows is None else rows
    if not rows:
        raise FileNotFoundError(f"{name} has no such version in {store}")
    wanted = None if parts is None else set(parts)
    paths = [r["path"] for r in rows[1:] if wanted is None or r["part"] in wanted]
    return spark.read.schema(schema_of(rows)).parquet(*paths) if paths else spark.createDataFrame([], schema_of(rows))


def write_parts(df: DataFrame, store: str, name: str, part: Column, version: int, sort: Sequence[str] = (),
                counts: dict[str, int] | None = None) -> list[tuple]:
    """(part, path, rows) of ``df`` written to a fresh folder; skewed parts are written by several tasks.

    ``counts``: rows per part, if they are known; else they are counted in the written files."""
    folder = f"{store}/{name}/v{version:06d}-{uuid.uuid4().hex[:8]}"
    out = df.withColumn(PART, part).hint("rebalance", F.col(PART)).sortWithinPartitions(PART, *sort)
    out.write.mode("errorifexists").partitionBy(PART).parquet(folder)
    if counts is None:
        # Strings: a day would be read back as a date, a bucket as a number.
        back = df.sparkSession.read.schema(T.StructType([*df.schema.fields, T.StructField(PART, T.StringType())])).parquet(folder)
        counts = {r[PART]: r["n"] for r in back.groupBy(PART).agg(F.count(F.lit(1)).alias("n")).collect()}
    return [(p, f"{folder}/{PART}={p}", n) for p, n in counts.items() if n]


def publish(spark: SparkSession, store: str, name: str, version: int, parts: Iterable[tuple], schema: T.StructType, as_of=None) -> None:
    """Makes a version of (part, path, rows) visible by one small append."""
    when = datetime.fromisoformat(str(as_of)) if as_of is not None else datetime.now(timezone.utc).replace(tzinfo=None)
    token, parts = uuid.uuid4().hex, list(parts)
    rows = [(name, version, token, None, schema.json(), sum(p[2] for p in parts), when)]
    rows += [(name, version, token, *p, when) for p in parts]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(f"{store}/{MANIFEST}")


def write(spark: SparkSession, store: str, name: str, df: DataFrame, part: Column, as_of=None, sort: Sequence[str] = ()) -> int:
    """Publishes ``df`` as the next version, all parts written; returns its number."""
    old = version_rows(spark, store, name)
    version = old[0]["version"] + 1 if old else 1
    publish(spark, store, name, version, write_parts(df, store, name, part, version, sort), df.schema, as_of)
    return version


def replace(spark: SparkSession, store: str, name: str, rows: DataFrame, gone: Iterable[str], part: Column, as_of=None,
            sort: Sequence[str] = (), *, counts: dict[str, int] | None = None, old: list | None = None) -> int:
    """Publishes the next version: the parts ``gone`` leave, those of ``rows`` come, all others keep their folder.

    ``counts`` as in :func:`write_parts`; ``old``: manifest rows of the newest version, if known."""
    old = version_rows(spark, store, name) if old is None else old
    if not old:
        raise FileNotFoundError(f"{name} has no version in {store}")
    version, gone, schema = old[0]["version"] + 1, set(gone), schema_of(old)
    new = []
    if gone and (counts is None or any(counts.values())):
        aligned = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in schema.fields])
        new = write_parts(aligned, store, name, part, version, sort, counts)
    stay = [(r["part"], r["path"], r["rows"]) for r in old[1:] if r["part"] not in gone]
    clash = {p[0] for p in new} & {p[0] for p in stay}
    if clash:
        raise ValueError(f"rows of parts that were to stay: {sorted(clash)}")
    publish(spark, store, name, version, [*stay, *new], schema, as_of)
    return version


def row_changes(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys and ``change`` (new, gone, changed, same) of every row of either side; null keys meet null keys.

    ``keys`` are unique on each side.  One full outer join on them; values compare null-safe.
    """
    values = [c for c in old.columns if c not in keys]
    side = lambda df, p: df.select(*[F.col(f"`{k}`").alias(f"{p}{i}") for i, k in enumerate(keys)],
                                   F.struct(*[F.col(f"`{c}`") for c in values], F.lit(1).alias("there")).alias(f"{p}v"))
    cond = None
    for i in range(len(keys)):
        c = F.col(f"o{i}").eqNullSafe(F.col(f"n{i}"))
        cond = c if cond is None else cond & c
    j = side(old, "o").join(side(new, "n"), cond, "full_outer")
    change = (F.when(F.col("ov").isNull(), "new").when(F.col("nv").isNull(), "gone")
              .when(F.col("ov").eqNullSafe(F.col("nv")), "same").otherwise("changed"))
    from_either = [F.when(F.col("nv").isNotNull(), F.col(f"n{i}")).otherwise(F.col(f"o{i}")).alias(k) for i, k in enumerate(keys)]
    return j.select(*from_either, change.alias("change"))
