"""Exact distinct counts that merge: bitmaps of dense user numbers beside the sketches of M7.

Distinct counts do not add up over buckets, and a sketch only estimates.  With every user numbered once, the users of a
rollup row are a bitmap, cut into pieces of 32,768 numbers (4 KB each): a row per (keys, piece).  Pieces merge
exactly by OR over any coarser grouping, so a week's users follow from the hourly rows alone.

The numbering is a stored dimension (:mod:`eventide.operators.parts`), kept in buckets by hash: a user's number is
fixed when it is first seen, and new users of a load get the next numbers of their bucket.  Number ``n`` in bucket ``b``
of ``k`` is ``(n * k + b) + 1``, so buckets number independently, without a counter that all tasks share, and
the numbers stay dense as far as the hash is even.  No user is numbered twice and no number is used twice.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventide.operators import parts
from eventide.operators.rollups import _key_cols
from eventide.plans.lineage import materialize

NUMBERS = "user_numbers"


def number_users(spark: SparkSession, store: str, events: DataFrame, as_of=None, *, user: str = "user_id",
                 buckets: int = 256) -> DataFrame:
    """Numbers the users of a load that have none yet; returns all (id, number).  Null users get no number.

    Only buckets with new users are written.  ``buckets`` must stay the same from the first load on.
    """
    part = parts.bucket_part("id", buckets)
    seen = events.where(F.col(user).isNotNull()).select(F.col(user).cast("string").alias("id")).distinct()
    there = bool(parts.version_rows(spark, store, NUMBERS))
    if there:
        seen = seen.join(parts.read(spark, store, NUMBERS), "id", "left_anti")
    seen = materialize(seen.withColumn("p", part), "new-users")
    touched = sorted(r[0] for r in seen.select("p").distinct().collect())         # at most ``buckets`` names
    if there and not touched:
        return parts.read(spark, store, NUMBERS)
    stored = parts.read(spark, store, NUMBERS, parts=touched) if there else spark.createDataFrame([], "id string, number long")
    stored = stored.withColumn("p", part)
    used = stored.groupBy(F.col("p").alias("b")).agg(F.count(F.lit(1)).alias("used"))
    # One window per bucket; a bucket is a ``buckets``-th of the users whatever their events.
    nth = F.row_number().over(Window.partitionBy("p").orderBy("id")) - 1
    new = (seen.withColumn("nth", nth).join(F.broadcast(used), F.col("p") == F.col("b"), "left")
           .select("id", ((F.coalesce("used", F.lit(0)) + F.col("nth")) * buckets + F.col("p").cast("long") + 1).alias("number")))
    rows = stored.select("id", "number").unionByName(new)
    if there:
        parts.replace(spark, store, NUMBERS, rows, touched, part, as_of, ("id",))
    else:
        parts.write(spark, store, NUMBERS, rows, part, as_of, ("id",))
    return parts.read(spark, store, NUMBERS)


def user_bitmaps(events: DataFrame, keys, numbers: DataFrame, *, user: str = "user_id") -> DataFrame:
    """Keys, ``piece`` and ``users`` (bitmap): the users of every key, one row per piece that holds any.

    (key, user) pairs are made distinct before the join with the numbers, so a hot user is one row per key and task.
    """
    named = events.select(*_key_cols(keys), F.col(user).cast("string").alias("_user"))
    names = [c for c in named.columns if c != "_user"]
    pairs = named.where(F.col("_user").isNotNull()).distinct().join(numbers.withColumnRenamed("id", "_user"), "_user")
    piece = F.bitmap_bucket_number("number").alias("piece")
    return pairs.groupBy(*names, piece).agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("users"))


def merge_bitmaps(bitmaps: DataFrame, keys: Sequence[str], out: str = "unique_users", where: Column | None = None) -> DataFrame:
    """M7, exact: distinct users of any coarser grouping of the rows of :func:`user_bitmaps`."""
    if where is not None:
        bitmaps = bitmaps.where(where)
    pieces = bitmaps.groupBy(*keys, "piece").agg(F.bitmap_or_agg("users").alias("users"))
    return pieces.groupBy(*keys).agg(F.coalesce(F.sum(F.bitmap_count("users")), F.lit(0)).cast("long").alias(out))
