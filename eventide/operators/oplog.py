"""Operation-log analytics (L1-L4) over statement statistics.

Input is either one row per statement (query, calls, total/mean/max/
stddev time, rows, hit/read counters — see STATEMENT_STATS_SCHEMA) or raw
timings, which :func:`statement_stats` aggregates first (one partial-
aggregated pass, so a hot statement is combined map-side).
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

from eventide.functions.timefns import round_dec

# Statements of the statistics collector itself are noise and
# are left out of the slow-operation list and of the per-class summary.
SLOW_NOISE_LIKE = "%pg_stat_statements%"
CLASS_NOISE_LIKE = "%pg_stat%"


def statement_stats(timings: DataFrame, *, op: str, ms: str, rows: str | None = None,
                    hit: str | None = None, read: str | None = None) -> DataFrame:
    """Aggregate raw timings (one row per execution) into statement stats."""
    def total(c):
        return F.sum(c).cast("long") if c else F.lit(0).cast("long")
    return timings.groupBy(F.col(op).alias("query")).agg(
        F.count(F.lit(1)).alias("calls"),
        F.sum(ms).alias("total_exec_time"),
        F.avg(ms).alias("mean_exec_time"),
        F.max(ms).alias("max_exec_time"),
        F.stddev_pop(ms).alias("stddev_exec_time"),
        (F.sum(rows).cast("long") if rows else F.count(F.lit(1))).alias("rows"),
        total(hit).alias("shared_blks_hit"),
        total(read).alias("shared_blks_read"),
    )


def _ratio(hit: Column, read: Column, digits: int = 2) -> Column:
    """100 * hit / NULLIF(hit + read, 0), decimal-rounded; NULL if both are 0."""
    num = F.lit(100.0) * hit.cast("double")
    den = F.nullif((hit + read).cast("double"), F.lit(0.0))
    return round_dec(num / den, digits)


def slow_operations(stats: DataFrame, n: int = 20, exclude_like: str | None = SLOW_NOISE_LIKE,
                    preview: int = 100) -> DataFrame:
    """L1: the n slowest statements by mean time (ties by statement text)."""
    df = stats if exclude_like is None else stats.where(~F.col("query").like(exclude_like))
    return (df.select(F.left(F.col("query"), F.lit(preview)).alias("query_preview"), "calls",
                      round_dec(F.col("total_exec_time")).alias("total_time_ms"),
                      round_dec(F.col("mean_exec_time")).alias("avg_time_ms"),
                      round_dec(F.col("max_exec_time")).alias("max_time_ms"),
                      round_dec(F.col("stddev_exec_time")).alias("stddev_time_ms"),
                      F.col("rows").alias("rows_returned"),
                      _ratio(F.col("shared_blks_hit"), F.col("shared_blks_read")).alias("cache_hit_ratio"),
                      F.col("mean_exec_time").alias("_mean"), F.col("query").alias("_q"))
            .orderBy(F.desc("_mean"), "_q").limit(n).drop("_mean", "_q"))


# Statement classes by leading keyword.
STATEMENT_CLASSES = {"SELECT": "SELECT%", "INSERT": "INSERT%", "UPDATE": "UPDATE%", "DELETE": "DELETE%"}


def stats_by_class(stats: DataFrame, classes: Mapping[str, str] = STATEMENT_CLASSES,
                   exclude_like: str | None = CLASS_NOISE_LIKE, other: str = "OTHER") -> DataFrame:
    """L2: statistics per statement class (first matching LIKE pattern wins)."""
    df = stats if exclude_like is None else stats.where(~F.col("query").like(exclude_like))
    cls = None
    for name, pat in classes.items():
        cond = F.col("query").like(pat)
        cls = F.when(cond, F.lit(name)) if cls is None else cls.when(cond, F.lit(name))
    cls = cls.otherwise(F.lit(other)) if cls is not None else F.lit(other)
    return (df.groupBy(cls.alias("query_type"))
            .agg(F.count(F.lit(1)).alias("query_count"), F.sum("calls").cast("long").alias("total_calls"),
                 round_dec(F.sum("total_exec_time")).alias("total_time_ms"),
                 round_dec(F.avg("mean_exec_time")).alias("avg_time_ms"),
                 F.sum("rows").cast("long").alias("total_rows")))


def usage_tier(dim: DataFrame, facts: DataFrame, *, dim_key: str, fact_key: str, lo: int = 100,
               hi: int | None = None, id_name: str = "id") -> DataFrame:
    """L3: uses per entity (zeros included) and a tier: 0 -> UNUSED,
    < lo -> RARELY_USED, else ACTIVE.  Least used first (ties by key).

    Facts are counted per key first (map-side combined), then the
    dimension is left-joined to the counts — the join sees one row per key.
    """
    n = facts.groupBy(F.col(fact_key).alias("_k")).agg(F.count(F.lit(1)).alias("_n"))
    j = dim.select(F.col(dim_key).alias(id_name)).join(n, F.col(id_name) == F.col("_k"), "left")
    uses = F.coalesce(F.col("_n"), F.lit(0)).cast("long")
    tier = F.when(uses == 0, "UNUSED").when(uses < lo, "RARELY_USED").otherwise("ACTIVE")
    return j.select(id_name, uses.alias("uses"), tier.alias("usage_status")).orderBy("uses", id_name)


def hit_ratio(sources: Mapping[str, tuple[DataFrame, Column, Column]], digits: int = 2) -> DataFrame:
    """L4: guarded ratio 100*hit/NULLIF(hit+read,0) per named source, stacked.

    ``sources``: metric -> (frame, hit expression, read expression); each
    frame is reduced to one row by a global sum.
    """
    out = None
    for metric, (df, hit, read) in sources.items():
        a = df.agg(F.sum(hit).cast("long").alias("h"), F.sum(read).cast("long").alias("r"))
        a = a.select(F.lit(metric).alias("metric"),
                     _ratio(F.coalesce(F.col("h"), F.lit(0)), F.coalesce(F.col("r"), F.lit(0)), digits).alias("ratio"))
        out = a if out is None else out.unionByName(a)
    return out
