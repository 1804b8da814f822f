"""Distribution profiling and reports.

Shares divide by a total taken from a scalar subquery over the already
aggregated counts instead of a window over all groups, so a
high-cardinality key never funnels its groups into one partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from eventide.functions.timefns import exact_pct, hour_of
from eventide.plans.broadcast import bounded_broadcast


def counts(df: DataFrame, key: str | Sequence[str], name: str = "count") -> DataFrame:
    """V3: count per key."""
    keys = [key] if isinstance(key, str) else list(key)
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(name))


def share(df: DataFrame, key: str, digits: int = 2, name: str = "pct") -> DataFrame:
    """V1/V2: count and percent share per key (exact decimal rounding)."""
    c = counts(df, key)
    total = c.select(F.sum("count")).scalar()
    return c.withColumn(name, exact_pct(F.col("count"), total, digits))


def hour_histogram(df: DataFrame, ts: str = "event_time") -> DataFrame:
    """V4: events per hour of day."""
    return df.groupBy(hour_of(ts).alias("hour")).agg(F.count(F.lit(1)).alias("count"))


def top_n(df: DataFrame, key: str = "user_id", n: int = 20, name: str = "event_count") -> DataFrame:
    """V5: the n keys with most rows (ties by key)."""
    return counts(df, key, name).orderBy(F.desc(name), F.asc(key)).limit(n)


def pareto(df: DataFrame, key: str = "user_id", top_pct: float = 20.0, digits: int = 2) -> DataFrame:
    """V6: share of rows that come from the top ``top_pct`` % of keys.

    The top k = ceil(top_pct/100 * keys) keys are the k largest per-key
    counts.  Instead of ranking every key in one global window, the keys
    are grouped by their count (a histogram with at most sqrt(2*rows)
    distinct counts); a window over that small histogram finds how many
    rows the top k keys hold — ties at the border contribute equally, so
    the result is exact.
    """
    per_key = counts(df, key, "n")
    hist = per_key.groupBy("n").agg(F.count(F.lit(1)).alias("keys"))
    w = Window.orderBy(F.desc("n")).rowsBetween(Window.unboundedPreceding, -1)
    hist = (hist.withColumn("keys_before", F.coalesce(F.sum("keys").over(w), F.lit(0)))
            .withColumn("total_keys", F.sum("keys").over(Window.partitionBy()))
            .withColumn("total_rows", F.sum(F.col("n") * F.col("keys")).over(Window.partitionBy())))
    k = F.ceil(F.col("total_keys").cast("decimal(38,10)") * F.lit(top_pct) / F.lit(100)).cast("long")
    take = F.greatest(F.lit(0), F.least(F.col("keys"), k - F.col("keys_before")))
    out = hist.agg(F.first(k).alias("top_keys"), F.first("total_keys").alias("total_keys"),
                   F.sum(take * F.col("n")).cast("long").alias("top_rows"),
                   F.first("total_rows").cast("long").alias("total_rows"))
    return out.withColumn("top_share_pct", exact_pct(F.col("top_rows"), F.col("total_rows"), digits))


def time_share(df: DataFrame, ts: str = "event_time", start_hour: int = 9, end_hour: int = 17,
               digits: int = 2) -> DataFrame:
    """V7: share of rows in business hours (start..end inclusive) and on weekends."""
    h = F.hour(ts)
    wd = F.dayofweek(ts)  # 1 = Sunday, 7 = Saturday
    agg = df.agg(F.count(F.lit(1)).alias("total"),
                 F.count_if(h.between(start_hour, end_hour)).alias("business_hours"),
                 F.count_if(wd.isin(1, 7)).alias("weekend"))
    return agg.select("total", "business_hours", "weekend",
                      exact_pct(F.col("business_hours"), F.col("total"), digits).alias("business_hours_pct"),
                      exact_pct(F.col("weekend"), F.col("total"), digits).alias("weekend_pct"))


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """V8: one labelled row count per table."""
    out = None
    for name, df in tables.items():
        c = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
        out = c if out is None else out.unionByName(c)
    return out


def report(events: DataFrame, tables: Mapping[str, DataFrame], *, month_col: str | None = None,
           ts: str = "event_time", sizes: DataFrame | None = None) -> DataFrame:
    """V9: long-form report (section, metric, value) over the data itself."""
    parts = [row_counts(tables).select(F.lit("ROW COUNTS").alias("section"),
                                       F.concat(F.lit("Total "), F.col("table_name")).alias("metric"),
                                       F.col("rows").cast("string").alias("value"))]
    month = F.col(month_col) if month_col else F.date_format(ts, "yyyy_MM")
    # One aggregate over the events (a row per month, then one row), unfolded into its three lines.
    per_month = events.groupBy(month.alias("m")).agg(F.min(ts).alias("lo"), F.max(ts).alias("hi"))
    one = per_month.agg(F.count("m").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))

    def line(section, metric, value):
        return F.struct(F.lit(section).alias("section"), F.lit(metric).alias("metric"), value.alias("value"))

    shown = "yyyy-MM-dd HH:mm:ss.SSSSSS"
    parts.append(one.select(F.inline(F.array(
        line("PARTITIONS", "Total partitions", F.col("n").cast("string")),
        line("DATA RANGE", "First event", F.date_format("lo", shown)),
        line("DATA RANGE", "Last event", F.date_format("hi", shown))))))
    if sizes is not None:  # (name, bytes) rows, e.g. from list_partitions(with_bytes=True)
        from eventide.functions.timefns import size_pretty
        parts.append(sizes.select(F.lit("DATA SIZE").alias("section"), F.col("name").alias("metric"),
                                  size_pretty("bytes").alias("value")))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def compare_share(df: DataFrame, key: str, expected: DataFrame, digits: int = 2) -> DataFrame:
    """Observed vs expected percent per category, absolute deviation.

    ``expected`` has (key, expected_pct).  Categories missing on one side
    count as 0 there.  The expectation is a small table of published
    weights; it is broadcast once its size is checked.
    """
    obs = share(df, key, digits, "observed_pct").select(key, "observed_pct")
    j = obs.join(bounded_broadcast(expected), key, "full_outer")
    o = F.coalesce(F.col("observed_pct"), F.lit(0.0))
    e = F.coalesce(F.col("expected_pct").cast("double"), F.lit(0.0))
    return j.select(key, o.alias("observed_pct"), e.alias("expected_pct"),
                    F.round(F.abs(o - e), digits).alias("abs_deviation"))


def expectation(spark: SparkSession, key: str, weights: Mapping[str, float]) -> DataFrame:
    """A (key, expected_pct) table from published weights (fractions)."""
    rows = [(k, float(round(w * 100, 6))) for k, w in weights.items()]
    return spark.createDataFrame(rows, f"{key} string, expected_pct double")
