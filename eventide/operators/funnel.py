"""U4: ordered funnel — how many users reach each step — in one pass over the events.

Step 1 is a user's first event of type steps[0]; step k is the first
event of type steps[k-1] strictly after the user's step k-1 time (and
within ``horizon`` of it when given).

A user's events are cut into time buckets.  A bucket's state says, for every step a user may have reached before it, through
which steps and times the bucket takes the user on; states of successive buckets combine by looking
up where the earlier one ends, so the combination is associative and a user's events never meet in one task, only
their bucket states do.  A step's event is the first of its type after the step before, whatever the horizon;
the horizon only decides how far the chain of times counts, so it is applied to the finished chain.

Inside a bucket a set of distinct (time, step type) is kept: its size is bounded by the bucket's length and the time
resolution, however many events fall on one user; ``bucket`` is the unit of the buckets ('second', 'minute', 'hour').
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from eventide.functions.timefns import interval_micros, trunc_ts


def _walk(events: Column, start: int, steps: Sequence[str], micros: str) -> Column:
    """Times at which a user with ``start`` steps reaches further ones in sorted (time, type) ``events``."""
    types = F.array(*[F.lit(s) for s in steps])

    def on(times, e):
        # The step looked for is the one after those reached; its time must be later than the last one's.
        wanted = F.get(types, F.size(times) + start)
        later = (F.size(times) == 0) | (e["t"] > F.element_at(times, -1))
        return F.when((e["kind"] == wanted) & later, F.concat(times, F.array(e["t"]))).otherwise(times)

    return F.aggregate(events, F.array().cast(f"array<{micros}>"), on)


def _combine(states: Column, start: int, k: int, micros: str) -> Column:
    """Times at which a user with ``start`` steps reaches further ones in successive states (sorted by time)."""
    def on(times, s):
        reached = F.size(times) + start
        return F.when(reached < k, F.concat(times, F.get(s["go"], reached))).otherwise(times)

    return F.aggregate(states, F.array().cast(f"array<{micros}>"), on)


def chains(events: DataFrame, steps: Sequence[str], *, user: str = "user_id", ts: str = "event_time", type_col: str = "event_type",
           bucket: str = "minute", group: str = "day") -> DataFrame:
    """(user, times): the times at which every user reached steps 1, 2, …, without a horizon.

    States are combined per (user, ``group``) first, so a user brings one state per day to the last step.
    """
    typ, k = events.schema[ts].dataType, len(steps)
    name = typ.simpleString()
    ev = (events.where(F.col(type_col).isin(list(steps)) & F.col(ts).isNotNull())
          .select(F.col(user), trunc_ts(group, ts, typ).alias("_g"), trunc_ts(bucket, ts, typ).alias("_b"),
                  F.struct(F.col(ts).alias("t"), F.col(type_col).alias("kind")).alias("_e")))
    per = ev.groupBy(user, "_g", "_b").agg(F.sort_array(F.collect_set("_e")).alias("_e"))
    # For every number of steps reached before the bucket: the times of the further ones.
    per = per.select(user, "_g", "_b", F.array(*[_walk(F.col("_e"), i, steps, name) for i in range(k)]).alias("go"))
    # Buckets that take nobody on change nothing.
    per = per.where(F.exists("go", lambda g: F.size(g) > 0))
    in_order = lambda at: F.sort_array(F.collect_list(F.struct(at, "go"))).alias("s")
    days = per.groupBy(user, "_g").agg(in_order("_b"))
    days = days.select(user, "_g", F.array(*[_combine(F.col("s"), i, k, name) for i in range(k)]).alias("go"))
    return days.groupBy(user).agg(in_order("_g")).select(user, _combine(F.col("s"), 0, k, name).alias("times"))


def funnel(events: DataFrame, steps: Sequence[str], horizon: str | None = None, *,
           user: str = "user_id", ts: str = "event_time", type_col: str = "event_type", bucket: str = "minute") -> DataFrame:
    """step, event_type, users, conversion (percent of the users of step 1)."""
    if not steps:
        raise ValueError("funnel needs at least one step")
    reached = chains(events, steps, user=user, ts=ts, type_col=type_col, bucket=bucket)
    if horizon:
        late = lambda i: F.timestamp_diff("MICROSECOND", F.get("times", i - 1), F.get("times", i)) > interval_micros(horizon)
        size = F.size("times")
        for i in range(len(steps) - 1, 0, -1):
            size = F.when((F.size("times") > i) & late(F.lit(i)), F.lit(i)).otherwise(size)
        reached = reached.withColumn("_n", size)
    else:
        reached = reached.withColumn("_n", F.size("times"))
    one = reached.agg(*[F.count_if(F.col("_n") >= i).alias(f"_{i}") for i in range(1, len(steps) + 1)])
    rows = F.array(*[F.struct(F.lit(i).alias("step"), F.lit(s).alias("event_type"), F.col(f"_{i}").alias("users"))
                     for i, s in enumerate(steps, 1)])
    conv = F.round(F.lit(100.0) * F.col("r.users") / F.nullif(F.col("_1"), F.lit(0)), 2)
    return one.select("_1", F.explode(rows).alias("r")).select("r.step", "r.event_type", "r.users", conv.alias("conversion"))
