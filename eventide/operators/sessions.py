"""Session and user derivation (sessionize, session/user dimensions, upsert).

Sessionization is written for a user who holds a large share of all
events: the per-event window is partitioned by (user, time bucket), not by
user alone, so no single task has to sort one user's whole history.  The
state that crosses bucket borders (the previous bucket's last event time
and the running session count) is carried by a small per-(user, bucket)
aggregate, whose per-user window has at most one row per bucket.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from eventide.functions.timefns import interval_micros, trunc_ts, day_of, ts_literal
from eventide.operators import parts
from eventide.plans.lineage import materialize


def sessionize(events: DataFrame, gap: str | int = "30 minutes", *, user: str = "user_id",
               ts: str = "event_time", tiebreak: str = "id", bucket: str = "hour",
               out: str = "session_id", number_col: str | None = None,
               state: DataFrame | None = None) -> DataFrame:
    """Label events with sessions: a new session starts when the gap to the
    user's previous event (order ``(ts, tiebreak)``) is strictly greater
    than ``gap``.  ``out`` = ``user || '-' || n`` with n = 1, 2, ... per user.

    ``bucket`` is the date_trunc unit that splits a user's events across
    tasks ('minute', 'hour', 'day').

    ``state`` continues an earlier load instead of re-labelling history:
    one row per user (``user``, ``last_time``, ``last_number``) as made by
    :func:`session_state`.  The new events must not be earlier than the user's
    ``last_time`` (the job fails if one is; :func:`repair_sessions` takes loads in any order); a user's first new
    event then joins the stored session when within ``gap`` and numbering continues from ``last_number``.

    Events without a user or a time keep their row; their session is NULL.  They are spread by their
    tiebreak, so many of them do not meet in one task.

    The events are read twice: once for the labels inside a bucket, once for the per-bucket state.
    """
    gap_us = interval_micros(gap)
    typ = events.schema[ts].dataType
    b, spread = "_ssn_bucket", "_ssn_spread"
    known = F.col(user).isNotNull() & F.col(ts).isNotNull()
    e = events.withColumn(b, trunc_ts(bucket, ts, typ)).withColumn(
        spread, F.when(known, F.lit(None).cast("int")).otherwise(F.pmod(F.xxhash64(tiebreak), F.lit(4096)).cast("int")))

    w = Window.partitionBy(user, b, spread).orderBy(F.col(ts), F.col(tiebreak))
    e = e.withColumn("_ssn_prev", F.lag(ts).over(w))
    prev = F.col("_ssn_prev")
    internal = F.when(prev.isNotNull() & (F.timestamp_diff("MICROSECOND", prev, F.col(ts)) > gap_us), 1).otherwise(0)
    e = e.withColumn("_ssn_flag", internal).drop("_ssn_prev")
    e = e.withColumn("_ssn_run", F.sum("_ssn_flag").over(w.rowsBetween(Window.unboundedPreceding, 0)))

    # One row per (user, bucket): the state carried across bucket borders.
    a = e.where(known).groupBy(user, b).agg(F.min(ts).alias("_ssn_min"), F.max(ts).alias("_ssn_max"),
                                            F.sum("_ssn_flag").alias("_ssn_inner"))
    a = a.withColumn("_ssn_stored", F.lit(0))
    if state is not None:
        # A stored user becomes one leading pseudo-bucket: its last event time
        # and (last_number - 1) inner starts, so the offset of the first new
        # bucket is last_number and its gap is measured from last_time.
        st = state.where(F.col(user).isNotNull()).select(
            F.col(user), trunc_ts(bucket, F.col("last_time").cast(typ), typ).alias(b),
            F.col("last_time").cast(typ).alias("_ssn_min"), F.col("last_time").cast(typ).alias("_ssn_max"),
            (F.col("last_number") - 1).cast("long").alias("_ssn_inner"), F.lit(1).alias("_ssn_stored"))
        a = a.unionByName(st)
        of_user = Window.partitionBy(user)
        last = F.max(F.when(F.col("_ssn_stored") == 1, F.col("_ssn_max"))).over(of_user)
        late = (F.col("_ssn_stored") == 0) & (F.col("_ssn_min") < last)
        a = a.withColumn("_ssn_min", F.when(late, F.raise_error(F.concat(
            F.lit("events before the stored state of user "), F.col(user).cast("string"), F.lit(": use repair_sessions"))).cast(typ))
            .otherwise(F.col("_ssn_min")))
    wa = Window.partitionBy(user).orderBy(b, F.desc("_ssn_stored"))
    prev_max = F.lag("_ssn_max").over(wa)
    first = F.when(prev_max.isNull() | (F.timestamp_diff("MICROSECOND", prev_max, F.col("_ssn_min")) > gap_us), 1).otherwise(0)
    a = a.withColumn("_ssn_first", first)
    a = a.withColumn("_ssn_offset", F.coalesce(
        F.sum(F.col("_ssn_first") + F.col("_ssn_inner")).over(wa.rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)))
    a = a.where(F.col("_ssn_stored") == 0).select(user, b, "_ssn_first", "_ssn_offset")

    e = e.join(a, [user, b], "left")              # rows without a user or a time meet nothing
    n = (F.col("_ssn_offset") + F.col("_ssn_first") + F.col("_ssn_run")).cast("long")
    e = e.withColumn(out, F.concat(F.col(user).cast("string"), F.lit("-"), n.cast("string")))
    if number_col:
        e = e.withColumn(number_col, n)
    return e.drop(b, spread, "_ssn_flag", "_ssn_run", "_ssn_first", "_ssn_offset")


def session_intervals(labelled: DataFrame, number_col: str, *, user: str = "user_id", ts: str = "event_time") -> DataFrame:
    """Stored sessions of labelled events: (user, number, started_at, ended_at)."""
    return (labelled.where(F.col(number_col).isNotNull()).groupBy(user, F.col(number_col).alias("number"))
            .agg(F.min(ts).alias("started_at"), F.max(ts).alias("ended_at")))


def repair_sessions(intervals: DataFrame, new: DataFrame, gap: str | int = "30 minutes", *, user: str = "user_id",
                    ts: str = "event_time", tiebreak: str = "id", out: str = "session_id", number_col: str = "number",
                    bucket: str = "hour") -> tuple[DataFrame, DataFrame, DataFrame]:
    """D2 for loads in any order: new events may fall before, between or inside stored sessions.

    A late event can extend a session, join two into one or begin one between others, which shifts the
    numbers after it.  The new events are sessionized alone first (per user and time bucket), so that only intervals
    meet: the new ones and the stored ones of the same users.  Intervals no more than ``gap`` apart, by the
    latest end so far, make one session.

    Returns ``(labelled, intervals, renumbered)``: the new events with ``out`` and ``number_col``, the stored
    intervals after the load, and (user, old_number, new_number) of stored sessions whose number changed, for
    :func:`relabel`.  The result equals :func:`sessionize` over all events, whatever the order of the loads.
    """
    gap_us = interval_micros(gap)
    typ = new.schema[ts].dataType
    own, nth = "_ssn_own", "_ssn_n"
    alone = materialize(sessionize(new, gap, user=user, ts=ts, tiebreak=tiebreak, bucket=bucket, out=own, number_col=nth).drop(own),
                        "sessions-alone")
    load = session_intervals(alone, nth, user=user, ts=ts).withColumn("_new", F.lit(True))
    touched = load.select(user).distinct()
    stored = intervals.select(user, "number", F.col("started_at").cast(typ).alias("started_at"), F.col("ended_at").cast(typ).alias("ended_at"))
    here = stored.join(touched, user, "left_semi").withColumn("_new", F.lit(False)).unionByName(load)
    order = Window.partitionBy(user).orderBy("started_at", "ended_at", "_new", "number")
    upto = F.max("ended_at").over(order.rowsBetween(Window.unboundedPreceding, -1))
    begins = F.when(upto.isNull() | (F.timestamp_diff("MICROSECOND", upto, F.col("started_at")) > gap_us), 1).otherwise(0)
    placed = here.withColumn("_begins", begins).withColumn(
        "_number", F.sum("_begins").over(order.rowsBetween(Window.unboundedPreceding, 0)).cast("long"))
    placed = materialize(placed.drop("_begins"), "sessions-placed")

    mine = placed.where("_new").select(F.col(user).alias("_u"), F.col("number").alias("_n"), "_number")
    labelled = alone.join(mine, (F.col(user) == F.col("_u")) & (F.col(nth) == F.col("_n")), "left")
    labelled = labelled.withColumn(out, F.concat(F.col(user).cast("string"), F.lit("-"), F.col("_number").cast("string")))
    labelled = labelled.select(*new.columns, out, F.col("_number").alias(number_col))
    renumbered = placed.where("NOT _new AND number <> _number").select(
        user, F.col("number").alias("old_number"), F.col("_number").alias("new_number"))
    after = placed.groupBy(user, F.col("_number").alias("number")).agg(
        F.min("started_at").alias("started_at"), F.max("ended_at").alias("ended_at"))
    return labelled, stored.join(touched, user, "left_anti").unionByName(after), renumbered


def relabel(labelled: DataFrame, renumbered: DataFrame, *, user: str = "user_id", out: str = "session_id",
            number_col: str = "number") -> DataFrame:
    """Stored labelled events with the numbers that :func:`repair_sessions` changed; other rows as they are."""
    r = renumbered.select(F.col(user).alias("_u"), F.col("old_number").alias("_o"), F.col("new_number").alias("_w"))
    j = labelled.join(r, (F.col(user) == F.col("_u")) & (F.col(number_col) == F.col("_o")), "left")
    moved = F.col("_w").isNotNull()
    return j.withColumns({
        out: F.when(moved, F.concat(F.col(user).cast("string"), F.lit("-"), F.col("_w").cast("string"))).otherwise(F.col(out)),
        number_col: F.coalesce("_w", number_col)}).select(*labelled.columns)


def session_state(labelled: DataFrame, number_col: str, previous: DataFrame | None = None, *,
                  user: str = "user_id", ts: str = "event_time") -> DataFrame:
    """Per-user state after a load: (user, last_time, last_number).

    One map-side-combined aggregate of the labelled load; users absent from
    the load keep their previous state (full outer join on the user)."""
    cur = (labelled.where(F.col(number_col).isNotNull()).groupBy(user)
           .agg(F.max(ts).alias("last_time"), F.max(number_col).alias("last_number")))
    if previous is None:
        return cur
    p = previous.select(F.col(user).alias("_u"), F.col("last_time").alias("_t"), F.col("last_number").alias("_n"))
    j = cur.join(p, cur[user] == p["_u"], "full_outer")
    return j.select(F.coalesce(F.col(user), F.col("_u")).alias(user),
                    F.coalesce(F.col("last_time"), F.col("_t")).alias("last_time"),
                    F.coalesce(F.col("last_number"), F.col("_n")).alias("last_number"))


def session_windows(events: DataFrame, gap: str = "30 minutes", *, user: str = "user_id",
                    ts: str = "event_time") -> DataFrame:
    """Aggregate form of sessionization: one row per (user, session
    window) with its event count, the rows of Spark's ``session_window``.
    That operator sorts all of a user's events in one task; here
    :func:`sessionize` labels them per (user, bucket) and the labels are
    aggregated.  Events without a user form sessions of their own; those
    without a time are in none."""
    key = F.coalesce(F.concat(F.lit("u"), F.col(user).cast("string")), F.lit("none"))
    e = events.where(F.col(ts).isNotNull()).select(key.alias("_key"), F.col(user), F.col(ts))
    e = sessionize(e, gap, user="_key", ts=ts, tiebreak=ts, out="_label", number_col="_number")
    end = F.timestamp_add("MICROSECOND", F.lit(interval_micros(gap)).cast("long"), F.max(ts))
    return (e.groupBy("_key", user, "_number")
            .agg(F.min(ts).alias("started_at"), end.alias("window_end"), F.count(F.lit(1)).alias("events_count"))
            .drop("_key", "_number"))


def _last_by(col: str, ts: str, tiebreak: str) -> Column:
    return F.max_by(F.col(col), F.struct(F.col(ts), F.col(tiebreak)))


def query_param(url: Column | str, name: str) -> Column:
    """Value of query parameter ``name`` of a URL; missing/empty -> NULL.

    Relative URLs parse too; malformed URLs give NULL (``try_parse_url``).
    """
    u = F.col(url) if isinstance(url, str) else url
    v = F.try_parse_url(u, F.lit("QUERY"), F.lit(name))
    return F.nullif(v, F.lit(""))


# The attribution parameters of a landing URL.
UTM_PARAMS = ("utm_source", "utm_medium", "utm_campaign")


def utm(df: DataFrame, url_col: str = "landing_page", names: Sequence[str] = UTM_PARAMS,
        out: Sequence[str] | None = None) -> DataFrame:
    """Attribution columns parsed from a URL's query string."""
    out = list(out) if out else list(names)
    for name, o in zip(names, out):
        df = df.withColumn(o, query_param(url_col, name))
    return df


def landing_exit(events: DataFrame, *, session: str = "session_id", url: str = "page_url",
                 ts: str = "event_time", tiebreak: str = "id") -> DataFrame:
    """D3: first and last page of every session (events in none are left out)."""
    ends = events.where(F.col(session).isNotNull()).groupBy(session).agg(F.min(F.struct(ts, tiebreak, url)).alias("_first"),
                                       F.max(F.struct(ts, tiebreak, url)).alias("_last"))
    return ends.select(session, F.col("_first")[url].alias("landing_page"), F.col("_last")[url].alias("exit_page"))


def sessions(events: DataFrame, *, page_view: str = "page_view", click: str = "click",
             form_submit: str = "form_submit", utm_names: Sequence[str] = UTM_PARAMS,
             created_at=None, ts: str = "event_time", tiebreak: str = "id") -> DataFrame:
    """The session dimension from sessionized events.

    One aggregation keyed by session (map-side partial aggregation, so a
    huge session does not land in one task unaggregated).  Attributes that
    may change inside a session take the value of its first event; the
    first and the last event are carried as one struct each.  Events without a session are in none.
    """
    cols = set(events.columns)
    firsts = [c for c in ("page_url", "device_type", "browser", "country_code") if c in cols]
    lasts = [c for c in ("page_url",) if c in cols]

    def attr(c, end="_first"):
        return F.col(end)[c] if c in cols else F.lit(None).cast("string")

    s = events.where(F.col("session_id").isNotNull()).groupBy(F.col("session_id").alias("id")).agg(
        F.min("user_id").alias("user_id"),
        F.min(ts).alias("started_at"),
        F.max(ts).alias("ended_at"),
        F.count_if(F.col("event_type") == page_view).alias("page_views"),
        F.count_if(F.col("event_type") == click).alias("clicks"),
        F.count_if(F.col("event_type") == form_submit).alias("form_submits"),
        F.count(F.lit(1)).alias("events_count"),
        F.min(F.struct(ts, tiebreak, *firsts)).alias("_first"),
        F.max(F.struct(ts, tiebreak, *lasts)).alias("_last"),
    )
    s = s.withColumns({"landing_page": attr("page_url"), "exit_page": attr("page_url", "_last"),
                       "device_type": attr("device_type"), "browser": attr("browser"),
                       "country_code": attr("country_code")})
    s = s.withColumn("duration_seconds",
                     F.floor(F.timestamp_diff("MICROSECOND", F.col("started_at"), F.col("ended_at")) / F.lit(1_000_000)))
    s = utm(s, "landing_page", utm_names, list(UTM_PARAMS))
    if created_at is not None:
        s = s.withColumn("created_at", ts_literal(created_at, events.schema[ts].dataType))
    return s.select("id", "user_id", "started_at", "ended_at", "duration_seconds", "page_views", "clicks",
                    "form_submits", "events_count", "landing_page", "exit_page", "device_type", "browser",
                    "country_code", *UTM_PARAMS, *(["created_at"] if created_at is not None else []))


def users(events: DataFrame, *, ts: str = "event_time", tiebreak: str = "id", number_col: str | None = None,
          state: DataFrame | None = None) -> DataFrame:
    """User dimension — first/last seen, totals, latest country.

    With ``number_col`` and the ``state`` before this load, ``total_sessions`` counts the
    sessions that began in the load, so totals of loads add up although a
    session may span two of them.
    """
    cols = set(events.columns)
    aggs = [F.min(ts).alias("first_seen"), F.max(ts).alias("last_seen"),
            F.count(F.lit(1)).alias("total_events")]
    if number_col:
        aggs.append(F.coalesce(F.max(number_col), F.lit(0)).cast("long").alias("total_sessions"))
    elif "session_id" in cols:
        aggs.append(F.count_distinct("session_id").alias("total_sessions"))
    if "country_code" in cols:
        aggs.append(_last_by("country_code", ts, tiebreak).alias("country_code"))
    out = events.groupBy(F.col("user_id").alias("id")).agg(*aggs)
    if number_col and state is not None:
        # Null-safe: events without a user are a user of their own, without sessions.
        before = state.select(F.col("user_id").alias("_user"), F.col("last_number").alias("_last"))
        began = F.greatest(F.col("total_sessions") - F.coalesce("_last", F.lit(0)), F.lit(0))
        out = (out.join(before, F.col("id").eqNullSafe(F.col("_user")), "left")
               .withColumn("total_sessions", began.cast("long")).drop("_user", "_last"))
    return out


def upsert_users(stored: DataFrame, new: DataFrame, as_of, *, mode: str = "accumulate") -> DataFrame:
    """Merge a freshly derived user batch into the stored dimension.

    Full outer join on ``id``; first_seen = least, last_seen = greatest,
    country = the newer one.  ``mode='accumulate'``: the batch covers new
    events only, totals add up; ``mode='replace'``: the batch is a full
    recomputation, its totals win.  ``updated_at`` = as_of for touched
    rows; ``created_at`` = as_of for inserted rows.  Every other column of either side is
    kept, the batch's value first.  In ``accumulate`` the batch's ``total_sessions`` must count
    sessions begun in it (``users(..., number_col=, state=)``).
    """
    o, n = stored.alias("o"), new.alias("n")
    # Null ids meet too; a side that is absent is told by its first_seen, which every stored user has.
    j = o.join(n, F.col("o.id").eqNullSafe(F.col("n.id")), "full_outer")
    typ = stored.schema["first_seen"].dataType
    now = ts_literal(as_of, typ)

    def total(c):
        if mode == "replace":
            return F.coalesce(F.col(f"n.{c}"), F.col(f"o.{c}"))
        return F.coalesce(F.col(f"o.{c}"), F.lit(0)) + F.coalesce(F.col(f"n.{c}"), F.lit(0))

    out = [F.coalesce(F.col("n.id"), F.col("o.id")).alias("id"),
           F.least(F.col("o.first_seen"), F.col("n.first_seen")).alias("first_seen"),
           F.greatest(F.col("o.last_seen"), F.col("n.last_seen")).alias("last_seen"),
           total("total_events").cast("long").alias("total_events")]
    cols = set(stored.columns) & set(new.columns)
    if "total_sessions" in cols:
        out.append(total("total_sessions").cast("long").alias("total_sessions"))
    if "country_code" in cols:
        out.append(F.coalesce(F.col("n.country_code"), F.col("o.country_code")).alias("country_code"))
    created = F.col("o.created_at") if "created_at" in stored.columns else F.lit(None).cast(typ)
    out.append(F.when(F.col("o.first_seen").isNull(), now).otherwise(created).alias("created_at"))
    updated = F.col("o.updated_at") if "updated_at" in stored.columns else F.lit(None).cast(typ)
    out.append(F.when(F.col("n.first_seen").isNotNull(), now).otherwise(updated).alias("updated_at"))
    done = {"id", "first_seen", "last_seen", "total_events", "created_at", "updated_at"} | (
        cols & {"total_sessions", "country_code"})
    for c in [*stored.columns, *[c for c in new.columns if c not in stored.columns]]:
        if c not in done:
            sides = [F.col(f"{a}.`{c}`") for a, side in (("n", new), ("o", stored)) if c in side.columns]
            out.append(F.coalesce(*sides).alias(c))
    return j.select(*out)


USERS = "users"


def store_users(spark: SparkSession, store: str, batch: DataFrame, as_of, *, buckets: int = 256, mode: str = "accumulate") -> list[str]:
    """D6 on a stored dimension: users hashed into buckets, published by version (:mod:`eventide.operators.parts`).

    Only buckets that hold users of the batch are read, merged (:func:`upsert_users`) and written; the next version
    keeps the folders of all others.  Returns the buckets written.  The first batch creates the table; ``buckets`` must
    stay the same from then on.
    """
    part = parts.bucket_part("id", buckets)
    typ = batch.schema["first_seen"].dataType
    if not parts.version_rows(spark, store, USERS):
        now = ts_literal(as_of, typ)
        first = batch.withColumn("created_at", now).withColumn("updated_at", now)
        parts.write(spark, store, USERS, first, part, as_of, ("id",))
        return [r["part"] for r in parts.version_rows(spark, store, USERS)[1:]]
    batch = materialize(batch, "users-batch")
    touched = sorted(r[0] for r in batch.select(part.alias("p")).distinct().collect())      # at most ``buckets`` names
    merged = upsert_users(parts.read(spark, store, USERS, parts=touched), batch, as_of, mode=mode)
    parts.replace(spark, store, USERS, merged, touched, part, as_of, ("id",))
    return touched


def campaign_report(sessions_df: DataFrame, by: Sequence[str] = ("utm_source", "utm_campaign")) -> DataFrame:
    """Sessions per attribution key and day (or per country: by=['country_code'])."""
    return (sessions_df.groupBy(*by, day_of("started_at").alias("date"))
            .agg(F.count(F.lit(1)).alias("sessions")))
