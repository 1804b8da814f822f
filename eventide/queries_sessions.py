"""Registry: session and user derivation D1-D7."""

from __future__ import annotations

from pyspark.sql import functions as F

from eventide.operators import sessions as S
from eventide.registry import register, ts, cte, D, AS_OF

# Driver event types standing in for page_view, click, form_submit.
PAGE_VIEW, CLICK, FORM_SUBMIT = "view", "click", "signup"
SPLIT = "2024-01-16 00:00:00"


def _param_sql(url: str, name: str) -> str:
    return f"nullif(regexp_extract({url}, '[?&]{name}=([^&#]*)', 1), '')"


SESSIONS_BODY = (
    "s AS (SELECT session_id AS id, min(user_id) AS user_id, min(event_time) AS started_at, "
    "max(event_time) AS ended_at, "
    f"CAST(count_if(event_type = '{PAGE_VIEW}') AS BIGINT) AS page_views, CAST(count_if(event_type = '{CLICK}') AS BIGINT) AS clicks, "
    f"CAST(count_if(event_type = '{FORM_SUBMIT}') AS BIGINT) AS form_submits, count(*) AS events_count, "
    "arg_min(page_url, (event_time, id)) AS landing_page, arg_max(page_url, (event_time, id)) AS exit_page, "
    "arg_min(device_type, (event_time, id)) AS device_type, CAST(NULL AS VARCHAR) AS browser, "
    "arg_min(country_code, (event_time, id)) AS country_code FROM ev GROUP BY session_id), "
    "sess AS (SELECT id, user_id, started_at, ended_at, "
    "(epoch_us(ended_at) - epoch_us(started_at)) // 1000000 AS duration_seconds, page_views, clicks, "
    "form_submits, events_count, landing_page, exit_page, device_type, browser, country_code, "
    f"{_param_sql('landing_page', 'utm_source')} AS utm_source, "
    f"{_param_sql('landing_page', 'utm_medium')} AS utm_medium, "
    f"{_param_sql('landing_page', 'utm_campaign')} AS utm_campaign FROM s)")
SESSIONS_WITH = f"WITH {cte(country=True, device=True, page=True, sessions=True)}, {SESSIONS_BODY}"


def _sessions(spark, sf):
    ev = D.events(spark, sf, country=True, device=True, page=True, sessions=True)
    return S.sessions(ev, page_view=PAGE_VIEW, click=CLICK, form_submit=FORM_SUBMIT)


@register("d1_sessions", f"{SESSIONS_WITH} SELECT * FROM sess")
def d1(spark, sf):
    return _sessions(spark, sf)


@register("d2_sessionize_4h",
          f"WITH {cte(sessions=True)} SELECT id, user_id, event_time, session_id FROM ev")
def d2(spark, sf):
    return D.events(spark, sf, sessions=True).select("id", "user_id", "event_time", "session_id")


@register("d2_session_windows_4h",
          f"WITH {cte(sessions=True)} SELECT user_id, min(event_time) AS started_at, "
          "max(event_time) + INTERVAL 4 HOUR AS window_end, count(*) AS events_count FROM ev "
          "GROUP BY user_id, session_id")
def d2w(spark, sf):
    out = S.session_windows(D.events(spark, sf), "4 hours")
    return out.select("user_id", F.col("started_at").cast("timestamp_ntz").alias("started_at"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "events_count")


@register("d3_landing_exit",
          f"WITH {cte(page=True, sessions=True)} SELECT session_id, arg_min(page_url, (event_time, id)) AS landing_page, "
          "arg_max(page_url, (event_time, id)) AS exit_page FROM ev GROUP BY session_id")
def d3(spark, sf):
    return S.landing_exit(D.events(spark, sf, page=True, sessions=True))


@register("d4_url_params",
          f"SELECT page_id, {_param_sql('url', 'utm_source')} AS utm_source, {_param_sql('url', 'ref')} AS ref, "
          f"{_param_sql('url', 'page')} AS page FROM pages")
def d4(spark, sf):
    pages = D.table(spark, sf, "pages").select("page_id", "url")
    return S.utm(pages, "url", ["utm_source", "ref", "page"]).drop("url")


_USERS_SQL = ("SELECT user_id AS id, min(event_time) AS first_seen, max(event_time) AS last_seen, "
              "count(*) AS total_events, count(DISTINCT session_id) AS total_sessions, "
              "arg_max(country_code, (event_time, id)) AS country_code FROM ev {where} GROUP BY user_id")


@register("d5_users", f"WITH {cte(country=True, sessions=True)} {_USERS_SQL.format(where='')}")
def d5(spark, sf):
    return S.users(D.events(spark, sf, country=True, sessions=True))


_D6_SQL = (f"WITH {cte(country=True, sessions=True)} SELECT id, first_seen, last_seen, total_events, total_sessions, "
           f"country_code, CASE WHEN first_seen < {ts(SPLIT)} THEN {ts(SPLIT)} ELSE {ts(AS_OF)} END AS created_at, "
           f"CASE WHEN last_seen >= {ts(SPLIT)} THEN {ts(AS_OF)} ELSE {ts(SPLIT)} END AS updated_at "
           f"FROM ({_USERS_SQL.format(where='')})")


def _two_loads(spark, sf):
    """Users of the events before SPLIT, and the batch of the later load (sessions continue)."""
    from eventide.functions.timefns import ts_literal
    ev = D.events(spark, sf, country=True)
    cut = ts_literal(SPLIT, ev.schema["event_time"].dataType)
    first = S.sessionize(ev.where(F.col("event_time") < cut), "4 hours", number_col="n")
    state = S.session_state(first, "n")
    second = S.sessionize(ev.where(F.col("event_time") >= cut), "4 hours", number_col="n", state=state)
    stored = S.users(first, number_col="n").withColumn("created_at", cut).withColumn("updated_at", cut)
    return stored, S.users(second, number_col="n", state=state)


@register("d6_upsert_users", _D6_SQL)
def d6(spark, sf):
    """Two loads upserted equal the users of all events: a session over the cut counts once."""
    return S.upsert_users(*_two_loads(spark, sf), AS_OF, mode="accumulate")


@register("d6_upsert_keeps_columns",
          f"WITH u AS ({_D6_SQL}) SELECT u.*, CASE WHEN created_at = {ts(SPLIT)} THEN 'user' || id || '@example.com' END AS email, "
          f"CASE WHEN created_at = {ts(SPLIT)} THEN CAST(first_seen AS DATE) END AS signup_date FROM u")
def d6_columns(spark, sf):
    """Stored columns that the batch does not derive stay."""
    stored, batch = _two_loads(spark, sf)
    stored = stored.withColumns({"email": F.concat(F.lit("user"), F.col("id").cast("string"), F.lit("@example.com")),
                                 "signup_date": F.to_date("first_seen")})
    return S.upsert_users(stored, batch, AS_OF, mode="accumulate")


@register("d2_sessionize_null_users",
          "SELECT count(*) AS rows, count_if(event_id % 7 <> 0) AS labelled FROM events")
def d2_null(spark, sf):
    """Events without a user keep their row and get no session."""
    ev = D.events(spark, sf).withColumn("user_id", F.when(F.col("id").cast("long") % 7 != 0, F.col("user_id")))
    out = S.sessionize(ev, "4 hours")
    return out.agg(F.count(F.lit(1)).alias("rows"), F.count("session_id").alias("labelled"))


@register("d7_campaign_report",
          f"{SESSIONS_WITH} SELECT utm_source, utm_campaign, CAST(started_at AS DATE) AS date, count(*) AS sessions "
          "FROM sess GROUP BY 1, 2, 3")
def d7(spark, sf):
    return S.campaign_report(_sessions(spark, sf))


@register("d7_country_report",
          f"{SESSIONS_WITH} SELECT country_code, CAST(started_at AS DATE) AS date, count(*) AS sessions "
          "FROM sess GROUP BY 1, 2")
def d7c(spark, sf):
    return S.campaign_report(_sessions(spark, sf), ["country_code"])


@register("d2_sessionize_incremental",
          f"WITH {cte(sessions=True)} SELECT id, user_id, event_time, session_id FROM ev")
def d2i(spark, sf):
    """Two loads (before / from 2024-01-16); the second continues the first's sessions."""
    ev = D.events(spark, sf)
    cut = F.lit(SPLIT).cast("timestamp_ntz")
    first = S.sessionize(ev.where(F.col("event_time") < cut), "4 hours", number_col="n")
    state = S.session_state(first, "n")
    second = S.sessionize(ev.where(F.col("event_time") >= cut), "4 hours", number_col="n", state=state)
    cols = ["id", "user_id", "event_time", "session_id"]
    return first.select(*cols).unionByName(second.select(*cols))


def _without_some_users(ev):
    """Every seventh event has no user, hence no country."""
    known = F.col("id").cast("long") % 7 != 0
    return ev.withColumns({c: F.when(known, F.col(c)) for c in ("user_id", "country_code") if c in ev.columns})


_NULL_EV = ("ev0 AS (SELECT * REPLACE (CASE WHEN event_id % 7 <> 0 THEN user_id END AS user_id) FROM events)")
_NULL_CTE = ("WITH " + _NULL_EV + ", " + cte(sessions=True).replace("FROM events e", "FROM ev0 e") + ", n AS (SELECT * REPLACE "
             "(CASE WHEN user_id IS NOT NULL THEN session_id END AS session_id) FROM ev)")


@register("d1_sessions_null_users",
          f"{_NULL_CTE} SELECT session_id AS id, count(*) AS events_count FROM n WHERE session_id IS NOT NULL GROUP BY 1")
def d1_null(spark, sf):
    """Events without a user are in no session, so they make none."""
    ev = S.sessionize(_without_some_users(D.events(spark, sf)), "4 hours")
    return S.sessions(ev, page_view=PAGE_VIEW, click=CLICK, form_submit=FORM_SUBMIT).select("id", "events_count")


@register("d2_late_events",
          f"WITH {cte(sessions=True)} SELECT id, user_id, event_time, session_id FROM ev")
def d2_late(spark, sf):
    """Three loads, each spread over the whole time, end at the labels of one pass over all events."""
    ev = D.events(spark, sf)
    third = F.pmod(F.xxhash64("id"), F.lit(3))
    stored = S.sessionize(ev.where(third == 0), "4 hours", number_col="number")
    intervals = S.session_intervals(stored, "number")
    for k in (1, 2):
        new, intervals, moved = S.repair_sessions(intervals, ev.where(third == k), "4 hours")
        stored = S.relabel(stored, moved).unionByName(new.select(*stored.columns))
    return stored.select("id", "user_id", "event_time", "session_id")


def _null_loads(spark, sf):
    """Two loads with events without a user: labelled first load, state after it, labelled second load."""
    from eventide.functions.timefns import ts_literal
    ev = _without_some_users(D.events(spark, sf, country=True))
    cut = ts_literal(SPLIT, ev.schema["event_time"].dataType)
    first = S.sessionize(ev.where(F.col("event_time") < cut), "4 hours", number_col="n")
    state = S.session_state(first, "n")
    return first, state, S.sessionize(ev.where(F.col("event_time") >= cut), "4 hours", number_col="n", state=state)


_NULL_USERS = ("WITH " + _NULL_EV + ", " + cte(country=True, sessions=True).replace("FROM events e", "FROM ev0 e") + ", n AS (SELECT * REPLACE "
               "(CASE WHEN user_id IS NOT NULL THEN session_id END AS session_id) FROM ev), "
               "u AS (SELECT user_id AS id, min(event_time) AS first_seen, max(event_time) AS last_seen, count(*) AS total_events, "
               "count(DISTINCT session_id) AS total_sessions, arg_max(country_code, (event_time, id)) AS country_code FROM n {w} GROUP BY 1)")


@register("d5_users_incremental",
          _NULL_USERS.format(w=f"WHERE event_time >= {ts(SPLIT)}") + ", "
          f"b AS (SELECT user_id AS id, count(DISTINCT session_id) AS before FROM n WHERE event_time < {ts(SPLIT)} GROUP BY 1), "
          "a AS (SELECT user_id AS id, count(DISTINCT session_id) AS all_sessions FROM n GROUP BY 1) "
          "SELECT coalesce(CAST(u.id AS VARCHAR), 'nobody') AS id, first_seen, last_seen, total_events, CAST(a.all_sessions - coalesce(b.before, 0) AS BIGINT) AS total_sessions, "
          "country_code FROM u JOIN a ON u.id IS NOT DISTINCT FROM a.id LEFT JOIN b ON u.id IS NOT DISTINCT FROM b.id")
def d5_incremental(spark, sf):
    """Users of the second load, the one without an id among them; sessions begun in it."""
    _, state, second = _null_loads(spark, sf)
    return _named(S.users(second, number_col="n", state=state))


def _named(users):
    """The user without an id shown as 'nobody'."""
    return users.withColumn("id", F.coalesce(F.col("id").cast("string"), F.lit("nobody")))


_STORED = (_NULL_USERS.format(w="") + f" SELECT * REPLACE (coalesce(CAST(id AS VARCHAR), 'nobody') AS id), CASE WHEN first_seen < {ts(SPLIT)} THEN {ts(SPLIT)} ELSE {ts(AS_OF)} END AS created_at, "
           f"CASE WHEN last_seen >= {ts(SPLIT)} THEN {ts(AS_OF)} ELSE {ts(SPLIT)} END AS updated_at FROM u")


@register("d6_upsert_null_users", _STORED)
def d6_null(spark, sf):
    """Two loads upserted: one user without an id, as over all events."""
    from eventide.functions.timefns import ts_literal
    first, state, second = _null_loads(spark, sf)
    cut = ts_literal(SPLIT, first.schema["event_time"].dataType)
    stored = S.users(first, number_col="n").withColumn("created_at", cut).withColumn("updated_at", cut)
    return _named(S.upsert_users(stored, S.users(second, number_col="n", state=state), AS_OF))


@register("d6_stored_users", _STORED)
def d6_stored(spark, sf):
    """Two loads merged into the stored dimension, bucket by bucket, and read back."""
    from eventide.operators import parts
    from eventide.session import scratch_dir
    store = scratch_dir(spark, "users-store")
    first, state, second = _null_loads(spark, sf)
    S.store_users(spark, store, S.users(first, number_col="n"), SPLIT, buckets=16)
    S.store_users(spark, store, S.users(second, number_col="n", state=state), AS_OF, buckets=16)
    return _named(parts.read(spark, store, S.USERS))
