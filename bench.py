"""Benchmark: the reference's Q1-Q6 on raw events and over rollups.

Mirrors how the reference is used: events are loaded once into the
month-partitioned store, the six benchmark queries run on the raw store,
the rollups are refreshed, and the same questions are answered from the
rollups.  Every timed query runs once as warm-up and then BENCH_REPEAT
times; the median is reported.  Prints ONE JSON line.

env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
     BENCH_REPEAT (default 3)
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from eventide.session import get_spark, input_size, scratch_dir, tune_for_input  # noqa: E402


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    spark = get_spark("eventide-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus))
    # Partition sizing from the input size (at sf0.1 this stays at one partition per core).
    tune_for_input(spark, input_size(sf_dir), min_partitions=int(cpus))

    from eventide.operators import queries as Q
    from eventide.operators import refresh as M
    from eventide.operators import rollups as R
    from eventide.operators import profile as V
    from eventide.operators.funnel import funnel
    from eventide.operators import sessions as S
    from eventide.sources import driver as D
    from eventide.sources import ingest as I

    as_of = D.AS_OF
    times: dict[str, float] = {}

    def timed(name, make, action="collect"):
        nonlocal times

        def run():
            df = make()
            if action == "call":
                return
            if action == "collect":
                df.collect()
            else:
                df.write.format("noop").mode("overwrite").save()
        run()  # warm-up
        samples = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            run()
            samples.append(time.perf_counter() - t0)
        times[name] = round(statistics.median(samples), 4)

    # JVM warm-up (class loading, codegen caches) outside the timings.
    D.events(spark, sf_dir, country=True).groupBy("event_type").count().collect()

    # Load: bind (country + 4 h sessions) and write the month-partitioned store.
    events = D.events(spark, sf_dir, country=True, device=True, sessions=True)
    stores = []

    def load():
        stores.append(scratch_dir(spark, "bench-store"))
        I.append_events(events, stores[-1])

    timed("load_events", load, "call")
    ev = I.read_store(spark, stores[-1])
    ev_footers = I.read_store(spark, stores[-1], footer_aggregates=True)  # count(*) from Parquet footers

    # Raw benchmark queries Q1-Q6 over the store.
    timed("q1_count", lambda: Q.q1_total(ev_footers))
    timed("q2_count_7d", lambda: Q.q2_recent_count(ev, as_of, "7 days"))
    timed("q3_by_type_24h", lambda: Q.q3_by_type(ev, as_of, "24 hours"))
    timed("q4_top_users_30d", lambda: Q.q4_top_users(ev, as_of, "30 days", 100))
    timed("q5_json_contains", lambda: Q.q5_json_count(ev, {"k": 69}))
    timed("q6_daily_country_7d", lambda: Q.q6_daily_country(ev, as_of, "7 days", 50))

    # Refresh the rollups (one scan into the base cube, then each rollup).
    rstores = []
    names = ["stats_totals", "stats_hourly", "stats_daily_users", "stats_geo_events", "mv_stats_total",
             "mv_hourly_stats"]

    def refresh():
        rstores.append(scratch_dir(spark, "bench-rollups"))
        M.refresh_all(spark, ev, rstores[-1], as_of, names=names,
                      options={"stats_geo_events": {"event_types": ["view", "click", "signup"]}})

    timed("refresh_all", refresh, "call")
    rstore = rstores[-1]
    totals = M.read_rollup(spark, rstore, "stats_totals")
    hourly = M.read_rollup(spark, rstore, "stats_hourly")
    daily = M.read_rollup(spark, rstore, "stats_daily_users")
    geo = M.read_rollup(spark, rstore, "stats_geo_events")
    mv_hourly = M.read_rollup(spark, rstore, "mv_hourly_stats")

    timed("rq1_totals", lambda: R.rq1_totals(totals))
    timed("rq2_recent_7d", lambda: R.rq2_recent(hourly, as_of, 7))
    timed("rq3_by_type_24h", lambda: R.rq3_by_type(hourly, as_of, 24))
    timed("rq4_top_users_30d", lambda: R.rq4_top_users(daily, as_of, 30, 100))
    timed("rq6_geo_7d", lambda: R.rq6_geo(geo, as_of, 7, ("view", "click"), 50))
    # The README's hourly view: computed from raw events vs read from the rollup.
    timed("hourly_agg_raw", lambda: R.mv_hourly_stats(ev))
    timed("rq_hourly_agg_read", lambda: mv_hourly)

    # Heavier derived work over the whole store.
    timed("d1_sessions", lambda: S.sessions(ev, page_view="view", click="click", form_submit="signup"), "noop")
    timed("d2_sessionize", lambda: S.sessionize(ev.drop("session_id"), "4 hours"), "noop")
    # Incremental sessionization: label the last day given the state of the days before it.
    last_day = F.col("event_time") >= F.lit("2024-01-30 00:00:00").cast("timestamp_ntz")
    earlier = S.sessionize(ev.where(~last_day).drop("session_id"), "4 hours", number_col="n")
    state = S.session_state(earlier, "n").cache()
    state.count()
    timed("d2_sessionize_last_day_incremental",
          lambda: S.sessionize(ev.where(last_day).drop("session_id"), "4 hours", state=state), "noop")
    timed("u4_funnel", lambda: funnel(ev, ["view", "click", "purchase"], "24 hours"))
    timed("v6_pareto", lambda: V.pareto(ev, "user_id", 20.0))
    timed("r2_hourly_from_raw", lambda: R.stats_hourly(ev), "noop")

    # Other operator families over the whole store.
    from eventide.operators import oplog as L
    from eventide.operators import partitions as P
    timed("u5_dau_by_country", lambda: Q.u5_dau_by_country(ev))
    timed("v1_share_by_type", lambda: V.share(ev, "event_type", 2))
    timed("p5_partitions_with_bytes", lambda: P.list_partitions(ev, with_bytes=True))
    timed("s4_validate", lambda: I.validate(ev.drop("event_month"), time_range=("2024-01-01 00:00:00",
                                                                                "2024-02-01 00:00:00"))[1], "noop")
    timed("l1_slow_operations", lambda: L.slow_operations(
        L.statement_stats(ev.withColumn("ms", F.timestamp_diff("MICROSECOND", "event_time", "created_at") / 1000.0),
                          op="event_type", ms="ms")))
    days = [f"2024-01-{d}" for d in range(24, 31)]
    timed("m2_refresh_7_days", lambda: M.refresh_dates(spark, rstore, "stats_daily_users", ev, days, as_of), "noop")

    # One corrected day of 31, to and fro: only that day is written.
    wrong = ev.withColumn("event_type", F.when((F.to_date("event_time") == F.lit("2024-01-10").cast("date")) & (F.col("id") % 3 == 0), "mistyped")
                          .otherwise(F.col("event_type")))
    M.write_days(spark, rstore, "mv_hourly_stats", wrong, as_of)
    turn = [0]

    def corrected():
        turn[0] += 1
        return M.refresh_changed(spark, rstore, "mv_hourly_stats", ev if turn[0] % 2 else wrong, ["2024-01-10"], as_of)

    timed("m2_refresh_changed_day", corrected)
    # The payload stored as Variant: Q5's question without parsing text.
    from eventide.functions.jsonmatch import to_payload, variant_contains
    vstore = scratch_dir(spark, "bench-variant")
    to_payload(ev.select("id", "event_time", "properties")).write.parquet(vstore)
    parsed = spark.read.parquet(vstore)
    timed("q5_stored_variant", lambda: Q.count_rows(parsed.where(variant_contains("properties", {"k": 69}))))

    # A dense set (50 users, ten times the events), as in the reference's own data: here rollups are much smaller than events.
    sparse, times = times, {}
    many = (ev.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(9)))).withColumn("user_id", F.col("user_id") % 50)
            .withColumn("session_id", F.concat_ws("-", "user_id", F.to_date("event_time").cast("string"))).drop("copy"))
    dpath, dstore = scratch_dir(spark, "bench-dense"), scratch_dir(spark, "bench-dense-rollups")
    I.append_events(many, dpath)
    dense = I.read_store(spark, dpath)
    M.refresh_all(spark, dense, dstore, as_of, names=["stats_hourly", "stats_daily_users"])
    dhourly, ddaily = M.read_rollup(spark, dstore, "stats_hourly"), M.read_rollup(spark, dstore, "stats_daily_users")
    timed("q2_raw", lambda: Q.q2_recent_count(dense, as_of, "7 days"))
    timed("q2_rollup", lambda: R.rq2_recent(dhourly, as_of, 7))
    timed("q3_raw", lambda: Q.q3_by_type(dense, as_of, "24 hours"))
    timed("q3_rollup", lambda: R.rq3_by_type(dhourly, as_of, 24))
    timed("q4_raw", lambda: Q.q4_top_users(dense, as_of, "30 days", 100))
    timed("q4_rollup", lambda: R.rq4_top_users(ddaily, as_of, 30, 100))
    dense_times, times = times, sparse

    raw = sum(times[k] for k in times if k.startswith("q"))
    rolled = sum(times[k] for k in times if k.startswith("rq"))
    pairs = {"q1": ("q1_count", "rq1_totals"), "q2": ("q2_count_7d", "rq2_recent_7d"),
             "q3": ("q3_by_type_24h", "rq3_by_type_24h"), "q4": ("q4_top_users_30d", "rq4_top_users_30d"),
             "q6": ("q6_daily_country_7d", "rq6_geo_7d"), "hourly": ("hourly_agg_raw", "rq_hourly_agg_read")}
    speedup = {k: round(times[a] / times[b], 2) for k, (a, b) in pairs.items() if times.get(b)}

    print(json.dumps({
        "metric": "total_query_sec", "value": round(sum(times.values()), 4), "unit": "sec",
        "queries": times, "raw_q1_q6_sec": round(raw, 4), "rollup_q_sec": round(rolled, 4),
        "rollup_speedup": speedup, "dense_sec": dense_times,
        "sf": os.path.basename(sf_dir).replace("sf", ""), "cpus": int(cpus), "repeat": repeat,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
