"""Month pruning by a bound known at run time, sizes from listings, payload stored as Variant."""

import json

from pyspark.sql import functions as F

from eventide.functions.jsonmatch import json_contains, member_eq, to_payload, variant_contains
from eventide.operators import partitions as P, queries as Q, refresh as M
from eventide.plans.inspect import plan_text
from eventide.plans.lineage import materialize
from eventide.session import scratch_dir
from eventide.sources import driver as D, ingest as I
from tests.conftest import SF_SMALL


def months_store(spark):
    rows = [(i, f"2024-{m:02d}-{d:02d} 12:00:00") for i, (m, d) in enumerate((m, d) for m in range(1, 13) for d in (1, 15))]
    df = spark.createDataFrame(rows, "id long, t string").select("id", F.col("t").cast("timestamp").alias("event_time"))
    path = scratch_dir(spark, "t-months")
    I.append_events(df, path, bloom=())
    return path, df


def files_read(spark, df):
    """Files that the scan of an executed plan has read."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan()
    todo, n = [plan], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
            continue
        if name in ("ShuffleQueryStageExec", "BroadcastQueryStageExec", "ResultQueryStageExec"):
            todo.append(node.plan())
            continue
        if name == "FileSourceScanExec":
            n += node.metrics().apply("numFiles").value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return n


def test_a_subquery_bound_prunes_months(spark):
    path, df = months_store(spark)
    store = I.read_store(spark, path)
    latest = spark.createDataFrame([("2024-11-10 00:00:00",), ("2024-10-01 00:00:00",)], "t string").agg(F.max("t").cast("timestamp")).scalar()
    got = Q.in_window(store, latest)
    assert "PartitionFilters: [isnotnull(event_month" in plan_text(got) and "Subquery" in plan_text(got)
    n_all, n_pruned = files_read(spark, store), files_read(spark, got)
    assert got.count() == 3 and 0 < n_pruned <= n_all / 4
    both = Q.in_window(store, latest, F.lit("2024-11-30 00:00:00").cast("timestamp"))
    assert both.count() == 1 and files_read(spark, both) < n_pruned


def test_a_bound_per_row_is_not_cut_short(spark):
    path, _ = months_store(spark)
    store = I.read_store(spark, path).withColumn("lo", F.when(F.col("id") % 2 == 0, F.col("event_time")).otherwise(F.lit("2025-01-01").cast("timestamp")))
    assert Q.in_window(store, F.col("lo")).count() == 12


def test_sizes_come_from_the_listing(spark):
    path, df = months_store(spark)
    found = P.partition_bytes(spark, path)
    plan = plan_text(found)
    assert "binaryFile" in plan and "Format: Parquet" not in plan and "ReadSchema: struct<path:string,length:bigint>" in plan
    want = {r.partition_name: r.total_size for r in P.list_partitions(I.read_store(spark, path), with_bytes=True).collect()}
    assert {r.partition_name: r.total_size for r in found.collect()} == want and len(want) == 12


def test_inventory_reads_no_rollup(spark):
    store = scratch_dir(spark, "t-inventory")
    ev = D.events(spark, SF_SMALL, country=True, sessions=True)
    assert M.inventory(spark, store).collect() == []
    M.refresh_all(spark, ev, store, D.AS_OF, names=["stats_totals", "mv_hourly_stats"])
    M.refresh_all(spark, ev.where("id % 2 = 0"), store, D.AS_OF, names=["mv_hourly_stats"])
    got = {r.rollup: (r.rows, r.bytes) for r in M.inventory(spark, store).collect()}
    for name, (rows, size) in got.items():
        exact = M.file_stats(M.read_rollup(spark, store, name)).first()
        assert (rows, size) == (exact.rows, exact.bytes)
    assert set(got) == {"stats_totals", "mv_hourly_stats"}
    assert M.inventory(spark, store, names=["none of them"]).collect() == []


DOCS = ['{"k": 69, "a": [1, {"b": null}]}', '{"k": 69.0}', '{"k": "69"}', '{"k": null}', '[69]', '69', None, "broken {", "{}", '{"k": [69]}',
        '{"a b": true, "q\\"x": 1}', '{"k": 1e2}', '{"K": 69}']


def test_variant_payload_answers_as_the_text(spark):
    df = spark.createDataFrame(list(enumerate(DOCS)), "id long, properties string")
    stored = materialize(to_payload(df), "t-variant")
    for pattern in ({"k": 69}, {"k": None}, {"a": [{"b": None}]}, {"a b": True}, {'q"x': 1}, 69, {}, {"k": "69"}, {"k": 100}):
        text = json.dumps(pattern)
        want = {r.id for r in df.where(json_contains("properties", text)).collect()}
        assert {r.id for r in stored.where(variant_contains("properties", text)).collect()} == want
        if isinstance(pattern, dict) and len(pattern) == 1 and not isinstance(next(iter(pattern.values())), list):
            (k, v), = pattern.items()
            assert {r.id for r in stored.where(member_eq("properties", k, v)).collect()} == want
