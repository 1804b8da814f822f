"""Plan shape checks: pruning, pushdown, top-k, and no Python in any query."""

import pytest

import __spark_entry__ as E
from eventide import registry
from eventide.operators import queries as Q
from eventide.plans.inspect import plan_text
from eventide.session import scratch_dir
from eventide.sources import driver as D
from eventide.sources import ingest as I
from tests.conftest import SF_SMALL


def test_partition_pruning_on_store(spark):
    ev = D.events(spark, SF_SMALL)
    orders = D.table(spark, SF_SMALL, "orders")
    bound = I.bind(orders, {"id": "o_orderkey", "event_time": "o_orderdate", "user_id": "o_custkey",
                            "event_type": "o_orderstatus"})
    path = scratch_dir(spark, "plan-store")
    I.append_events(bound, path)
    store = I.read_store(spark, path)
    text = plan_text(Q.q2_recent_count(store, "2001-08-31 00:00:00", "30 days"))
    assert "PartitionFilters: [isnotnull(event_month" in text and "event_month" in text.split("PartitionFilters:")[1].split("\n")[0]
    assert "PushedFilters: [IsNotNull(event_time), GreaterThanOrEqual(event_time" in text
    assert Q.q2_recent_count(store, "2001-08-31 00:00:00", "30 days").collect()[0][0] == \
        bound.where("event_time >= timestamp'2001-08-01 00:00:00'").count()
    assert ev is not None


def test_footer_count_on_store(spark):
    from pyspark.sql import functions as F
    ev = D.events(spark, SF_SMALL)
    path = scratch_dir(spark, "plan-footer")
    I.append_events(ev, path)
    store = I.read_store(spark, path, footer_aggregates=True)
    q1 = Q.q1_total(store)
    assert "PushedAggregation: [COUNT(*)]" in plan_text(q1)
    assert q1.collect()[0][0] == ev.count()
    by_month = store.where(F.col("event_month") == "2024_01").agg(F.count(F.lit(1)))
    assert "PushedAggregation: [COUNT(*)]" in plan_text(by_month)
    # the session still reads Parquet with the default reader afterwards
    assert "BatchScan" not in plan_text(Q.q1_total(I.read_store(spark, path)))


def test_top_k_is_take_ordered(spark):
    text = plan_text(Q.q4_top_users(D.events(spark, SF_SMALL), D.AS_OF))
    assert "TakeOrderedAndProject" in text


def test_count_reads_no_columns(spark):
    text = plan_text(Q.q1_total(D.events(spark, SF_SMALL)))
    assert "ReadSchema: struct<>" in text


@pytest.mark.parametrize("name", sorted(k for k in registry.QUERIES if not k.startswith(("s1_", "s5_", "s6_", "s8_", "m1_", "m2_", "m5_", "m4_", "m6_", "rq", "p5_partition_bytes", "p7_"))))
def test_no_python_udf_and_no_cross_join(spark, name):
    text = plan_text(E.queries()[name](spark, SF_SMALL))
    assert "BatchEvalPython" not in text and "ArrowEvalPython" not in text
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text


def test_bounded_broadcast_checks_rows_and_bytes(spark):
    from pyspark.sql import functions as F
    from eventide.plans.broadcast import bounded_broadcast, side_size
    small = spark.range(10).select(F.col("id"), F.lit("x" * 100).alias("s"))
    assert side_size(small) == (10, 10 * (8 + 100))
    big = spark.range(10)
    facts = spark.range(1000).withColumnRenamed("id", "k")
    hinted = facts.join(bounded_broadcast(big), facts.k == big.id)
    assert "BroadcastHashJoin" in plan_text(hinted) or "broadcast" in plan_text(hinted, "extended").lower()
    wide = spark.range(10).select(F.col("id"), F.lit("y" * 1000).alias("s"))
    assert bounded_broadcast(wide, max_bytes=5000) is wide          # 10 kB > 5 kB bound: no hint
    assert bounded_broadcast(big, max_rows=5) is big                 # 10 rows > 5: no hint
