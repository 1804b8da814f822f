"""Measure the largest task of the sessionizer under a hot user.

Every third event of the sf table is given to one user (a third of all
rows), then a plain per-user window and ``sessionize`` run with the event
log written to ``logdir`` (a scratch folder).  Prints, per shuffle stage,
the most records one task read, out of the stage's total.

usage: python tools/skew_check.py <empty logdir> [sf_dir]
"""

from __future__ import annotations

import glob
import io
import json
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def run(logdir: str, sf: str) -> None:
    from pyspark.sql import SparkSession, Window, functions as F
    from eventide.operators import sessions as S
    from eventide.session import configure
    from eventide.sources import driver as D

    spark = (SparkSession.builder.master("local[8]").config("spark.ui.enabled", "false")
             .config("spark.ui.showConsoleProgress", "false")
             .config("spark.eventLog.enabled", "true").config("spark.eventLog.dir", f"file://{logdir}")
             .config("spark.sql.shuffle.partitions", "64").getOrCreate())
    configure(spark)
    # Broadcast off and no coalescing: the shape of the plan at 100 TB.
    for k, v in {"spark.sql.adaptive.coalescePartitions.enabled": "false",
                 "spark.sql.autoBroadcastJoinThreshold": "-1",
                 "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}.items():
        spark.conf.set(k, v)
    ev = D.events(spark, sf)
    ev = ev.withColumn("user_id", F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("user_id")))
    gap = 4 * 3600 * 10 ** 6
    spark.sparkContext.setJobGroup("plain per-user window", "")
    w = Window.partitionBy("user_id").orderBy("event_time", "id")
    prev = F.lag("event_time").over(w)
    flag = F.when(prev.isNull() | (F.timestamp_diff("MICROSECOND", prev, F.col("event_time")) > gap), 1).otherwise(0)
    (ev.withColumn("f", flag).withColumn("n", F.sum("f").over(w.rowsBetween(Window.unboundedPreceding, 0)))
     .write.format("noop").mode("overwrite").save())
    spark.sparkContext.setJobGroup("sessionize (hour buckets)", "")
    S.sessionize(ev, "4 hours", bucket="hour").write.format("noop").mode("overwrite").save()
    # Hot user in a shuffle join (events left-joined to the user dimension):
    # AQE's skew split, with its thresholds scaled down to this data size.
    spark.conf.set("spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes", "4096")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "4096")
    spark.sparkContext.setJobGroup("dimension join (AQE skew split)", "")
    dim = D.user_dimension(spark, sf).withColumn("user_id", F.col("user_id"))
    dim = dim.unionByName(dim.where("user_id = 0").withColumn("user_id", F.lit(-1).cast("long")))
    # AQE splits a skewed partition along ranges of map tasks; the sf file is
    # one row group (one mapper), so spread it over 16 mappers first, as a
    # large input is anyway.
    ev.repartition(16).join(dim, "user_id", "left").write.format("noop").mode("overwrite").save()
    spark.stop()


def report(logdir: str) -> None:
    import zstandard
    stage_group, most, total = {}, {}, {}
    for f in sorted(glob.glob(os.path.join(logdir, "**", "events_*"), recursive=True)):
        raw = open(f, "rb").read()
        if f.endswith(".zstd"):
            raw = zstandard.ZstdDecompressor().stream_reader(io.BytesIO(raw)).read()
        for line in raw.decode().splitlines():
            e = json.loads(line)
            if e.get("Event") == "SparkListenerJobStart":
                for sid in e.get("Stage IDs", []):
                    stage_group[sid] = (e.get("Properties") or {}).get("spark.jobGroup.id")
            elif e.get("Event") == "SparkListenerTaskEnd":
                recs = ((e.get("Task Metrics") or {}).get("Shuffle Read Metrics") or {}).get("Total Records Read", 0)
                key = (stage_group.get(e["Stage ID"]), e["Stage ID"])
                most[key] = max(most.get(key, 0), recs)
                total[key] = total.get(key, 0) + recs
    for group in ("plain per-user window", "sessionize (hour buckets)", "dimension join (AQE skew split)"):
        stages = sorted(k for k in most if k[0] == group and total[k] > 0)
        print(f"{group}: " + "; ".join(f"stage {s}: largest task {most[(g, s)]} of {total[(g, s)]} records"
                                       for g, s in stages))


if __name__ == "__main__":
    logdir = os.path.abspath(sys.argv[1])
    run(logdir, sys.argv[2] if len(sys.argv) > 2 else "/root/testdata/sf0.1")
    report(logdir)
