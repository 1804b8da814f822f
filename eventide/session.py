"""Session configuration shared by the library, tests and the bench."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import SparkSession

# Settings every operator relies on.  They are session-level, so a
# cluster deployment sets them once in spark-defaults or here.
REQUIRED_CONF = {
    # All timestamps are UTC; the reference stores TIMESTAMPTZ.
    "spark.sql.session.timeZone": "UTC",
    # Runtime re-planning: coalesce small shuffle partitions, split skewed
    # join partitions, switch to broadcast when a side turns out small.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # JSONB keeps the last of duplicate keys; Variant does too with this.
    "spark.sql.variant.allowDuplicateKeys": "true",
    # Answer count(*) from Parquet footers when read through the DSv2
    # reader (see sources.ingest.read_store(footer_aggregates=True)).
    "spark.sql.parquet.aggregatePushdown": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the session settings the operators assume."""
    for k, v in REQUIRED_CONF.items():
        spark.conf.set(k, v)
    return spark


def get_spark(app: str = "eventide", master: str | None = None,
              shuffle_partitions: int | None = None) -> SparkSession:
    """Get or create a session with the library's settings.

    ``master`` defaults to ``local[$BENCH_CPUS or *]`` only outside ``spark-submit``
    (which sets PYSPARK_GATEWAY_PORT and provides the master) and when neither
    SPARK_MASTER nor MASTER names one.  Shuffle partitions are left to the
    cluster unless given; local runs use 8.
    """
    b = SparkSession.builder.appName(app)
    if master is None and not any(os.environ.get(k) for k in ("PYSPARK_GATEWAY_PORT", "SPARK_MASTER", "MASTER")):
        master = f"local[{os.environ.get('BENCH_CPUS', '*')}]"
    if master:
        b = b.master(master)
    if shuffle_partitions is None and (master or "").startswith("local["):
        shuffle_partitions = 8
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    b = (b.config("spark.ui.enabled", "false")
         .config("spark.ui.showConsoleProgress", "false")
         .config("spark.driver.memory", os.environ.get("EVENTIDE_DRIVER_MEMORY", "16g")))
    for k, v in REQUIRED_CONF.items():
        b = b.config(k, v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def _context(spark: SparkSession):
    """The SparkContext of a classic session; None under Spark Connect."""
    try:
        return spark.sparkContext
    except Exception:  # noqa: BLE001 - Connect sessions have no SparkContext
        return None


def ship_package(spark: SparkSession) -> None:
    """Send this package to the executors, once per context.

    Python code that runs in tasks is pickled by reference, so the workers
    must be able to import it wherever the driver found it.
    """
    sc = _context(spark)
    if sc is None or getattr(sc, "_eventide_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="eventide-code-"), "eventide.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for f in sorted(files):
                if f.endswith(".py"):
                    full = os.path.join(folder, f)
                    z.write(full, os.path.join("eventide", os.path.relpath(full, root)))
    sc.addPyFile(path)
    sc._eventide_shipped = True


def tune_for_input(spark: SparkSession, input_bytes: int, *, target_partition_bytes: int = 256 << 20,
                   min_partitions: int | None = None, max_partitions: int = 100_000) -> dict[str, str]:
    """Size shuffles and scans from the input size (spill-aware defaults).

    Initial shuffle partitions = input / target (at least the cluster's
    default parallelism, at most ``max_partitions``); AQE then coalesces small ones toward the
    advisory size and splits skewed join partitions above it.  Scans split
    files at the same target.  Returns the settings applied.
    """
    sc = _context(spark)
    cores = min_partitions or (sc.defaultParallelism if sc is not None else 8)
    # Capped: the shuffle's map-output bookkeeping grows with maps x reducers,
    # so at ~100 TB each reducer takes ~1 GB (sorted/aggregated with spill).
    n = min(max_partitions, max(int(cores), -(-int(input_bytes) // target_partition_bytes)))
    conf = {
        "spark.sql.shuffle.partitions": str(n),
        "spark.sql.adaptive.coalescePartitions.initialPartitionNum": str(n),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(target_partition_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
    }
    for k, v in conf.items():
        spark.conf.set(k, v)
    return conf


def input_size(paths, spark: SparkSession | None = None) -> int:
    """Total bytes of input files or directories (for tune_for_input).

    With ``spark`` the paths may be on any file system that Spark reads;
    without it they must be local."""
    if spark is not None:
        jvm, conf = spark._jvm, spark._jsparkSession.sessionState().newHadoopConf()
        hadoop = [jvm.org.apache.hadoop.fs.Path(p) for p in ([paths] if isinstance(paths, str) else paths)]
        return sum(p.getFileSystem(conf).getContentSummary(p).getLength() for p in hadoop)
    total = 0
    for p in ([paths] if isinstance(paths, str) else paths):
        p = p.replace("file:", "")
        if os.path.isdir(p):
            for root, _, files in os.walk(p):
                total += sum(os.path.getsize(os.path.join(root, f)) for f in files)
        elif os.path.exists(p):
            total += os.path.getsize(p)
    return total


def scratch_dir(spark: SparkSession, name: str = "") -> str:
    """A fresh directory under the cluster's shared checkpoint folder.

    The folder comes from ``spark.checkpoint.dir`` (or a directory set with
    ``setCheckpointDir``).  Only when neither is set and the master is ``local``
    (tests) a private folder under the system temp dir is created and registered;
    on a cluster that raises, because executors would each write to their own disk.
    """
    sc = _context(spark)
    base = spark.conf.get("spark.checkpoint.dir", None)
    if sc is not None:
        base = base or sc.getConf().get("spark.checkpoint.dir", None)
        if base and not sc.getCheckpointDir():
            sc.setCheckpointDir(base)  # so DataFrame.checkpoint() writes there too
        if not base:
            base = sc.getCheckpointDir()
    if not base:
        master = sc.master if sc is not None else ""
        if not (master == "local" or master.startswith("local[")):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        base = tempfile.mkdtemp(prefix="eventide-ckpt-")
        if sc is not None:
            sc.setCheckpointDir(base)
        else:
            spark.conf.set("spark.checkpoint.dir", base)
    base = base.rstrip("/")
    return f"{base}/{name or 'work'}-{uuid.uuid4().hex[:12]}"
