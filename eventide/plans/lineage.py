"""Cut long lineages with a reliable checkpoint in the shared folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from eventide.session import scratch_dir


def cut_lineage(df: DataFrame, eager: bool = True) -> DataFrame:
    """``df.checkpoint()`` into ``spark.checkpoint.dir``.

    The checkpoint is written to the cluster's shared folder (set up by
    :func:`eventide.session.scratch_dir` only when the session has none),
    so a lost executor does not lose the data, unlike a local checkpoint.
    """
    spark = df.sparkSession
    scratch_dir(spark, "ckpt")  # makes sure a checkpoint dir is registered
    return df.checkpoint(eager=eager)


def materialize(df: DataFrame, name: str = "stage") -> DataFrame:
    """Write ``df`` as Parquet to a fresh directory in the shared folder and
    read it back: cuts the lineage, survives executor loss, and later scans
    are columnar with pushdown (unlike a checkpointed RDD)."""
    path = scratch_dir(df.sparkSession, name)
    df.write.mode("errorifexists").parquet(path)
    return df.sparkSession.read.parquet(path)
