"""Session-level helpers: shared scratch space and materialisation."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

def scratch_dir(spark: SparkSession) -> str:
    """Shared folder for materialised intermediates.

    It is the folder the cluster names in ``spark.checkpoint.dir`` (or the one set on the
    context). A temporary folder is used only in local mode, where there is one machine.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        if not context.master.partition("[")[0] == "local":  # local-cluster has executors of its own
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="sitefold-"))
    return context.getCheckpointDir()


def fresh_path(spark: SparkSession, label: str) -> str:
    """A new, unused path below the scratch folder."""
    return f"{scratch_dir(spark)}/sitefold/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str, partition_by: str | None = None) -> DataFrame:
    """Write ``df`` once to shared storage and read it back.

    Cuts the lineage: values that depend on how rows were placed (partition ids, range
    bounds) stay fixed even when executors are lost later. Parquet keeps column pruning. With
    ``partition_by``, the last column, each of its values has a folder with one file.
    """
    path = fresh_path(df.sparkSession, label)
    if partition_by is None:
        df.write.parquet(path)
    else:
        df.repartition(partition_by).write.partitionBy(partition_by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Let Spark drop the shuffles and broadcasts that nothing refers to any more.

    Its cleaner learns of them when the driver's JVM collects its garbage. Until then a job of many small
    steps keeps them on the executors' disks, and the driver's heap grows by what the steps leave.
    """
    gc.collect()  # Python's proxies hold the JVM's objects
    spark.sparkContext._jvm.System.gc()
