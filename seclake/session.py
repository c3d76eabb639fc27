"""Session construction and lineage cutting.

Cluster settings (executor memory, shuffle partitions, checkpoint folder)
belong to the cluster; ``build_session`` only fills in values that are
unset, which is what tests and the local bench need.
"""

from __future__ import annotations

import contextvars
import os
import uuid

from pyspark.sql import DataFrame, SparkSession

# Defaults applied only when the cluster has not set them.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # AQE turns a sort-merge join into a broadcast only after it has
    # measured the materialised side; that is the size check for every
    # aggregate-then-attach join in the detection plan.
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "64MB",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "10000",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(master: str | None = None, shuffle_partitions: int | None = None,
                  app_name: str = "seclake", driver_memory: str | None = None) -> SparkSession:
    """``driver_memory`` matters in local mode, where every task runs in the
    driver JVM; it only takes effect when this call starts the JVM."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    if driver_memory:
        builder = builder.config("spark.driver.memory", driver_memory)
    builder = builder.config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    spark = builder.getOrCreate()
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) in (None, ""):
            spark.conf.set(key, value)
    spark.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone", "UTC"))
    return spark


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only when nothing is configured and the master is local (a test) a
    folder is created under the system temp dir; on a cluster a missing
    setting is an error, never a machine-local folder.
    """
    sc = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or sc.getConf().get("spark.checkpoint.dir", None)
    current = sc.getCheckpointDir()
    if current:
        return current
    if not configured:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
        import tempfile
        configured = tempfile.mkdtemp(prefix="seclake-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir() or configured


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as parquet into the checkpoint folder and read it back.

    Cuts lineage (a lost executor re-reads the written files instead of
    recomputing the plan) and is columnar, so later readers prune columns.
    What is written stays until the ``Scratch`` around it ends.
    """
    spark = df.sparkSession
    base = checkpoint_dir(spark)
    path = os.path.join(base, f"{name}-{uuid.uuid4().hex}")
    for scratch in _SCRATCH.get():
        scratch.paths.append(path)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def _hadoop_path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def list_path(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder, by Spark's file system; none if there is no such folder."""
    p, fs = _hadoop_path(spark, path)
    return sorted(x.getPath().getName() for x in fs.listStatus(p)) if fs.exists(p) else []


def delete_path(spark: SparkSession, path: str) -> None:
    p, fs = _hadoop_path(spark, path)
    fs.delete(p, True)


_SCRATCH: contextvars.ContextVar[tuple] = contextvars.ContextVar("scratch", default=())


class Scratch:
    """Removes, when it ends, all that ``materialize`` wrote inside it. For the owner of a run: frames
    built inside can't be read afterwards, so the result has to be written before.

        with Scratch(spark):
            detection.analyze(raw).write.parquet(path)
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.paths = spark, []

    def __enter__(self) -> Scratch:
        self._token = _SCRATCH.set((*_SCRATCH.get(), self))
        return self

    def __exit__(self, *error) -> None:
        _SCRATCH.reset(self._token)
        for path in self.paths:
            delete_path(self.spark, path)


LARGEST_ESTIMATE = 1 << 50


def partitions_for(df: DataFrame, requested: int | None = None) -> int:
    """Partition count for an explicit range repartition: at least the
    configured shuffle partitions, and enough that each holds about the AQE
    advisory size by Catalyst's size estimate of the plan (no job is run)."""
    if requested:
        return requested
    spark = df.sparkSession
    base = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    target = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes", "64MB")
    try:
        target_bytes = int(spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(target))
        size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    except Exception:
        return base
    if size > LARGEST_ESTIMATE:  # Catalyst's way of saying that it doesn't know
        return base
    return int(max(base, -(-size // max(target_bytes, 1))))
