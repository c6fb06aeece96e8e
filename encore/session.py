"""Session helpers.

Library functions never create a session; these helpers are for scripts,
tests and the bench.  Settings are the ones the jobs are designed around:
AQE on (runtime coalescing, skew-join splitting, size-checked broadcast),
UTC session zone, ANSI mode, no UI server.
"""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

CORE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    # data_dt=20240130 directories stay strings (no integer inference)
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # checkpoint files of lineage cuts are removed once their frames are gone
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(
    app: str = "encore",
    master: str | None = None,
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in CORE_CONF.items():
        builder = builder.config(key, value)
    if shuffle_partitions is not None:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_dir(spark: SparkSession, fallback: str | None = None) -> str:
    """Shared folder for lineage cuts and streaming checkpoints.

    The cluster names it in ``spark.checkpoint.dir``.  Where that is unset
    (local tests), the folder given to ``SparkContext.setCheckpointDir`` counts,
    else ``fallback``, which is then set; without any of them it raises, as a
    folder of one machine would not do on a cluster.
    """
    context = spark.sparkContext
    path = spark.conf.get("spark.checkpoint.dir", None)
    if path:
        if context.getCheckpointDir() is None:
            context.setCheckpointDir(path)
        return path
    if context.getCheckpointDir():
        return context.getCheckpointDir()
    if not fallback:
        raise ValueError("spark.checkpoint.dir is not set on this session")
    context.setCheckpointDir(fallback)
    return fallback


def sub_dir(base: str, *parts: str) -> str:
    return os.path.join(base, *parts)


def materialize(df):
    """Cut lineage by a reliable checkpoint in the shared folder, which a lost
    executor does not touch; its files go with the frame."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


MB = 1 << 20
GB = 1 << 30


def scale_conf(input_bytes: int, executor_cores: int, executors: int,
               target_partition_bytes: int = 256 * MB) -> dict[str, str]:
    """Settings sized for a run reading ``input_bytes`` on ``executors`` x
    ``executor_cores``: ~256 MB scan splits and shuffle partitions (a task's
    working set fits a few GB of executor memory and spills gracefully),
    at least two waves of tasks, AQE coalescing small partitions and splitting
    skewed ones, broadcasts capped at 64 MB, RocksDB state for streams.

    Example: 100 TB on 1000 executors x 8 cores gives 400k scan splits and
    shuffle partitions of ~256 MB each.
    """
    cores = max(1, executor_cores * executors)
    partitions = max(2 * cores, -(-input_bytes // target_partition_bytes))
    return {
        "spark.sql.files.maxPartitionBytes": str(target_partition_bytes),
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_partition_bytes),
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "5",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": str(4 * target_partition_bytes),
        "spark.sql.autoBroadcastJoinThreshold": str(64 * MB),
        "spark.sql.streaming.stateStore.providerClass":
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
