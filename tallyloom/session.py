"""Session defaults and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_SCRATCH: list[str] = []  # folders that this process has named


def local_session(cores: int | str = 8, memory: str = "16g", **extra: str) -> SparkSession:
    """Single-machine session for tests and the benchmark."""
    builder = SparkSession.builder.master(f"local[{cores}]").appName("tallyloom")
    settings = {
        **DEFAULTS,
        "spark.sql.shuffle.partitions": str(cores if cores != "*" else 8),
        "spark.driver.memory": memory,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        **extra,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    return session


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new folder name below the shared folder of the cluster.

    The cluster names that folder in ``spark.checkpoint.dir``. Only a session of one process
    (``local[n]``) without the setting gets a local one; any other raises.
    """
    context = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not root:
        if context.master != "local" and not context.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        context.setCheckpointDir(tempfile.mkdtemp(prefix="tallyloom-"))
        root = context.getCheckpointDir()
    path = f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex[:12]}"
    _SCRATCH.append(path)
    return path


def clear_scratch(spark: SparkSession) -> int:
    """Delete what this process has stored in the shared folder; the number of folders that were there.

    For the end of a job, when its results are written: frames that were built on stored tables cannot be read any more.
    """
    deleted = 0
    hadoop = spark._jvm.org.apache.hadoop.fs
    while _SCRATCH:
        path = hadoop.Path(_SCRATCH.pop())
        deleted += bool(path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True))
    return deleted


DROP_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str, compression: str = "snappy", *, drop_shuffles: bool = False, **options: str) -> DataFrame:
    """``df`` written once to the shared folder and read back.

    For results that several later steps read: they scan a columnar table instead of repeating the
    work, and a lost executor costs no more than reading it again. With ``drop_shuffles`` the shuffle files of the
    write go at its end, not when the driver happens to collect its garbage.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    before = spark.conf.get(DROP_SHUFFLES, "false")
    if drop_shuffles:
        spark.conf.set(DROP_SHUFFLES, "true")
    try:
        df.write.options(compression=compression, **options).parquet(path)
    finally:
        if drop_shuffles:
            spark.conf.set(DROP_SHUFFLES, before)
    return spark.read.schema(df.schema).parquet(path)
