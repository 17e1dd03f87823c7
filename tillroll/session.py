"""Spark session settings, and the shared folder for intermediate tables."""

from __future__ import annotations

import re
import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on.  A hot order, customer or product is split by the
# adaptive skew join; the "force" switch lets that happen even where the following aggregation
# could have reused the join's partitioning (it then gets its own, pre-aggregated, exchange).
# Partitions are sized by their compressed bytes, and shuffled keys take several times as much, up
# to twenty-five times, as rows in a task's sorts and hash maps: small partitions keep the memory of
# one task, several of which share an executor, the same however much is shuffled or scanned.
# What counts as hot and partition counts are the cluster's to choose.
RUNTIME_SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "8m",
    "spark.sql.files.maxPartitionBytes": "32m",
}


# What else to do when intermediate tables are deleted.
_ON_CLEAR: list[Callable[[], None]] = []


def on_clear(forget: Callable[[], None]) -> Callable[[], None]:
    """Have ``forget`` called whenever the intermediate tables are deleted."""
    _ON_CLEAR.append(forget)
    return forget


def tune(spark: SparkSession) -> SparkSession:
    """Apply those runtime settings that the session does not set itself."""
    given = spark.conf.getAll
    for key, value in RUNTIME_SETTINGS.items():
        if key not in given:
            spark.conf.set(key, value)
    return spark


def build_session(app: str, master: str | None = None, **settings: str) -> SparkSession:
    """Create a session; keyword settings use ``__`` in place of ``.`` in the setting's name."""
    builder = (
        SparkSession.builder.appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # recording the Python line of every column takes longer than building the plan
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return tune(builder.getOrCreate())


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by the cluster.

    Only a session whose executors are threads of the driver may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    context = spark.sparkContext
    if context.getCheckpointDir():
        return context.getCheckpointDir().rstrip("/")
    if not re.fullmatch(r"local(\[[^\]]*\])?", context.master):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    context.setCheckpointDir(tempfile.mkdtemp(prefix="tillroll-"))
    return context.getCheckpointDir().rstrip("/")


def scratch_dir(spark: SparkSession) -> str:
    """This application's own folder in the shared one."""
    return f"{shared_dir(spark)}/tillroll-{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new, unused path in the application's folder."""
    return f"{scratch_dir(spark)}/{label}-{uuid.uuid4().hex}"


def _file_system(spark: SparkSession, path: str) -> tuple:
    """The file system that holds a path, and the path as it takes it."""
    context = spark.sparkContext
    where = context._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(context._jsc.hadoopConfiguration()), where


def has_path(spark: SparkSession, path: str) -> bool:
    """Whether there is a file or folder of that name."""
    system, where = _file_system(spark, path)
    return system.exists(where)


def last_change(spark: SparkSession, path: str) -> int:
    """When a file, or the list of files in a folder, was last changed."""
    system, where = _file_system(spark, path)
    return system.getFileStatus(where).getModificationTime()


def drop_path(spark: SparkSession, path: str) -> None:
    """Delete a file, or a folder with all it holds."""
    system, where = _file_system(spark, path)
    system.delete(where, True)


def move_path(spark: SparkSession, path: str, to: str) -> None:
    """Give a file or folder another name on its file system; folders above it are made."""
    system, where = _file_system(spark, path)
    _, there = _file_system(spark, to)
    system.mkdirs(there.getParent())
    if not system.rename(where, there):
        raise OSError(f"could not move {path} to {to}")


def clear_scratch(spark: SparkSession) -> None:
    """Delete all intermediate tables of this application.

    Results that were not written or collected yet still read them, so call this once a result is
    out, or at the end.
    """
    drop_path(spark, scratch_dir(spark))
    for forget in _ON_CLEAR:
        forget()


def materialise(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and return the written table.

    This fixes the rows (and any partition-dependent column) once, survives the loss of
    executors, and lets later passes read only the columns they need.
    """
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
