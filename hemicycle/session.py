"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Runtime SQL settings the models rely on; all can be changed on a live session.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Hot roll calls and members are split at run time instead of by a fixed salt.
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Short texts that are alike shrink to a tenth in a shuffle: 64 MB of them would be a sort of a GB in one task.
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16777216",
    # Landing files are many and small: pack about a thousand into a scan task of 128 MB.
    "spark.sql.files.maxPartitionBytes": "134217728",
    "spark.sql.files.openCostInBytes": "131072",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SQL_SETTINGS` to a session made elsewhere."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: str = "*", shuffle_partitions: int = 8, memory: str = "8g") -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("hemicycle")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    )
    for key, value in SQL_SETTINGS.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_root(spark: SparkSession) -> str:
    """Folder for checkpoints and scratch tables, visible to every executor.

    The cluster names it in ``spark.checkpoint.dir``. Only a local master may fall
    back to a temporary folder; on a cluster the executors could not read it.
    """
    context = spark.sparkContext
    configured = spark.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
    root = configured or context.getCheckpointDir()
    if root is None:
        if not context.master.startswith("local") or context.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder shared by the cluster")
        root = tempfile.mkdtemp(prefix="hemicycle-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(root)
    return root


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder; each call gives another one."""
    return f"{checkpoint_root(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


def files_of(spark: SparkSession, path: str):
    """The file system of a path, and a maker of its paths."""
    make = spark._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()), make


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """Writes in this block delete their shuffle files as they end.

    Else the files stay until the driver happens to collect its memory, and add up over the writes of a run.
    """
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, "false")
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def briefly_stored(df: DataFrame, label: str) -> Iterator[DataFrame]:
    """:func:`stored` for a block: the files are deleted as it ends, however it ends."""
    path = scratch_path(df.sparkSession, label)
    files, make = files_of(df.sparkSession, path)
    try:
        with shuffles_dropped(df.sparkSession):
            df.write.parquet(path)
        yield df.sparkSession.read.parquet(path)
    finally:
        files.delete(make(path), True)


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared scratch folder and read it back.

    For a small result that a large table is about to be joined with: the planner then
    knows its true size and broadcasts it only if it fits, and its lineage is cut.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
