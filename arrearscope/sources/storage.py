"""Where intermediate tables go."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"


_owned: ContextVar[str | None] = ContextVar("scratch", default=None)


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder, from ``spark.checkpoint.dir``.

    Only a local master may go without: executors on other machines cannot see a
    temporary folder of the driver.
    """
    folder = spark.conf.get(CHECKPOINT_SETTING, None) or spark.sparkContext.getCheckpointDir()
    if folder:
        return folder
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder that all executors can reach")
    spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="arrearscope-"))
    return spark.sparkContext.getCheckpointDir()


def use_checkpoints(spark: SparkSession) -> None:
    """Let iterative training cut its lineage in the shared folder."""
    folder = shared_folder(spark)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(folder)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path that nothing else uses, in the open scratch folder or else in the shared one."""
    return f"{(_owned.get() or shared_folder(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"


@contextmanager
def scratch(spark: SparkSession, base: str | None = None) -> Iterator[str]:
    """A folder of its own for what is stored inside the block, removed at the end of it.

    ``base`` is any folder that all executors can reach, by default the shared one. Frames that
    are built inside read from the folder, so results have to be written or collected before the end.
    """
    folder = f"{(base or shared_folder(spark)).rstrip('/')}/scratch-{uuid.uuid4().hex}"
    before = _owned.set(folder)
    try:
        yield folder
    finally:
        _owned.reset(before)
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(hadoop_path)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the shared folder and read back.

    For tables that several jobs read: they are computed once, and a lost executor costs
    a re-read instead of the whole lineage. The table stays until the ``scratch`` block it was stored
    in ends; outside of one, until the owner of the shared folder clears it.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
