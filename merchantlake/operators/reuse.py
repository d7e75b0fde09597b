"""Results that several plans read."""

from __future__ import annotations

import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession

SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class NoSharedFolderError(RuntimeError):
    """Executors and driver have no folder in common that a result could be stored in."""


def use_work_folder(spark: SparkSession, path: str) -> None:
    """Store results below ``path`` unless the cluster names a folder."""
    if not spark.conf.get("spark.checkpoint.dir", None) and not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(path)


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, or the one set for this application.

    Only a local session, whose tasks all run on this machine, may do without and gets a temporary one.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
        raise NoSharedFolderError("set spark.checkpoint.dir to a folder that all executors share")
    use_work_folder(spark, tempfile.mkdtemp(prefix="merchantlake-"))
    return spark.sparkContext.getCheckpointDir()


def new_path(spark: SparkSession, name: str) -> str:
    """A place in the shared folder that nothing else uses."""
    return f"{shared_folder(spark).rstrip('/')}/{name}-{uuid4().hex}"


@contextmanager
def _shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Within, Spark removes the shuffle files of an execution when it ends. What was stored makes them useless."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


def store(df: DataFrame, name: str = "stored") -> DataFrame:
    """Write ``df`` once to the shared folder and read it from there.

    Later plans neither compute it again nor depend on the executors that made it,
    and read only the columns they need.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with _shuffles_removed(spark):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)
