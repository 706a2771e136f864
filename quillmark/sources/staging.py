"""Stage tables: written results that cut lineage and survive lost executors."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from threading import Lock

from pyspark.sql import DataFrame, SparkSession

#: Removes what a statement has shuffled as soon as it ends; otherwise files stay until the
#: driver's memory is collected.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
_lock, _writing = Lock(), 0
_before: str | None = None


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names in ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if shared is None:
        shared = spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if shared is None:
        shared = spark.sparkContext.getCheckpointDir()
    if shared is None:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        shared = tempfile.mkdtemp(prefix="quillmark-")
        spark.sparkContext.setCheckpointDir(shared)
    elif spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared)
    return shared.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Statements inside remove their shuffle files; the session's setting comes back after the last one."""
    global _writing, _before
    with _lock:
        if not _writing:
            _before = spark.conf.get(CLEANUP, None)
            spark.conf.set(CLEANUP, "true")
        _writing += 1
    try:
        yield
    finally:
        with _lock:
            _writing -= 1
            if not _writing:
                spark.conf.unset(CLEANUP) if _before is None else spark.conf.set(CLEANUP, _before)


def stage(df: DataFrame, name: str, path: str | None = None, partition_by: tuple = ()) -> DataFrame:
    """Write a table once and read it back. What the write has shuffled is not needed after it."""
    spark = df.sparkSession
    path = path or new_folder(spark, name)
    with shuffles_removed(spark):
        df.write.mode("overwrite").option("compression", "zstd").partitionBy(*partition_by).parquet(path)
    return spark.read.parquet(path)
