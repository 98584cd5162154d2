"""Shared scratch space: where intermediate tables go so that losing an executor costs no recomputation."""

from __future__ import annotations

import tempfile
import uuid

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path below the folder named by ``spark.checkpoint.dir``. Where that is unset, a local session gets a folder of its own; a
    cluster must name one that every executor reaches."""
    root = spark.conf.get(CHECKPOINT_CONF, None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
        root = tempfile.mkdtemp(prefix="promptloom-")
        spark.conf.set(CHECKPOINT_CONF, root)
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system it names."""
    files, target = _file_system(spark, path)
    return files.exists(target)


def _file_system(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def list_names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder on whatever file system it is; none where there is no folder."""
    files, target = _file_system(spark, path)
    return [s.getPath().getName() for s in files.listStatus(target)] if files.exists(target) else []


def drop_path(spark: SparkSession, path: str) -> None:
    """Remove a file or folder, if it is there."""
    files, target = _file_system(spark, path)
    files.delete(target, True)


def materialise(df: DataFrame, label: str = "stage") -> DataFrame:
    """Write ``df`` once as a Parquet table and read it back.

    Used after model calls, so that no later action repeats them, and wherever two plans must see the
    same task-dependent value. Being columnar, it still prunes columns and pushes filters down.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored(df: DataFrame, label: str = "stage") -> Iterator[DataFrame]:
    """``materialise`` for as long as the block runs; for jobs that go on and on and would fill the scratch space."""
    path = scratch_path(df.sparkSession, label)
    try:
        df.write.parquet(path)
        yield df.sparkSession.read.schema(df.schema).parquet(path)
    finally:
        drop_path(df.sparkSession, path)
