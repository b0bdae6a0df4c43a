"""Scratch folders that every executor can reach."""

from __future__ import annotations

import uuid
from collections.abc import Iterable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession


_handed_out: ContextVar[list[str] | None] = ContextVar("handed_out", default=None)


@contextmanager
def collected() -> Iterator[list[str]]:
    """The paths for scratch that are handed out inside the block, but not in one within it.

    For steps whose tables serve one result only: once that is written, nothing
    reads them, and ``remove_paths`` deletes them.
    """
    paths: list[str] = []
    before = _handed_out.set(paths)
    try:
        yield paths
    finally:
        _handed_out.reset(before)


def hand_over(paths: Iterable[str]) -> None:
    """Paths that outlive the block they were collected in, passed to the block around it."""
    around = _handed_out.get()
    if around is not None:
        around.extend(paths)


def scratch_base(master: str, checkpoint_dir: str | None, warehouse_dir: str) -> str:
    """The folder for scratch: the checkpoint folder if one is set, else the warehouse.

    A warehouse on a machine's own disk serves a session whose executors are on
    that machine (master ``local...``); on a cluster it is refused, as every machine would
    write to a folder of its own.
    """
    if checkpoint_dir:
        return checkpoint_dir
    if warehouse_dir.startswith(("file:", "/")) and not master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return warehouse_dir


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the session's folder for scratch (``scratch_base``); the caller removes what is written there."""
    conf = spark.conf
    base = scratch_base(conf.get("spark.master", "local"), conf.get("spark.checkpoint.dir", None), conf.get("spark.sql.warehouse.dir"))
    path = f"{base.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    paths = _handed_out.get()
    if paths is not None:
        paths.append(path)
    return path


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jvm_path)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of the numbered folders in a folder; none if it is not there."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = jvm_path.getFileSystem(spark._jsc.hadoopConfiguration())
    names = [f.getPath().getName() for f in files.listStatus(jvm_path)] if files.exists(jvm_path) else []
    return [n for n in names if n.isdigit()]


def remove_path(spark: SparkSession, path: str) -> None:
    """Delete a folder wherever it is stored; one that is not there is no error."""
    jvm_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    jvm_path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(jvm_path, True)


def remove_paths(spark: SparkSession, paths: Iterable[str]) -> None:
    for path in paths:
        remove_path(spark, path)


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` computed once into the shared folder, and read from there (an action).

    For a result that several branches of a plan read: column pruning makes the
    branches differ, so Spark would not share their shuffles. Unlike a cached
    result, the files outlive the executors that wrote them.
    """
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
