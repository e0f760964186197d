"""Names and folders on Spark's file systems; file contents never come here."""

from __future__ import annotations

from collections.abc import Set
from concurrent.futures import ThreadPoolExecutor
from urllib.parse import unquote

from pyspark.sql import SparkSession

_THREADS = 16


def _system(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def rename_partitions(spark: SparkSession, source: str, target: str, column: str, values: Set[str]) -> None:
    """Move the partitions of ``values`` from one table to another; each replaces its predecessor as a whole."""
    if not values:
        return
    folder, system = _system(spark, source)
    goal, _ = _system(spark, target)
    system.mkdirs(goal)
    path = spark._jvm.org.apache.hadoop.fs.Path

    def move(status) -> None:
        name = status.getPath().getName()
        if not name.startswith(f"{column}=") or unquote(name.removeprefix(f"{column}=")) not in values:
            return
        to = path(f"{target}/{name}")
        if system.exists(to):
            system.delete(to, True)
        if not system.rename(status.getPath(), to):
            raise OSError(f"cannot move {status.getPath()} to {to}")

    with ThreadPoolExecutor(_THREADS) as pool:
        list(pool.map(move, system.listStatus(folder)))


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of this package's own, if it is there."""
    folder, system = _system(spark, path)
    system.delete(folder, True)
