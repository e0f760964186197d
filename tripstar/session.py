"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

CHECKPOINT_DIR = "spark.checkpoint.dir"

# Adaptive execution merges small shuffle partitions and splits skewed ones at run time.
SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.timestampType": "TIMESTAMP_NTZ",
    "spark.sql.codegen.hugeMethodLimit": "8000",  # see compiled_methods
}


def local_session(cores: int | str = "*", memory: str = "8g", **settings: str) -> SparkSession:
    """Single-machine session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("tripstar")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "8")
    )
    for key, value in {**SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def let_workers_import(spark: SparkSession) -> None:
    """Python tasks find this package where the driver found it; a cluster may have it installed elsewhere."""
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    known = spark.sparkContext.environment
    paths = [p for p in known.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths:
        known["PYTHONPATH"] = os.pathsep.join([root, *paths])


def session_with(spark: SparkSession, values: dict[str, str]) -> SparkSession:
    """A session of the same application with the settings of ``spark`` and these on top; ``spark`` keeps its own."""
    let_workers_import(spark)
    child = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if spark.conf.isModifiable(key):
            child.conf.set(key, value)
    for key, value in values.items():
        child.conf.set(key, value)
    return child


# The parsed rows of one task go to a file for each layer and source file, held open side by side instead
# of sorted; a task's rows are those of one input split. Small quarantine partitions are merged by number of
# files, not by size. For wide code see compiled_methods.
INGEST_SETTINGS = {
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Session settings for the jobs of one block; the earlier values come back afterwards."""
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


def compiled_methods(spark: SparkSession):
    """Settings under which the JVM compiles the code of wide frames.

    The JIT compiler skips methods above 8,000 bytes, and the fused code of a wide CSV projection
    exceeds that; Spark then splits the code instead. Measured: 2.4 times faster at 18 columns.
    """
    return settings(spark, {"spark.sql.codegen.hugeMethodLimit": "8000"})


# A join before the write hashes its smaller side instead of sorting both where every partition of it is small;
# the measured sizes decide.
_MANY_SMALL_FILES = {
    "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1b",
    "spark.sql.maxConcurrentOutputFileWriters": "64",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
}


def many_small_files(spark: SparkSession):
    """Settings for a write into many small partitions, of rows that were dealt out by them.

    By default little data is merged into one task, which then writes all files one by one, and each task's rows
    are sorted first. The number of files does not depend on this.
    """
    return settings(spark, _MANY_SMALL_FILES)


def small_batches(spark: SparkSession):
    """Settings for jobs over whole texts: Spark hands them to the Python workers a few MB at a time.

    By default a batch may have 64 MB, which the executor and each of its workers hold at once.
    """
    return settings(spark, {"spark.sql.execution.arrow.maxBytesPerBatch": "4m"})


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name for intermediate tables, on storage that all executors reach.

    Lies under the cluster's ``spark.checkpoint.dir``. Only a local session without that setting
    gets a folder on this machine.
    """
    shared = spark.conf.get(CHECKPOINT_DIR, None)
    if shared:
        return f"{shared.rstrip('/')}/tripstar-{uuid.uuid4().hex}"
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_DIR} to a folder that all executors can reach")
    return tempfile.mkdtemp(prefix="run-", dir="/tmp")
