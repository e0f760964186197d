"""Stored layers: silver, quarantine, gold and the run tables, all Parquet (Snappy)."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar.schemas import (
    ERROR_FOLDER,
    FILE_METRICS_SCHEMA,
    GOLD_SCHEMAS,
    QUARANTINE_SCHEMA,
    RUN_ID,
    SILVER_SCHEMA,
    SOURCE_FILE,
)
from tripstar.sources.footers import partition_counts, table_count
from tripstar.sources.raw import path_exists_or_none

BUILD_ID = "build_id"
BUILDS_SCHEMA = T.StructType([T.StructField(BUILD_ID, T.StringType())])


@dataclass(frozen=True)
class Layout:
    """Where the tables live; ``root`` is storage that every executor can reach.

    Each build of the star has folders of its own.
    """

    raw: str
    root: str

    @property
    def silver(self) -> str:
        return f"{self.root}/silver"

    @property
    def quarantine(self) -> str:
        return f"{self.root}/quarantine"

    @property
    def gold(self) -> str:
        return f"{self.root}/gold/star_schema"

    @property
    def builds(self) -> str:
        """The pointer: one row per finished build; the greatest id is the star that readers see."""
        return f"{self.root}/gold/builds"

    @property
    def runs(self) -> str:
        return f"{self.root}/runs"

    def staging(self, run_id: str) -> str:
        return f"{self.root}/_staging/{run_id}"

    def gold_table(self, name: str, build: str) -> str:
        return f"{self.gold}/{build}/{name}"

    def run_table(self, run_id: str) -> str:
        return f"{self.runs}/{run_id}/file_metrics"


def write_partitions(df: DataFrame, path: str, *columns: str) -> None:
    """Replace only the partitions present in ``df``; each becomes visible at job commit."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "snappy")
        .partitionBy(*columns)
        .parquet(path)
    )


def write_quarantine(quarantine: DataFrame, layout: Layout, run_id: str) -> None:
    """Quarantined rows of one run by folder and source file.

    Each input task holds a few rows for many folders, so the rows are rebalanced first: small
    partitions are merged into few files, and a folder with most of the rows is split.
    """
    balanced = quarantine.hint("rebalance", ERROR_FOLDER, SOURCE_FILE).withColumn(RUN_ID, F.lit(run_id))
    write_partitions(balanced, layout.quarantine, RUN_ID, ERROR_FOLDER, SOURCE_FILE)


def _read(spark: SparkSession, path: str, schema, **options) -> DataFrame:
    """Parquet table with a declared schema; an empty frame where nothing is stored."""
    df = path_exists_or_none(spark.read.schema(schema).options(**options).parquet, path)
    return spark.createDataFrame([], schema) if df is None else df


def read_silver(
    spark: SparkSession,
    layout: Layout,
    *,
    all_columns: bool = False,
    skip_paths: tuple[str, ...] = (),
) -> DataFrame:
    """All silver rows. A column that a file lacks is NULL; NULL becomes 0 in the fact table.

    ``all_columns`` also merges in raw columns outside the model. ``skip_paths`` leaves out
    files (see ``unreadable_files`` and ``damaged_files``) before any of them is opened. Page checksums are checked.
    """
    if all_columns:
        df = path_exists_or_none(spark.read.option("mergeSchema", True).parquet, layout.silver)
        df = spark.createDataFrame([], SILVER_SCHEMA) if df is None else df
    else:
        df = _read(spark, layout.silver, SILVER_SCHEMA, **_CHECKED_PAGES)
    if skip_paths:
        df = df.where(~F.col("_metadata.file_path").isin(list(skip_paths)))
    return df


def latest_metrics(spark: SparkSession, layout: Layout) -> DataFrame:
    """``run_id`` and the metrics of each source file in its newest run; one row per file."""
    metrics = _read(spark, f"{layout.runs}/*/file_metrics", FILE_METRICS_SCHEMA)
    if not metrics.inputFiles():
        return metrics.withColumn(RUN_ID, F.lit(None).cast("string"))
    run = F.regexp_extract("_metadata.file_path", r"/([^/]+)/file_metrics/[^/]*$", 1)
    rows = metrics.withColumn(RUN_ID, run)
    newest = F.max_by(F.struct(*rows.columns), RUN_ID).alias("newest")
    return rows.groupBy(SOURCE_FILE).agg(newest).select("newest.*")


def read_quarantine(spark: SparkSession, layout: Layout) -> DataFrame:
    """Quarantined rows of each file's newest run; rows of a file that was rejected since are gone."""
    stored = _read(spark, layout.quarantine, T.StructType([*QUARANTINE_SCHEMA, T.StructField(RUN_ID, T.StringType())]))
    newest = latest_metrics(spark, layout).select(SOURCE_FILE, RUN_ID)
    return stored.join(newest, [SOURCE_FILE, RUN_ID], "left_semi").select(QUARANTINE_SCHEMA.names)


def finished_builds(spark: SparkSession, layout: Layout) -> list[str]:
    """Ids of finished builds, oldest first; one row each."""
    return [r[BUILD_ID] for r in _read(spark, layout.builds, BUILDS_SCHEMA).distinct().orderBy(BUILD_ID).collect()]


def current_build(spark: SparkSession, layout: Layout) -> str | None:
    newest = _read(spark, layout.builds, BUILDS_SCHEMA).agg(F.max(BUILD_ID)).first()
    return newest[0]


def finish_build(spark: SparkSession, layout: Layout, build: str) -> None:
    """Turn the pointer to a build; readers see the whole new star from here on."""
    spark.createDataFrame([(build,)], BUILDS_SCHEMA).coalesce(1).write.mode("append").parquet(layout.builds)


def read_gold(spark: SparkSession, layout: Layout, name: str, build: str | None = None) -> DataFrame:
    """A table of the current star, or of one build; empty where there is none."""
    build = build or current_build(spark, layout)
    if build is None:
        return spark.createDataFrame([], GOLD_SCHEMAS[name])
    return _read(spark, layout.gold_table(name, build), GOLD_SCHEMAS[name])


def read_file_metrics(spark: SparkSession, layout: Layout, run_id: str) -> DataFrame:
    return _read(spark, layout.run_table(run_id), FILE_METRICS_SCHEMA)


def stored_files(spark: SparkSession, path: str) -> DataFrame | None:
    """Listing of a stored layer with its partition columns; no file is opened."""
    return path_exists_or_none(
        spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load, path
    )


def silver_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """``source_file`` of every raw file that already has silver rows, from the listing."""
    listing = stored_files(spark, layout.silver)
    if listing is None or SOURCE_FILE not in listing.columns:
        return spark.createDataFrame([], f"{SOURCE_FILE} string")
    return listing.select(SOURCE_FILE).distinct()


def unreadable_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """``file_path`` of silver files whose Parquet footer cannot be read.

    Only this footer pass and ``damaged_files`` tolerate bad files. The data pass stays strict, so a
    failing executor is retried and never loses rows silently.
    """
    listing = stored_files(spark, layout.silver)
    if listing is None:
        return spark.createDataFrame([], "file_path string")
    good = _tolerant(spark, layout).select("file_path").distinct()
    listed = listing.where(F.col("length") > 0).select(F.col("_metadata.file_path").alias("file_path"))
    return listed.join(good, "file_path", "left_anti")


_CHECKED_PAGES = {"parquet.page.verify-checksum.enabled": "true"}


def _tolerant(spark: SparkSession, layout: Layout) -> DataFrame:
    options = {"ignoreCorruptFiles": True, **_CHECKED_PAGES}
    rows = spark.read.schema(SILVER_SCHEMA).options(**options).parquet(layout.silver)
    return rows.withColumn("file_path", F.col("_metadata.file_path"))


def damaged_files(spark: SparkSession, layout: Layout) -> DataFrame:
    """``file_path`` of silver files of which not every row can be decoded, with page checksums.

    Tasks decode all columns of all files and go on after a bad page; a file that gives fewer rows than its
    footer says is damaged. Files found so are looked at once more by themselves, so that a read that failed for
    another reason does not count.
    """

    def short(rows: DataFrame) -> DataFrame:
        values = F.xxhash64(*[c for c in SILVER_SCHEMA.names if c != SOURCE_FILE])
        decoded = rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("decoded"), F.bit_xor(values).alias("_all"))
        decoded = decoded.select("file_path", "decoded", F.col("_all").isNotNull().alias("_read"))
        stated = rows.groupBy("file_path").agg(F.count(F.lit(1)).alias("stated"))
        both = stated.join(decoded, "file_path", "left")
        return both.where("decoded IS NULL OR decoded < stated OR NOT _read").select("file_path")

    listing = stored_files(spark, layout.silver)
    if listing is None:
        return spark.createDataFrame([], "file_path string")
    first = [r.file_path for r in short(_tolerant(spark, layout)).collect()]
    suspects = _tolerant(spark, layout).where(F.col("_metadata.file_path").isin(first)) if first else None
    found = [r.file_path for r in short(suspects).collect()] if first else []
    return spark.createDataFrame([(p,) for p in found], "file_path string")


def write_dimension(df: DataFrame, layout: Layout, name: str, build: str) -> None:
    """Small table as one sorted file."""
    key = df.columns[0]
    df.coalesce(1).sortWithinPartitions(key).write.mode("overwrite").parquet(layout.gold_table(name, build))


def write_fact(fact: DataFrame, layout: Layout, build: str) -> None:
    fact.write.mode("overwrite").option("compression", "snappy").parquet(layout.gold_table("fact_trips", build))


def _quarantine_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """``error_folder``, ``source_file``, ``records`` of each file's newest run, from footers."""
    stored = partition_counts(spark, layout.quarantine, RUN_ID, ERROR_FOLDER, SOURCE_FILE)
    newest = latest_metrics(spark, layout).select(SOURCE_FILE, RUN_ID)
    # one row for each file; a semi join would be moved below the count and keep it from the footers
    return stored.join(newest, [SOURCE_FILE, RUN_ID]).select(ERROR_FOLDER, SOURCE_FILE, "records")


def saved_counts(spark: SparkSession, layout: Layout, files: DataFrame | None = None) -> DataFrame:
    """Rows stored per ``(layer, source_file)``, from footers.

    ``files(source_file)`` restricts the count to one run's files.
    """
    silver = partition_counts(spark, layout.silver, SOURCE_FILE)
    quarantine = _quarantine_counts(spark, layout).groupBy(SOURCE_FILE).agg(F.sum("records").alias("records"))
    parts = [df.select(F.lit(layer).alias("layer"), SOURCE_FILE, "records") for layer, df in (("silver", silver), ("quarantine", quarantine))]
    out = parts[0].unionByName(parts[1])
    return out if files is None else out.join(files.select(SOURCE_FILE).distinct(), SOURCE_FILE)


def folder_counts(spark: SparkSession, layout: Layout) -> DataFrame:
    """Quarantined rows per folder and source file, from footers."""
    return _quarantine_counts(spark, layout)


def gold_counts(spark: SparkSession, layout: Layout, build: str | None = None) -> DataFrame:
    """``table``, ``records`` of the current star or of one build, from footers."""
    build = build or current_build(spark, layout)
    tables = []
    for name in GOLD_SCHEMAS:
        counted = table_count(spark, layout.gold_table(name, build or "none"))
        tables.append(counted.select(F.lit(name).alias("table"), "records"))
    return reduce(DataFrame.unionByName, tables)


def gold_tables(spark: SparkSession, layout: Layout) -> Mapping[str, DataFrame]:
    build = current_build(spark, layout)
    return {name: read_gold(spark, layout, name, build) for name in GOLD_SCHEMAS}


def register_gold_views(spark: SparkSession, layout: Layout) -> None:
    """Make the star schema available to ``spark.sql`` under its table names."""
    for name, df in gold_tables(spark, layout).items():
        df.createOrReplaceTempView(name)
