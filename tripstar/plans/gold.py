"""Silver -> star schema: a full rebuild from all silver rows."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.operators.dimensions import dim_date, static_dimensions
from tripstar.operators.fact import build_fact, with_trip_id
from tripstar.plans.ingest import new_run_id
from tripstar.schemas import PICKUP
from tripstar.session import INGEST_SETTINGS, session_with
from tripstar.sources.files import remove
from tripstar.sources.layers import (
    Layout,
    damaged_files,
    finish_build,
    finished_builds,
    gold_counts,
    read_gold,
    read_silver,
    silver_files,
    unreadable_files,
    write_dimension,
    write_fact,
)

SUCCESS, SKIPPED, LEFT_OUT = "success", "skipped", "left_out"
RESULT = "status string, reason string, table string, records bigint"


def build_gold(spark: SparkSession, layout: Layout, *, skip_paths: tuple[str, ...] = (), keep: int = 2) -> DataFrame:
    """Write the five dimensions and the fact; ``(status, reason, table, records)`` per table.

    A build writes folders of its own and is published by one row, so that a build that stops half-way leaves the
    star as it was; the last ``keep`` builds stay stored. Silver files that cannot be opened are left
    out, and listed as ``left_out``. If the data pass fails, files with damaged pages are looked
    for, and the build is repeated without them; ``skip_paths`` names such files in advance. Skips the
    build when there is no silver row or no date in it.
    """
    bad = {*skip_paths, *(r.file_path for r in unreadable_files(spark, layout).collect())}
    if silver_files(spark, layout).isEmpty():
        return spark.createDataFrame([(SKIPPED, "silver_empty", None, None)], RESULT)
    try:
        build = write_star(spark, layout, tuple(sorted(bad)))
    except (Py4JJavaError, PySparkException):
        damaged = {r.file_path for r in damaged_files(spark, layout).collect()} - bad
        if not damaged:
            raise
        bad |= damaged
        build = write_star(spark, layout, tuple(sorted(bad)))
    left_out = spark.createDataFrame([(LEFT_OUT, "unreadable", path, None) for path in sorted(bad)], RESULT)
    if build is None:
        return spark.createDataFrame([(SKIPPED, "no_readable_files", None, None)], RESULT)
    finish_build(spark, layout, build)
    for old in finished_builds(spark, layout)[:-keep]:
        remove(spark, f"{layout.gold}/{old}")
    counts = gold_counts(spark, layout, build).selectExpr(
        f"'{SUCCESS}' AS status", "CAST(NULL AS STRING) AS reason", "table", "records"
    )
    return counts.unionByName(left_out) if bad else counts


def write_star(spark: SparkSession, layout: Layout, skip_paths: tuple[str, ...] = ()) -> str | None:
    """Write one star without publishing it; its id, or None where no row has a date."""
    spark = session_with(spark, INGEST_SETTINGS)
    silver = read_silver(spark, layout, skip_paths=skip_paths)
    if silver.where(F.col(PICKUP).isNotNull()).isEmpty():
        return None
    build = new_run_id()
    write_dimension(dim_date(silver), layout, "dim_date", build)
    for name, table in static_dimensions(spark).items():
        write_dimension(table, layout, name, build)
    dates = read_gold(spark, layout, "dim_date", build)
    write_fact(build_fact(with_trip_id(silver), dates), layout, build)
    return build
