"""The run report over stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.operators.quality import quality_report
from tripstar.plans.ingest import IngestRun
from tripstar.sources.layers import Layout, saved_counts


def run_report(
    spark: SparkSession, layout: Layout, run: IngestRun, gold: DataFrame | None = None
) -> DataFrame:
    """Quality report of one ingest run; ``gold`` is the result of ``build_gold``."""
    saved = (
        saved_counts(spark, layout, run.metrics)
        .groupBy("layer")
        .agg(F.sum("records").alias("records"))
    )
    built = None if gold is None else gold.where(F.col("status") == "success")
    bad = None if gold is None else gold.where(F.col("status") == "left_out").select(F.col("table").alias("file"))
    return quality_report(run.metrics, run.skipped, saved, built, bad)
