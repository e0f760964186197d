"""Data-quality numbers per file and per run, the alert, and the report table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.functions.coerce import percent, round2
from tripstar.operators.rules import Rule, is_clean
from tripstar.schemas import QUALITY_THRESHOLD, SOURCE_FILE


def file_metrics(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Total, clean and quarantined rows and the clean share of each source file.

    Counts are combined before the shuffle, so one file may hold most of the rows.
    """
    counts = df.groupBy(SOURCE_FILE).agg(
        F.count(F.lit(1)).alias("total"), F.expr(f"count_if({is_clean(rules)}) AS clean")
    )
    return with_shares(counts)


def with_shares(counts: DataFrame) -> DataFrame:
    """Add quarantine count and clean percentage to ``total`` and ``clean`` counts."""
    return counts.selectExpr(
        SOURCE_FILE,
        "total",
        "clean",
        "total - clean AS quarantine",
        f"{round2(percent('clean', 'total'))} AS clean_percentage",
        "CAST(NULL AS STRING) AS error",
    )


def complete_metrics(files: DataFrame, counts: DataFrame, errors: DataFrame) -> DataFrame:
    """One row per file of the run: counts for files read, an error row for files rejected.

    ``files(source_file)`` lists the run's files, so a file without rows still gets zeros;
    ``errors(source_file, error)`` lists the rejected ones, whose counts are not reported.
    All three have one row per file.
    """
    accepted = files.join(errors, SOURCE_FILE, "left_anti")
    counted = accepted.join(
        counts.select(SOURCE_FILE, "total", "clean"), SOURCE_FILE, "left"
    ).selectExpr(SOURCE_FILE, "coalesce(total, 0L) AS total", "coalesce(clean, 0L) AS clean")
    return with_shares(counted).unionByName(
        errors.select(SOURCE_FILE, "error"), allowMissingColumns=True
    )


def run_totals(metrics: DataFrame) -> DataFrame:
    """One row of totals over the files that were read; zeros when there are none."""
    sums = metrics.where("error IS NULL").agg(
        F.count(F.lit(1)).alias("files_processed"),
        *[F.expr(f"coalesce(sum({c}), 0L) AS {c}_records") for c in ("total", "clean", "quarantine")],
    )
    return sums.selectExpr(
        "*",
        f"{percent('clean_records', 'total_records')} AS clean_percentage",
        f"{percent('quarantine_records', 'total_records')} AS quarantine_percentage",
    )


def quality_alert(totals: DataFrame, threshold: float = QUALITY_THRESHOLD) -> DataFrame:
    """``alert_triggered``: true only if rows were processed and too few of them are clean."""
    low = (F.col("total_records") > 0) & (F.col("clean_percentage") < F.lit(threshold))
    return totals.withColumn("alert_triggered", low)


def _lines(df: DataFrame, section: str, item: str, values: dict[str, str]) -> DataFrame:
    """Each row of ``df`` as one report line per entry of ``values`` (metric -> SQL value)."""
    pairs = ", ".join(f"'{name}', CAST({value} AS DOUBLE)" for name, value in values.items())
    return df.selectExpr(
        f"'{section}' AS section",
        f"{item} AS item",
        f"stack({len(values)}, {pairs}) AS (metric, value)",
    )


def quality_report(
    metrics: DataFrame,
    skipped: DataFrame | None = None,
    saved: DataFrame | None = None,
    gold: DataFrame | None = None,
    left_out: DataFrame | None = None,
    threshold: float = QUALITY_THRESHOLD,
) -> DataFrame:
    """Report as ``(section, item, metric, value)`` lines.

    ``skipped(source_file)``: files left out because they are done. ``saved(layer, records)`` and
    ``gold(table, records)``: row counts of what was written. ``left_out(file)``: stored files that could not be read.
    """
    totals = quality_alert(run_totals(metrics), threshold)
    run = _lines(
        totals,
        "run",
        "'all'",
        {
            "files_processed": "files_processed",
            "total_records": "total_records",
            "clean_records": "clean_records",
            "quarantine_records": "quarantine_records",
            "clean_percentage": round2("clean_percentage"),
            "quarantine_percentage": round2("quarantine_percentage"),
            "alert_triggered": "CAST(alert_triggered AS INT)",
        },
    )
    per_file = _lines(
        metrics.where("error IS NULL"),
        "file",
        SOURCE_FILE,
        {name: name for name in ("clean", "quarantine", "clean_percentage")},
    )
    failed = _lines(
        metrics.where("error IS NOT NULL"),
        "error",
        f"concat_ws(': ', {SOURCE_FILE}, error)",
        {"files": "1"},
    )
    report = run.unionByName(per_file).unionByName(failed)
    if skipped is not None:
        lines = _lines(skipped, "skipped", SOURCE_FILE, {"files": "1"})
        report = report.unionByName(lines)
    if saved is not None:
        lines = _lines(saved, "saved", "layer", {"records": "records"})
        report = report.unionByName(lines)
    if gold is not None:
        lines = _lines(gold, "gold", "`table`", {"records": "records"})
        report = report.unionByName(lines)
    if left_out is not None:
        lines = _lines(left_out, "left_out", "file", {"files": "1"})
        report = report.unionByName(lines)
    return report
