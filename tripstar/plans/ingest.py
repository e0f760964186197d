"""Raw files -> silver and quarantine, with per-file metrics."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tripstar.operators.quality import complete_metrics
from tripstar.operators.rules import annotate, failed_bits, quarantine_columns, trip_rules
from tripstar.schemas import (
    FAILED_RULES,
    HEADER_LINE,
    LAYER,
    MALFORMED,
    OPEN_QUOTE,
    RAW_PREFIX,
    RAW_SUFFIX,
    SILVER_SCHEMA,
    SOURCE_FILE,
)
from tripstar.session import INGEST_SETTINGS, session_with
from tripstar.sources.files import remove, rename_partitions
from tripstar.sources.footers import partition_counts
from tripstar.sources.layers import (
    Layout,
    read_file_metrics,
    silver_files,
    write_quarantine,
)
from tripstar.sources.raw import (
    RawPart,
    RawUnit,
    collect_units,
    new_files,
    raw_units,
    read_heads,
    read_lines,
    read_whole_records,
    repeated_headers,
    skipped_files,
)

MALFORMED_ERROR = "Error tokenizing data: a line has more fields than the header"
UNTERMINATED_ERROR = "Error tokenizing data: the file ends inside a quoted field"

# Layers of the staging area; a file with rows in one of the last two is not published from there.
CLEAN, BROKEN, SURPLUS, QUOTED = "clean", "broken", "surplus", "quoted"


@dataclass(frozen=True)
class IngestRun:
    """Outcome of one run; the frames read stored tables or file names."""

    run_id: str
    metrics: DataFrame
    skipped: DataFrame


def ingest(
    spark: SparkSession,
    layout: Layout,
    *,
    pattern: str = f"{RAW_PREFIX}*{RAW_SUFFIX}",
    multi_line: bool = False,
) -> IngestRun:
    """Validate every raw file that has no silver rows yet."""
    units = raw_units(spark, layout.raw, pattern)
    done = silver_files(spark, layout)
    fresh = collect_units(new_files(units, done))
    old = [(u.source_file,) for u in collect_units(skipped_files(units, done))]
    run_id = ingest_units(spark, layout, fresh, multi_line=multi_line)
    return IngestRun(
        run_id,
        read_file_metrics(spark, layout, run_id),
        spark.createDataFrame(old, f"{SOURCE_FILE} string"),
    )


def new_run_id() -> str:
    """Unique; later runs have greater ids."""
    return f"{time.time_ns():020d}-{uuid.uuid4().hex[:12]}"


def ingest_units(
    spark: SparkSession,
    layout: Layout,
    units: Sequence[RawUnit],
    *,
    run_id: str | None = None,
    multi_line: bool = False,
) -> str:
    """Validate the given units and store the results; returns the run id.

    Files are parsed once, into a staging area with a folder for each layer and file. A file is wholly in
    or wholly out: one with a line of too many fields is left out of both layers. A file with a line that ends
    inside quotes is staged again from whole records (``multi_line`` says so of all files in advance). Row
    counts come from the staged files' footers. Accepted files are published one by one, silver last and by a
    rename, because a file counts as done once it has silver rows. Readers see the quarantine of a file's newest
    run only. A run that fails leaves nothing but its staging area, and its files are taken again.
    """
    run_id = run_id or new_run_id()
    session = session_with(spark, INGEST_SETTINGS)
    parts, errors = read_heads(session, units)
    staging = layout.staging(run_id)

    plain = [] if multi_line else [p for p in parts if p.header_line is not None]
    again = {p.unit.source_file for p in parts if multi_line or p.header_line is None}
    again |= _stage(read_lines(session, plain), f"{staging}/lines", session, plain)
    redo = [p for p in parts if p.unit.source_file in again]
    records, unterminated = read_whole_records(session, redo, f"{staging}/text")
    _stage(records, f"{staging}/records", session)
    errors += [(name, UNTERMINATED_ERROR) for name in sorted(set(unterminated))]

    try:
        _publish(session, layout, run_id, units, errors, again)
    finally:
        remove(spark, staging)
    return run_id


def _stage(frame: DataFrame | None, path: str, spark: SparkSession, parts: Sequence[RawPart] = ()) -> set[str]:
    """Write typed rows by layer and source file; returns the files whose records cannot be told by lines."""
    if frame is None:
        return set()
    by_lines = HEADER_LINE in frame.columns
    if by_lines:
        seen = Observation()
        counts = [F.count_if(HEADER_LINE).alias("headers"), F.count_if(OPEN_QUOTE).alias("quotes")]
        frame = frame.observe(seen, *counts).where(~F.col(HEADER_LINE))
    quoted = f"WHEN {OPEN_QUOTE} THEN '{QUOTED}'" if by_lines else ""
    layer = f"CASE {quoted} WHEN {MALFORMED} THEN '{SURPLUS}' WHEN {FAILED_RULES} = 0 THEN '{CLEAN}' ELSE '{BROKEN}' END"
    rows = frame.selectExpr("*", *failed_bits(trip_rules())).selectExpr("*", f"{layer} AS {LAYER}")
    rows = rows.drop(MALFORMED, OPEN_QUOTE, HEADER_LINE, FAILED_RULES)
    rows.write.option("compression", "snappy").partitionBy(LAYER, SOURCE_FILE).parquet(path)
    if not by_lines:
        return set()
    found = set()
    if seen.get["quotes"]:
        found |= {r[SOURCE_FILE] for r in staged_counts(spark, path) if r[LAYER] == QUOTED}
    if seen.get["headers"] != len(parts):
        found |= repeated_headers(spark, parts)
    return found


def staged_counts(spark: SparkSession, path: str) -> list:
    """One row per layer and file, from footers."""
    return partition_counts(spark, path, LAYER, SOURCE_FILE).collect()


def _publish(
    spark: SparkSession,
    layout: Layout,
    run_id: str,
    units: Sequence[RawUnit],
    errors: list[tuple[str, str]],
    from_records: set[str],
) -> None:
    staging = layout.staging(run_id)
    counts: dict[str, dict[str, int]] = {}
    for place in ("lines", "records"):
        for row in staged_counts(spark, f"{staging}/{place}"):
            if (row[SOURCE_FILE] in from_records) == (place == "records"):
                counts.setdefault(row[SOURCE_FILE], {})[row[LAYER]] = row.records
    strangers = set(counts) - {u.source_file for u in units}
    if strangers:
        raise ValueError(f"rows of files that were not asked for: {sorted(strangers)}")
    unread = {name for name, _ in errors}
    surplus = sorted(name for name, layers in counts.items() if SURPLUS in layers and name not in unread)
    errors = [*errors, *((name, MALFORMED_ERROR) for name in surplus)]
    good = {name: layers for name, layers in counts.items() if name not in unread and SURPLUS not in layers}

    rules = trip_rules()
    broken = {name for name, layers in good.items() if layers.get(BROKEN)}
    for place, names in (("lines", broken - from_records), ("records", broken & from_records)):
        if names:
            base = f"{staging}/{place}"
            rows = spark.read.schema(SILVER_SCHEMA).parquet(f"{base}/{LAYER}={BROKEN}")
            chosen = spark.createDataFrame([(n,) for n in sorted(names)], f"{SOURCE_FILE} string")
            rows = annotate(rows.join(F.broadcast(chosen), SOURCE_FILE, "left_semi"), rules)
            write_quarantine(quarantine_columns(rows, rules), layout, run_id)

    files = spark.createDataFrame([(u.source_file,) for u in units], f"{SOURCE_FILE} string")
    totals = [(name, sum(layers.values()), layers.get(CLEAN, 0)) for name, layers in good.items()]
    counted = spark.createDataFrame(totals, f"{SOURCE_FILE} string, total bigint, clean bigint")
    error_rows = spark.createDataFrame(errors, f"{SOURCE_FILE} string, error string")
    metrics = complete_metrics(files, counted, error_rows)
    metrics.coalesce(1).write.mode("overwrite").parquet(layout.run_table(run_id))

    clean = {name for name, layers in good.items() if layers.get(CLEAN)}
    for place, names in (("lines", clean - from_records), ("records", clean & from_records)):
        rename_partitions(spark, f"{staging}/{place}/{LAYER}={CLEAN}", layout.silver, SOURCE_FILE, names)
