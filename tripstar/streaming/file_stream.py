"""Incremental ingest as a stream of raw file names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripstar.plans.ingest import ingest_units
from tripstar.schemas import RAW_PREFIX, RAW_SUFFIX, SOURCE_FILE
from tripstar.sources.layers import Layout, latest_metrics, silver_files
from tripstar.sources.raw import RawUnit, collect_units, new_files, raw_units, units_frame, units_of_paths

# Fixed by the binaryFile source; a streaming read must declare it.
_LISTING_SCHEMA = "path string, modificationTime timestamp_ltz, length bigint, content binary"


def ingest_stream(
    spark: SparkSession,
    layout: Layout,
    checkpoint: str,
    *,
    pattern: str = f"{RAW_PREFIX}*{RAW_SUFFIX}",
    max_files_per_trigger: int = 1000,
    once: bool = True,
    interval: str = "1 minute",
) -> StreamingQuery:
    """Ingest raw files as they appear.

    The stream carries file names, not contents: every micro-batch hands its names to the batch
    ingest, so files with different headers stay apart. As in a batch, a file that has silver
    rows is skipped, whatever the checkpoint says, and files that were rejected before are tried
    again, at the start and with every micro-batch. Each run has an id of its own; a repeated one
    replaces what it stored for its files. ``once`` takes what is there and stops.
    """
    listing = (
        spark.readStream.format("binaryFile")
        .schema(_LISTING_SCHEMA)
        .option("maxFilesPerTrigger", max_files_per_trigger)
        .load(f"{layout.raw}/{pattern}")
    )

    def ingest_named(session: SparkSession, units: list[RawUnit]) -> None:
        done = silver_files(session, layout)
        rejected = latest_metrics(session, layout).where("error IS NOT NULL").select(SOURCE_FILE)
        again = raw_units(session, layout.raw, pattern).join(rejected, SOURCE_FILE, "left_semi")
        fresh = collect_units(new_files(units_frame(session, units).unionByName(again).distinct(), done))
        if fresh:
            ingest_units(session, layout, fresh)

    def take(batch: DataFrame, batch_id: int) -> None:
        ingest_named(batch.sparkSession, units_of_paths(row.file_path for row in batch.collect()))  # names only

    ingest_named(spark, [])

    names = listing.select("_metadata.file_path")
    writer = names.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint)
    if once:
        return writer.trigger(availableNow=True).start()
    return writer.trigger(processingTime=interval).start()
