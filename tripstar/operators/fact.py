"""Fact table: keys, locations, measures, duration and dense row ids.

Everything is map-only: the lookups broadcast dimensions of fixed
size, and no row is shuffled. Only the list of files is sorted, for the id offsets.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.functions.coerce import minutes_between, number, typed, whole_number
from tripstar.operators.dimensions import date_key, dim_payment_type, dim_rate_code, dim_vendor
from tripstar.operators.lookup import Lookup, star_lookup
from tripstar.operators.positions import sums_before
from tripstar.schemas import (
    DROPOFF,
    FACT_KEYS,
    LOCATION_COLUMNS,
    MEASURES,
    PICKUP,
    SOURCE_FILE,
)

TRIP_ID = "trip_id"
FILE_PATH = "_file_path"
ROW_INDEX = "_row_index"

# Offsets are broadcast for so many files at a time (about 20 MB); the rows are never shuffled.
FILES_PER_BROADCAST = 100_000


def measures(trips: DataFrame) -> list[str]:
    """The ten measures as DOUBLE; missing values and absent columns are 0.0."""
    return [f"coalesce({number(trips, name)}, 0D) AS {name}" for name in MEASURES]


def build_fact(trips: DataFrame, dim_date: DataFrame | None = None) -> DataFrame:
    """Fact rows of silver rows; ``trip_id`` comes first if ``trips`` carries it.

    ``dim_date`` looks up ``date_key`` and gives 0 for a date it does not hold. Leave it out when
    the dimension is built from these same rows: every date is then found, and the key can be
    computed without the join.
    """
    spark = trips.sparkSession
    trips = typed(trips)
    carried = [TRIP_ID] if TRIP_ID in trips.columns else []
    values = trips.selectExpr(
        *carried,
        f"CAST({PICKUP} AS DATE) AS _day",
        f"coalesce(CAST(hour({PICKUP}) AS BIGINT), 0L) AS time_key",
        f"{whole_number(trips, 'VendorID')} AS _vendor",
        f"{whole_number(trips, 'payment_type')} AS _payment",
        f"{whole_number(trips, 'RatecodeID')} AS _rate",
        *[f"{whole_number(trips, name)} AS {name}" for name in LOCATION_COLUMNS],
        *measures(trips),
        f"{minutes_between(PICKUP, DROPOFF)} AS trip_duration_minutes",
    )
    lookups = [
        Lookup(dim_vendor(spark), "vendor_id", "vendor_key", "_vendor", "vendor_key", bounded=True),
        Lookup(dim_payment_type(spark), "payment_type_code", "payment_key", "_payment",
               "payment_key", bounded=True),
        Lookup(dim_rate_code(spark), "rate_code_id", "rate_code_key", "_rate", "rate_code_key",
               bounded=True),
    ]
    if dim_date is None:
        key = f"coalesce({date_key('_day')}, 0L) AS date_key"
    else:
        # One row per calendar day between 1677 and 2262 at most: about 3.5 MB.
        lookups.append(
            Lookup(dim_date, "full_date", "date_key", "_day", "date_key", bounded=True)
        )
        key = "date_key"
    return star_lookup(values, lookups).selectExpr(
        *carried, key, *FACT_KEYS[1:], *LOCATION_COLUMNS, *MEASURES, "trip_duration_minutes"
    )


def with_file_position(stored: DataFrame) -> DataFrame:
    """Add the Parquet file and the row's position in it; ``stored`` must be an unfiltered scan."""
    return stored.withColumns(
        {FILE_PATH: F.col("_metadata.file_path"), ROW_INDEX: F.col("_metadata.row_index")}
    )


def file_offsets(stored: DataFrame, order_column: str = SOURCE_FILE) -> DataFrame:
    """``_group``, ``_file_path``, ``_offset`` and ``_place``: rows and files before each file, in (source file, path) order.

    A prefix sum over one row per Parquet file: range-partitioned, then sums by partition.
    """
    files = (
        stored.select(F.col(order_column).alias("_group"), F.col("_metadata.file_path").alias(FILE_PATH))
        .groupBy("_group", FILE_PATH)
        .agg(F.count(F.lit(1)).alias("_rows"))
    )
    partitions = int(stored.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col("_group"), F.col(FILE_PATH)]
    return sums_before(files, order, partitions, _offset=F.col("_rows"), _place=F.lit(1).cast("bigint"))


def with_trip_id(stored: DataFrame, order_column: str = SOURCE_FILE) -> DataFrame:
    """Dense ids from 0 over stored Parquet rows, without sorting or shuffling the rows.

    id = rows in earlier files + position in the own file. The files are taken in consecutive blocks, each with
    the offsets of its own files broadcast; a block reads the partitions of its source files only. ``stored`` must be an
    unfiltered scan that still exposes ``_metadata``.
    """
    offsets = file_offsets(stored, order_column)
    heads = offsets.where(F.col("_place") % FILES_PER_BROADCAST == 0).orderBy("_place").collect()  # one row a block
    rows = with_file_position(stored)
    blocks = []
    for k, head in enumerate(heads):
        end = heads[k + 1] if k + 1 < len(heads) else None
        mine = offsets.where(F.col("_place").between(head["_place"], head["_place"] + FILES_PER_BROADCAST - 1))
        # prunes partitions; the join then leaves the files of the block
        block = rows.where(F.col(order_column) >= head["_group"]) if k else rows
        if end is not None:
            block = block.where(F.col(order_column) <= end["_group"])
        blocks.append(block.join(F.broadcast(mine.select(FILE_PATH, "_offset")), FILE_PATH))
    if not blocks:
        return rows.withColumn(TRIP_ID, F.lit(0).cast("bigint")).drop(FILE_PATH, ROW_INDEX).limit(0)
    numbered = reduce(DataFrame.unionByName, blocks)
    return numbered.withColumn(TRIP_ID, F.col("_offset") + F.col(ROW_INDEX)).drop(FILE_PATH, ROW_INDEX, "_offset")
