"""Trips derived from order lines, for running the operators on order tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.schemas import DROPOFF, PICKUP, SOURCE_FILE

# Declared, so that opening a table does not cost a job to read its footer.
TABLE_SCHEMAS = {
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT,"
    " l_quantity DOUBLE, l_extendedprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_orderdate TIMESTAMP_NTZ",
    "customer": "c_custkey BIGINT, c_nationkey INT",
    "nation": "n_nationkey INT, n_regionkey INT",
    "part": "p_partkey BIGINT, p_size INT",
    "supplier": "s_suppkey BIGINT, s_nationkey INT",
    "events": "ts TIMESTAMP_NTZ, event_type STRING, value DOUBLE",
}

FILE_YEAR = "file_year"
# Columns that a trip is made from, and which of them go to the file of a year of its own.
_SOURCES = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "o_orderdate"]
_LATE = "l_suppkey % 13 = 0 AND l_partkey % 5 = 0"
_HOUR, _MINUTE = "INTERVAL '1' HOUR", "INTERVAL '1' MINUTE"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(TABLE_SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def trip_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One trip per order line, with every kind of invalid row and some optional columns absent.

    The join is left to Catalyst: a small ``orders`` is broadcast by its measured size, a large
    one is sorted and merged, with hot order keys split at run time. ``file_year`` is the year in
    ``source_file``, known where the name is made, so no rule has to search the name for it.
    """
    return _trips_of(_dated_lines(spark, sf_dir))


def dealt_trip_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trip_view`` dealt out by ``source_file``; only the numbers that it is made from are shuffled."""
    month = f"CASE WHEN {_LATE} THEN -1 ELSE year(o_orderdate) * 12 + month(o_orderdate) END AS _month"
    dated = _dated_lines(spark, sf_dir).selectExpr(*_SOURCES, month)
    return _trips_of(dated.hint("rebalance", "_month"))


def _dated_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines, orders = table(spark, sf_dir, "lineitem"), table(spark, sf_dir, "orders")
    return lines.join(orders, F.expr("l_orderkey = o_orderkey"))


def _trips_of(dated: DataFrame) -> DataFrame:
    start = f"o_orderdate + l_partkey % 24 * {_HOUR}"
    return dated.selectExpr(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        f"""CASE WHEN {_LATE} THEN 'yellow_tripdata_2019-01.csv'
            ELSE concat('yellow_tripdata_', substring(CAST(o_orderdate AS STRING), 1, 7), '.csv')
            END AS {SOURCE_FILE}""",
        f"""CASE WHEN {_LATE} THEN 2019
            ELSE year(o_orderdate) END AS {FILE_YEAR}""",
        "l_linenumber % 4 AS VendorID",
        f"CASE WHEN l_orderkey % 97 != 0 THEN {start} END AS {PICKUP}",
        f"""CASE WHEN l_orderkey % 89 = 0 THEN NULL
            WHEN l_partkey % 41 = 0 THEN o_orderdate + (l_partkey % 24 - 30) * {_HOUR}
            ELSE {start} + CAST(l_quantity AS INT) * {_MINUTE} END AS {DROPOFF}""",
        """CASE WHEN l_linenumber = 1 AND l_orderkey % 11 = 0 THEN 0D
            WHEN l_linenumber != 7 THEN CAST(l_linenumber AS DOUBLE) END AS passenger_count""",
        "if(l_suppkey % 10 = 9 AND l_partkey % 7 = 0, 0D, l_quantity) AS trip_distance",
        "if(l_linenumber = 2, 99, l_linenumber) AS RatecodeID",
        "l_linenumber - 1 AS payment_type",
        "if(l_partkey % 37 = 0, -l_extendedprice, l_extendedprice) AS fare_amount",
        "l_extendedprice AS total_amount",
    )


def trip_columns(trips: DataFrame) -> DataFrame:
    """The columns a raw trip file would have, plus its name."""
    return trips.drop("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", FILE_YEAR)
