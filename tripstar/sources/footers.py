"""Row counts of Parquet tables from file footers: the count is pushed into the reader, no row is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar.session import session_with
from tripstar.sources.raw import path_exists_or_none

# Only the newer Parquet reader takes the count; it is one of the engine's own readers.
_PUSHED = {"spark.sql.parquet.aggregatePushdown": "true"}
_READERS = "spark.sql.sources.useV1SourceList"


def _session(spark: SparkSession) -> SparkSession:
    others = [name for name in spark.conf.get(_READERS).split(",") if name.strip().lower() != "parquet"]
    return session_with(spark, {**_PUSHED, _READERS: ",".join(others)})


def partition_counts(spark: SparkSession, path: str, *columns: str) -> DataFrame:
    """``records`` for each value of the partition ``columns`` (all that the table has, in its order), as text; empty where nothing is stored."""
    schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
    table = path_exists_or_none(_session(spark).read.schema(schema).parquet, path)
    if table is None:
        return spark.createDataFrame([], T.StructType([*schema, T.StructField("records", T.LongType())]))
    return table.groupBy(*columns).agg(F.count(F.lit(1)).alias("records"))


def table_count(spark: SparkSession, path: str) -> DataFrame:
    """One row with the ``records`` of a table without partitions; 0 where nothing is stored."""
    table = path_exists_or_none(_session(spark).read.parquet, path)
    if table is None:
        return spark.range(1).select(F.lit(0).cast("bigint").alias("records"))
    return table.agg(F.count(F.lit(1)).alias("records"))
