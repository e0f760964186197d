"""Tables between the jobs of an operator, and small helpers on frames."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripstar.session import scratch_folder


def stored(frame: DataFrame, folder: str | None = None) -> DataFrame:
    """The frame written as Parquet to shared storage and read again.

    Cuts the lineage: later jobs survive the loss of executors, and nothing is computed twice.
    """
    spark = frame.sparkSession
    path = f"{folder or scratch_folder(spark)}/table"
    frame.write.mode("error").parquet(path)
    return spark.read.schema(frame.schema).parquet(path)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bucket_of(column: str, n: int):
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")
