"""Dimension tables: four fixed ones and the observed-dates one."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar.schemas import (
    DIM_PAYMENT_SCHEMA,
    DIM_RATE_SCHEMA,
    DIM_VENDOR_SCHEMA,
    PAYMENT_TYPES,
    PICKUP,
    RATE_CODES,
    VENDORS,
)

DATE_KEY_YEAR = 10_000  # date_key is YYYYMMDD


def date_key(day: str) -> str:
    """YYYYMMDD of a date as BIGINT; NULL stays NULL."""
    return f"CAST(year({day}) * {DATE_KEY_YEAR} + month({day}) * 100 + day({day}) AS BIGINT)"


def dim_date(df: DataFrame, timestamp_column: str = PICKUP) -> DataFrame:
    """One row per date observed in ``timestamp_column``, not a full calendar.

    Reads that one column; distinct dates are combined before the shuffle, so the shuffle
    carries at most one row per date and task.
    """
    days = (
        df.select(F.to_date(F.col(timestamp_column)).alias("full_date"))
        .where(F.col("full_date").isNotNull())
        .distinct()
    )
    return days.selectExpr(
        f"{date_key('full_date')} AS date_key",
        "full_date",
        "CAST(year(full_date) AS BIGINT) AS year",
        "CAST(month(full_date) AS BIGINT) AS month",
        "CAST(day(full_date) AS BIGINT) AS day",
        "CAST(weekday(full_date) AS BIGINT) AS day_of_week",
        "date_format(full_date, 'EEEE') AS day_name",
        "date_format(full_date, 'MMMM') AS month_name",
        "CAST(quarter(full_date) AS BIGINT) AS quarter",
        "weekday(full_date) >= 5 AS is_weekend",
    )


def dim_time(spark: SparkSession) -> DataFrame:
    """24 hours with their period of the day."""
    return spark.range(0, 24, 1, 1).selectExpr(
        "id AS time_key",
        "id AS hour",
        "CASE WHEN id < 6 THEN 'night' WHEN id < 12 THEN 'morning'"
        " WHEN id < 18 THEN 'afternoon' ELSE 'evening' END AS time_period",
    )


def _constant_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """Fixed rows as literals of the plan, so that Catalyst knows their size."""
    literals = ", ".join(str(row) for row in rows)
    columns = [f"CAST({f.name} AS {f.dataType.simpleString()}) AS {f.name}" for f in schema]
    names = ", ".join(schema.fieldNames())
    return spark.sql(f"SELECT {', '.join(columns)} FROM VALUES {literals} AS t({names})")


def dim_vendor(spark: SparkSession) -> DataFrame:
    return _constant_table(spark, VENDORS, DIM_VENDOR_SCHEMA)


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return _constant_table(spark, PAYMENT_TYPES, DIM_PAYMENT_SCHEMA)


def dim_rate_code(spark: SparkSession) -> DataFrame:
    return _constant_table(spark, RATE_CODES, DIM_RATE_SCHEMA)


def static_dimensions(spark: SparkSession) -> dict[str, DataFrame]:
    return {
        "dim_time": dim_time(spark),
        "dim_vendor": dim_vendor(spark),
        "dim_payment_type": dim_payment_type(spark),
        "dim_rate_code": dim_rate_code(spark),
    }


def with_fact_counts(dim: DataFrame, fact: DataFrame, key: str) -> DataFrame:
    """Every row of a dimension with the number of fact rows that refer to it."""
    used = fact.groupBy(key).agg(F.count(F.lit(1)).alias("trips"))
    return dim.join(used, key, "left").withColumn(
        "trips", F.coalesce("trips", F.lit(0).cast("bigint"))
    )
