"""Integrity checks and summary reports over the star schema."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.functions.coerce import ident, round2, year_in_name
from tripstar.operators.dimensions import DATE_KEY_YEAR
from tripstar.schemas import FACT_KEYS, SOURCE_FILE

OK, WARN = "OK", "WARN"
SUMMARY_COLUMNS = ["fare_amount", "trip_distance", "passenger_count", "trip_duration_minutes"]


def _rows_from(one_row: DataFrame, label: str, items: Mapping[str, dict[str, str]]) -> DataFrame:
    """Turn a one-row aggregate into one row per item: ``(label, *values)``."""
    names = [label, *next(iter(items.values()))]
    values = ", ".join(f"'{item}', {', '.join(v.values())}" for item, v in items.items())
    return one_row.selectExpr(f"stack({len(items)}, {values}) AS ({', '.join(map(ident, names))})")


def overview(fact: DataFrame) -> DataFrame:
    """Row count, column list and range of ``date_key``."""
    return fact.agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.min("date_key").alias("min_date_key"),
        F.max("date_key").alias("max_date_key"),
    ).withColumn("columns", F.lit(", ".join(fact.columns)))


def null_counts(df: DataFrame) -> DataFrame:
    """NULLs (and NaNs) per column in one pass; only columns that have any."""

    def missing(name: str, dtype: str) -> str:
        column = ident(name)
        nan = f" OR isnan({column})" if dtype in ("double", "float") else ""
        return f"count_if({column} IS NULL{nan})"

    counts = [F.expr(f"{missing(c, t)} AS n{i}") for i, (c, t) in enumerate(df.dtypes)]
    items = {c: {"null_count": f"n{i}"} for i, c in enumerate(df.columns)}
    return _rows_from(df.agg(*counts), "column_name", items).where("null_count > 0")


def fk_orphans(
    fact: DataFrame, dims: Mapping[str, DataFrame], keys: Sequence[str] = tuple(FACT_KEYS)
) -> DataFrame:
    """Fact rows per key that have no dimension row: ``(fk, orphans, status)``.

    One pass over the fact: rows are reduced to counts per key value before anything is shuffled
    or joined, so neither a hot key nor a large dimension hurts.
    """
    spark = fact.sparkSession
    pairs = ", ".join(f"'{k}', CAST({ident(k)} AS BIGINT)" for k in keys)
    used = (
        fact.selectExpr(f"stack({len(keys)}, {pairs}) AS (fk, key)")
        .groupBy("fk", "key")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    known = None
    for key in keys:
        one = dims[key].selectExpr(f"'{key}' AS fk", f"CAST({ident(key)} AS BIGINT) AS key")
        known = one if known is None else known.unionByName(one)
    missing = used.join(known, ["fk", "key"], "left_anti").groupBy("fk").agg(F.sum("n").alias("n"))
    names = spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{k}')" for k in keys) + " AS t(fk)")
    return names.join(missing, "fk", "left").selectExpr(
        "fk", "coalesce(n, 0L) AS orphans", f"if(n IS NULL, '{OK}', '{WARN}') AS status"
    )


def measure_sanity(fact: DataFrame) -> DataFrame:
    """Counts of values a clean fact should not hold, in one pass."""
    checks = [
        "fare_amount < 0",
        "trip_distance < 0",
        "trip_distance = 0",
        "total_amount < 0",
        "trip_duration_minutes < 0",
    ]
    counted = fact.agg(*[F.expr(f"count_if({c}) AS n{i}") for i, c in enumerate(checks)])
    return _rows_from(counted, "check", {c: {"trips": f"n{i}"} for i, c in enumerate(checks)})


def valid_years(files: DataFrame) -> DataFrame:
    """Distinct years in the names of ``files(source_file)``; at most 10,000 four-digit years."""
    return (
        files.select(SOURCE_FILE)
        .distinct()
        .selectExpr(f"CAST({year_in_name(SOURCE_FILE)} AS BIGINT) AS year")
        .where(F.col("year").isNotNull())
        .distinct()
    )


def trip_year(column: str = "date_key") -> str:
    return f"{ident(column)} div {DATE_KEY_YEAR}"


def trips_per_year(fact: DataFrame, years: DataFrame) -> DataFrame:
    """Trips per year in year order, tagged WARN where no source file covers the year."""
    counted = fact.groupBy(F.expr(f"{trip_year()} AS year")).agg(F.count(F.lit(1)).alias("trips"))
    known = F.broadcast(years.select("year", F.lit(OK).alias("status")))
    return (
        counted.join(known, "year", "left")
        .withColumn("status", F.coalesce("status", F.lit(WARN)))
        .orderBy("year")
    )


def bad_year_trips(fact: DataFrame, years: DataFrame) -> DataFrame:
    """Fact rows whose year no source file covers."""
    with_year = fact.withColumn("_year", F.expr(trip_year()))
    known = F.broadcast(years.select(F.col("year").alias("_year")))
    return with_year.join(known, "_year", "left_anti").drop("_year")


def bad_year_sample(
    fact: DataFrame,
    years: DataFrame,
    columns: Sequence[str] = ("trip_id", "date_key", "fare_amount", "trip_distance"),
    n: int = 10,
) -> DataFrame:
    """The first ``n`` such rows, ordered by ``columns``."""
    return bad_year_trips(fact, years).select(*columns).orderBy(*columns).limit(n)


def summary_stats(fact: DataFrame, columns: Sequence[str] = tuple(SUMMARY_COLUMNS)) -> DataFrame:
    """Mean, sample standard deviation, min and max, to two decimals, in one pass."""
    stats = {"mean": "avg", "std": "stddev_samp", "min": "min", "max": "max"}
    one_row = fact.agg(
        *[
            F.expr(f"{fn}({ident(c)}) AS {s}{i}")
            for i, c in enumerate(columns)
            for s, fn in stats.items()
        ]
    )
    items = {c: {s: round2(f"{s}{i}") for s in stats} for i, c in enumerate(columns)}
    return _rows_from(one_row, "column_name", items)


def top_dates(fact: DataFrame, dim_date: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` busiest dates with their revenue; ties go to the earlier date."""
    per_date = fact.groupBy("date_key").agg(
        F.count(F.lit(1)).alias("trips"),
        # in cents, so that the sum does not depend on the order of the rows
        F.expr("sum(try_cast(total_amount AS DECIMAL(18, 2)))").alias("revenue"),
    )
    names = dim_date.select("date_key", "full_date", "day_name")
    return (
        per_date.join(F.broadcast(names), "date_key")
        .orderBy(F.desc("trips"), "full_date")
        .limit(n)
        .selectExpr("full_date", "day_name", "trips", "CAST(revenue AS DOUBLE) AS revenue")
    )


def trips_by_vendor(fact: DataFrame, dim_vendor: DataFrame) -> DataFrame:
    """Trips and mean fare per vendor, in vendor-key order."""
    per_vendor = fact.groupBy("vendor_key").agg(
        F.count(F.lit(1)).alias("trips"), F.avg("fare_amount").alias("avg_fare")
    )
    return (
        per_vendor.join(F.broadcast(dim_vendor), "vendor_key")
        .orderBy("vendor_key")
        .selectExpr("vendor_name", "trips", f"{round2('avg_fare')} AS avg_fare")
    )


def trips_by_payment(fact: DataFrame, dim_payment_type: DataFrame) -> DataFrame:
    """Trips per payment type, most frequent first; ties go to the smaller key."""
    per_type = fact.groupBy("payment_key").agg(F.count(F.lit(1)).alias("trips"))
    return (
        per_type.join(F.broadcast(dim_payment_type), "payment_key")
        .orderBy(F.desc("trips"), "payment_key")
        .select("payment_description", "trips")
    )


def table_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """Row count per table: ``(table, records)``."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("table"), "records")
        out = one if out is None else out.unionByName(one)
    return out
