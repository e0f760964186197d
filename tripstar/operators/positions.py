"""Places and running sums over a whole table without bringing it into one task.

The rows are range-partitioned and sorted by their order and stored. Sums by partition, one row each, give the
offset of every partition; a row adds its place or running sum within its own.
"""

from __future__ import annotations

from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripstar.session import scratch_folder

PART = "_part"
_PLACE_BITS = 33  # monotonically_increasing_id: partition above, place within the partition below


def _stored(frame: DataFrame) -> DataFrame:
    path = f"{scratch_folder(frame.sparkSession)}/table"
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def _dealt(frame: DataFrame, order: list[Column], partitions: int) -> DataFrame:
    return frame.repartitionByRange(partitions, *order).sortWithinPartitions(*order)


def _offsets(rows: DataFrame, totals: dict[str, Column]) -> DataFrame:
    """For each partition the sum of every total over all earlier ones; one row for each passes through the driver."""
    sums = rows.groupBy(PART).agg(*[total.alias(name) for name, total in totals.items()]).orderBy(PART).collect()
    before = [[0, *accumulate(r[name] for r in sums)] for name in totals]
    values = [(r[PART], *at) for r, *at in zip(sums, *before)]
    return rows.sparkSession.createDataFrame(values, f"{PART} bigint, {', '.join(f'{name} bigint' for name in totals)}")


def row_places(frame: DataFrame, order: list[Column], partitions: int, name: str) -> DataFrame:
    """``frame`` and the place of each row (from 0) in ``order``, which should tell all rows apart."""
    placed = _dealt(frame, order, partitions).withColumn("_id", F.monotonically_increasing_id())
    rows = _stored(placed).withColumn(PART, F.shiftright("_id", _PLACE_BITS))
    offsets = _offsets(rows, {"_before": F.count(F.lit(1))})
    place = F.col("_before") + F.col("_id").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return rows.join(F.broadcast(offsets), PART).select(*frame.columns, place.alias(name))


def sums_before(frame: DataFrame, order: list[Column], partitions: int, **values: Column) -> DataFrame:
    """``frame`` and the sum of each of ``values`` (new name = column) over all rows before a row in ``order``, which should tell all rows apart."""
    with_values = frame.withColumns({f"_value_{name}": value for name, value in values.items()})
    rows = _stored(_dealt(with_values, order, partitions).withColumn(PART, F.spark_partition_id().cast("bigint")))
    within = Window.partitionBy(PART).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    zero = F.lit(0).cast("bigint")
    summed = rows.withColumns({f"_within_{n}": F.coalesce(F.sum(f"_value_{n}").over(within), zero) for n in values})
    offsets = _offsets(rows, {f"_before_{n}": F.sum(f"_value_{n}") for n in values})
    sums = [(F.col(f"_before_{n}") + F.col(f"_within_{n}")).alias(n) for n in values]
    return summed.join(F.broadcast(offsets), PART).select(*frame.columns, *sums)
