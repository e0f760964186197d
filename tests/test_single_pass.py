"""Queries that write raw files several times make their trips once, and shuffle them as numbers."""

import datetime

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tripstar.plans import catalog, trip_view
from tripstar.sources.records import is_blank

ORDERS, LINES = 48, 3


@pytest.fixture
def tables(spark, tmp_path):
    day = datetime.datetime(1996, 1, 15)
    months = [None if k == 5 else day.replace(month=k % 12 + 1) for k in range(ORDERS)]
    orders = [(k, k, "O", at) for k, at in enumerate(months)]
    lines = [(k, k * 7 + n, k * 3 + n, n, float(n), 10.0 * (k + 1)) for k in range(ORDERS) for n in range(1, LINES + 1)]
    lines.append((7, None, None, 1, None, None))
    for name, rows in (("orders", orders), ("lineitem", lines)):
        spark.createDataFrame(rows, trip_view.TABLE_SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    return str(tmp_path)


@pytest.mark.parametrize(
    "name",
    ["csv_stream_metrics", "csv_reingest_counts", "csv_time_formats", "csv_stopped_build", "csv_mixed_case_fact", "csv_bad_headers", "csv_stream_skips"],
)
def test_lines_are_read_once(spark, tables, monkeypatch, name):
    read = spark.sparkContext.accumulator(0)
    plain = trip_view.table

    def counted(batches):
        for batch in batches:
            read.add(batch.num_rows)
            yield pa.RecordBatch.from_arrays(batch.columns, schema=batch.schema)

    def table(session, folder, of):
        rows = plain(session, folder, of)
        return rows.mapInArrow(counted, rows.schema) if of == "lineitem" else rows

    monkeypatch.setattr(trip_view, "table", table)
    assert catalog.all_queries()[name](spark, tables).count() > 0
    assert read.value == ORDERS * LINES + 1


def test_dealt_trips_are_the_same(spark, tables):
    dealt, plain = trip_view.dealt_trip_view(spark, tables), trip_view.trip_view(spark, tables)
    assert dealt.columns == plain.columns
    assert dealt.exceptAll(plain).isEmpty() and plain.exceptAll(dealt).isEmpty()


def test_names_are_made_after_the_shuffle(spark, tables):
    plan = trip_view.dealt_trip_view(spark, tables)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("yellow_tripdata_") < plan.index("RebalancePartitions")


@pytest.mark.parametrize("line", ["", " ", "\t", " \t ", "a", " a", "a ", " ", "\x0b", '""'])
def test_blank_lines(spark, line):
    found = spark.createDataFrame([(line,)], "value string").select(F.expr(is_blank("value"))).first()[0]
    assert found == (line.strip(" \t") == "")
