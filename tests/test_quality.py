"""Totals, alert and report on hand-made metrics."""

import pytest

from tripstar.operators import quality as Q
from tripstar.schemas import FILE_METRICS_SCHEMA


def metrics(spark, *rows):
    return spark.createDataFrame(list(rows), FILE_METRICS_SCHEMA)


def one_file(spark, total, clean):
    return metrics(spark, ("f.csv", total, clean, total - clean, 0.0, None))


@pytest.mark.parametrize(
    ("total", "clean", "alert"),
    [(0, 0, False), (100, 50, True), (100, 90, False), (100, 80, False), (10_000, 7_999, True)],
)
def test_alert(spark, total, clean, alert):
    row = Q.quality_alert(Q.run_totals(one_file(spark, total, clean))).first()
    assert row.alert_triggered is alert


def test_percentages(spark):
    row = Q.run_totals(one_file(spark, 100, 70)).first()
    assert (row.clean_percentage, row.quarantine_percentage) == (70.0, 30.0)
    none = Q.run_totals(one_file(spark, 0, 0)).first()
    assert (none.clean_percentage, none.quarantine_percentage) == (0.0, 0.0)


def test_empty_run(spark):
    row = Q.quality_alert(Q.run_totals(metrics(spark))).first()
    assert tuple(row) == (0, 0, 0, 0, 0.0, 0.0, False)
    assert Q.quality_report(metrics(spark)).count() == 7


def test_failed_files_do_not_count(spark):
    both = metrics(spark, ("a.csv", 4, 3, 1, 75.0, None), ("b.csv", None, None, None, None, "broken"))
    row = Q.run_totals(both).first()
    assert (row.files_processed, row.total_records) == (1, 4)
    lines = {(r.section, r.item) for r in Q.quality_report(both).collect()}
    assert ("error", "b.csv: broken") in lines and ("file", "b.csv") not in lines


def test_complete_metrics(spark):
    files = spark.createDataFrame([("a",), ("b",), ("c",)], "source_file string")
    counts = spark.createDataFrame([("a", 32, 1), ("c", 9, 9)], "source_file string, total bigint, clean bigint")
    errors = spark.createDataFrame([("c", "bad")], "source_file string, error string")
    got = [tuple(r) for r in Q.complete_metrics(files, counts, errors).orderBy("source_file").collect()]
    assert got == [("a", 32, 1, 31, 3.12, None), ("b", 0, 0, 0, 0.0, None), ("c", None, None, None, None, "bad")]
