"""Silver to star schema, ids, checks."""

import os

import pytest
from sample import COLUMNS, clean_line, sample, write_csv

from tripstar.operators import checks, fact
from tripstar.plans.gold import build_gold
from tripstar.plans.ingest import ingest
from tripstar.plans.report import run_report
from tripstar.schemas import FACT_SCHEMA, GOLD_SCHEMAS
from tripstar.sources import layers


@pytest.fixture
def stored(spark, layout):
    extra = [*COLUMNS, "VendorID", "payment_type", "RatecodeID", "PULocationID"]
    lines = [[*clean_line(i), str(i % 4), str(i), "99" if i == 0 else str(i), "7.9"] for i in range(8)]
    lines.append([*clean_line(8), "x", "", "inf", ""])
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", lines, extra)
    write_csv(layout.raw, "yellow_tripdata_2019-02.csv", sample(3, 1, "2019-02-02"))
    write_csv(layout.raw, "yellow_tripdata_2020-01.csv", sample(4, 0, "2020-01-06"))
    run = ingest(spark, layout)
    return layout, run, build_gold(spark, layout)


def test_counts_and_status(spark, stored):
    _, _, built = stored
    got = {r.table: r.records for r in built.collect()}
    assert got == {
        "dim_date": 3, "dim_time": 24, "dim_vendor": 3, "dim_payment_type": 7, "dim_rate_code": 7,
        "fact_trips": 16,
    }
    assert {(r.status, r.reason) for r in built.collect()} == {("success", None)}


def test_fact(spark, stored):
    layout, _, _ = stored
    trips = layers.read_gold(spark, layout, "fact_trips")
    assert trips.schema == FACT_SCHEMA
    rows = trips.orderBy("trip_id").collect()
    assert [r.trip_id for r in rows] == list(range(16))
    assert [r.date_key for r in rows] == [20190101] * 9 + [20190202] * 3 + [20200106] * 4
    january = sorted(rows[:9], key=lambda r: r.fare_amount)
    assert [r.vendor_key for r in january] == [0, 1, 2, 0, 0, 1, 2, 0, 0]
    assert [r.payment_key for r in january] == [0, 1, 2, 3, 4, 5, 6, 0, 0]
    assert [r.rate_code_key for r in january] == [0, 1, 2, 3, 4, 5, 6, 0, 0]
    assert [r.PULocationID for r in january] == [7] * 8 + [0]
    assert {r.DOLocationID for r in rows} == {0}
    assert {(r.time_key, r.trip_duration_minutes, r.extra) for r in rows} == {(10, 30.0, 0.0)}
    assert not any(v is None for r in rows for v in r)


def test_dim_date(spark, stored):
    layout, _, _ = stored
    rows = layers.read_gold(spark, layout, "dim_date").collect()
    assert [r.date_key for r in rows] == [20190101, 20190202, 20200106]
    first, saturday, monday = rows
    assert (first.day_of_week, first.day_name, first.month_name, first.quarter) == (1, "Tuesday", "January", 1)
    assert (saturday.day_of_week, saturday.is_weekend, monday.day_of_week, monday.is_weekend) == (5, True, 0, False)


def test_rebuild_is_the_same(spark, stored):
    layout, _, _ = stored
    before = sorted(layers.read_gold(spark, layout, "fact_trips").collect())
    build_gold(spark, layout)
    assert sorted(layers.read_gold(spark, layout, "fact_trips").collect()) == before


def test_schemas_and_views(spark, stored):
    layout, _, _ = stored
    for name, schema in GOLD_SCHEMAS.items():
        assert layers.read_gold(spark, layout, name).schema == schema
    layers.register_gold_views(spark, layout)
    got = spark.sql("SELECT count(*) AS n FROM fact_trips JOIN dim_date USING (date_key) WHERE is_weekend")
    assert got.first().n == 3


def test_checks_on_a_clean_star(spark, stored):
    layout, _, _ = stored
    tables = layers.gold_tables(spark, layout)
    trips = tables["fact_trips"]
    dims = {
        "date_key": tables["dim_date"],
        "time_key": tables["dim_time"],
        "vendor_key": tables["dim_vendor"],
        "payment_key": tables["dim_payment_type"],
        "rate_code_key": tables["dim_rate_code"],
    }
    assert {(r.fk, r.orphans, r.status) for r in checks.fk_orphans(trips, dims).collect()} == {
        (key, 0, "OK") for key in dims
    }
    assert checks.null_counts(trips).count() == 0
    assert {r.trips for r in checks.measure_sanity(trips).collect()} == {0}
    years = checks.valid_years(layers.silver_files(spark, layout))
    assert [tuple(r) for r in checks.trips_per_year(trips, years).collect()] == [
        (2019, 12, "OK"), (2020, 4, "OK"),
    ]
    assert checks.bad_year_sample(trips, years).count() == 0
    only_2019 = years.where("year = 2019")
    assert [r.trip_id for r in checks.bad_year_sample(trips, only_2019).collect()] == [12, 13, 14, 15]
    top = checks.top_dates(trips, tables["dim_date"]).collect()
    assert [(str(r.full_date), r.trips) for r in top] == [
        ("2019-01-01", 9), ("2020-01-06", 4), ("2019-02-02", 3),
    ]
    view = checks.overview(trips).first()
    assert (view.total_trips, view.min_date_key, view.max_date_key) == (16, 20190101, 20200106)
    assert view.columns.split(", ") == trips.columns
    single = checks.summary_stats(trips.limit(1), ["fare_amount"]).first()
    assert single["std"] is None and single["mean"] == single["min"]


def test_empty_fact_checks(spark, layout):
    trips = layers.read_gold(spark, layout, "fact_trips")
    dims = {"date_key": layers.read_gold(spark, layout, "dim_date")}
    assert [tuple(r) for r in checks.fk_orphans(trips, dims, ["date_key"]).collect()] == [("date_key", 0, "OK")]
    assert checks.overview(trips).first().total_trips == 0


def test_report(spark, stored):
    layout, run, built = stored
    lines = {(r.section, r.item, r.metric): r.value for r in run_report(spark, layout, run, built).collect()}
    assert lines["run", "all", "files_processed"] == 3
    assert lines["run", "all", "quarantine_percentage"] == round(100 / 17, 2)
    assert lines["saved", "silver", "records"] == 16
    assert lines["gold", "fact_trips", "records"] == 16
    assert lines["file", "yellow_tripdata_2019-02.csv", "clean_percentage"] == 75.0


def test_no_silver(spark, layout):
    (row,) = build_gold(spark, layout).collect()
    assert (row.status, row.reason) == ("skipped", "silver_empty")


def test_unreadable_silver_file_is_left_out(spark, stored):
    layout, _, _ = stored
    folder = f"{layout.silver}/source_file=yellow_tripdata_2018-01.csv"
    os.mkdir(folder)
    with open(f"{folder}/part-0.parquet", "w") as out:
        out.write("not parquet")
    bad = [r.file_path for r in layers.unreadable_files(spark, layout).collect()]
    assert len(bad) == 1 and bad[0].endswith("part-0.parquet")
    assert {r.records for r in build_gold(spark, layout).where("`table` = 'fact_trips'").collect()} == {16}


def test_only_unreadable_silver(spark, layout):
    folder = f"{layout.silver}/source_file=yellow_tripdata_2018-01.csv"
    os.makedirs(folder)
    with open(f"{folder}/part-0.parquet", "w") as out:
        out.write("not parquet")
    (row,) = build_gold(spark, layout).collect()
    assert (row.status, row.reason) == ("skipped", "no_readable_files")


@pytest.mark.parametrize("limit", [1, 3, 5, 100_000])
def test_dense_ids_in_blocks_of_files(spark, tmp_path, monkeypatch, limit):
    """Most rows in one source file, several part files each; blocks may begin within a source file."""
    monkeypatch.setattr(fact, "FILES_PER_BROADCAST", limit)
    path = str(tmp_path / "stored")
    rows = spark.range(30_000, numPartitions=4).selectExpr(
        "if(id % 3 < 2, 'b.csv', if(id % 2 = 0, 'a.csv', 'c.csv')) AS source_file", "id AS v"
    )
    rows.write.partitionBy("source_file").parquet(path)
    ids = fact.with_trip_id(spark.read.parquet(path))
    got = ids.groupBy("source_file").agg({"trip_id": "min", "*": "count"}).orderBy("source_file").collect()
    assert [(r[0], r["min(trip_id)"], r["count(1)"]) for r in got] == [
        ("a.csv", 0, 5000), ("b.csv", 5000, 20000), ("c.csv", 25000, 5000),
    ]
    one = ids.selectExpr("count(DISTINCT trip_id) AS n", "max(trip_id) AS hi", "count(DISTINCT v) AS v").first()
    assert tuple(one) == (30_000, 29_999, 30_000)
    assert fact.with_trip_id(spark.read.parquet(path).where("source_file = 'x'")).count() == 0
    text = ids._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text.split("BroadcastExchange")[0] and "SinglePartition" not in text


def test_fact_rows_are_not_shuffled(spark, stored):
    layout, _, _ = stored
    silver = layers.read_silver(spark, layout)
    plan = fact.build_fact(silver, layers.read_gold(spark, layout, "dim_date"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert "Exchange hashpartitioning" not in text and text.count("BroadcastHashJoin") == 4


def damage(path):
    """Overwrite some bytes of the first data page."""
    data = bytearray(open(path, "rb").read())
    data[60:84] = bytes(24)
    open(path, "wb").write(data)


def silver_path(layout, month):
    folder = f"{layout.silver}/source_file=yellow_tripdata_{month}.csv"
    (name,) = (f for f in os.listdir(folder) if f.endswith(".parquet"))
    crc = f"{folder}/.{name}.crc"
    if os.path.exists(crc):
        os.remove(crc)
    return f"{folder}/{name}"


def test_a_damaged_page_costs_its_file_only(spark, stored):
    layout, run, _ = stored
    damage(silver_path(layout, "2019-02"))
    assert layers.unreadable_files(spark, layout).count() == 0
    (bad,) = [r.file_path for r in layers.damaged_files(spark, layout).collect()]
    built = build_gold(spark, layout)
    assert {r.table: r.records for r in built.where("status = 'success'").collect()}["fact_trips"] == 13
    assert [(r.reason, r.table) for r in built.where("status = 'left_out'").collect()] == [("unreadable", bad)]
    lines = run_report(spark, layout, run, built).where("section = 'left_out'").collect()
    assert [(r.item, r.value) for r in lines] == [(bad, 1.0)]
    again = build_gold(spark, layout, skip_paths=(bad,))
    assert {r.table: r.records for r in again.where("status = 'success'").collect()}["fact_trips"] == 13


def test_a_build_that_stops_leaves_the_star(spark, stored, monkeypatch):
    from tripstar.plans import gold as plan

    layout, _, _ = stored
    before = sorted(layers.read_gold(spark, layout, "fact_trips").collect())
    write_csv(layout.raw, "yellow_tripdata_2018-01.csv", sample(2, 0, "2018-01-01"))
    ingest(spark, layout)

    def fail(*_):
        raise RuntimeError("stopped")

    monkeypatch.setattr(plan, "write_fact", fail)
    with pytest.raises(RuntimeError):
        build_gold(spark, layout)
    assert sorted(layers.read_gold(spark, layout, "fact_trips").collect()) == before
    assert layers.read_gold(spark, layout, "dim_date").count() == 3
    monkeypatch.undo()
    for _ in range(3):
        build_gold(spark, layout)
    assert layers.read_gold(spark, layout, "fact_trips").count() == len(before) + 2
    builds = layers.finished_builds(spark, layout)
    assert sorted(os.listdir(layout.gold))[-2:] == builds[-2:] and len(builds) == 4
    assert not set(builds[:-2]) & set(os.listdir(layout.gold))


def test_counts_come_from_footers(spark, stored):
    layout, _, _ = stored
    for counts in (layers.saved_counts(spark, layout), layers.folder_counts(spark, layout), layers.gold_counts(spark, layout)):
        assert "PushedAggregation: [COUNT(*)]" in counts._jdf.queryExecution().executedPlan().toString()
