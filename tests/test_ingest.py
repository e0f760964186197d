"""Raw files to silver and quarantine, on real files."""

import os

import pytest
from sample import COLUMNS, bad_line, clean_line, sample, write_csv

from tripstar.plans.gold import build_gold
from tripstar.plans.ingest import ingest
from tripstar.sources import layers, raw
from tripstar.sources.layers import Layout


def metrics_of(run):
    return {r.source_file: r for r in run.metrics.collect()}


def names(df):
    return [r.source_file for r in df.orderBy("source_file").collect()]


def test_discovery(spark, layout):
    for name in ["yellow_tripdata_2019-02.csv", "yellow_tripdata_2019-01.csv"]:
        write_csv(layout.raw, name, [])
    write_csv(layout.raw, "other.txt", [])
    write_csv(layout.raw, "green_2019-01.csv", [])
    units = raw.raw_units(spark, layout.raw)
    assert [r.source_file for r in units.collect()] == [
        "yellow_tripdata_2019-01.csv", "yellow_tripdata_2019-02.csv",
    ]


@pytest.mark.parametrize("folder", ["raw", "missing"])
def test_no_files(spark, layout, folder):
    layout = Layout(raw=layout.raw.replace("raw", folder), root=layout.root)
    run = ingest(spark, layout)
    assert run.metrics.count() == 0
    assert run.skipped.count() == 0
    assert layers.read_silver(spark, layout).count() == 0
    assert layers.read_quarantine(spark, layout).count() == 0
    assert layers.saved_counts(spark, layout).count() == 0


@pytest.mark.parametrize("whole", [True, False])
def test_split(spark, layout, whole):
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", sample(5, 3))
    row = metrics_of(ingest(spark, layout, multi_line=whole))["yellow_tripdata_2019-01.csv"]
    assert (row.total, row.clean, row.quarantine, row.clean_percentage, row.error) == (8, 5, 3, 62.5, None)
    assert layers.read_silver(spark, layout).count() == 5
    bad = layers.read_quarantine(spark, layout)
    assert {r.error_folder for r in bad.collect()} == {"invalid_fare"}
    assert [tuple(r) for r in layers.folder_counts(spark, layout).collect()] == [
        ("invalid_fare", "yellow_tripdata_2019-01.csv", 3)
    ]


def test_missing_column_rejects_only_that_file(spark, layout):
    columns = [c for c in COLUMNS if c != "fare_amount"]
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", [clean_line()[:5]], columns)
    write_csv(layout.raw, "yellow_tripdata_2019-02.csv", sample(2, 0))
    got = metrics_of(ingest(spark, layout))
    assert got["yellow_tripdata_2019-01.csv"].error == "Missing columns: ['fare_amount']"
    assert got["yellow_tripdata_2019-01.csv"].total is None
    assert got["yellow_tripdata_2019-02.csv"].clean == 2
    assert names(layers.silver_files(spark, layout)) == ["yellow_tripdata_2019-02.csv"]


def test_header_names_are_case_sensitive(spark, layout):
    columns = [c.upper() if c == "fare_amount" else c for c in COLUMNS]
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", sample(2, 0), columns)
    assert "fare_amount" in metrics_of(ingest(spark, layout))["yellow_tripdata_2019-01.csv"].error


def test_empty_file_and_header_only_file(spark, layout):
    open(os.path.join(layout.raw, "yellow_tripdata_2019-01.csv"), "w").close()
    write_csv(layout.raw, "yellow_tripdata_2019-02.csv", [])
    got = metrics_of(ingest(spark, layout))
    assert got["yellow_tripdata_2019-01.csv"].error
    row = got["yellow_tripdata_2019-02.csv"]
    assert (row.total, row.clean, row.clean_percentage, row.error) == (0, 0, 0.0, None)


def test_permuted_headers_follow_names(spark, layout):
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", [clean_line(1)])
    write_csv(layout.raw, "yellow_tripdata_2019-02.csv", [clean_line(2)], order=[5, 4, 3, 2, 1, 0])
    ingest(spark, layout)
    rows = {r.source_file: r for r in layers.read_silver(spark, layout).collect()}
    assert rows["yellow_tripdata_2019-01.csv"].fare_amount == 11.0
    assert rows["yellow_tripdata_2019-02.csv"].fare_amount == 12.0
    assert rows["yellow_tripdata_2019-02.csv"].total_amount == 14.0


def test_byte_order_mark(spark, layout):
    path = write_csv(layout.raw, "yellow_tripdata_2019-01.csv", sample(2, 0))
    text = open(path, encoding="utf-8").read()
    open(path, "w", encoding="utf-8-sig").write(text)
    assert metrics_of(ingest(spark, layout))["yellow_tripdata_2019-01.csv"].clean == 2


def test_ragged_lines(spark, layout):
    short = clean_line()[:5]
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", [clean_line(), short])
    long = [*clean_line(), "surplus"]
    write_csv(layout.raw, "yellow_tripdata_2019-02.csv", [clean_line(), bad_line(), long])
    got = metrics_of(ingest(spark, layout))
    assert got["yellow_tripdata_2019-01.csv"].clean == 2
    assert "more fields" in got["yellow_tripdata_2019-02.csv"].error
    silver = layers.read_silver(spark, layout)
    assert names(silver) == ["yellow_tripdata_2019-01.csv"] * 2
    assert silver.where("total_amount IS NULL").count() == 1
    assert layers.read_quarantine(spark, layout).count() == 0


def test_quoted_fields(spark, layout):
    columns = [*COLUMNS, "note"]
    lines = [[*clean_line(), '"a, ""b"""'], [*clean_line(), "NA"], [*clean_line(), "plain"]]
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", lines, columns)
    assert metrics_of(ingest(spark, layout))["yellow_tripdata_2019-01.csv"].clean == 3
    notes = {r.note for r in layers.read_silver(spark, layout, all_columns=True).collect()}
    assert notes == {'a, "b"', None, "plain"}


def test_line_breaks_inside_quotes(spark, layout):
    columns = [*COLUMNS, "note"]
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", [[*clean_line(), '"a\nb"']], columns)
    run = ingest(spark, layout, multi_line=True)
    assert metrics_of(run)["yellow_tripdata_2019-01.csv"].total == 1


def test_second_run_takes_only_new_files(spark, layout):
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", sample(2, 1))
    ingest(spark, layout)
    write_csv(layout.raw, "yellow_tripdata_2019-02.csv", sample(0, 2, "2019-02-01"))
    second = ingest(spark, layout)
    assert names(second.metrics) == ["yellow_tripdata_2019-02.csv"]
    assert names(second.skipped) == ["yellow_tripdata_2019-01.csv"]
    # a file without a clean row leaves no silver, so it is looked at again and replaced
    third = ingest(spark, layout)
    assert names(third.metrics) == ["yellow_tripdata_2019-02.csv"]
    assert layers.read_quarantine(spark, layout).count() == 3
    saved = {(r.layer, r.source_file): r.records for r in layers.saved_counts(spark, layout).collect()}
    assert saved == {
        ("silver", "yellow_tripdata_2019-01.csv"): 2,
        ("quarantine", "yellow_tripdata_2019-01.csv"): 1,
        ("quarantine", "yellow_tripdata_2019-02.csv"): 2,
    }


def test_directory_of_part_files(spark, layout):
    for name in ["yellow_tripdata_2019-01.csv", "yellow_tripdata odd_2019-02.csv"]:
        os.mkdir(os.path.join(layout.raw, name))
        for part in range(2):
            write_csv(os.path.join(layout.raw, name), f"part-{part}.csv", sample(2, 1, f"2019-{name[-6:-4]}-03"))
    write_csv(layout.raw, "yellow_tripdata one file_2019-03.csv", sample(1, 0, "2019-03-01"))
    got = {k: (r.total, r.clean) for k, r in metrics_of(ingest(spark, layout)).items()}
    assert got == {
        "yellow_tripdata_2019-01.csv": (6, 4),
        "yellow_tripdata odd_2019-02.csv": (6, 4),
        "yellow_tripdata one file_2019-03.csv": (1, 1),
    }


def test_hot_file_is_not_written_by_one_task(spark, layout):
    """Rebalancing splits a folder that holds most of the rows."""
    from pyspark.sql import functions as F

    rows = spark.range(300_000, numPartitions=8).selectExpr(
        "'yellow_tripdata_2019-01.csv' AS source_file", "uuid() AS error_reason",
        "'invalid_fare' AS error_folder", "CAST(id AS DOUBLE) AS fare_amount",
    )
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        layers.write_quarantine(rows, layout, "1")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    stored = spark.read.parquet(layout.quarantine)
    assert stored.count() == 300_000
    assert stored.select(F.col("_metadata.file_path")).distinct().count() > 1


# ------------------------------------------------------------------ odd files


def store(spark, layout, **options):
    """error or (total, clean) of each file, and the stored rows."""
    run = ingest(spark, layout, **options)
    rows = run.metrics.collect()
    return {r.source_file[16:-4]: r.error or (r.total, r.clean) for r in rows}


def raw_text(layout, name, *lines):
    with open(f"{layout.raw}/yellow_tripdata_{name}.csv", "w", encoding="utf-8") as out:
        out.write("\n".join(lines) + "\n")


HEAD = "tpep_pickup_datetime,tpep_dropoff_datetime,fare_amount,trip_distance,passenger_count,note,memo"
ROW = "2019-01-01 10:00:00,2019-01-01 10:30:00,10,1.5,1"


@pytest.mark.parametrize("whole", [True, False])
def test_surplus_fields(spark, layout, whole):
    options = {"multi_line": whole}
    raw_text(layout, "2019-01", HEAD, f"{ROW},a,b", f"{ROW},a,b,c")
    raw_text(layout, "2019-02", HEAD, f'{ROW},a"b,c"d,e')
    raw_text(layout, "2019-03", HEAD, f'{ROW},"a,b",c', f"{ROW},short")
    raw_text(layout, "2019-04", HEAD.removesuffix(",memo"), f"{ROW},x", f"{ROW},x,y")
    found = store(spark, layout, **options)
    assert found.pop("2019-03") == (2, 2)
    assert all("more fields" in error for error in found.values()) and len(found) == 3


def test_a_bad_header_costs_only_its_file(spark, layout):
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", sample(2, 1))
    raw_text(layout, "2019-02", HEAD.replace("memo", "note"), f"{ROW},a,b")
    raw_text(layout, "2019-03", f",{HEAD}", f"0,{ROW},a,b")
    raw_text(layout, "2019-04", HEAD.replace("note", "source_file").replace("memo", "_malformed"), f"{ROW},a,b")
    raw_text(layout, "2019-05", HEAD.replace("note", "vendorid").replace("memo", "VendorID"), f"{ROW},text,2")
    raw_text(layout, "2019-06", HEAD.replace("note", "vendorid").replace("memo", "Note"), f"{ROW},text,b")
    raw_text(layout, "2019-07", "some,thing", "1,2")
    raw_text(layout, "2019-08", "")
    parts = f"{layout.raw}/yellow_tripdata_2019-09.csv"
    os.mkdir(parts)
    for k, order in enumerate((HEAD, HEAD.replace("note,memo", "memo,note"))):
        with open(f"{parts}/part-{k}.csv", "w", encoding="utf-8") as out:
            out.write(f"{order}\n{ROW},a,b\n")
    found = store(spark, layout)
    assert found["2019-01"] == (3, 2) and found["2019-09"] == (2, 2)
    assert all(found[f"2019-0{k}"] == (1, 1) for k in range(2, 7))
    assert "Missing columns" in found["2019-07"]
    rows = {r.source_file[16:-4]: r for r in layers.read_silver(spark, layout, all_columns=True).collect()}
    assert rows["2019-02"]["note.1"] == "b" and rows["2019-03"]["Unnamed: 0"] == "0"
    assert rows["2019-04"]["source_file_raw"] == "a" and rows["2019-05"]["VendorID"] == 2.0
    assert rows["2019-05"]["vendorid_raw"] == "text" and rows["2019-06"]["VendorID"] is None
    both = layers.read_silver(spark, layout, all_columns=True).where("source_file LIKE '%-09.csv'")
    assert {(r.note, r.memo) for r in both.collect()} == {("a", "b"), ("b", "a")}
    assert build_gold(spark, layout).where("table = 'fact_trips' AND records = 9").count() == 1
    write_csv(layout.raw, "yellow_tripdata_2019-10.csv", sample(1, 0))
    assert store(spark, layout)["2019-10"] == (1, 1)


def test_time_format_of_the_file(spark, layout):
    times = {
        "2019-01": ("2019-01-02T03:04:05", "2019-01-02T03:14:05"),
        "2019-02": ("2019-02-02 03:04:05.250", "2019-02-02 03:14:05.5"),
        "2019-03": ("2019-03-02 03:04", "2019-03-02 03:14"),
        "2019-04": ("04/02/2019 03:04:05", "4/2/2019 3:14:05"),
        "2019-05": ("05/02/2019 11:04:05 PM", "05/02/2019 11:14:05 pm"),
        "2019-06": ("2019-06-02", "2019-06-03"),
    }
    for name, (start, end) in times.items():
        other = "2019-01-01 10:00:00"
        raw_text(layout, name, HEAD, f",{end},10,1,1,a,b", f"{start},{end},10,1,1,a,b", f"{other},{end},10,1,1,a,b")
    assert set(store(spark, layout).values()) == {(3, 1)}
    got = {r.source_file[16:-4]: str(r.tpep_pickup_datetime) for r in layers.read_silver(spark, layout).collect()}
    assert got == {
        "2019-01": "2019-01-02 03:04:05", "2019-02": "2019-02-02 03:04:05.250000", "2019-03": "2019-03-02 03:04:00",
        "2019-04": "2019-04-02 03:04:05", "2019-05": "2019-05-02 23:04:05", "2019-06": "2019-06-02 00:00:00",
    }


def test_quoted_line_breaks_by_default(spark, layout):
    raw_text(layout, "2019-01", HEAD, f'{ROW},"two\nlines",b', f'{ROW},a,"last\nfield"', f"{ROW},a,b")
    raw_text(layout, "2019-02", HEAD, f"{ROW},5\" pipe,b", f"{ROW},a,b")
    assert store(spark, layout) == {"2019-01": (3, 3), "2019-02": (2, 2)}
    notes = {r.note for r in layers.read_silver(spark, layout, all_columns=True).collect()}
    assert notes == {"two\nlines", "a", '5" pipe'}


@pytest.mark.parametrize("whole", [True, False])
def test_no_record_is_cut(spark, layout, whole):
    """Both parts of the broken record are as long as the header."""
    raw_text(layout, "2019-01", f"{HEAD},c1,c2,c3,c4", f'{ROW},1,2,a,b,c,"x\n{ROW},a,b,c,d,e,f"', f"{ROW},a,b,c,d,e,f")
    raw_text(layout, "2019-02", HEAD, f'{ROW},a,"never closed', f"{ROW},a,b")
    raw_text(layout, "2019-03", HEAD, "", HEAD, f"{ROW},a,b", " \t ", f"{ROW},a,b")
    raw_text(layout, "2019-04", HEAD.replace("memo", '"me\nmo"'), f'{ROW},a,"""b"""')
    raw_text(layout, "2019-05", HEAD, f"{ROW},a,b")
    found = store(spark, layout, multi_line=whole)
    assert "ends inside a quoted field" in found.pop("2019-02")
    # a line that repeats the header is a row like any other, and breaks the rules
    assert found == {"2019-01": (2, 2), "2019-03": (3, 2), "2019-04": (1, 1), "2019-05": (1, 1)}
    rows = layers.read_silver(spark, layout, all_columns=True)
    assert {r.c4 for r in rows.where("c4 IS NOT NULL").collect()} == {f"x\n{ROW},a,b,c,d,e,f", "f"}
    assert [r["me\nmo"] for r in rows.where("source_file LIKE '%04.csv'").collect()] == ['"b"']
    assert not os.path.exists(f"{layout.root}/_staging") or os.listdir(f"{layout.root}/_staging") == []


def test_heads_are_read_by_tasks(spark, layout):
    """The first times may come late, one column may have none, and a vanished file costs itself only."""
    late = [f",,10,1.5,1,a,b"] * 30_000
    raw_text(layout, "2019-01", HEAD, *late, "2019-01-02T03:04:05,2019-01-02T03:14:05,10,1.5,1,a,b")
    raw_text(layout, "2019-02", HEAD, *late[:3])
    raw_text(layout, "2019-03", HEAD, f"{ROW},a,b")
    units = raw.collect_units(raw.raw_units(spark, layout.raw))
    os.remove(f"{layout.raw}/yellow_tripdata_2019-03.csv")
    parts, errors = raw.read_heads(spark, units)
    assert [dict(p.formats)["tpep_pickup_datetime"] for p in parts] == ["yyyy-M-dTH:m:s", "yyyy-M-d H:m:s"]
    assert [name for name, _ in errors] == ["yellow_tripdata_2019-03.csv"]
    assert [r.clean for r in metrics_of(ingest(spark, layout)).values()] == [1, 0]


def test_a_changed_file_replaces_its_quarantine(spark, layout):
    name = "yellow_tripdata_2019-01.csv"
    write_csv(layout.raw, name, sample(0, 5))
    store(spark, layout)
    assert {(r.error_folder, r.records) for r in layers.folder_counts(spark, layout).collect()} == {("invalid_fare", 5)}
    bad = clean_line()
    bad[3] = "0"
    write_csv(layout.raw, name, [bad, bad])
    store(spark, layout)
    assert {(r.error_folder, r.records) for r in layers.folder_counts(spark, layout).collect()} == {("invalid_distance", 2)}
    write_csv(layout.raw, name, sample(1, 0))
    store(spark, layout)
    assert layers.folder_counts(spark, layout).count() == 0 and layers.saved_counts(spark, layout).count() == 1
