"""Each rule, each pair of rules, and the split."""

import datetime
import itertools

import pytest

from tripstar.operators import rules as R
from tripstar.schemas import SILVER_SCHEMA, SOURCE_FILE, TRIP_RULE_NAMES

T = datetime.datetime
GOOD = {
    "tpep_pickup_datetime": T(2019, 1, 1, 10),
    "tpep_dropoff_datetime": T(2019, 1, 1, 10, 30),
    "fare_amount": 10.0,
    "trip_distance": 1.5,
    "passenger_count": 1.0,
    SOURCE_FILE: "yellow_tripdata_2019-01.csv",
}
BREAK = [
    {"tpep_pickup_datetime": None},
    {"tpep_dropoff_datetime": None},
    {"fare_amount": 0.0},
    {"trip_distance": None},
    {"passenger_count": 0.0},
    {"tpep_dropoff_datetime": T(2019, 1, 1, 10)},
    {SOURCE_FILE: "yellow_tripdata_2020-01.csv"},
]
LABELS = [label for label, _, _ in TRIP_RULE_NAMES]
FOLDERS = [folder for _, folder, _ in TRIP_RULE_NAMES]


def frame(spark, rows):
    names = [f.name for f in SILVER_SCHEMA if f.name in GOOD]
    fields = [f for f in SILVER_SCHEMA if f.name in GOOD]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], type(SILVER_SCHEMA)(fields))


def annotated(spark, rows):
    return R.annotate(frame(spark, rows), R.trip_rules()).collect()


@pytest.mark.parametrize("i", range(7))
def test_one_broken_rule(spark, i):
    (row,) = annotated(spark, [{**GOOD, **BREAK[i]}])
    assert (row.failed_rules, row.error_reason, row.error_folder) == (1 << i, LABELS[i], FOLDERS[i])


def test_every_possible_pair(spark):
    pairs = [
        (i, j)
        for i, j in itertools.combinations(range(7), 2)
        # without a pickup, order and year are not judged; a missing drop-off has no order
        if (i, j) not in {(0, 5), (0, 6), (1, 5)}
    ]
    rows = annotated(spark, [{**GOOD, **BREAK[i], **BREAK[j]} for i, j in pairs])
    for (i, j), row in zip(pairs, rows, strict=True):
        assert row.error_reason == f"{LABELS[i]}; {LABELS[j]}"
        assert row.error_folder == "multiple_errors"


@pytest.mark.parametrize(
    "change",
    [
        {},
        {"passenger_count": None},
        {"passenger_count": float("nan")},
        {SOURCE_FILE: "x.csv"},
        {"fare_amount": float("inf")},
    ],
)
def test_clean(spark, change):
    (row,) = annotated(spark, [{**GOOD, **change}])
    assert (row.failed_rules, row.error_reason, row.error_folder) == (0, None, "clean")


@pytest.mark.parametrize(
    ("change", "folder"),
    [
        ({"fare_amount": float("nan")}, "invalid_fare"),
        ({"fare_amount": None}, "invalid_fare"),
        ({"trip_distance": float("nan")}, "invalid_distance"),
        ({"passenger_count": -1.0}, "invalid_passenger_count"),
    ],
)
def test_missing_and_negative_values(spark, change, folder):
    (row,) = annotated(spark, [{**GOOD, **change}])
    assert row.error_folder == folder


def test_split_is_total_and_disjoint(spark):
    rows = [{**GOOD, **b} for b in BREAK] + [GOOD, {k: None for k in GOOD}]
    df = frame(spark, rows)
    clean = R.clean_rows(df, R.trip_rules())
    bad = R.quarantine_rows(df, R.trip_rules())
    assert (clean.count(), bad.count()) == (1, len(rows) - 1)
    assert clean.columns == df.columns


def test_quarantine_keeps_only_the_folder_columns(spark):
    df = frame(spark, [{**GOOD, **b} for b in BREAK] + [{**GOOD, "fare_amount": -1.0, "trip_distance": -2.0}])
    rules = R.trip_rules()
    bad = R.quarantine_rows(df, rules)
    kept = R.kept_columns(rules)
    for row in bad.collect():
        for name in kept["multiple_errors"]:
            assert row[name] is None or name in kept[row.error_folder]
    both = R.quarantine_folder(bad, "multiple_errors", rules).first()
    assert (both.fare_amount, both.trip_distance, both.passenger_count) == (-1.0, -2.0, 1.0)
    for folder in kept:
        stored = R.quarantine_folder(bad, folder, rules)
        assert sorted(map(str, R.folder_rows(df, folder, rules).collect())) == sorted(map(str, stored.collect()))
    assert R.quarantine_folder(bad, "invalid_year", rules).columns == [
        "source_file", "error_reason", "tpep_pickup_datetime",
    ]


def test_reasons_as_array(spark):
    df = R.annotate(frame(spark, [GOOD, {**GOOD, "fare_amount": 0.0, "trip_distance": 0.0}]), R.trip_rules())
    got = [r.v for r in df.orderBy("failed_rules").selectExpr(f"{R.error_reasons(R.trip_rules())} AS v").collect()]
    assert got == [[], LABELS[2:4]]


def test_limits_and_quoting(spark):
    df = spark.range(3)
    odd = R.Rule("it's\\odd", "odd", "id % 2 = 1")
    assert {r.error_reason for r in R.annotate(df, [odd]).collect()} == {None, "it's\\odd"}
    for n in (R.MAX_BITS, 80):
        many = [R.Rule(f"r{i}", f"f{i}", f"id = {i}") for i in range(n)]
        assert {r.error_folder for r in R.annotate(df, many).collect()} == {"f0", "f1", "f2"}
    with pytest.raises(ValueError, match="rules"):
        R.failed_bits([])


def test_reason_array_keeps_odd_labels(spark):
    rules = [R.Rule("a; b", "x", "id > 0"), R.Rule("c", "y", "id > 1")]
    df = R.annotate(spark.range(3), rules).orderBy("id")
    assert [r.v for r in df.selectExpr(f"{R.error_reasons(rules)} AS v").collect()] == [[], ["a; b"], ["a; b", "c"]]


def test_eighty_rules(spark):
    """The array form gives what the bits give."""
    few = [R.Rule(f"r{i}", f"f{i % 7}", f"id % {i + 2} = 1", ("id", "half")[: i % 3]) for i in range(40)]
    many = few + [R.Rule(f"never{i}", "g", "id < 0") for i in range(40)]
    df = spark.range(200).selectExpr("id", "id / 2 AS half", "'s' AS source_file")
    assert R.route_counts(df, many).orderBy("error_folder").collect() == R.route_counts(df, few).orderBy("error_folder").collect()
    one, other = (R.annotate(df, rules).select("id", "error_reason", "error_folder").orderBy("id").collect() for rules in (few, many))
    assert one == other
    assert R.clean_rows(df, many).count() == R.clean_rows(df, few).count()
    wide = [R.Rule(r.label, f"own{i}", r.fails, r.keep) for i, r in enumerate(few)]
    wider = wide + many[40:]
    one, other = (R.quarantine_rows(df, rules).orderBy("error_reason", "id").collect() for rules in (wide, wider))
    assert one == other


@pytest.mark.parametrize("n", [62, 63, 125])
def test_rules_may_share_labels(spark, n):
    """A row that breaks the second of two rules of one label goes to the second's folder, and bits mean the same rules."""
    rules = [R.Rule("same", "first", "id = 1", ("id",)), R.Rule("same", "second", "id = 2"), *[R.Rule(f"r{i}", f"f{i}", f"id = {i}", ("half",)) for i in range(2, n)]]
    df = spark.range(n).selectExpr("id", "id / 2 AS half", "'s' AS source_file")
    got = {r.id: r for r in R.annotate(df, rules).collect()}
    assert (got[1].error_folder, got[1].error_reason, got[1].failed_rules) == ("first", "same", 1)
    assert (got[2].error_folder, got[2].error_reason, got[2].failed_rules) == ("multiple_errors", "same; r2", 6)
    assert (got[0].error_folder, got[0].error_reason, got[0].failed_rules) == ("clean", None, 0)
    last = got[n - 1]
    words = list(R.words_of(rules))
    assert (last.error_folder, last[words[-1]]) == (f"f{n - 1}", 1 << (n - 1) % R.MAX_BITS)
    only = R.annotate(spark.range(3).selectExpr("id + 2 AS id", "'s' AS source_file"), [*rules[:2], *[R.Rule(f"r{i}", f"f{i}", "false") for i in range(2, n)]])
    assert [r.error_folder for r in only.orderBy("id").collect()] == ["second", "clean", "clean"]
    kept = {r.error_folder: (r.id, r.half) for r in R.quarantine_rows(df.where(f"id IN (1, {n - 1})"), rules).collect()}
    assert kept == {"first": (1, None), f"f{n - 1}": (None, (n - 1) / 2)}


def test_generated_methods_stay_small(spark):
    """The JIT compiler skips methods above 8,000 bytes."""
    from sample import SF_SMALL

    import __spark_entry__ as contract

    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("codegen")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for name in ["quarantine_rows", "clean_rows", "fact_trips", "top_dates", "rule_flags",
                     "quarantine_project_invalid_fare", "quarantine_project_multiple_errors"]:
            df = contract.queries()[name](spark, SF_SMALL)
            text = df._jdf.queryExecution().explainString(mode)
            sizes = [int(part.split(";")[0]) for part in text.split("maxMethodCodeSize:")[1:]]
            assert sizes and max(sizes) < 8000, name
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
