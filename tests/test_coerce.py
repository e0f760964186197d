"""Coercions against a table of cases and against pandas itself."""

import pandas as pd
import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripstar.functions import coerce
from tripstar.schemas import NA_TOKENS, PICKUP


def run(spark, values, expression):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, t string")
    return [r.v for r in df.selectExpr("i", f"{expression} AS v").orderBy("i").collect()]


TIMES = {
    "2019-01-01 10:00:00": "2019-01-01 10:00:00",
    "2019-1-1 1:00:00": "2019-01-01 01:00:00",
    " 2019-01-01 10:00:00": None,
    "2019-01-03": None,
    "2019": None,
    "2019-01-01 10:00": None,
    "2019-01-01T10:00:00": None,
    "2019-01-01 10:00:00Z": None,
    "2019-01-01 10:00:00.5": None,
    "2019-02-30 00:00:00": None,
    "2019-01-01 24:00:00": None,
    "1600-01-01 00:00:00": None,
    "3000-01-01 00:00:00": None,
    "2262-04-11 23:47:16": "2262-04-11 23:47:16",
    "2262-04-11 23:47:17": None,
    "1677-09-21 00:12:44": "1677-09-21 00:12:44",
    "1677-09-21 00:12:43": None,
    "junk": None,
    "": None,
    None: None,
}


def test_timestamps(spark):
    got = run(spark, list(TIMES), coerce.parse_timestamp("t"))
    assert [None if v is None else str(v) for v in got] == list(TIMES.values())


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
def test_timestamps_do_not_depend_on_the_session_zone(spark, zone):
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        got = run(spark, ["2019-03-10 02:30:00"], f"CAST({coerce.parse_timestamp('t')} AS STRING)")
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert got == ["2019-03-10 02:30:00"]


NUMBERS = {
    " 5 ": 5.0, "1e3": 1000.0, ".5": 0.5, "5.": 5.0, "+3": 3.0, "inf": float("inf"),
    "-Infinity": float("-inf"), "5\t": 5.0, "-0.25": -0.25,
    "NaN": None, "1,000": None, "5d": None, "5F": None, "5d ": None, "0e308": 0.0, "0e309": None, "0e998": None, "-.0E+400 ": None, "0e-400": 0.0, "0x10": None, "0x1p3": None,
    "True": None, "1_000": None, "": None, "1e400": None, " inf ": None, "1e": None, None: None,
}


def test_numbers(spark):
    assert run(spark, list(NUMBERS), coerce.parse_number("t")) == list(NUMBERS.values())


@settings(max_examples=8, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet="0123456789.+-eEdDfFxXinfNa ,_", max_size=9), min_size=200, max_size=300))
def test_numbers_equal_pandas(spark, texts):
    want = pd.to_numeric(pd.Series(texts, dtype=object), errors="coerce")
    got = run(spark, texts, coerce.parse_number("t"))
    for text, w, g in zip(texts, want, got, strict=True):
        assert (g is None) == pd.isna(w), text
        assert g is None or g == pytest.approx(float(w), rel=1e-12), text


def test_staged_and_single_forms_agree(spark):
    texts = [t for t in NUMBERS]
    df = spark.createDataFrame(pa.table({"fare_amount": texts, PICKUP: [None] * len(texts)},
                                        schema=pa.schema([("fare_amount", pa.string()), (PICKUP, pa.string())])))
    both = df.selectExpr(f"{coerce.parse_number('fare_amount')} AS one", "fare_amount", PICKUP)
    typed = coerce.typed(both)
    assert [f.dataType.simpleString() for f in typed.schema] == ["double", "double", "timestamp_ntz"]
    assert all(r.one == r.fare_amount for r in typed.collect())


def test_missing_value_tokens(spark):
    got = run(spark, [*NA_TOKENS, "N", "Y", None], coerce.null_if_na("t"))
    assert got == [None] * len(NA_TOKENS) + ["N", "Y", None]


def test_year_in_name(spark):
    names = ["yellow_tripdata_2019-01.csv", "x.csv", "a_12-34.csv", "b_20190-11_2020-02.csv"]
    assert run(spark, names, coerce.year_in_name("t")) == [2019, None, None, 190]


def test_round2_and_percent(spark):
    row = spark.sql(
        f"SELECT {coerce.round2('3.125D')} AS a, {coerce.round2(coerce.percent('1', '32'))} AS b,"
        f" {coerce.percent('0', '0')} AS c"
    ).first()
    assert tuple(row) == (3.12, 3.12, 0.0)


def test_numeric_columns_without_text(spark):
    df = spark.sql("SELECT double('NaN') AS a, double('inf') AS b, 3.9D AS c, -3.9D AS d, 7 AS e")
    assert tuple(df.selectExpr(*[coerce.whole_number(df, c) for c in "abcdex"]).first()) == (0, 0, 3, -3, 7, 0)
    assert tuple(df.selectExpr(coerce.number(df, "a"), coerce.number(df, "x")).first()) == (None, None)
