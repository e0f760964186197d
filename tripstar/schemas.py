"""Names, schemas and fixed values of the trip data model."""

from __future__ import annotations

from pyspark.sql import types as T

PICKUP = "tpep_pickup_datetime"
DROPOFF = "tpep_dropoff_datetime"

# ---------------------------------------------------------------------------
# File names, column names and thresholds that the existing data
# and its consumers rely on.
# ---------------------------------------------------------------------------
RAW_PREFIX = "yellow_tripdata"
RAW_SUFFIX = ".csv"

REQUIRED_COLUMNS = [PICKUP, DROPOFF, "fare_amount", "trip_distance", "passenger_count"]

MEASURES = [
    "passenger_count",
    "trip_distance",
    "fare_amount",
    "extra",
    "mta_tax",
    "tip_amount",
    "tolls_amount",
    "improvement_surcharge",
    "congestion_surcharge",
    "total_amount",
]
CODE_COLUMNS = ["VendorID", "payment_type", "RatecodeID"]
LOCATION_COLUMNS = ["PULocationID", "DOLocationID"]

QUALITY_THRESHOLD = 80.0  # percent clean; strictly below raises the alert

CLEAN = "clean"
MULTIPLE_ERRORS = "multiple_errors"

# (label, folder, quarantine columns kept besides source_file and error_reason)
TRIP_RULE_NAMES = [
    ("Invalid pickup datetime", "invalid_pickup_datetime", (PICKUP,)),
    ("Invalid dropoff datetime", "invalid_dropoff_datetime", (DROPOFF,)),
    ("Fare amount <= 0 or NaN", "invalid_fare", ("fare_amount",)),
    ("Trip distance <= 0 or NaN", "invalid_distance", ("trip_distance",)),
    ("Passenger count = 0", "invalid_passenger_count", ("passenger_count",)),
    ("Dropoff before pickup", "invalid_time_sequence", (PICKUP, DROPOFF)),
    ("Pickup year mismatch", "invalid_year", (PICKUP,)),
]

VENDORS = [
    (1, 1, "Creative Mobile Technologies"),
    (2, 2, "VeriFone Inc."),
    (0, 0, "Unknown"),
]
PAYMENT_TYPES = [
    (1, 1, "Credit card"),
    (2, 2, "Cash"),
    (3, 3, "No charge"),
    (4, 4, "Dispute"),
    (5, 5, "Unknown"),
    (6, 6, "Voided trip"),
    (0, 0, "Not recorded"),
]
RATE_CODES = [
    (1, 1, "Standard rate"),
    (2, 2, "JFK"),
    (3, 3, "Newark"),
    (4, 4, "Nassau or Westchester"),
    (5, 5, "Negotiated fare"),
    (6, 6, "Group ride"),
    (0, 0, "Not recorded"),
]

# Tokens that the pandas CSV reader takes as missing by default (public pandas documentation).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# Whole-second range of a nanosecond timestamp; text outside it counts as unparsable.
# It also bounds dim_date: at most 213,504 days.
MIN_TIMESTAMP = "1677-09-21 00:12:44"
MAX_TIMESTAMP = "2262-04-11 23:47:16"
# ---------------------------------------------------------------------------

# Columns that the silver layer stores as DOUBLE, in file order of the fact table.
NUMERIC_COLUMNS = [*CODE_COLUMNS, *LOCATION_COLUMNS, *MEASURES]

# Added by the raw reader and by the rule engine.
SOURCE_FILE = "source_file"
MALFORMED = "_malformed"
OPEN_QUOTE = "_open_quote"
HEADER_LINE = "_header_line"
LAYER = "_layer"
RUN_ID = "run_id"
FAILED_RULES = "failed_rules"
ERROR_REASON = "error_reason"
ERROR_FOLDER = "error_folder"


def _long(name: str) -> T.StructField:
    return T.StructField(name, T.LongType())


def _double(name: str) -> T.StructField:
    return T.StructField(name, T.DoubleType())


def _text(name: str) -> T.StructField:
    return T.StructField(name, T.StringType())


def _stamp(name: str) -> T.StructField:
    return T.StructField(name, T.TimestampNTZType())


def trip_field(name: str) -> T.StructField:
    """Type of a raw column once it is stored in silver."""
    if name in (PICKUP, DROPOFF):
        return _stamp(name)
    return _double(name) if name in NUMERIC_COLUMNS else _text(name)


SILVER_SCHEMA = T.StructType(
    [trip_field(c) for c in [PICKUP, DROPOFF, *NUMERIC_COLUMNS]] + [_text(SOURCE_FILE)]
)

QUARANTINE_SCHEMA = T.StructType(
    [_text(ERROR_REASON)]
    + [trip_field(c) for c in REQUIRED_COLUMNS]
    + [_text(ERROR_FOLDER), _text(SOURCE_FILE)]
)

DIM_DATE_SCHEMA = T.StructType(
    [
        _long("date_key"),
        T.StructField("full_date", T.DateType()),
        _long("year"),
        _long("month"),
        _long("day"),
        _long("day_of_week"),
        _text("day_name"),
        _text("month_name"),
        _long("quarter"),
        T.StructField("is_weekend", T.BooleanType()),
    ]
)
DIM_TIME_SCHEMA = T.StructType([_long("time_key"), _long("hour"), _text("time_period")])
DIM_VENDOR_SCHEMA = T.StructType([_long("vendor_key"), _long("vendor_id"), _text("vendor_name")])
DIM_PAYMENT_SCHEMA = T.StructType(
    [_long("payment_key"), _long("payment_type_code"), _text("payment_description")]
)
DIM_RATE_SCHEMA = T.StructType(
    [_long("rate_code_key"), _long("rate_code_id"), _text("rate_code_description")]
)

FACT_KEYS = ["date_key", "time_key", "vendor_key", "payment_key", "rate_code_key"]
FACT_SCHEMA = T.StructType(
    [_long(c) for c in ["trip_id", *FACT_KEYS, *LOCATION_COLUMNS]]
    + [_double(c) for c in [*MEASURES, "trip_duration_minutes"]]
)

FILE_METRICS_SCHEMA = T.StructType(
    [
        _text(SOURCE_FILE),
        _long("total"),
        _long("clean"),
        _long("quarantine"),
        _double("clean_percentage"),
        _text("error"),
    ]
)

GOLD_SCHEMAS = {
    "dim_date": DIM_DATE_SCHEMA,
    "dim_time": DIM_TIME_SCHEMA,
    "dim_vendor": DIM_VENDOR_SCHEMA,
    "dim_payment_type": DIM_PAYMENT_SCHEMA,
    "dim_rate_code": DIM_RATE_SCHEMA,
    "fact_trips": FACT_SCHEMA,
}
