"""Plain SQL for each catalog query, written independently of the Spark operators."""

from __future__ import annotations

from tripstar.schemas import (
    LOCATION_COLUMNS,
    MEASURES,
    PAYMENT_TYPES,
    RATE_CODES,
    REQUIRED_COLUMNS,
    TRIP_RULE_NAMES,
    VENDORS,
)

_TRIPS = """
trips AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey,
    CASE WHEN l_suppkey % 13 = 0 AND l_partkey % 5 = 0 THEN 'yellow_tripdata_2019-01.csv'
         ELSE concat('yellow_tripdata_', CAST(year(o_orderdate) AS VARCHAR), '-',
                     lpad(CAST(month(o_orderdate) AS VARCHAR), 2, '0'), '.csv') END AS source_file,
    l_linenumber % 4 AS VendorID,
    CASE WHEN l_orderkey % 97 = 0 THEN NULL
         ELSE o_orderdate + to_hours(CAST(l_partkey % 24 AS INT)) END AS tpep_pickup_datetime,
    CASE WHEN l_orderkey % 89 = 0 THEN NULL
         WHEN l_partkey % 41 = 0 THEN o_orderdate + to_hours(CAST(l_partkey % 24 - 30 AS INT))
         ELSE o_orderdate + to_hours(CAST(l_partkey % 24 AS INT))
              + to_minutes(CAST(l_quantity AS INT)) END AS tpep_dropoff_datetime,
    CASE WHEN l_linenumber = 1 AND l_orderkey % 11 = 0 THEN CAST(0 AS DOUBLE)
         WHEN l_linenumber = 7 THEN NULL
         ELSE CAST(l_linenumber AS DOUBLE) END AS passenger_count,
    CASE WHEN l_suppkey % 10 = 9 AND l_partkey % 7 = 0 THEN CAST(0 AS DOUBLE)
         ELSE l_quantity END AS trip_distance,
    CASE WHEN l_linenumber = 2 THEN 99 ELSE l_linenumber END AS RatecodeID,
    l_linenumber - 1 AS payment_type,
    CASE WHEN l_partkey % 37 = 0 THEN -l_extendedprice ELSE l_extendedprice END AS fare_amount,
    l_extendedprice AS total_amount
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey
)"""

_CONDITIONS = [
    "tpep_pickup_datetime IS NULL",
    "tpep_dropoff_datetime IS NULL",
    "fare_amount IS NULL OR fare_amount <= 0",
    "trip_distance IS NULL OR trip_distance <= 0",
    "passenger_count IS NOT NULL AND passenger_count <= 0",
    "tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL"
    " AND tpep_dropoff_datetime <= tpep_pickup_datetime",
    "tpep_pickup_datetime IS NOT NULL AND year(tpep_pickup_datetime)"
    " <> CAST(regexp_extract(source_file, '(\\d{4})-\\d{2}', 1) AS INT)",
]
_FLAG_NAMES = [folder for _, folder, _ in TRIP_RULE_NAMES]
_FLAGS = ", ".join(f"({c}) AS {n}" for c, n in zip(_CONDITIONS, _FLAG_NAMES, strict=True))
_BITS = " + ".join(f"CAST({n} AS BIGINT) * {1 << i}" for i, n in enumerate(_FLAG_NAMES))
_BROKEN = " + ".join(f"CAST({n} AS INT)" for n in _FLAG_NAMES)
_LABELS = ", ".join(
    f"CASE WHEN {folder} THEN '{label}' END" for label, folder, _ in TRIP_RULE_NAMES
)
_ROUTES = " ".join(f"WHEN {n} THEN '{n}'" for n in _FLAG_NAMES)

_CHECKED = f"""{_TRIPS},
flagged AS (SELECT *, {_FLAGS} FROM trips),
checked AS (
  SELECT *, {_BITS} AS failed_rules,
    CASE WHEN {_BROKEN} > 0 THEN concat_ws('; ', {_LABELS}) END AS error_reason,
    CASE WHEN {_BROKEN} = 0 THEN 'clean' WHEN {_BROKEN} > 1 THEN 'multiple_errors'
         {_ROUTES} END AS error_folder
  FROM flagged
),
silver AS (SELECT * FROM checked WHERE error_folder = 'clean')"""

_TRIP_COLUMNS = (
    "source_file, VendorID, tpep_pickup_datetime, tpep_dropoff_datetime, passenger_count, "
    "trip_distance, RatecodeID, payment_type, fare_amount, total_amount"
)


def _dim_date(source: str, column: str = "tpep_pickup_datetime") -> str:
    return f"""(
  SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key, d AS full_date, year(d) AS year,
    month(d) AS month, day(d) AS day, isodow(d) - 1 AS day_of_week, dayname(d) AS day_name,
    monthname(d) AS month_name, quarter(d) AS quarter, isodow(d) >= 6 AS is_weekend
  FROM (SELECT DISTINCT CAST({column} AS DATE) AS d FROM {source} WHERE {column} IS NOT NULL))"""


def _values(rows: list[tuple], *names: str) -> str:
    body = ", ".join(
        "(" + ", ".join(f"'{v}'" if isinstance(v, str) else f"CAST({v} AS BIGINT)" for v in r) + ")"
        for r in rows
    )
    return f"(VALUES {body}) AS t({', '.join(names)})"


_DIM_TIME = """(SELECT range AS time_key, range AS hour,
  CASE WHEN range < 6 THEN 'night' WHEN range < 12 THEN 'morning'
       WHEN range < 18 THEN 'afternoon' ELSE 'evening' END AS time_period FROM range(24))"""
_VENDOR = _values(VENDORS, "vendor_key", "vendor_id", "vendor_name")
_PAYMENT = _values(PAYMENT_TYPES, "payment_key", "payment_type_code", "payment_description")
_RATE = _values(RATE_CODES, "rate_code_key", "rate_code_id", "rate_code_description")

_PRESENT = ["passenger_count", "trip_distance", "fare_amount", "total_amount"]
_MEASURE_SQL = ", ".join(
    f"coalesce({m}, 0.0::DOUBLE) AS {m}" if m in _PRESENT else f"0.0::DOUBLE AS {m}" for m in MEASURES
)


def _fact(source: str) -> str:
    """Fact rows of ``source``: the code columns of the trip view are all present."""
    places = ", ".join(f"0::BIGINT AS {c}" for c in LOCATION_COLUMNS)
    return f"""(
  SELECT coalesce(CAST(strftime(tpep_pickup_datetime, '%Y%m%d') AS BIGINT), 0) AS date_key,
    coalesce(hour(tpep_pickup_datetime), 0) AS time_key,
    CASE WHEN VendorID IN (1, 2) THEN VendorID ELSE 0 END::BIGINT AS vendor_key,
    CASE WHEN payment_type BETWEEN 1 AND 6 THEN payment_type ELSE 0 END::BIGINT AS payment_key,
    CASE WHEN RatecodeID BETWEEN 1 AND 6 THEN RatecodeID ELSE 0 END::BIGINT AS rate_code_key,
    {places}, {_MEASURE_SQL},
    coalesce(round_even(greatest(
      date_diff('microsecond', tpep_pickup_datetime, tpep_dropoff_datetime) / 60000000.0::DOUBLE,
      0.0::DOUBLE), 2)::DOUBLE, 0.0::DOUBLE) AS trip_duration_minutes
  FROM {source})"""


def _round2(value: str) -> str:
    return f"round_even(({value})::DOUBLE, 2)::DOUBLE"


def _pct(part: str, whole: str = "total") -> str:
    return f"CASE WHEN {whole} > 0 THEN 100.0::DOUBLE * {part} / {whole} ELSE 0.0::DOUBLE END"


_FILE_METRICS = f"""(
  SELECT *, {_round2(_pct('clean'))} AS clean_percentage FROM (
    SELECT source_file, count(*) AS total, count(*) FILTER (error_folder = 'clean') AS clean,
      count(*) FILTER (error_folder <> 'clean') AS quarantine
    FROM checked GROUP BY source_file))"""
_TOTALS = f"""(
  SELECT count(*) AS files_processed, sum(total)::BIGINT AS total_records,
    sum(clean)::BIGINT AS clean_records, sum(quarantine)::BIGINT AS quarantine_records
  FROM {_FILE_METRICS})"""
_FILE_YEAR = "CAST(regexp_extract(source_file, '(\\d{4})-\\d{2}', 1) AS BIGINT)"


def _long(columns: dict[str, str], source: str, section: str, item: str) -> str:
    """One report line per column of ``source``."""
    return " UNION ALL ".join(
        f"SELECT '{section}' AS section, {item} AS item, '{name}' AS metric,"
        f" ({value})::DOUBLE AS value FROM {source}"
        for name, value in columns.items()
    )


_RUN_LINES = {
    "files_processed": "files_processed",
    "total_records": "total_records",
    "clean_records": "clean_records",
    "quarantine_records": "quarantine_records",
    "clean_percentage": _round2(_pct("clean_records", "total_records")),
    "quarantine_percentage": _round2(_pct("quarantine_records", "total_records")),
    "alert_triggered": "CASE WHEN total_records > 0 AND 100.0 * clean_records / total_records < 80"
    " THEN 1 ELSE 0 END",
}
_FILE_LINES = {"clean": "clean", "quarantine": "quarantine", "clean_percentage": "clean_percentage"}


def _report(checked: str) -> str:
    metrics = _FILE_METRICS.replace("FROM checked", f"FROM {checked}")
    totals = _TOTALS.replace("FROM checked", f"FROM {checked}")
    return (
        _long(_RUN_LINES, totals, "run", "'all'")
        + " UNION ALL "
        + _long(_FILE_LINES, metrics, "file", "source_file")
    )


def _with(ctes: str, body: str) -> str:
    return f"WITH {ctes.strip()}\n{body.strip()}"


def _kept(folder: str) -> list[str]:
    return next(
        (list(keep) for _, name, keep in TRIP_RULE_NAMES if name == folder), REQUIRED_COLUMNS
    )


def _quarantine_column(name: str) -> str:
    folders = [f for _, f, keep in TRIP_RULE_NAMES if name in keep] + ["multiple_errors"]
    quoted = ", ".join(f"'{f}'" for f in folders)
    return f"CASE WHEN error_folder IN ({quoted}) THEN {name} END AS {name}"


_QUARANTINE = (
    "SELECT source_file, error_reason, error_folder, "
    + ", ".join(map(_quarantine_column, REQUIRED_COLUMNS))
    + " FROM checked WHERE error_folder <> 'clean'"
)

_COERCE = r"""
texts AS (
  SELECT l_orderkey, l_linenumber,
    CASE l_partkey % 6
      WHEN 0 THEN strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S')
      WHEN 1 THEN strftime(tpep_pickup_datetime, '%Y-%-m-%-d %-H:%-M:%-S')
      WHEN 2 THEN strftime(tpep_pickup_datetime, '%Y-%m-%d')
      WHEN 3 THEN strftime(tpep_pickup_datetime, '%Y-%m-%d %H:%M:%S') || '.5'
      WHEN 4 THEN 'junk' ELSE '' END AS pickup_text,
    CASE l_suppkey % 8
      WHEN 0 THEN l_partkey || '.25' WHEN 1 THEN ' ' || l_partkey || ' '
      WHEN 2 THEN l_partkey || 'e2' WHEN 3 THEN '-' || l_partkey || '.'
      WHEN 4 THEN 'NaN' WHEN 5 THEN l_partkey || 'd' WHEN 6 THEN '1,000' ELSE '' END AS number_text
  FROM trips
)"""

_YEARS = f"(SELECT DISTINCT {_FILE_YEAR} AS year FROM trips)"
_SOME_YEARS = f"(SELECT year FROM {_YEARS} WHERE year NOT IN (1996, 1999))"
_BAD_YEAR = f"{_fact('trips')} WHERE date_key // 10000 NOT IN (SELECT year FROM {_SOME_YEARS})"


def _dim_usage(dim: str, key: str) -> str:
    return _with(
        _CHECKED,
        f"""SELECT d.*, count(f.{key}) AS trips FROM (SELECT * FROM {dim}) d
        LEFT JOIN {_fact('silver')} f ON f.{key} = d.{key} GROUP BY ALL""",
    )


def _orphans(fact: str, dims: dict[str, str]) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{key}' AS fk, count(*) AS orphans FROM {fact} f"
        f" WHERE NOT EXISTS (SELECT 1 FROM {dim} d WHERE d.{column} = f.{key})"
        for key, (dim, column) in dims.items()
    )
    return f"SELECT *, CASE WHEN orphans = 0 THEN 'OK' ELSE 'WARN' END AS status FROM ({counts})"


def _nulls(columns: list[str], source: str) -> str:
    counts = " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS null_count FROM {source} WHERE {c} IS NULL"
        for c in columns
    )
    return f"SELECT * FROM ({counts}) WHERE null_count > 0"


_SUMMARY = " UNION ALL ".join(
    f"SELECT '{c}' AS column_name, {_round2(f'avg({c})')} AS mean, {_round2(f'stddev_samp({c})')} AS std,"
    f" {_round2(f'min({c})')} AS min, {_round2(f'max({c})')} AS max FROM {_fact('silver')}"
    for c in ["fare_amount", "trip_distance", "passenger_count", "trip_duration_minutes"]
)

_GOLD_COUNTS = f"""
  SELECT 'dim_time' AS "table", count(*) AS records FROM {_DIM_TIME}
  UNION ALL SELECT 'dim_vendor', count(*) FROM {_VENDOR}
  UNION ALL SELECT 'dim_payment_type', count(*) FROM {_PAYMENT}
  UNION ALL SELECT 'dim_rate_code', count(*) FROM {_RATE}
  UNION ALL SELECT 'dim_date', count(*) FROM {_dim_date('silver')}
  UNION ALL SELECT 'fact_trips', count(*) FROM silver"""

_FACT_COLUMNS = ", ".join(
    ["date_key", "time_key", "vendor_key", "payment_key", "rate_code_key", *LOCATION_COLUMNS,
     *MEASURES, "trip_duration_minutes"]
)
_MEASURE_CHECKS = {
    "fare_amount < 0": "fare_amount < 0",
    "trip_distance < 0": "trip_distance < 0",
    "trip_distance = 0": "trip_distance = 0",
    "total_amount < 0": "total_amount < 0",
    "trip_duration_minutes < 0": "trip_duration_minutes < 0",
}
# Silver and quarantine store the code columns as DOUBLE.
_SILVER_CAST = _TRIP_COLUMNS
for _code in ("VendorID", "RatecodeID", "payment_type"):
    _SILVER_CAST = _SILVER_CAST.replace(_code, f"{_code}::DOUBLE AS {_code}")

_EVENT_BITS = (
    "CAST(value < 5 AS INT) + CAST(event_type = 'error' AS INT) + CAST(day(ts) > 20 AS INT)"
)


def all_sql() -> dict[str, str]:
    sql = {
        "coerce_types": _with(
            _TRIPS + "," + _COERCE,
            r"""SELECT l_orderkey, l_linenumber,
              try_strptime(pickup_text, '%Y-%m-%d %H:%M:%S') AS pickup,
              CASE WHEN regexp_full_match(number_text,
                   '\s*[+-]?(\d+(\.\d*)?|\.\d+)([eE][+-]?\d+)?\s*')
                   THEN try_cast(trim(number_text) AS DOUBLE) END AS number,
              CASE WHEN number_text IN ('', 'NaN') THEN NULL ELSE number_text END AS token
            FROM texts""",
        ),
        "rule_flags": _with(_CHECKED, f"SELECT l_orderkey, l_linenumber, {', '.join(_FLAG_NAMES)} FROM flagged"),
        "error_reason": _with(
            _CHECKED,
            "SELECT l_orderkey, l_linenumber, source_file, failed_rules, error_reason, error_folder"
            " FROM checked",
        ),
        "route_counts": _with(
            _CHECKED, "SELECT error_folder, count(*) AS trips FROM checked GROUP BY error_folder"
        ),
        "clean_rows": _with(_CHECKED, f"SELECT {_TRIP_COLUMNS} FROM silver"),
        "quarantine_rows": _with(_CHECKED, _QUARANTINE),
        "event_rule_counts": f"""SELECT error_folder, count(*) AS trips FROM (
            SELECT CASE WHEN {_EVENT_BITS} > 1 THEN 'multiple_errors'
              WHEN value < 5 THEN 'low_value' WHEN event_type = 'error' THEN 'error_event'
              WHEN day(ts) > 20 THEN 'late' ELSE 'clean' END AS error_folder FROM events)
            GROUP BY error_folder""",
        "new_files_anti": _with(
            _TRIPS, f"SELECT DISTINCT source_file FROM trips WHERE {_FILE_YEAR} >= 1998"
        ),
        "skipped_files_semi": _with(
            _TRIPS, f"SELECT DISTINCT source_file FROM trips WHERE {_FILE_YEAR} < 1998"
        ),
        "file_metrics": _with(_CHECKED, f"SELECT * FROM {_FILE_METRICS}"),
        "run_totals": _with(
            _CHECKED,
            f"""SELECT *, {_pct('clean_records', 'total_records')} AS clean_percentage,
              {_pct('quarantine_records', 'total_records')} AS quarantine_percentage FROM {_TOTALS}""",
        ),
        "quality_alert": _with(
            _CHECKED,
            f"""SELECT threshold::INT AS threshold, total_records,
              total_records > 0 AND {_pct('clean_records', 'total_records')} < threshold
                AS alert_triggered
            FROM {_TOTALS}, (VALUES (80), (95)) t(threshold)""",
        ),
        "quality_report": _with(
            _CHECKED + f",\nfresh AS (SELECT * FROM checked WHERE {_FILE_YEAR} >= 1998)",
            _report("fresh")
            + f""" UNION ALL SELECT DISTINCT 'skipped', source_file, 'files', 1.0::DOUBLE
              FROM trips WHERE {_FILE_YEAR} < 1998""",
        ),
        "dim_date": _with(_CHECKED, f"SELECT * FROM {_dim_date('silver')}"),
        "dim_date_events": f"SELECT * FROM {_dim_date('events', 'ts')}",
        "dim_time": _dim_usage(_DIM_TIME, "time_key"),
        "dim_vendor": _dim_usage(_VENDOR, "vendor_key"),
        "dim_payment_type": _dim_usage(_PAYMENT, "payment_key"),
        "dim_rate_code": _dim_usage(_RATE, "rate_code_key"),
        "fact_keys": _with(
            _CHECKED,
            f"""SELECT CASE WHEN isodow(strptime(date_key::VARCHAR, '%Y%m%d')) >= 6 THEN 0
                ELSE date_key END AS date_key, time_key, vendor_key, payment_key, rate_code_key,
              {', '.join(LOCATION_COLUMNS)} FROM {_fact('silver')}""",
        ),
        "fact_measures": _with(_CHECKED, f"SELECT date_key, {', '.join(MEASURES)} FROM {_fact('silver')}"),
        "fact_duration": _with(
            _TRIPS, f"SELECT date_key, time_key, trip_duration_minutes FROM {_fact('trips')}"
        ),
        "fact_trips": _with(_CHECKED, f"SELECT {_FACT_COLUMNS} FROM {_fact('silver')}"),
        "fact_dense_id": """
          SELECT 'lineitem.parquet' AS source, row_number() OVER () - 1 AS trip_id FROM lineitem
          UNION ALL
          SELECT 'orders.parquet', row_number() OVER () - 1 + (SELECT count(*) FROM lineitem) FROM orders""",
        "gold_row_counts": _with(_CHECKED, _GOLD_COUNTS),
        "star_lookup_generic": """
          SELECT l_orderkey, l_linenumber, coalesce(o_custkey, 0)::BIGINT AS cust_key,
            coalesce(c_nationkey, 0)::BIGINT AS nation_key,
            coalesce(n_regionkey, 0)::BIGINT AS region_key,
            CASE WHEN p_size <= 25 THEN p_size ELSE 0 END::BIGINT AS part_size
          FROM lineitem LEFT JOIN orders ON o_orderkey = l_orderkey
          LEFT JOIN customer ON c_custkey = coalesce(o_custkey, 0)
          LEFT JOIN nation ON n_nationkey = coalesce(c_nationkey, 0)
          LEFT JOIN part ON p_partkey = l_partkey""",
        "check_overview": _with(
            _CHECKED,
            f"""SELECT count(*) AS total_trips, min(date_key) AS min_date_key,
              max(date_key) AS max_date_key, '{_FACT_COLUMNS}' AS columns FROM {_fact('silver')}""",
        ),
        "check_nulls": _with(_TRIPS, _nulls(_TRIP_COLUMNS.split(", "), "trips")),
        "check_nulls_fact": _with(_TRIPS, _nulls(_FACT_COLUMNS.split(", "), _fact("trips"))),
        "check_fk_orphans": _with(
            _CHECKED,
            _orphans(
                _fact("trips"),
                {
                    "date_key": (_dim_date("silver"), "date_key"),
                    "time_key": (_DIM_TIME, "time_key"),
                    "vendor_key": (f"(SELECT * FROM {_VENDOR})", "vendor_key"),
                    "payment_key": (f"(SELECT * FROM {_PAYMENT})", "payment_key"),
                    "rate_code_key": (f"(SELECT * FROM {_RATE})", "rate_code_key"),
                },
            ),
        ),
        "check_fk_orphans_orders": _orphans(
            "lineitem",
            {
                "l_orderkey": ("(SELECT * FROM orders WHERE o_orderstatus <> 'F')", "o_orderkey"),
                "l_partkey": ("part", "p_partkey"),
                "l_suppkey": ("supplier", "s_suppkey"),
            },
        ),
        "check_measures": _with(
            _TRIPS,
            " UNION ALL ".join(
                f"SELECT '{name}' AS \"check\", count(*) AS trips FROM {_fact('trips')} WHERE {test}"
                for name, test in _MEASURE_CHECKS.items()
            ),
        ),
        "check_valid_years": _with(_TRIPS, f"SELECT * FROM {_YEARS}"),
        "check_years": _with(
            _TRIPS,
            f"""SELECT date_key // 10000 AS year, count(*) AS trips,
              CASE WHEN date_key // 10000 IN (SELECT year FROM {_SOME_YEARS}) THEN 'OK'
                   ELSE 'WARN' END AS status
            FROM {_fact('trips')} GROUP BY ALL""",
        ),
        "check_bad_years": _with(_TRIPS, f"SELECT count(*) AS trips FROM {_BAD_YEAR}"),
        "check_bad_year_sample": _with(
            _TRIPS,
            f"""SELECT date_key, fare_amount, trip_distance FROM {_BAD_YEAR}
            ORDER BY date_key, fare_amount, trip_distance LIMIT 10""",
        ),
        "check_summary": _with(_CHECKED, _SUMMARY),
        "top_dates": _with(
            _CHECKED,
            f"""SELECT full_date, day_name, trips, {_round2('revenue')} AS revenue FROM (
              SELECT date_key, count(*) AS trips, sum(total_amount::DECIMAL(18, 2)) AS revenue
              FROM {_fact('silver')} GROUP BY date_key)
            JOIN {_dim_date('silver')} USING (date_key) ORDER BY trips DESC, full_date LIMIT 5""",
        ),
        "trips_by_vendor": _with(
            _CHECKED,
            f"""SELECT vendor_name, count(*) AS trips, {_round2('avg(fare_amount)')} AS avg_fare
            FROM {_fact('silver')} JOIN {_VENDOR} USING (vendor_key) GROUP BY vendor_name""",
        ),
        "trips_by_payment": _with(
            _CHECKED,
            f"""SELECT payment_description, count(*) AS trips
            FROM {_fact('silver')} JOIN {_PAYMENT} USING (payment_key) GROUP BY payment_description""",
        ),
    }
    for folder in [*_FLAG_NAMES, "multiple_errors"]:
        sql[f"quarantine_project_{folder}"] = _with(
            _CHECKED,
            f"""SELECT source_file, error_reason, {', '.join(_kept(folder))}
            FROM checked WHERE error_folder = '{folder}'""",
        )

    sql["csv_ingest_metrics"] = sql["file_metrics"]
    sql["csv_ingest_silver"] = _with(_CHECKED, f"SELECT {_SILVER_CAST} FROM silver")
    sql["csv_ingest_quarantine"] = sql["quarantine_rows"]
    sql["csv_folder_counts"] = _with(
        _CHECKED,
        """SELECT error_folder, source_file, count(*) AS records FROM checked
        WHERE error_folder <> 'clean' GROUP BY ALL""",
    )
    sql["csv_gold_fact"] = sql["fact_trips"]
    sql["csv_gold_ids"] = _with(
        _CHECKED,
        f"""SELECT year, trips, (sum(trips) OVER (ORDER BY year) - trips)::BIGINT AS first_id,
          (sum(trips) OVER (ORDER BY year) - 1)::BIGINT AS last_id
        FROM (SELECT date_key // 10000 AS year, count(*) AS trips FROM {_fact('silver')} GROUP BY 1)""",
    )
    sql["csv_run_report"] = _with(
        _CHECKED,
        _report("checked")
        + """ UNION ALL SELECT 'saved', CASE WHEN error_folder = 'clean' THEN 'silver' ELSE 'quarantine' END,
            'records', count(*)::DOUBLE FROM checked GROUP BY ALL"""
        + f' UNION ALL SELECT \'gold\', "table", \'records\', records::DOUBLE FROM ({_GOLD_COUNTS})',
    )
    sql["csv_time_formats"] = sql["file_metrics"]
    sql["csv_reingest_counts"] = sql["csv_folder_counts"]
    month = "substring(source_file, -6, 2)"
    figures = ", ".join(
        f"CASE WHEN NOT bad THEN {c} END AS {c}" for c in ("total", "clean", "quarantine", "clean_percentage")
    )

    def with_errors(error: str, bad: str) -> str:
        files = f"SELECT source_file, bool_or({bad}) AS bad FROM ({_with(_CHECKED, 'SELECT * FROM checked')}) GROUP BY 1"
        return f"""SELECT source_file, {figures}, CASE WHEN bad THEN {error} END AS error
            FROM ({sql["file_metrics"]}) JOIN ({files}) USING (source_file)"""

    surplus = f"{month} = '05' AND coalesce(passenger_count = 3, false)"
    sql["csv_ragged_metrics"] = with_errors("'Error tokenizing data: a line has more fields than the header'", surplus)
    rest = "y," * 9 + "y"
    note = f"""CASE WHEN {month} IN ('04', '08') AND coalesce(passenger_count = 4, false) THEN 'x' || chr(10) || '{rest}'
        WHEN {month} = '09' THEN 'x, "y"' ELSE 'x' END AS note"""
    sql["csv_multiline_silver"] = _with(_CHECKED, f"SELECT {_SILVER_CAST}, {note} FROM silver")
    later = "source_file > (SELECT min(source_file) FROM silver)"
    sql["csv_damaged_silver"] = _with(_CHECKED, f"SELECT {_FACT_COLUMNS} FROM {_fact(f'(SELECT * FROM silver WHERE {later})')}")
    sql["csv_stopped_build"] = _with(
        _CHECKED, f"SELECT date_key, count(*) AS trips FROM {_fact(f'(SELECT * FROM silver WHERE {month} <= {chr(39)}06{chr(39)})')} GROUP BY 1"
    )
    zeros = ", ".join(f"0::BIGINT AS {c}" for c in ("files_processed", "total_records", "clean_records", "quarantine_records"))
    sql["csv_empty_run"] = _with(
        _CHECKED,
        f"SELECT {zeros}, 0.0::DOUBLE AS clean_percentage, 0.0::DOUBLE AS quarantine_percentage, count(DISTINCT source_file) AS skipped FROM silver",
    )
    sql["csv_gold_skipped"] = _with(
        _CHECKED,
        "SELECT source_file, count(*) AS total, 0::BIGINT AS clean, 'skipped' AS status, 'silver_empty' AS reason FROM checked GROUP BY 1",
    )
    sql["csv_stream_metrics"] = sql["file_metrics"]
    sql["csv_stream_skips"] = _with(
        _CHECKED, f"SELECT source_file, CASE WHEN {month} = '03' THEN 0 WHEN bool_or(error_folder = 'clean') THEN 1 ELSE 2 END::BIGINT AS runs FROM checked GROUP BY 1"
    )
    sql["csv_bad_headers"] = with_errors("'Missing columns: [''fare_amount'']'", f"{month} = '02'")
    other_case = "CASE WHEN month(o_orderdate) = 3 AND NOT (l_suppkey % 13 = 0 AND l_partkey % 5 = 0) THEN NULL ELSE l_linenumber % 4 END AS VendorID"
    march = sql["fact_trips"].replace("l_linenumber % 4 AS VendorID", other_case)
    february = "WHERE error_folder = 'clean')"
    sql["csv_mixed_case_fact"] = march.replace(february, f"{february[:-1]} AND {month} <> '02')")
    conditions = [f"l_partkey % {50 + i} = 1" for i in range(80)]
    broken = " + ".join(f"CAST({c} AS INT)" for c in conditions)
    single = " ".join(f"WHEN {c} THEN 'f{i}'" for i, c in enumerate(conditions))
    sql["rules_many"] = f"""SELECT CASE WHEN n = 0 THEN 'clean' WHEN n > 1 THEN 'multiple_errors' {single} END AS error_folder,
        count(*) AS trips FROM (SELECT *, {broken} AS n FROM lineitem) GROUP BY 1"""
    sql["star_lookup_misses"] = """SELECT l_orderkey, l_linenumber, coalesce(o_custkey, 0)::BIGINT AS cust_key,
        coalesce(c_nationkey, -1)::BIGINT AS nation_key, coalesce(n_regionkey, -1)::BIGINT AS region_key
        FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 7 <> 0) ON l_orderkey = o_orderkey
        LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 5 <> 0) ON o_custkey = c_custkey
        LEFT JOIN nation ON c_nationkey = n_nationkey"""
    return sql
