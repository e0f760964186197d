"""Every operator as a named query over the order tables; each maps (session, folder) to rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstar.functions import coerce
from tripstar.operators import checks, dimensions, fact, quality, rules
from tripstar.operators.lookup import Lookup, star_lookup
from tripstar.plans import gold as gold_plan
from tripstar.plans.ingest import ingest
from tripstar.plans.report import run_report
from tripstar.plans.trip_view import FILE_YEAR, dealt_trip_view, table, trip_columns, trip_view
from tripstar.schemas import (
    DROPOFF,
    ERROR_FOLDER,
    ERROR_REASON,
    FAILED_RULES,
    MEASURES,
    MULTIPLE_ERRORS,
    PICKUP,
    FILE_METRICS_SCHEMA,
    REQUIRED_COLUMNS,
    RUN_ID,
    SOURCE_FILE,
)
from tripstar.session import many_small_files, scratch_folder
from tripstar.sources import layers, raw
from tripstar.sources.files import rename_partitions
from tripstar.streaming.file_stream import ingest_stream

Query = Callable[[SparkSession, str], DataFrame]
_QUERIES: dict[str, Query] = {}

FOLDERS = [rule[1] for rule in rules.TRIP_RULE_NAMES] + [MULTIPLE_ERRORS]
DONE_BEFORE = 1998  # files of earlier years stand for the ones already ingested


def query(fn: Query) -> Query:
    _QUERIES[fn.__name__] = fn
    return fn


def all_queries() -> dict[str, Query]:
    return dict(_QUERIES)


def _trips(spark: SparkSession, sf: str) -> DataFrame:
    return trip_columns(trip_view(spark, sf))


TRIP_RULES = rules.trip_rules(FILE_YEAR)


def _clean(spark: SparkSession, sf: str) -> DataFrame:
    return trip_columns(rules.clean_rows(trip_view(spark, sf), TRIP_RULES))


def _fact(spark: SparkSession, sf: str) -> DataFrame:
    return fact.build_fact(_clean(spark, sf))


def _unchecked_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Fact of all trips, invalid ones included, so that the checks have something to find."""
    return fact.build_fact(_trips(spark, sf))


def _dims(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    return {
        "date_key": dimensions.dim_date(_clean(spark, sf)),
        "time_key": dimensions.dim_time(spark),
        "vendor_key": dimensions.dim_vendor(spark),
        "payment_key": dimensions.dim_payment_type(spark),
        "rate_code_key": dimensions.dim_rate_code(spark),
    }


# ----------------------------------------------------------------- coercion and rules


@query
def coerce_types(spark: SparkSession, sf: str) -> DataFrame:
    """Trip values rendered as text, some of it junk, and read back."""
    full = f"date_format({PICKUP}, 'yyyy-MM-dd HH:mm:ss')"
    time_forms = [
        full,
        f"date_format({PICKUP}, 'yyyy-M-d H:m:s')",
        f"date_format({PICKUP}, 'yyyy-MM-dd')",
        f"concat({full}, '.5')",
        "'junk'",
        "''",
    ]
    number_forms = [
        "concat(l_partkey, '.25')",
        "concat(' ', l_partkey, ' ')",
        "concat(l_partkey, 'e2')",
        "concat('-', l_partkey, '.')",
        "'NaN'",
        "concat(l_partkey, 'd')",
        "'1,000'",
        "''",
    ]

    def pick(column: str, forms: list[str]) -> str:
        cases = " ".join(f"WHEN {i} THEN {form}" for i, form in enumerate(forms))
        return f"CASE {column} % {len(forms)} {cases} END"

    text = trip_view(spark, sf).selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"{pick('l_partkey', time_forms)} AS {PICKUP}",
        f"{pick('l_suppkey', number_forms)} AS fare_amount",
    )
    return coerce.typed(text.withColumn("token", F.col("fare_amount"))).selectExpr(
        "l_orderkey",
        "l_linenumber",
        f"{PICKUP} AS pickup",
        "fare_amount AS number",
        f"{coerce.null_if_na('token')} AS token",
    )


@query
def rule_flags(spark: SparkSession, sf: str) -> DataFrame:
    flags = rules.rule_flags(TRIP_RULES)
    return trip_view(spark, sf).selectExpr("l_orderkey", "l_linenumber", *flags)


@query
def error_reason(spark: SparkSession, sf: str) -> DataFrame:
    annotated = rules.annotate(trip_view(spark, sf), rules.trip_rules())
    return annotated.select(
        "l_orderkey", "l_linenumber", SOURCE_FILE, FAILED_RULES, ERROR_REASON, ERROR_FOLDER
    )


@query
def route_counts(spark: SparkSession, sf: str) -> DataFrame:
    return rules.route_counts(trip_view(spark, sf), TRIP_RULES)


@query
def clean_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _clean(spark, sf)


@query
def quarantine_rows(spark: SparkSession, sf: str) -> DataFrame:
    return rules.quarantine_rows(trip_view(spark, sf), TRIP_RULES)


def _quarantine_folder(folder: str) -> Query:
    def run(spark: SparkSession, sf: str) -> DataFrame:
        return rules.folder_rows(trip_view(spark, sf), folder, TRIP_RULES)

    return run


for _folder in FOLDERS:
    _QUERIES[f"quarantine_project_{_folder}"] = _quarantine_folder(_folder)


@query
def event_rule_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The rule engine on another table with its own rules."""
    event_rules = [
        rules.Rule("Value missing or small", "low_value", "value IS NULL OR value < 5"),
        rules.Rule("Error event", "error_event", "event_type = 'error'"),
        rules.Rule("Late in the month", "late", "day(ts) > 20"),
    ]
    return rules.route_counts(table(spark, sf, "events"), event_rules)


# ----------------------------------------------------------------- incremental file lists


def _file_lists(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    files = _trips(spark, sf).select(SOURCE_FILE).distinct()
    return files, files.where(f"{coerce.year_in_name(SOURCE_FILE)} < {DONE_BEFORE}")


@query
def new_files_anti(spark: SparkSession, sf: str) -> DataFrame:
    return raw.new_files(*_file_lists(spark, sf))


@query
def skipped_files_semi(spark: SparkSession, sf: str) -> DataFrame:
    return raw.skipped_files(*_file_lists(spark, sf))


# ----------------------------------------------------------------- quality


@query
def file_metrics(spark: SparkSession, sf: str) -> DataFrame:
    return quality.file_metrics(trip_view(spark, sf), TRIP_RULES).drop("error")


@query
def run_totals(spark: SparkSession, sf: str) -> DataFrame:
    metrics = quality.file_metrics(trip_view(spark, sf), TRIP_RULES)
    return quality.run_totals(metrics)


@query
def quality_alert(spark: SparkSession, sf: str) -> DataFrame:
    """The alert decision per threshold, on both sides of the clean share."""
    totals = quality.run_totals(quality.file_metrics(trip_view(spark, sf), TRIP_RULES))
    default = quality.quality_alert(totals)
    strict = quality.quality_alert(totals, 95.0)
    columns = ["total_records", "alert_triggered"]
    return (
        default.select(F.lit(80).alias("threshold"), *columns)
        .unionByName(strict.select(F.lit(95).alias("threshold"), *columns))
    )


@query
def quality_report(spark: SparkSession, sf: str) -> DataFrame:
    """Report of a run over the new files only, with the skipped ones listed."""
    trips = trip_view(spark, sf)
    year = FILE_YEAR
    fresh = trips.where(f"{year} >= {DONE_BEFORE}")
    old = trips.where(f"{year} < {DONE_BEFORE}").select(SOURCE_FILE).distinct()
    return quality.quality_report(quality.file_metrics(fresh, TRIP_RULES), old)


# ----------------------------------------------------------------- dimensions


@query
def dim_date(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.dim_date(_clean(spark, sf))


@query
def dim_date_events(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.dim_date(table(spark, sf, "events"), "ts")


@query
def dim_time(spark: SparkSession, sf: str) -> DataFrame:
    return dimensions.with_fact_counts(dimensions.dim_time(spark), _fact(spark, sf), "time_key")


@query
def dim_vendor(spark: SparkSession, sf: str) -> DataFrame:
    dim = dimensions.dim_vendor(spark)
    return dimensions.with_fact_counts(dim, _fact(spark, sf), "vendor_key")


@query
def dim_payment_type(spark: SparkSession, sf: str) -> DataFrame:
    dim = dimensions.dim_payment_type(spark)
    return dimensions.with_fact_counts(dim, _fact(spark, sf), "payment_key")


@query
def dim_rate_code(spark: SparkSession, sf: str) -> DataFrame:
    dim = dimensions.dim_rate_code(spark)
    return dimensions.with_fact_counts(dim, _fact(spark, sf), "rate_code_key")


# ----------------------------------------------------------------- fact


@query
def fact_keys(spark: SparkSession, sf: str) -> DataFrame:
    """Key columns, with ``date_key`` looked up in a dimension that lacks the weekends."""
    clean = _clean(spark, sf)
    weekdays = dimensions.dim_date(clean).where(~F.col("is_weekend"))
    return fact.build_fact(clean, weekdays).select(*fact.FACT_KEYS, *fact.LOCATION_COLUMNS)


@query
def fact_measures(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf).select("date_key", *MEASURES)


@query
def fact_duration(spark: SparkSession, sf: str) -> DataFrame:
    return _unchecked_fact(spark, sf).select("date_key", "time_key", "trip_duration_minutes")


@query
def fact_trips(spark: SparkSession, sf: str) -> DataFrame:
    return _fact(spark, sf)


@query
def fact_dense_id(spark: SparkSession, sf: str) -> DataFrame:
    """Dense ids over two stored files of different size, in file order."""
    paths = [f"{sf}/lineitem.parquet", f"{sf}/orders.parquet"]
    stored = spark.read.schema("l_orderkey bigint, o_orderkey bigint").parquet(*paths)
    ids = fact.with_trip_id(stored.withColumn("source", F.col("_metadata.file_name")), "source")
    return ids.select("source", fact.TRIP_ID)


@query
def gold_row_counts(spark: SparkSession, sf: str) -> DataFrame:
    tables = dimensions.static_dimensions(spark)
    tables["dim_date"] = dimensions.dim_date(_clean(spark, sf))
    tables["fact_trips"] = _fact(spark, sf)
    return checks.table_counts(tables)


@query
def star_lookup_generic(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines through orders and customers to nation and region; small parts by lookup."""
    small_parts = table(spark, sf, "part").where(F.col("p_size") <= 25)
    lines = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey")
    found = star_lookup(
        lines,
        [
            Lookup(table(spark, sf, "orders"), "o_orderkey", "o_custkey", "l_orderkey",
                   "cust_key"),
            Lookup(table(spark, sf, "customer"), "c_custkey", "c_nationkey", "cust_key",
                   "nation_key"),
            Lookup(table(spark, sf, "nation"), "n_nationkey", "n_regionkey", "nation_key",
                   "region_key"),
            Lookup(small_parts, "p_partkey", "p_size", "l_partkey", "part_size"),
        ],
    )
    return found.drop("l_partkey")


# ----------------------------------------------------------------- checks and reports


@query
def check_overview(spark: SparkSession, sf: str) -> DataFrame:
    return checks.overview(_fact(spark, sf))


@query
def check_nulls(spark: SparkSession, sf: str) -> DataFrame:
    return checks.null_counts(_trips(spark, sf))


@query
def check_nulls_fact(spark: SparkSession, sf: str) -> DataFrame:
    """A fact never holds NULLs: no rows."""
    return checks.null_counts(_unchecked_fact(spark, sf))


@query
def check_fk_orphans(spark: SparkSession, sf: str) -> DataFrame:
    return checks.fk_orphans(_unchecked_fact(spark, sf), _dims(spark, sf))


@query
def check_fk_orphans_orders(spark: SparkSession, sf: str) -> DataFrame:
    """The same check between large tables: order lines against orders, parts and suppliers."""
    orders = table(spark, sf, "orders").where(F.col("o_orderstatus") != "F")
    dims = {
        "l_orderkey": orders.withColumnRenamed("o_orderkey", "l_orderkey"),
        "l_partkey": table(spark, sf, "part").withColumnRenamed("p_partkey", "l_partkey"),
        "l_suppkey": table(spark, sf, "supplier").withColumnRenamed("s_suppkey", "l_suppkey"),
    }
    return checks.fk_orphans(table(spark, sf, "lineitem"), dims, list(dims))


@query
def check_measures(spark: SparkSession, sf: str) -> DataFrame:
    return checks.measure_sanity(_unchecked_fact(spark, sf))


def _years(spark: SparkSession, sf: str) -> DataFrame:
    """Years in the file names, but for two years, so that some trips are unexpected."""
    years = checks.valid_years(_trips(spark, sf))
    return years.where(~F.col("year").isin(1996, 1999))


@query
def check_valid_years(spark: SparkSession, sf: str) -> DataFrame:
    return checks.valid_years(_trips(spark, sf))


@query
def check_years(spark: SparkSession, sf: str) -> DataFrame:
    return checks.trips_per_year(_unchecked_fact(spark, sf), _years(spark, sf))


@query
def check_bad_years(spark: SparkSession, sf: str) -> DataFrame:
    bad = checks.bad_year_trips(_unchecked_fact(spark, sf), _years(spark, sf))
    return bad.agg(F.count(F.lit(1)).alias("trips"))


@query
def check_bad_year_sample(spark: SparkSession, sf: str) -> DataFrame:
    columns = ["date_key", "fare_amount", "trip_distance"]
    return checks.bad_year_sample(_unchecked_fact(spark, sf), _years(spark, sf), columns)


@query
def check_summary(spark: SparkSession, sf: str) -> DataFrame:
    return checks.summary_stats(_fact(spark, sf))


@query
def top_dates(spark: SparkSession, sf: str) -> DataFrame:
    return checks.top_dates(_fact(spark, sf), dimensions.dim_date(_clean(spark, sf)))


@query
def trips_by_vendor(spark: SparkSession, sf: str) -> DataFrame:
    return checks.trips_by_vendor(_fact(spark, sf), dimensions.dim_vendor(spark))


@query
def trips_by_payment(spark: SparkSession, sf: str) -> DataFrame:
    return checks.trips_by_payment(_fact(spark, sf), dimensions.dim_payment_type(spark))


# ----------------------------------------------------------------- stored layers, end to end


def _times_as_text(trips: DataFrame, form: str = "yyyy-MM-dd HH:mm:ss") -> DataFrame:
    return trips.withColumns({c: F.date_format(c, form) for c in (PICKUP, DROPOFF)})


def _dealt_trips(spark: SparkSession, sf: str) -> DataFrame:
    """``_trips`` dealt out by monthly file, for writing."""
    return trip_columns(dealt_trip_view(spark, sf))


def _write_csv(text: DataFrame, folder: str, mode: str = "error") -> None:
    """Headered CSV, one directory of part files per monthly file; ``text`` is dealt out by file."""
    with many_small_files(text.sparkSession):
        text.write.mode(mode).partitionBy(SOURCE_FILE).option("header", True).csv(folder)


def _stored_trips(spark: SparkSession, sf: str, layout: layers.Layout) -> DataFrame:
    """``_trips`` stored by monthly file and read back: made once, for several writes that shuffle nothing."""
    trips, folder = _dealt_trips(spark, sf), f"{layout.root}/trips"
    with many_small_files(spark):
        trips.write.partitionBy(SOURCE_FILE).parquet(folder)
    return spark.read.schema(trips.schema).parquet(folder).select(trips.columns)


def _move_months(spark: SparkSession, source: str, target: str, first: int) -> None:
    """Move the monthly files from month ``first`` of every year on, without a look into them."""
    names = {unit.source_file for unit in raw.collect_units(raw.raw_units(spark, source, MONTHS))}
    rename_partitions(spark, source, target, SOURCE_FILE, {name for name in names if int(name[-6:-4]) >= first})


def _write_raw(spark: SparkSession, sf: str, folder: str) -> None:
    _write_csv(_times_as_text(_dealt_trips(spark, sf)), folder)


def _new_layout(spark: SparkSession) -> layers.Layout:
    root = scratch_folder(spark)
    return layers.Layout(raw=f"{root}/raw", root=f"{root}/tables")


MONTHS = "*yellow_tripdata*.csv"
FILE_MONTH = f"CAST(substring({SOURCE_FILE}, -6, 2) AS INT)"


def _ingested(spark: SparkSession, sf: str) -> tuple[layers.Layout, object]:
    layout = _new_layout(spark)
    _write_raw(spark, sf, layout.raw)
    return layout, ingest(spark, layout, pattern=MONTHS)


@query
def csv_ingest_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of a run over real CSV files."""
    _, run = _ingested(spark, sf)
    return run.metrics.drop("error")


@query
def csv_ingest_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver rows after the CSV round trip, with the columns that the files have."""
    layout, _ = _ingested(spark, sf)
    silver = layers.read_silver(spark, layout)
    return silver.select(SOURCE_FILE, *[c for c in _trips(spark, sf).columns if c != SOURCE_FILE])


@query
def csv_ingest_quarantine(spark: SparkSession, sf: str) -> DataFrame:
    layout, _ = _ingested(spark, sf)
    return layers.read_quarantine(spark, layout).select(
        SOURCE_FILE, ERROR_REASON, ERROR_FOLDER, *REQUIRED_COLUMNS
    )


@query
def csv_folder_counts(spark: SparkSession, sf: str) -> DataFrame:
    layout, _ = _ingested(spark, sf)
    return layers.folder_counts(spark, layout)


@query
def csv_gold_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Fact table rebuilt from stored silver; ids are checked by ``csv_gold_ids``."""
    layout, _ = _ingested(spark, sf)
    gold_plan.build_gold(spark, layout)
    return layers.read_gold(spark, layout, "fact_trips").drop(fact.TRIP_ID)


@query
def csv_gold_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Range of trip ids per pickup year: dense, and in source-file order."""
    layout, _ = _ingested(spark, sf)
    gold_plan.build_gold(spark, layout)
    return (
        layers.read_gold(spark, layout, "fact_trips")
        .groupBy(F.expr(f"{checks.trip_year()} AS year"))
        .agg(
            F.count(F.lit(1)).alias("trips"),
            F.min(fact.TRIP_ID).alias("first_id"),
            F.max(fact.TRIP_ID).alias("last_id"),
        )
    )


@query
def csv_run_report(spark: SparkSession, sf: str) -> DataFrame:
    layout, run = _ingested(spark, sf)
    built = gold_plan.build_gold(spark, layout)
    return run_report(spark, layout, run, built)


# ----------------------------------------------------------------- odd files and repeated runs

FORMATS = ["yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm:ss", "yyyy-MM-dd HH:mm", "MM/dd/yyyy HH:mm:ss"]


@query
def csv_time_formats(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics where the files of different months write times differently."""
    layout = _new_layout(spark)
    trips = _dealt_trips(spark, sf).where(f"{FILE_MONTH} IS NOT NULL")

    def text(name: str) -> str:
        forms = " ".join(f'WHEN {k} THEN date_format({name}, "{form}")' for k, form in enumerate(FORMATS))
        return f"CASE {FILE_MONTH} % {len(FORMATS)} {forms} END"

    _write_csv(trips.withColumns({c: F.expr(text(c)) for c in (PICKUP, DROPOFF)}), layout.raw)
    return ingest(spark, layout, pattern=MONTHS).metrics.drop("error")


# What the note of a line holds, written as it is: a surplus field, a quoted comma, a stray quote,
# a line break inside quotes.
NOTES = f"""CASE WHEN {FILE_MONTH} = 5 AND passenger_count = 3 THEN 'x,y' WHEN {FILE_MONTH} = 6 THEN '"x,y"'
    WHEN {FILE_MONTH} = 7 THEN 'x"y' WHEN {FILE_MONTH} = 8 AND passenger_count = 4 THEN '"x\ny"' ELSE 'x' END AS note"""


@query
def csv_ragged_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics and errors of files with surplus fields, stray quotes and quoted line breaks."""
    layout = _new_layout(spark)
    noted = _times_as_text(_trips(spark, sf)).selectExpr("*", NOTES)
    _write_lines(noted, layout.raw)
    return ingest(spark, layout, pattern=MONTHS).metrics


def _write_lines(noted: DataFrame, folder: str) -> None:
    """Lines as they are, one part for each file, because a CSV writer would not write such lines."""
    names = [c for c in noted.columns if c != SOURCE_FILE]
    line = F.concat_ws(",", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in names))
    lines = noted.select(SOURCE_FILE, line.alias("value"), F.lit(1).alias("at"))
    heads = noted.select(SOURCE_FILE).distinct().select(SOURCE_FILE, F.lit(",".join(names)).alias("value"), F.lit(0).alias("at"))
    dealt = heads.unionByName(lines).repartition(SOURCE_FILE).sortWithinPartitions(SOURCE_FILE, "at")
    dealt.drop("at").write.partitionBy(SOURCE_FILE).text(folder)


@query
def csv_multiline_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Silver rows of files in which some records are broken inside quotes, both parts as long as the header."""
    layout = _new_layout(spark)
    trips = _trips(spark, sf)
    rest = "y," * (len(trips.columns) - 1) + "y"
    quoted = '"x, ""y"""'
    broken = (
        f"CASE WHEN {FILE_MONTH} IN (4, 8) AND passenger_count = 4 THEN '\"x\n{rest}\"'"
        f" WHEN {FILE_MONTH} = 9 THEN '{quoted}' ELSE 'x' END AS note"
    )
    _write_lines(_times_as_text(trips).selectExpr("*", broken), layout.raw)
    ingest(spark, layout, pattern=MONTHS)
    return layers.read_silver(spark, layout, all_columns=True).select(SOURCE_FILE, *[c for c in trips.columns if c != SOURCE_FILE], "note")


def _odd_headers(spark: SparkSession, sf: str) -> tuple[layers.Layout, object]:
    """February lacks a required column; March spells one in another case."""
    layout = _new_layout(spark)
    text = _times_as_text(_stored_trips(spark, sf, layout))
    _write_csv(text.where(f"{FILE_MONTH} NOT IN (2, 3)"), layout.raw)
    _write_csv(text.where(f"{FILE_MONTH} = 2").drop("fare_amount"), layout.raw, "append")
    _write_csv(text.where(f"{FILE_MONTH} = 3").withColumnRenamed("VendorID", "vendorid"), layout.raw, "append")
    return layout, ingest(spark, layout, pattern=MONTHS)


@query
def csv_bad_headers(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics where some files have a header that does not fit; the others go in."""
    return _odd_headers(spark, sf)[1].metrics


@query
def csv_mixed_case_fact(spark: SparkSession, sf: str) -> DataFrame:
    """Fact table where a column name differs by case in some files and so does not count there."""
    layout, _ = _odd_headers(spark, sf)
    gold_plan.build_gold(spark, layout)
    return layers.read_gold(spark, layout, "fact_trips").drop(fact.TRIP_ID)


@query
def csv_reingest_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Quarantine counts after files that were wholly broken came again with other content."""
    layout = _new_layout(spark)
    text = _times_as_text(_stored_trips(spark, sf, layout))
    _write_csv(text.withColumn("fare_amount", F.lit(-1.0)), layout.raw)
    ingest(spark, layout, pattern=MONTHS)
    _write_csv(text, layout.raw, "overwrite")
    ingest(spark, layout, pattern=MONTHS)
    return layers.folder_counts(spark, layout)


def _damage(spark: SparkSession, folder: str) -> None:
    """Overwrite some bytes of the first data page of each Parquet file of a folder."""
    for row in spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(folder).collect():
        content = bytearray(row.content)
        content[60:84] = bytes(24)
        path = spark._jvm.org.apache.hadoop.fs.Path(row.path)
        out = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).create(path, True)
        out.write(content)
        out.close()


@query
def csv_damaged_silver(spark: SparkSession, sf: str) -> DataFrame:
    """Fact table where the silver files of the first month have a damaged page: they are left out, nothing else is."""
    layout, _ = _ingested(spark, sf)
    first = layers.silver_files(spark, layout).agg(F.min(SOURCE_FILE)).first()[0]
    _damage(spark, f"{layout.silver}/{SOURCE_FILE}={first}")
    gold_plan.build_gold(spark, layout)
    return layers.read_gold(spark, layout, "fact_trips").drop(fact.TRIP_ID)


@query
def csv_stopped_build(spark: SparkSession, sf: str) -> DataFrame:
    """Trips by date key in the star that readers see, after more files came and the build of their star stopped before its end."""
    layout = _new_layout(spark)
    later = f"{layout.root}/later"
    _write_csv(_times_as_text(_dealt_trips(spark, sf)), layout.raw)
    _move_months(spark, layout.raw, later, 7)
    ingest(spark, layout, pattern=MONTHS)
    gold_plan.build_gold(spark, layout)
    _move_months(spark, later, layout.raw, 7)
    ingest(spark, layout, pattern=MONTHS)
    gold_plan.write_star(spark, layout)  # all tables are written, but the pointer isn't turned
    return layers.read_gold(spark, layout, "fact_trips").groupBy("date_key").agg(F.count(F.lit(1)).alias("trips"))


@query
def csv_empty_run(spark: SparkSession, sf: str) -> DataFrame:
    """Totals of a run that finds nothing new, and the files that it skipped."""
    layout = _new_layout(spark)
    clean = rules.clean_rows(dealt_trip_view(spark, sf), TRIP_RULES)
    _write_csv(_times_as_text(trip_columns(clean)), layout.raw)  # a file without clean rows would be taken again
    ingest(spark, layout, pattern=MONTHS)
    run = ingest(spark, layout, pattern=MONTHS)
    return quality.run_totals(run.metrics).withColumn("skipped", F.lit(run.skipped.count()).cast("bigint"))


@query
def csv_gold_skipped(spark: SparkSession, sf: str) -> DataFrame:
    """Result of a build without any silver row, and the files that were looked at."""
    layout = _new_layout(spark)
    _write_csv(_times_as_text(_dealt_trips(spark, sf)).withColumn("trip_distance", F.lit(0.0)), layout.raw)
    run = ingest(spark, layout, pattern=MONTHS)
    built = gold_plan.build_gold(spark, layout).first()
    return run.metrics.select(SOURCE_FILE, "total", "clean", F.lit(built.status).alias("status"), F.lit(built.reason).alias("reason"))


def _streamed(spark: SparkSession, layout: layers.Layout, checkpoint: str) -> None:
    """A stream over the raw files from a checkpoint, run to its end."""
    ingest_stream(spark, layout, f"{layout.root}/{checkpoint}", pattern=MONTHS, max_files_per_trigger=30).awaitTermination()


@query
def csv_stream_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """Metrics of files that a stream took in two goes."""
    layout = _new_layout(spark)
    later = f"{layout.root}/later"
    _write_csv(_times_as_text(_dealt_trips(spark, sf)), layout.raw)
    _move_months(spark, layout.raw, later, 7)
    _streamed(spark, layout, "checkpoint")
    _move_months(spark, later, layout.raw, 7)
    _streamed(spark, layout, "checkpoint")
    return layers.latest_metrics(spark, layout).drop("error", RUN_ID)


@query
def csv_stream_skips(spark: SparkSession, sf: str) -> DataFrame:
    """Runs in which each file was taken: once, though an old and a fresh checkpoint look at it again.

    A file without clean rows leaves no silver, so the fresh checkpoint takes it again; 0 for rejected files.
    """
    layout = _new_layout(spark)
    text = _times_as_text(_stored_trips(spark, sf, layout))
    _write_csv(text.where(f"{FILE_MONTH} != 3"), layout.raw)
    _write_csv(text.where(f"{FILE_MONTH} = 3").drop("fare_amount"), layout.raw, "append")
    for checkpoint in ("old", "old", "fresh"):
        _streamed(spark, layout, checkpoint)
    metrics = spark.read.schema(FILE_METRICS_SCHEMA).parquet(f"{layout.runs}/*/file_metrics")
    runs = metrics.where("error IS NULL").groupBy(SOURCE_FILE).agg(F.count(F.lit(1)).alias("runs"))
    rejected = metrics.where("error IS NOT NULL").select(SOURCE_FILE).distinct().withColumn("runs", F.lit(0).cast("bigint"))
    return runs.unionByName(rejected)


@query
def rules_many(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines per folder under eighty rules."""
    many = [rules.Rule(f"rule {i}", f"f{i}", f"l_partkey % {50 + i} = 1") for i in range(80)]
    return rules.route_counts(table(spark, sf, "lineitem"), many)


@query
def star_lookup_misses(spark: SparkSession, sf: str) -> DataFrame:
    """Order lines through some orders and some customers to nations: a miss stays a miss."""
    orders = table(spark, sf, "orders").where("o_orderkey % 7 != 0")
    customers = table(spark, sf, "customer").where("c_custkey % 5 != 0")
    return star_lookup(
        table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"),
        [
            Lookup(orders, "o_orderkey", "o_custkey", "l_orderkey", "cust_key"),
            Lookup(customers, "c_custkey", "c_nationkey", "cust_key", "nation_key", default=-1),
            Lookup(table(spark, sf, "nation"), "n_nationkey", "n_regionkey", "nation_key", "region_key", default=-1),
        ],
    )
