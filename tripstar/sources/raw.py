"""Raw CSV files: discovery, incremental skip, header check and typed reading.

A raw unit is a file ``yellow_tripdata*.csv`` or a directory of that name holding part files.
"""

from __future__ import annotations

import csv
import io
import re
from collections.abc import Iterable, Iterator, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce
from urllib.parse import unquote

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripstar.functions.coerce import ident, null_if_na, time_format, typed
from tripstar.schemas import (
    DROPOFF,
    ERROR_FOLDER,
    ERROR_REASON,
    FAILED_RULES,
    HEADER_LINE,
    LAYER,
    MALFORMED,
    NA_TOKENS,
    NUMERIC_COLUMNS,
    OPEN_QUOTE,
    PICKUP,
    RAW_PREFIX,
    RAW_SUFFIX,
    REQUIRED_COLUMNS,
    SOURCE_FILE,
)
from tripstar.session import session_with
from tripstar.sources.records import COMPLETE_QUOTED, PATH, VALUE, ends_open, is_blank, opens, read_records, runs, text_lines

UNIT_PATH = "unit_path"
NAME_START = "name_start"
_CORRUPT = "_corrupt_line"
_PARSED = "_parsed"
_BOM = "\ufeff"
_ONE_TASK_A_FILE = 1 << 40
_SMALL_FILE = 16 << 20

# Same quoting as the pandas reader: a doubled quote is a literal quote, no escape character.
_CSV_OPTIONS = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "columnNameOfCorruptRecord": _CORRUPT}
_MODEL_NAMES = {PICKUP, DROPOFF, *NUMERIC_COLUMNS}
_RESERVED = {name.lower() for name in (*_MODEL_NAMES, SOURCE_FILE, MALFORMED, OPEN_QUOTE, HEADER_LINE, LAYER, FAILED_RULES, ERROR_REASON, ERROR_FOLDER)}


@dataclass(frozen=True)
class RawUnit:
    """One raw file (or directory of part files) to ingest."""

    path: str
    source_file: str
    name_start: int = 0  # a directory of part files: where its name starts in their paths


def path_exists_or_none(load, *paths: str) -> DataFrame | None:
    """``load(*paths)``, or None where nothing is there yet."""
    try:
        return load(*paths)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def unit_of(file_path: str) -> RawUnit | None:
    """Raw unit of one listed file path (escaped, as listings return it)."""
    # ``_metadata.file_path`` writes local paths with one slash.
    file_path = file_path.replace("file:///", "file:/", 1)
    found = re.fullmatch(rf"(.*/[^/]*?)({RAW_PREFIX}[^/]*{re.escape(RAW_SUFFIX)})(/[^/]*)?", file_path)
    if not found:
        return None
    parent, name, part = found.groups()
    return RawUnit(unquote(parent + name), unquote(name), len(parent) + 1 if part else 0)


def units_of_paths(file_paths: Iterable[str]) -> list[RawUnit]:
    """Distinct units in name order; part files fold into their directory."""
    units = {unit for unit in map(unit_of, file_paths) if unit}
    return sorted(units, key=lambda unit: unit.source_file)


def raw_units(
    spark: SparkSession, raw_dir: str, pattern: str = f"{RAW_PREFIX}*{RAW_SUFFIX}"
) -> DataFrame:
    """``(unit_path, source_file, name_start)`` of every raw unit under ``raw_dir``, by name.

    Lists names only; no file is opened. Empty if the directory is missing.
    """
    listing = path_exists_or_none(
        spark.read.format("binaryFile").load, f"{raw_dir.rstrip('/')}/{pattern}"
    )
    return units_frame(spark, units_of_paths(listing.inputFiles()) if listing is not None else [])


def units_frame(spark: SparkSession, units: Sequence[RawUnit]) -> DataFrame:
    return spark.createDataFrame(
        [(u.path, u.source_file, u.name_start) for u in units],
        f"{UNIT_PATH} string, {SOURCE_FILE} string, {NAME_START} int",
    )


def new_files(units: DataFrame, done: DataFrame) -> DataFrame:
    """Units whose ``source_file`` is not in ``done``."""
    return units.join(done, SOURCE_FILE, "left_anti")


def skipped_files(units: DataFrame, done: DataFrame) -> DataFrame:
    """Units whose ``source_file`` is in ``done``."""
    return units.join(done, SOURCE_FILE, "left_semi")


def collect_units(units: DataFrame) -> list[RawUnit]:
    """File names on the driver; their number is that of raw files, not of rows."""
    rows = units.select(UNIT_PATH, SOURCE_FILE, NAME_START).orderBy(SOURCE_FILE).collect()
    return [RawUnit(*row) for row in rows]


@dataclass(frozen=True)
class RawPart:
    """One CSV file of a unit: its raw column names and the time formats of its first values.

    ``header_line`` is the header as it stands in the file; None where it takes several lines.
    """

    unit: RawUnit
    path: str
    header: tuple[str, ...]
    formats: tuple[tuple[str, str], ...]
    header_line: str | None


_TIMES = (PICKUP, DROPOFF)
_HEAD = f"{PATH} string, header array<string>, lines array<string>, first array<string>"


class _Head:
    """Takes the lines of one file until the header and both first times are known."""

    def __init__(self, path: str):
        self.path, self.lines, self.header, self.done = path, [], [], False
        self._pending = ""
        self._first: dict[str, str] = {}

    def take(self, line: str) -> None:
        self._pending = f"{self._pending}\n{line}" if self._pending else line
        if not self.header and line.strip(" \t"):
            self.lines.append(line)
        if ends_open(self._pending):
            return
        row, self._pending = next(csv.reader(io.StringIO(self._pending, newline="")), []), ""
        if not self.header:
            self.header = [name.removeprefix(_BOM) for name in row]
            self._wanted = {name: self.header.index(name) for name in _TIMES if name in self.header}
        else:
            for name, at in self._wanted.items():
                if name not in self._first and at < len(row) and row[at] not in NA_TOKENS:
                    self._first[name] = row[at]
        self.done = bool(self.header) and len(self._first) == len(self._wanted)

    def row(self) -> tuple:
        return self.path, self.header, self.lines, [self._first.get(name) for name in _TIMES]


def _head_reader(one_file: bool):
    """A task's heads. One that holds a single file reads no further than it must; its worker process ends with it."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        heads: list[_Head] = []
        for batch in batches:
            for (path, _), run in runs(batch):
                if not heads or heads[-1].path != path:
                    heads.append(_Head(path))
                head = heads[-1]
                values = run.column(VALUE)
                for at in range(len(values)):
                    if head.done:
                        break
                    head.take(values[at].as_py())
            if one_file and heads and heads[-1].done:
                break
        text = pa.list_(pa.string())
        rows = [head.row() for head in heads if head.header]
        columns = zip(*rows, strict=True) if rows else [[]] * 4
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), text, text, text), strict=True)], names=[PATH, "header", "lines", "first"])

    return read


def _lines_of_heads(spark: SparkSession, paths: Sequence[str]) -> DataFrame | None:
    """Heads of all files: small ones many to a task, large ones each in a task of its own, whole, so that it can stop early."""
    sizes = path_exists_or_none(lambda *p: spark.read.format("binaryFile").load(list(p)), *paths)
    if sizes is None:
        return None
    files = sizes.select(F.col("_metadata.file_path").alias(PATH), (F.col("length") > _SMALL_FILE).alias("large")).where("length > 0").collect()
    tolerant = {"spark.sql.files.ignoreCorruptFiles": "true", "spark.sql.files.ignoreMissingFiles": "true"}
    frames = []
    # a file no longer than the cost of opening one is never split
    for large, split, cost in ((False, _SMALL_FILE * 64, _SMALL_FILE), (True, _ONE_TASK_A_FILE, _ONE_TASK_A_FILE)):
        mine = [unquote(row[PATH]) for row in files if row.large == large]
        if mine:
            session = session_with(spark, {**tolerant, "spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": str(cost)})
            frames.append(text_lines(session, mine).mapInArrow(_head_reader(large), _HEAD))
    return _united(frames) if frames else spark.createDataFrame([], _HEAD)


def read_heads(spark: SparkSession, units: Sequence[RawUnit]) -> tuple[list[RawPart], list[tuple[str, str]]]:
    """Heads of all files, read by tasks; unreadable units become errors.

    The driver sees one row for each file and opens none.
    """
    if not units:
        return [], []
    heads = _lines_of_heads(spark, [u.path for u in units])
    if heads is None:  # a file went away since it was listed
        there = [u for u in units if path_exists_or_none(spark.read.text, u.path) is not None]
        gone = [(u.source_file, f"Path does not exist: {u.path}") for u in units if u not in there]
        parts, errors = read_heads(spark, there)
        return parts, errors + gone
    rows = heads.collect()
    by_path = {unit.path: unit for unit in units}
    parts: dict[RawUnit, list[RawPart]] = {unit: [] for unit in units}
    for row in sorted(rows, key=lambda r: r[PATH]):
        found = unit_of(row[PATH])
        unit = by_path.get(found.path) if found else None
        if unit is None:
            raise ValueError(f"a file that was not asked for: {row[PATH]}")
        times = tuple((name, time_format(value)) for name, value in zip(_TIMES, row.first, strict=True) if name in row.header)
        line = row.lines[0] if len(row.lines) == 1 else None
        parts[unit].append(RawPart(unit, unquote(row[PATH]) if unit.name_start else unit.path, tuple(row.header), times, line))
    good, errors = [], []
    for unit, found in parts.items():
        absent = next((a for part in found if (a := [c for c in REQUIRED_COLUMNS if c not in part.header])), None)
        if not found:
            errors.append((unit.source_file, "No columns to parse from file"))
        elif absent:
            errors.append((unit.source_file, f"Missing columns: {absent}"))
        else:
            good += found
    return good, errors


def column_names(header: Sequence[str]) -> list[str]:
    """A distinct name for each raw column, also where case does not count.

    A repeated name gets ``.1``, ``.2``, an empty one its place. Only the exact names of the model
    count; a name that differs from one by case, or that this package uses itself, gets ``_raw``.
    """
    taken: set[str] = set()
    names = []
    for at, raw in enumerate(header):
        name = raw or f"Unnamed: {at}"
        if name.lower() in _RESERVED and name not in _MODEL_NAMES:
            name += "_raw"
        candidate, k = name, 0
        while candidate.lower() in taken or (k and candidate in header):
            k += 1
            candidate = f"{name}.{k}"
        taken.add(candidate.lower())
        names.append(candidate)
    return names


def _name_source(unit: RawUnit) -> tuple[str, ...]:
    """How rows of a unit learn its name; units that agree can share a read.

    A plain file is its own name. In a directory the name is cut out of the part file's path at a
    fixed place, which costs far less per row than searching for it. A name that paths would
    escape needs a read of its own.
    """
    if not re.fullmatch(r"[\w.-]+", unit.source_file, re.ASCII):
        return ("constant", unit.source_file)
    if unit.name_start:
        return ("folder", unit.name_start, len(unit.source_file))
    return ("file",)


def _source_file(source: tuple, path: str) -> Column:
    kind, *where = source
    if kind == "file":
        return F.substring_index(path, "/", -1)
    if kind == "folder":
        return F.substring(path, *where)
    return F.lit(*where)


def _too_many_fields(width: int) -> Column:
    """True for a record with more fields than the header; short ones are padded with NULL.

    The parser marks both kinds; only marked records are looked at again, without their complete
    quoted fields.
    """
    bare = F.regexp_replace(F.col(f"{_PARSED}.{_CORRUPT}"), COMPLETE_QUOTED, "$1")
    fields = F.length(bare) - F.length(F.replace(bare, F.lit(","), F.lit(""))) + 1
    return F.coalesce(fields > width, F.lit(False))


def parse_group(rows: DataFrame, header: Sequence[str], names: Sequence[str] | None = None) -> DataFrame:
    """``value`` cut into columns of text by position; the other columns of ``rows`` follow, and ``_malformed``."""
    places = [f"_column_{k}" for k in range(len(header))]
    schema = T.StructType([T.StructField(name, T.StringType()) for name in [*places, _CORRUPT]])
    parsed = rows.withColumn(_PARSED, F.from_csv(VALUE, schema.simpleString()[7:-1].replace(":", " "), _CSV_OPTIONS))
    return parsed.select(
        *[F.col(f"{_PARSED}.{place}").alias(name) for place, name in zip(places, names or column_names(header), strict=True)],
        *[c for c in rows.columns if c != VALUE],
        _too_many_fields(len(header)).alias(MALFORMED),
    )


def typed_raw(frame: DataFrame, formats: Mapping[str, str] | None = None) -> DataFrame:
    """Type the known columns and drop the missing-value tokens of all others."""
    known = {*_MODEL_NAMES, SOURCE_FILE, MALFORMED, OPEN_QUOTE, HEADER_LINE}
    others = [c for c in frame.columns if c not in known]
    frame = typed(frame, formats)
    if not others:
        return frame
    return frame.selectExpr(
        *[ident(c) for c in frame.columns if c in known],
        *[f"{null_if_na(ident(c))} AS {ident(c)}" for c in others],
    )


def _grouped(parts: Sequence[RawPart]) -> Iterator[tuple[list[RawPart], list[str]]]:
    """Parts that can share a read, and their column names."""
    # one spelling of each name for all files, as the stored table has one column for them
    spelling = {name.lower(): name for name in _MODEL_NAMES}
    groups: dict[tuple, list[RawPart]] = {}
    for part in parts:
        for name in column_names(part.header):
            spelling.setdefault(name.lower(), name)
        groups.setdefault((part.header, part.header_line, _name_source(part.unit), part.formats), []).append(part)
    for group in groups.values():
        yield group, [spelling[name.lower()] for name in column_names(group[0].header)]


def _united(frames: list[DataFrame]) -> DataFrame | None:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames) if frames else None


def read_lines(spark: SparkSession, parts: Sequence[RawPart]) -> DataFrame | None:
    """Typed rows of all lines, one read per distinct header and time formats.

    ``_header_line`` marks lines that look like the header in a file's first split, ``_open_quote``
    those that end inside quotes: where there are such, or several headers, only ``read_whole_records``
    can tell the records of the file.
    """
    frames = []
    for group, names in _grouped(parts):
        part = group[0]
        rows = text_lines(spark, [p.path for p in group]).where(f"NOT {is_blank(VALUE)}")
        header = (F.col("_block") == 0) & (F.col(VALUE) == F.lit(part.header_line))
        rows = rows.select(VALUE, _source_file(_name_source(part.unit), PATH).alias(SOURCE_FILE), header.alias(HEADER_LINE), F.expr(opens(VALUE)).alias(OPEN_QUOTE))
        frames.append(typed_raw(parse_group(rows, part.header, names), dict(part.formats)))
    return _united(frames)


def repeated_headers(spark: SparkSession, parts: Sequence[RawPart]) -> set[str]:
    """Source files in which the header line stands more than once, or is not found."""
    frames = []
    for group, _ in _grouped(parts):
        line = group[0].header_line
        lines = text_lines(spark, [p.path for p in group])
        heads = lines.where((F.col("_block") == 0) & (F.col(VALUE) == F.lit(line))).groupBy(PATH).count()
        frames.append(heads.where("count = 1").select(PATH))
    once = {row[PATH] for row in _united(frames).collect()} if frames else set()
    found = {unquote(path).replace("file:///", "file:/", 1) for path in once}
    return {part.unit.source_file for part in parts if part.path not in found}


def read_whole_records(spark: SparkSession, parts: Sequence[RawPart], folder: str) -> tuple[DataFrame | None, list[str]]:
    """Typed rows of files whose quoted fields may hold line breaks, and the source files that end inside quotes."""
    frames, broken = [], []
    for k, (group, names) in enumerate(_grouped(parts)):
        part = group[0]
        records, bad = read_records(spark, [p.path for p in group], f"{folder}/{k}")
        broken += [unit_of(path).source_file for path in bad]
        rows = records.select(VALUE, _source_file(_name_source(part.unit), PATH).alias(SOURCE_FILE))
        frames.append(typed_raw(parse_group(rows, part.header, names), dict(part.formats)))
    return _united(frames), broken
