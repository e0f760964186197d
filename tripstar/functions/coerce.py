"""Text-to-type coercions that turn anything unparsable into NULL, and rounding.

Functions named after a value take and return SQL text, for ``selectExpr`` and ``F.expr``: a
frame of many columns is then built in one call. All of it is built-in expressions inside
whole-stage code generation.
"""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tripstar.schemas import (
    DROPOFF,
    MAX_TIMESTAMP,
    MIN_TIMESTAMP,
    NA_TOKENS,
    NUMERIC_COLUMNS,
    PICKUP,
)

_DAY, _US_DAY, _CLOCK = r"\d{4}-\d{1,2}-\d{1,2}", r"\d{1,2}/\d{1,2}/\d{4}", r"\d{1,2}:\d{1,2}:\d{1,2}"
SECONDS = "yyyy-M-d H:m:s"
# Time formats that a file may use: the shape of a value, and the SQL that reads one. One or two
# digits per part except the year.
TIME_FORMATS = {
    SECONDS: (rf"^{_DAY} {_CLOCK}$", "try_cast({} AS TIMESTAMP_NTZ)"),
    "yyyy-M-dTH:m:s": (rf"^{_DAY}T{_CLOCK}$", "try_cast({} AS TIMESTAMP_NTZ)"),
    "yyyy-M-d H:m:s.S": (rf"^{_DAY} {_CLOCK}\.\d{{1,9}}$", "try_cast({} AS TIMESTAMP_NTZ)"),
    "yyyy-M-dTH:m:s.S": (rf"^{_DAY}T{_CLOCK}\.\d{{1,9}}$", "try_cast({} AS TIMESTAMP_NTZ)"),
    "yyyy-M-d H:m": (rf"^{_DAY} \d{{1,2}}:\d{{1,2}}$", "try_cast(concat({}, ':00') AS TIMESTAMP_NTZ)"),
    "yyyy-M-d": (rf"^{_DAY}$", "try_cast({} AS TIMESTAMP_NTZ)"),
    "M/d/yyyy H:m:s": (rf"^{_US_DAY} {_CLOCK}$", "CAST(try_to_timestamp({}, 'M/d/yyyy H:m:s') AS TIMESTAMP_NTZ)"),
    "M/d/yyyy h:m:s a": (rf"^{_US_DAY} {_CLOCK} [AaPp][Mm]$", "CAST(try_to_timestamp(upper({}), 'M/d/yyyy h:m:s a') AS TIMESTAMP_NTZ)"),
    "M/d/yyyy H:m": (rf"^{_US_DAY} \d{{1,2}}:\d{{1,2}}$", "CAST(try_to_timestamp({}, 'M/d/yyyy H:m') AS TIMESTAMP_NTZ)"),
}
_PADDED_NUMBER = r"^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s+$"
_INFINITY_SHAPE = r"^[+-]?(?i)inf(inity)?$"
_ZERO_OUT_OF_RANGE = r"[eE]\+?0*(309|3[1-9]\d|[4-9]\d\d|[1-9]\d{3,})\s*$"
_NUMBER_ENDS = "'0', '1', '2', '3', '4', '5', '6', '7', '8', '9', '.'"
_NA_LIST = ", ".join(f"'{token}'" for token in NA_TOKENS)


def ident(name: str) -> str:
    """Column reference by exact name, whatever characters the name holds."""
    return "`" + name.replace("`", "``") + "`"


def time_format(value: str | None) -> str:
    """Format of a file, from its first value; the default where that has none of the known shapes."""
    for name, (shape, _) in TIME_FORMATS.items():
        if value is not None and re.match(shape, value, re.ASCII):
            return name
    return SECONDS


def read_timestamp(text: str, form: str = SECONDS) -> str:
    """Text -> TIMESTAMP_NTZ in one format, NULL where it can't be read; the shape is not tested."""
    return TIME_FORMATS[form][1].format(text)


def parse_timestamp(text: str, cast: str | None = None, form: str = SECONDS) -> str:
    """Text of one format (``yyyy-M-d H:m:s`` by default) -> TIMESTAMP_NTZ, else NULL.

    The shape test is needed because the cast alone also takes ``2019``, a bare date, a fraction
    or a zone. Independent of the session's time zone and timestamp type. ``cast`` is the column
    that already holds ``read_timestamp(text, form)``.
    """
    cast = cast or read_timestamp(text, form)
    return (
        f"CASE WHEN {text} RLIKE r'{TIME_FORMATS[form][0]}'"
        f" AND {cast} >= TIMESTAMP_NTZ'{MIN_TIMESTAMP}' AND {cast} <= TIMESTAMP_NTZ'{MAX_TIMESTAMP}'"
        f" THEN {cast} END"
    )


def parse_number(text: str, cast: str | None = None) -> str:
    """Decimal text -> DOUBLE, else NULL.

    ``try_cast`` also takes ``NaN``, Java's ``5d`` / ``5f`` suffixes, hex floats and values that
    overflow to infinity; those count as missing, as does a zero whose exponent is beyond 308.
    Infinity itself must be spelled out. ``cast`` is the column that already holds
    ``try_cast(text AS DOUBLE)``.

    Byte tests settle the usual text; only a number with trailing blanks and the words for
    infinity need a pattern.
    """
    cast = cast or f"try_cast({text} AS DOUBLE)"
    finite = f"abs({cast}) < double('inf')"
    return (
        f"CASE WHEN {cast} = 0 AND {text} RLIKE r'{_ZERO_OUT_OF_RANGE}' THEN NULL"
        f" WHEN {finite} AND substring({text}, -1) IN ({_NUMBER_ENDS})"
        f" AND NOT contains({text}, 'x') AND NOT contains({text}, 'X') THEN {cast}"
        f" WHEN {cast} IS NOT NULL AND {text} RLIKE if({finite}, r'{_PADDED_NUMBER}', r'{_INFINITY_SHAPE}')"
        f" THEN {cast} END"
    )


def null_if_na(text: str) -> str:
    """Text with the usual missing-value tokens turned into NULL."""
    return f"CASE WHEN NOT {text} IN ({_NA_LIST}) THEN {text} END"


def typed(df: DataFrame, formats: Mapping[str, str] | None = None) -> DataFrame:
    """``df`` with its known columns typed where they are still text; others are unchanged.

    ``formats`` names the time format of a column (see ``TIME_FORMATS``).

    Two steps: cast every column once, then keep the casts whose text has the right form. One
    step would repeat each cast, and make generated methods too long for the JIT compiler.
    """
    texts = {f.name for f in df.schema if isinstance(f.dataType, T.StringType)}
    times = [c for c in df.columns if c in texts and c in (PICKUP, DROPOFF)]
    numbers = [c for c in df.columns if c in texts and c in NUMERIC_COLUMNS]
    if not times and not numbers:
        return df
    formats = {c: (formats or {}).get(c, SECONDS) for c in times}
    casts = [f"{read_timestamp(c, formats[c])} AS _cast_{c}" for c in times]
    casts += [f"try_cast({c} AS DOUBLE) AS _cast_{c}" for c in numbers]

    def final(name: str) -> str:
        if name in times:
            return f"{parse_timestamp(name, f'_cast_{name}', formats[name])} AS {name}"
        if name in numbers:
            return f"{parse_number(name, f'_cast_{name}')} AS {name}"
        return ident(name)

    return df.selectExpr("*", *casts).selectExpr(*map(final, df.columns))


def number(df: DataFrame, name: str) -> str:
    """Typed column ``name`` as DOUBLE with NaN as NULL; NULL if the column is absent."""
    if name not in df.columns:
        return "CAST(NULL AS DOUBLE)"
    if isinstance(df.schema[name].dataType, (T.DoubleType, T.FloatType)):
        return f"nanvl(CAST({ident(name)} AS DOUBLE), CAST(NULL AS DOUBLE))"
    return f"CAST({ident(name)} AS DOUBLE)"


def whole_number(df: DataFrame, name: str) -> str:
    """Typed column ``name`` truncated to BIGINT; NULL, NaN, infinity or absence become 0."""
    if name not in df.columns:
        return "0L"
    return f"coalesce(try_cast({ident(name)} AS BIGINT), 0L)"


def year_in_name(name: str) -> str:
    """First ``YYYY`` of a ``YYYY-MM`` in a file name as INT; NULL if there is none."""
    return rf"try_cast(regexp_extract({name}, r'(\d{{4}})-\d{{2}}', 1) AS INT)"


def round2(value: str) -> str:
    """Round to two decimals, ties to even (scale, round to integer, scale back)."""
    return f"rint(({value}) * 100) / 100"


def percent(part: str, whole: str) -> str:
    """Share in percent, unrounded; 0.0 when ``whole`` is 0."""
    return f"coalesce(CAST({part} AS DOUBLE) / nullif({whole}, 0) * 100, 0D)"


def minutes_between(start: str, end: str) -> str:
    """Minutes from ``start`` to ``end`` (TIMESTAMP_NTZ), floored at 0, two decimals, NULL -> 0."""
    minutes = f"greatest(timestampdiff(MICROSECOND, {start}, {end}) / 6e7D, 0D)"
    return f"coalesce({round2(minutes)}, 0D)"
