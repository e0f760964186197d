"""Row rules: annotate every row with the rules it breaks, split and route the rows.

The rule set is generic; a rule is a SQL predicate over the row. ``annotate`` needs one pass and
no shuffle: it keeps the broken rules of a row as bits, and derives the reason text and the folder from
them. Rule i is bit i of ``failed_rules``; from ``MAX_BITS`` rules on further ones follow in ``failed_rules_2`` and so on,
so a bit means the same rule however many rules there are, and rules may share labels and folders.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripstar.functions.coerce import ident, year_in_name
from tripstar.schemas import (
    CLEAN,
    DROPOFF,
    ERROR_FOLDER,
    ERROR_REASON,
    FAILED_RULES,
    MULTIPLE_ERRORS,
    PICKUP,
    SOURCE_FILE,
    TRIP_RULE_NAMES,
)

MAX_BITS = 62  # rules in one BIGINT
REASON_SEPARATOR = "; "


@dataclass(frozen=True)
class Rule:
    """A row breaks the rule where the SQL predicate ``fails`` is true (NULL: not broken)."""

    label: str
    folder: str
    fails: str
    keep: tuple[str, ...] = ()

    @property
    def broken(self) -> str:
        return f"coalesce({self.fails}, false)"


def trip_rules(expected_year: str = f"nullif({year_in_name(SOURCE_FILE)}, 0)") -> list[Rule]:
    """The seven trip rules over typed columns, in reporting order.

    ``expected_year`` is a SQL expression; where it is NULL the year rule is off.
    """
    fails = [
        f"{PICKUP} IS NULL",
        f"{DROPOFF} IS NULL",
        _missing_or_not_positive("fare_amount"),
        _missing_or_not_positive("trip_distance"),
        "passenger_count <= 0",
        f"{DROPOFF} <= {PICKUP}",
        f"year({PICKUP}) != {expected_year}",
    ]
    return [
        Rule(label, folder, test, keep)
        for (label, folder, keep), test in zip(TRIP_RULE_NAMES, fails, strict=True)
    ]


def _missing_or_not_positive(name: str) -> str:
    # NaN compares greater than every number, so it is replaced like NULL.
    return f"nanvl(coalesce({name}, 0D), 0D) <= 0D"


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def words_of(rules: Sequence[Rule]) -> dict[str, list[Rule]]:
    """Column of bits -> the rules that it stands for."""
    if not rules:
        raise ValueError("need one or more rules")
    parts = [list(rules[at : at + MAX_BITS]) for at in range(0, len(rules), MAX_BITS)]
    return {FAILED_RULES if k == 0 else f"{FAILED_RULES}_{k + 1}": part for k, part in enumerate(parts)}


def _bits(rules: Sequence[Rule]) -> str:
    return " + ".join(f"if({rule.broken}, {1 << i}L, 0L)" for i, rule in enumerate(rules))


def failed_bits(rules: Sequence[Rule]) -> list[str]:
    """One BIGINT per word: bit i is set where its rule i is broken; all 0 means clean."""
    return [f"{_bits(part)} AS {word}" for word, part in words_of(rules).items()]


def _labels(rules: Sequence[Rule]) -> str:
    tests = [f"if({word} & {1 << i}L != 0, {_text(r.label)}, NULL)" for word, part in words_of(rules).items() for i, r in enumerate(part)]
    return ", ".join(tests)


def _any(rules: Sequence[Rule]) -> str:
    return " OR ".join(f"{word} != 0" for word in words_of(rules))


def reason_text(rules: Sequence[Rule]) -> str:
    """Labels of the broken rules in rule order; NULL for a clean row."""
    return f"if({_any(rules)}, concat_ws({_text(REASON_SEPARATOR)}, {_labels(rules)}), NULL)"


def folder_name(rules: Sequence[Rule], multiple: str = MULTIPLE_ERRORS) -> str:
    """``clean``, the folder of the only broken rule, or ``multiple``."""
    words = words_of(rules)
    if len(words) == 1:
        single = " ".join(f"WHEN {1 << i}L THEN {_text(r.folder)}" for i, r in enumerate(rules))
        return f"CASE {FAILED_RULES} WHEN 0L THEN {_text(CLEAN)} {single} ELSE {_text(multiple)} END"
    broken = " + ".join(f"bit_count({word})" for word in words)
    single = [f"CASE {word} {' '.join(f'WHEN {1 << i}L THEN {_text(r.folder)}' for i, r in enumerate(part))} END" for word, part in words.items()]
    return f"CASE {broken} WHEN 0 THEN {_text(CLEAN)} WHEN 1 THEN coalesce({', '.join(single)}) ELSE {_text(multiple)} END"


def annotate(df: DataFrame, rules: Sequence[Rule], multiple: str = MULTIPLE_ERRORS) -> DataFrame:
    """Add ``failed_rules`` (and further words, see above), ``error_reason`` and ``error_folder``."""
    return df.selectExpr("*", *failed_bits(rules)).selectExpr(
        "*",
        f"{reason_text(rules)} AS {ERROR_REASON}",
        f"{folder_name(rules, multiple)} AS {ERROR_FOLDER}",
    )


def error_reasons(rules: Sequence[Rule]) -> str:
    """The broken rules' labels of an annotated row as ARRAY<STRING> (empty if clean)."""
    return f"array_compact(array({_labels(rules)}))"


def rule_flags(rules: Sequence[Rule]) -> list[str]:
    """One non-NULL boolean per rule, named after its folder."""
    return [f"{rule.broken} AS {ident(rule.folder)}" for rule in rules]


def is_clean(rules: Sequence[Rule]) -> str:
    """True where no rule is broken; never NULL, so its negation is the exact complement."""
    return " AND ".join(f"NOT {rule.broken}" for rule in rules)


def clean_rows(df: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """Rows that break no rule, with the columns of ``df``."""
    return df.where(is_clean(rules))


def kept_columns(rules: Sequence[Rule], multiple: str = MULTIPLE_ERRORS) -> dict[str, list[str]]:
    """Folder -> columns kept besides ``source_file`` and ``error_reason``."""
    kept = {rule.folder: list(rule.keep) for rule in rules}
    kept[multiple] = list(dict.fromkeys(c for rule in rules for c in rule.keep))
    return kept


def quarantine_columns(
    annotated: DataFrame, rules: Sequence[Rule], multiple: str = MULTIPLE_ERRORS
) -> DataFrame:
    """Annotated broken rows as one narrow table for all folders.

    A column is NULL where the row's folder drops it. Rows that break several rules keep all.
    """
    words, columns = words_of(rules), []
    broken = " + ".join(f"bit_count({word})" for word in words)
    several = f"{broken} > 1" if len(words) > 1 else f"{FAILED_RULES} & ({FAILED_RULES} - 1) != 0"
    keeping = [f"if({several}, {(1 << len(part)) - 1}L, {word}) AS _keep_{word}" for word, part in words.items()]
    for name in kept_columns(rules, multiple)[multiple]:
        if name in annotated.columns:
            masks = {word: sum(1 << i for i, rule in enumerate(part) if name in rule.keep) for word, part in words.items()}
            kept = " OR ".join(f"_keep_{word} & {mask}L != 0" for word, mask in masks.items() if mask)
            columns.append(f"if({kept}, {ident(name)}, NULL) AS {ident(name)}")
    return annotated.selectExpr("*", *keeping).selectExpr(SOURCE_FILE, ERROR_REASON, ERROR_FOLDER, *columns)


def quarantine_rows(
    df: DataFrame, rules: Sequence[Rule], multiple: str = MULTIPLE_ERRORS
) -> DataFrame:
    """Rows that break a rule, annotated and narrowed to what the quarantine keeps."""
    broken = df.where(f"NOT ({is_clean(rules)})")
    return quarantine_columns(annotate(broken, rules, multiple), rules, multiple)


def folder_rows(
    df: DataFrame, folder: str, rules: Sequence[Rule], multiple: str = MULTIPLE_ERRORS
) -> DataFrame:
    """``quarantine_folder`` of rows not yet annotated.

    The rows are selected by the rules themselves: a filter on the derived folder name would
    repeat the rules once per folder when Catalyst pushes it down.
    """
    if folder == multiple:
        wanted = " + ".join(f"if({rule.broken}, 1, 0)" for rule in rules) + " > 1"
    else:
        wanted = " AND ".join(
            rule.broken if rule.folder == folder else f"NOT {rule.broken}" for rule in rules
        )
    narrow = quarantine_columns(annotate(df.where(wanted), rules, multiple), rules, multiple)
    names = [c for c in kept_columns(rules, multiple)[folder] if c in narrow.columns]
    return narrow.selectExpr(SOURCE_FILE, ERROR_REASON, *map(ident, names))


def quarantine_folder(
    quarantine: DataFrame, folder: str, rules: Sequence[Rule], multiple: str = MULTIPLE_ERRORS
) -> DataFrame:
    """One folder's rows of a stored quarantine, with only the columns that folder keeps."""
    names = [c for c in kept_columns(rules, multiple)[folder] if c in quarantine.columns]
    return quarantine.where(F.col(ERROR_FOLDER) == folder).selectExpr(
        SOURCE_FILE, ERROR_REASON, *map(ident, names)
    )


def route_counts(
    df: DataFrame, rules: Sequence[Rule], multiple: str = MULTIPLE_ERRORS
) -> DataFrame:
    """Rows per folder, clean included; counted per bit pattern before anything is shuffled."""
    words = list(words_of(rules))
    counts = df.selectExpr(*failed_bits(rules)).groupBy(*words).agg(F.count(F.lit(1)).alias("n"))
    folders = counts.selectExpr(f"{folder_name(rules, multiple)} AS {ERROR_FOLDER}", "n")
    return folders.groupBy(ERROR_FOLDER).agg(F.sum("n").alias("trips"))
