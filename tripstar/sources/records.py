"""Records of delimited text whose quoted fields may hold line breaks, read in splits.

A line is a function of whether it begins inside quotes: it ends inside or outside them. Two pattern tests tell
both ends of a line, a run of lines composes them, and so does a run of splits. One pass over the
flags gives each split its function, which are composed in file order; the second pass then knows where every
split begins, keeps records that end in their own line as they are, joins those that do not, and hands the
pieces that cross splits (two for each split at most) to a small shuffle. No file is read in one piece.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

# Possessive groups, so that a long field needs no stack. After its closing quote a field is plain text up to the comma.
_QUOTED = r'"(?:[^"]++|"")*+'
_FIELD = rf'(?:{_QUOTED}"[^,]*+|[^",][^,]*+|)'
_OPEN_LINE = rf"^(?:{_FIELD},)*+{_QUOTED}$"
_OPEN_TEXT = re.compile(_OPEN_LINE[:-1] + r"\Z")
COMPLETE_QUOTED = rf'(^|,){_QUOTED}"'

PATH, BLOCK, VALUE = "_path", "_block", "value"
_WHOLE, _STARTS, _THROUGH, _ENDS = range(4)
_FLAGS = "_path string, _block bigint, outside boolean, inside boolean"


def opens(line: str) -> str:
    """SQL: a line that begins outside quotes ends inside them."""
    return f"(contains({line}, '\"') AND {line} RLIKE r'{_OPEN_LINE}')"


def ends_open(text: str) -> bool:
    """Whether text that begins outside quotes ends inside them."""
    return '"' in text and _OPEN_TEXT.match(text) is not None


def is_blank(line: str) -> str:
    """SQL: a line that readers skip."""
    return f"trim(LEADING ' \\t' FROM {line}) = ''"


def text_lines(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """``_path``, ``_block`` (start of the split) and ``value`` of every line, in file order within a split."""
    lines = spark.read.text(list(paths))
    return lines.select(F.col("_metadata.file_path").alias(PATH), F.col("_metadata.file_block_start").alias(BLOCK), VALUE)


def line_ends(lines: DataFrame) -> DataFrame:
    """``outside`` and ``inside``: whether a line ends inside quotes, having begun outside or inside them."""
    inside = f"(NOT contains({VALUE}, '\"') OR concat('\"', {VALUE}) RLIKE r'{_OPEN_LINE}')"
    return lines.selectExpr(PATH, BLOCK, VALUE, f"{opens(VALUE)} AS outside", f"{inside} AS inside")


def ends_inside(outside: np.ndarray, inside: np.ndarray, begins: bool) -> np.ndarray:
    """For each line of a run whether it ends inside quotes."""
    at = np.arange(len(outside))
    fixed = np.maximum.accumulate(np.where(outside == inside, at, -1))  # the last line with the same end either way
    turns = np.concatenate(([0], np.cumsum(outside & ~inside)))
    start = np.where(fixed >= 0, outside[fixed], begins)
    return start ^ ((turns[at + 1] - turns[fixed + 1]) % 2 == 1)


def _flags(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    return tuple(batch.column(c).to_numpy(zero_copy_only=False) for c in ("outside", "inside"))


def runs(batch: pa.RecordBatch) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Consecutive lines of one split."""
    if not batch.num_rows:
        return
    paths, blocks = batch.column(PATH).dictionary_encode(), batch.column(BLOCK).to_numpy()
    codes = paths.indices.to_numpy()
    edges = np.flatnonzero((np.diff(codes) != 0) | (np.diff(blocks) != 0)) + 1
    for a, b in zip([0, *edges], [*edges, batch.num_rows]):
        yield (paths.dictionary[int(codes[a])].as_py(), int(blocks[a])), batch.slice(a, b - a)


def split_ends(lines: DataFrame) -> DataFrame:
    """``_path``, ``_block``, ``outside``, ``inside``: the function of each split; needs ``line_ends``."""

    def compose(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[tuple[str, int], tuple[bool, bool]] = {}
        for batch in batches:
            for split, run in runs(batch):
                now = found.get(split, (False, True))
                found[split] = tuple(bool(ends_inside(*_flags(run), begins)[-1]) for begins in now)
        rows = [(*split, *ends) for split, ends in found.items()]
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*rows) if rows else [[]] * 4, (pa.string(), pa.int64(), pa.bool_(), pa.bool_()))],
            names=[PATH, BLOCK, "outside", "inside"],
        )

    return lines.select(PATH, BLOCK, "outside", "inside").mapInArrow(compose, _FLAGS)


def split_starts(ends: DataFrame) -> DataFrame:
    """``_path``, ``starts`` (array of block and whether it begins inside quotes) and ``unterminated``, one row for each file."""
    splits = F.array_sort(F.collect_list(F.struct(BLOCK, "outside", "inside"))).alias("splits")
    step = """aggregate(splits, named_struct('now', false, 'starts', CAST(array() AS array<struct<_block: bigint, begins: boolean>>)),
        (s, x) -> named_struct('now', if(s.now, x.inside, x.outside),
                               'starts', concat(s.starts, array(named_struct('_block', x._block, 'begins', s.now)))))"""
    folded = ends.groupBy(PATH).agg(splits).selectExpr(PATH, f"{step} AS done")
    return folded.selectExpr(PATH, "done.starts", "done.now AS unterminated")


def split_records(lines: DataFrame, inside_splits: set[tuple[str, int]]) -> DataFrame:
    """``_path``, ``_block``, ``kind``, ``value``: whole records without the header, and the pieces of records that cross splits.

    ``inside_splits`` are those that begin inside quotes; needs ``line_ends``.
    """

    def assemble(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, begins, pending, first, kind = None, False, [], False, _STARTS
        out: list[tuple[str, int, int, str]] = []

        def close(ended: bool):
            """The open record, if any: whole, or a piece of one that crosses splits."""
            nonlocal first
            if pending:
                whole = ended and kind == _STARTS
                label = _WHOLE if whole else (_ENDS if ended else kind)
                if not (whole and first):
                    # a header that crosses splits is told by its NULL value
                    out.append((*now, label, None if first and label == _STARTS else "\n".join(pending)))
                first = False
                pending.clear()

        for batch in batches:
            for split, run in runs(batch):
                if split != now:
                    close(False)
                    now, first = split, split[1] == 0
                    begins = split in inside_splits
                    kind = _THROUGH if begins else _STARTS
                ends = ends_inside(*_flags(run), begins)
                starts = np.concatenate(([begins], ends[:-1]))
                begins = bool(ends[-1])
                values = run.column(VALUE)
                plain = ~starts & ~ends
                if first and plain[0]:
                    plain[0], first = False, False
                if plain.any():
                    kept = values.filter(pa.array(plain))
                    kept = kept.filter(pc.not_equal(pc.utf8_length(pc.utf8_trim(kept, " \t")), 0))
                    n = len(kept)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([now[0]] * n, pa.string()), pa.array(np.full(n, now[1], np.int64)), pa.array(np.full(n, _WHOLE, np.int32)), kept],
                        names=[PATH, BLOCK, "kind", VALUE],
                    )
                for at in np.flatnonzero(starts | ends):
                    if not starts[at]:
                        kind = _STARTS
                    pending.append(values[int(at)].as_py())
                    if not ends[at]:
                        close(True)
                        kind = _STARTS
        close(False)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, (pa.string(), pa.int64(), pa.int32(), pa.string()))],
            names=[PATH, BLOCK, "kind", VALUE],
        )

    columns = (PATH, BLOCK, VALUE, "outside", "inside")
    return lines.select(*columns).mapInArrow(assemble, f"{PATH} string, {BLOCK} bigint, kind int, {VALUE} string")


def joined_pieces(pieces: DataFrame) -> DataFrame:
    """``_path``, ``value`` of the records that cross splits; one task sees a few pieces of a file, never its lines."""
    late: Column = (F.col("kind") == _STARTS).cast("int")  # a split's last piece starts a record
    order = Window.partitionBy(PATH).orderBy(BLOCK, "late")
    numbered = pieces.withColumn("late", late).withColumn("record", F.sum("late").over(order))
    parts = F.array_sort(F.collect_list(F.struct(BLOCK, "late", VALUE)))
    whole = numbered.groupBy(PATH, "record").agg(parts.alias("parts"))
    return whole.where(~F.exists("parts", lambda p: p[VALUE].isNull())).select(
        PATH, F.array_join(F.col(f"parts.{VALUE}"), "\n").alias(VALUE)
    )


def read_records(spark: SparkSession, paths: Sequence[str], folder: str) -> tuple[DataFrame | None, list[str]]:
    """``_path``, ``value`` of every record but the header, and the paths of files that end inside quotes (left out).

    The records are stored below ``folder``. The driver sees the splits that begin inside quotes.
    """
    lines = line_ends(text_lines(spark, paths))
    split_starts(split_ends(lines)).write.mode("overwrite").parquet(f"{folder}/splits")
    splits = spark.read.parquet(f"{folder}/splits")
    broken = [row[PATH] for row in splits.where("unterminated").select(PATH).collect()]
    begun = splits.selectExpr(PATH, "inline(starts)").where("begins").select(PATH, BLOCK)
    good = lines.where(~F.col(PATH).isin(broken)) if broken else lines
    split_records(good, {tuple(row) for row in begun.collect()}).write.mode("overwrite").parquet(f"{folder}/pieces")
    stored = spark.read.schema(f"{PATH} string, {BLOCK} bigint, kind int, {VALUE} string").parquet(f"{folder}/pieces")
    whole = stored.where(F.col("kind") == _WHOLE).select(PATH, VALUE)
    return whole.unionByName(joined_pieces(stored.where(F.col("kind") != _WHOLE))), broken
