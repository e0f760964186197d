"""Removal of long repeated byte strings with hash-compared suffix sorting.

Two suffixes are compared by the length of their common extension, found by binary search over prefix
polynomial hashes, so a comparison takes a logarithmic number of hash lookups; a mergesort over such
comparisons gives the suffix array, and neighbours that share ``length`` bytes are verified byte by byte.

To sort the suffixes of a corpus in Spark, they are first dealt out so that equal strings meet: the
anchor of a window of ``length`` bytes is its substring of ANCHOR bytes with the smallest hash, so equal
windows have equal anchors at equal offsets. The consecutive windows of one anchor form one context.

1. Each task finds the contexts of its documents. Of equal contexts it hands on only the first; all
   windows of the others are repeats at once. So a very frequent passage leaves one row per task.
2. Rows meet by anchor. Equal contexts (two independent hashes) are one class with a first occurrence.
3. Anchors with more than HOT_CLASSES classes (the edges of a passage that stands after different texts)
   are dealt further by the hash of each single window, again combined in each task. Only windows whose
   hashes (two, independent) occur again go on, each as a class of its own.
4. Anchors with several classes: the bytes of each class are fetched, and its suffixes are sorted
   with the others of the same anchor and offset. Of equal windows the first occurrence stays.
5. Each document merges its repeats.

Defined cases: NULL text is empty; rows with NULL doc_id take no part and lose nothing; rows of one
doc_id share their repeats; texts shorter than ``length`` lose nothing; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripstar.llm.tables import stored
from tripstar.llm.text import OTHER_VALUES, U64, VALUES, PrefixHash, blocks, list_array, mix64, ranges

LENGTH = 100
ANCHOR = 32
TASK_BYTES = 32 << 20  # texts whose contexts are combined before they are handed on
CHUNK_ROWS = 1 << 17
HOT_CLASSES = CHUNK_ROWS >> 6  # of one anchor, sorted in one table; those of an anchor with more are dealt by windows

OCCURRENCES = "doc_id bigint, start bigint, offset bigint, windows bigint, anchor bigint, context bigint"
FOUND = "doc_id bigint, start bigint, stop bigint, anchor bigint, offset bigint, windows bigint, hot boolean"


class Suffixes:
    """Suffixes of a byte array, compared through prefix hashes."""

    def __init__(self, data: np.ndarray):
        self.data = data
        self._hash = PrefixHash(data, VALUES)

    def common(self, a: np.ndarray, b: np.ndarray, limit: np.ndarray) -> np.ndarray:
        """Length of the common extension of each pair of suffixes, up to limit."""
        low, high = np.zeros_like(limit), limit.copy()
        while (low < high).any():
            middle = (low + high + 1) >> 1
            same = self._hash.raw(a, a + middle) == self._hash.raw(b, b + middle)
            low, high = np.where(same, middle, low), np.where(same, high, middle - 1)
        return low

    def compare(self, a: np.ndarray, b: np.ndarray, limit: int) -> np.ndarray:
        """-1, 0 or 1 by the first ``limit`` bytes; the end of the data comes before any byte."""
        size = len(self.data)
        reach = np.minimum(np.minimum(size - a, size - b), limit)
        at = self.common(a, b, reach)
        first = np.where(a + at < size, self.data[np.minimum(a + at, size - 1)].astype(np.int16), -1)
        second = np.where(b + at < size, self.data[np.minimum(b + at, size - 1)].astype(np.int16), -1)
        return np.where(at >= limit, 0, np.sign(first - second))

    def sorted(self, starts: np.ndarray, sizes: np.ndarray, limit: int) -> np.ndarray:
        """Order of the suffixes within each group of consecutive starts; a mergesort over all groups at once."""
        order = np.arange(len(starts))
        begin = np.repeat(np.cumsum(sizes) - sizes, sizes)
        end = begin + np.repeat(sizes, sizes)
        local = order - begin
        width = 1
        while width < sizes.max(initial=0):
            run = local // width
            other = begin + (run ^ 1) * width
            low, high = np.minimum(other, end), np.minimum(other + width, end)
            base = low.copy()
            open_ = np.flatnonzero(low < high)
            while len(open_):  # rank of each suffix in the run that it is merged with
                middle = (low[open_] + high[open_]) >> 1
                sign = self.compare(starts[order[middle]], starts[order[open_]], limit)
                ahead = np.where(run[open_] & 1 == 0, sign < 0, sign <= 0)
                low[open_] = np.where(ahead, middle + 1, low[open_])
                high[open_] = np.where(ahead, high[open_], middle)
                open_ = open_[low[open_] < high[open_]]
            merged = np.empty_like(order)
            merged[begin + (run >> 1) * 2 * width + local % width + low - base] = order
            order = merged
            width *= 2
        return order


def suffix_array(data: bytes) -> np.ndarray:
    """Suffix array of one text."""
    text = np.frombuffer(data, np.uint8)
    return Suffixes(text).sorted(np.arange(len(text)), np.array([len(text)]), max(1, len(text)))


def contexts(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int):
    """The contexts of a block: text, first window, offset of the anchor in it, windows, anchor hash, context hash."""
    n_windows = np.maximum(ends - starts - length + 1, 0)
    if not n_windows.any():
        return None
    grams = np.arange(len(data) - ANCHOR + 1)
    anchor_hash = PrefixHash(data, VALUES).of(grams, grams + ANCHOR)
    bits = U64(int(len(data)).bit_length())
    least = (anchor_hash >> bits << bits) | grams.astype(U64)  # ties go to the leftmost
    width, reach = length - ANCHOR + 1, 1
    while reach * 2 <= width:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    if reach < width:
        least = np.minimum(least[: len(least) - (width - reach)], least[width - reach :])
    at = ranges(starts, n_windows)
    text = np.repeat(np.arange(len(starts)), n_windows)
    anchor = (least[at] & ((U64(1) << bits) - U64(1))).astype(np.int64)
    new = np.flatnonzero(np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1]))))
    count = np.diff(np.append(new, len(at)))
    first, anchor = at[new], anchor[new]
    offset = anchor - first
    context = PrefixHash(data, OTHER_VALUES).of(first, first + count + length - 1)
    return text[new], first, offset, count, anchor_hash[anchor], mix64(context ^ (offset * 256 + count).astype(U64))


def _rows(**columns: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(v) for v in columns.values()], names=list(columns))


def _found(doc, start, stop, anchor=None, offset=None, windows=None, hot=False) -> pa.RecordBatch:
    zeros = np.zeros(len(doc), np.int64)
    anchor, offset, windows = (zeros if x is None else x for x in (anchor, offset, windows))
    return _rows(doc_id=doc, start=start, stop=stop, anchor=anchor, offset=offset, windows=windows, hot=np.full(len(doc), hot))


def _combined(parts: list[tuple], length: int) -> Iterator[pa.RecordBatch]:
    """OCCURRENCES rows of (doc, start, offset, windows, anchor, context): the first of each context, and repeats (windows 0)."""
    doc, start, offset, count, anchor, context = (np.concatenate(c) for c in zip(*parts, strict=True))
    order = np.lexsort((start, doc)) if (doc[1:] < doc[:-1]).any() else np.arange(len(doc))
    order = order[np.argsort(mix64(anchor ^ mix64(context))[order], kind="stable")]
    doc, start, offset, count, anchor, context = (c[order] for c in (doc, start, offset, count, anchor, context))
    new = np.concatenate(([True], (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])))
    lead = np.flatnonzero(new)[np.cumsum(new) - 1]
    again = (doc != doc[lead]) | (start != start[lead])  # a row given twice repeats nothing
    kept = new | ~again
    yield _rows(doc_id=doc[kept], start=start[kept], offset=offset[kept], windows=count[kept], anchor=anchor[kept].view(np.int64), context=context[kept].view(np.int64))
    a, b, c = merged(doc[again], start[again], start[again] + count[again] + length - 1)
    yield _rows(doc_id=a, start=b, offset=c, windows=np.zeros_like(a), anchor=mix64(a.astype(U64)).view(np.int64), context=np.zeros_like(a))


def _first_occurrences(docs: DataFrame, length: int) -> DataFrame:
    """Rows with windows > 0: the first occurrence in the task of each context. Rows with windows 0: repeats [start, stop)."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for part, block in blocks(batch):
                found = contexts(block.data, block.starts, block.ends, length)
                size += len(block.data)
                if found is not None:
                    text, first, *rest = found
                    parts.append((part.column("doc_id").to_numpy()[text], first - block.starts[text], *rest))
                if size >= TASK_BYTES and parts:
                    yield from _combined(parts, length)
                    parts, size = [], 0
        if parts:
            yield from _combined(parts, length)

    return docs.where("doc_id IS NOT NULL").mapInArrow(emit, OCCURRENCES)


def merged(doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching stretches of each document joined."""
    if not len(doc):
        return doc, start, stop
    order = np.lexsort((start, doc))
    doc, start, stop = doc[order], start[order], stop[order]
    edge = np.flatnonzero(np.concatenate(([True], doc[1:] != doc[:-1])))
    rank = np.repeat(np.arange(len(edge)), np.diff(np.append(edge, len(doc))))
    far = int(stop.max()) + 1
    reach = np.maximum.accumulate(stop + rank * far) - rank * far  # furthest end so far in the document
    new = np.flatnonzero(np.concatenate(([True], (doc[1:] != doc[:-1]) | (start[1:] > reach[:-1]))))
    return doc[new], start[new], np.maximum.reduceat(reach, new)


def _whole_groups(batches: Iterator[pa.RecordBatch], key: str, least: int) -> Iterator[pa.Table]:
    """Rows that come ordered by key, in tables of at least so many rows that never split a key."""
    held, size = [], 0
    for batch in batches:
        if not batch.num_rows:
            continue
        held.append(batch)
        size += batch.num_rows
        if size >= least:
            table = pa.Table.from_batches(held)
            keys = table.column(key).to_numpy()
            cut = int(np.searchsorted(keys, keys[-1]))
            if cut:
                yield table.slice(0, cut)
            held, size = table.slice(cut).combine_chunks().to_batches(), size - cut
    if held:
        yield pa.Table.from_batches(held)


def _classes(occurrences: DataFrame, length: int) -> DataFrame:
    """FOUND rows: repeats (windows 0), and first occurrences of classes that share their anchor with others."""

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        # carried: the classes of the last anchor while they are few, else the last class (the others are handed on)
        carried, carried_hot = [np.zeros(0, np.int64)] * 6, False
        names = [c.split()[0] for c in OCCURRENCES.split(", ")]
        for batch in batches:
            columns = [batch.column(c).to_numpy() for c in names]
            done = columns[3] == 0
            yield _found(*(columns[k][done] for k in (0, 1, 2)))
            columns = [np.concatenate([x, c[~done]]) for x, c in zip(carried, columns, strict=True)]
            doc, start, offset, windows, anchor, context = columns
            if not len(doc):
                continue
            new_anchor = np.concatenate(([True], anchor[1:] != anchor[:-1]))
            new = new_anchor | np.concatenate(([True], context[1:] != context[:-1]))
            lead = np.flatnonzero(new)[np.cumsum(new) - 1]
            again = (doc != doc[lead]) | (start != start[lead])
            yield _found(doc[again], start[again], (start + windows + length - 1)[again])
            group = np.cumsum(new_anchor) - 1
            count = np.bincount(group, weights=new)
            hot = count > HOT_CLASSES
            hot[0] |= carried_hot
            ends = group == group[-1]
            few = new & ~hot[group] & (count[group] > 1) & ~ends
            many = new & hot[group]
            many[0] &= not carried_hot
            for mine, kind in ((few, False), (many, True)):
                yield _found(*(c[mine] for c in (doc, start, start + windows + length - 1, anchor, offset, windows)), kind)
            carried_hot = bool(hot[-1])
            kept = np.flatnonzero(new & ends)[-1:] if carried_hot else np.flatnonzero(new & ends)
            carried = [c[kept] for c in columns]
        if len(carried[0]) > 1:
            doc, start, offset, windows, anchor, _ = carried
            yield _found(doc, start, start + windows + length - 1, anchor, offset, windows)

    return occurrences.repartition("anchor").sortWithinPartitions("anchor", "context", "doc_id", "start").mapInArrow(judge, FOUND)


def _window_classes(classes: DataFrame, length: int) -> DataFrame:
    """FOUND rows of classes with their bytes: repeats within a task (windows 0), and windows that occur again elsewhere."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            doc, start, windows = (batch.column(c).to_numpy() for c in ("doc_id", "start", "windows"))
            if not len(doc):
                continue
            data = np.frombuffer(b"".join(batch.column("bytes").to_pylist()), np.uint8)
            at = ranges(np.cumsum(windows + length - 1) - (windows + length - 1), windows)
            hashes = [PrefixHash(data, values).of(at, at + length) for values in (VALUES, OTHER_VALUES)]
            parts.append((np.repeat(doc, windows), ranges(start, windows), np.zeros_like(at), np.ones_like(at), *hashes))
            size += len(data)
            if size >= TASK_BYTES >> 3:
                yield from _combined(parts, length)
                parts, size = [], 0
        if parts:
            yield from _combined(parts, length)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, "anchor", CHUNK_ROWS):
            doc, start, stop, windows, anchor, context = (table.column(c).to_numpy() for c in ("doc_id", "start", "offset", "windows", "anchor", "context"))
            done = windows == 0
            yield _found(doc[done], start[done], stop[done])
            doc, start, anchor, context = (c[~done] for c in (doc, start, anchor, context))
            if not len(doc):
                continue
            same = (anchor[1:] == anchor[:-1]) & (context[1:] == context[:-1])
            both = np.concatenate(([False], same)) | np.concatenate((same, [False]))
            doc, start, anchor = doc[both], start[both], anchor[both]
            yield _found(doc, start, start + length, anchor, np.zeros_like(doc), np.ones_like(doc))

    occurrences = classes.mapInArrow(emit, OCCURRENCES)
    return occurrences.repartition("anchor").sortWithinPartitions("anchor", "context", "doc_id", "start").mapInArrow(meet, FOUND)


def _with_bytes(docs: DataFrame, classes: DataFrame) -> DataFrame:
    """The bytes of each class, cut from its document."""
    wanted = classes.groupBy("doc_id").agg(F.collect_list(F.struct("anchor", "start", "stop", "offset", "windows")).alias("wanted"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch):
                lists = part.column("wanted")
                row = np.repeat(np.arange(block.size), lists.value_lengths().to_numpy(zero_copy_only=False))
                anchor, start, stop, offset, windows = (x.to_numpy(zero_copy_only=False) for x in lists.flatten().flatten())
                inside = start + block.starts[row] + (stop - start) <= block.ends[row]  # another row of the same doc_id may be shorter
                row, anchor, start, stop, offset, windows = (x[inside] for x in (row, anchor, start, stop, offset, windows))
                data = block.data[ranges(block.starts[row] + start, stop - start)]
                at = np.concatenate(([0], np.cumsum(stop - start))).astype(np.int32)
                text = pa.Array.from_buffers(pa.binary(), len(row), [None, pa.py_buffer(at), pa.py_buffer(data.tobytes())])
                rest = _rows(doc_id=part.column("doc_id").to_numpy()[row], start=start, anchor=anchor, offset=offset, windows=windows)
                yield pa.RecordBatch.from_arrays([*rest.columns, text], names=[*rest.schema.names, "bytes"])

    return docs.join(wanted, "doc_id").select("doc_id", "text", "wanted").mapInArrow(cut, "doc_id bigint, start bigint, anchor bigint, offset bigint, windows bigint, bytes binary")


def _sorted_repeats(classes: DataFrame, length: int) -> DataFrame:
    """FOUND rows of windows of a class that equal windows of a class that occurs earlier."""

    def repeats(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_groups(batches, "anchor", CHUNK_ROWS >> 5):
            doc, start, anchor, offset, windows = (table.column(c).to_numpy() for c in ("doc_id", "start", "anchor", "offset", "windows"))
            joined = b"".join(table.column("bytes").to_pylist())
            suffixes = Suffixes(np.frombuffer(joined, np.uint8))
            base = np.cumsum(windows + length - 1) - (windows + length - 1)
            owner = np.repeat(np.arange(len(doc)), windows)
            shift = ranges(np.zeros(len(doc), np.int64), windows)  # window within its class
            group = np.cumsum(np.concatenate(([0], anchor[1:] != anchor[:-1])))[owner] * 256 + (offset[owner] - shift)
            order = np.lexsort((start[owner] + shift, doc[owner], group))
            owner, shift, group = owner[order], shift[order], group[order]
            _, sizes = np.unique(group, return_counts=True)
            more = np.repeat(sizes > 1, sizes)
            owner, shift, group = owner[more], shift[more], group[more]
            if not len(owner):
                continue
            sizes = sizes[sizes > 1]
            place = base[owner] + shift
            order = suffixes.sorted(place, sizes, length)
            place, owner, shift, group = place[order], owner[order], shift[order], group[order]
            near = np.flatnonzero((group[1:] == group[:-1]) & (suffixes.common(place[:-1], place[1:], np.full(len(place) - 1, length)) == length))
            verified = [k for k in np.array_split(near, 1 + len(near) // CHUNK_ROWS) if len(k)]
            equal = np.zeros(len(place), bool)
            for k in verified:
                step = np.arange(length)
                equal[k + 1] = (suffixes.data[place[k][:, None] + step] == suffixes.data[place[k + 1][:, None] + step]).all(1)
            # the sort is stable and began in order of occurrence, so the first of equal windows is the earliest;
            # a window that a row given twice brings again is the same occurrence
            lead = np.flatnonzero(~equal)[np.cumsum(~equal) - 1]
            equal &= (doc[owner] != doc[owner[lead]]) | (start[owner] + shift != start[owner[lead]] + shift[lead])
            a, b, c = merged(owner[equal], shift[equal], shift[equal] + 1)
            yield _found(doc[a], start[a] + b, start[a] + c + length - 1)

    return classes.repartition("anchor").sortWithinPartitions("anchor").mapInArrow(repeats, FOUND)


def remove_repeats(docs: DataFrame, length: int = LENGTH, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, kept (the bytes left), n_bytes, spans (starts and stops of the removed runs, in turn) of each row of docs.

    Removed is each byte covered by a string of ``length`` bytes (at least 34) that also starts earlier, in an earlier
    document or the same.
    """
    if not ANCHOR + 2 <= length <= ANCHOR + 200:
        raise ValueError(f"length must lie between {ANCHOR + 2} and {ANCHOR + 200}")
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    found = stored(_classes(_first_occurrences(docs, length), length))
    if found.where("hot").head(1):
        dealt = stored(_window_classes(_with_bytes(docs, found.where("hot")), length))
        found = found.where("NOT hot").unionByName(dealt)
    late = stored(_sorted_repeats(_with_bytes(docs, found.where("windows > 0")), length))
    spans = found.where("windows = 0").unionByName(late).groupBy("doc_id").agg(F.collect_list(F.struct("start", "stop")).alias("spans"))

    def remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch):
                lists = part.column("spans")
                row = np.repeat(np.arange(block.size), lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))
                start, stop = (x.to_numpy(zero_copy_only=False).astype(np.int64) for x in lists.flatten().flatten())
                size = block.ends - block.starts
                start, stop = np.minimum(start, size[row]), np.minimum(stop, size[row])
                row, start, stop = (x[start < stop] for x in (row, start, stop))
                row, start, stop = merged(row, start, stop)
                keep = np.ones(len(block.data), bool)
                keep[ranges(block.starts[row] + start, stop - start)] = False
                left, at = block.data[keep].tobytes(), np.concatenate(([0], np.cumsum(keep)))
                kept = [left[a:b] for a, b in zip(at[block.starts], at[block.ends], strict=True)]
                runs = list_array(np.stack([start, stop], 1).ravel(), np.bincount(row, minlength=block.size) * 2, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(kept, pa.binary()), pa.array(size), runs], names=["doc_id", "kept", "n_bytes", "spans"])

    return docs.join(spans, "doc_id", "left").mapInArrow(remove, "doc_id bigint, kept binary, n_bytes bigint, spans array<bigint>")
