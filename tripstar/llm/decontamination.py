"""Benchmark decontamination with a positional inverted index.

``build_index`` turns each block of training documents into one shard: for every indexed term the
ascending list of its positions, stored as a table. A search takes the terms of a phrase from the
rarest in the shard to the commonest and intersects their position lists, each shifted by the term's
offset in the phrase; with ``slack`` a term may stand that many positions off (proximity).

Shards are cut by documents, so building needs no shuffle, a document lies in one shard, and matches
never cross documents: positions of neighbouring documents are kept apart by a gap.

Defined cases: NULL or empty text has no words and no hits; an item without words has no window; rows
with NULL doc_id or repeated rows are each judged by themselves; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripstar.llm.tables import stored
from tripstar.llm.text import ALPHANUMERIC, Block, blocks, list_array, ranges

WINDOW = 10
GAP = 1 << 12  # positions left free between documents; above any window plus slack
ITEM_BYTES = 32 << 20  # largest test set that is sent to the workers

INDEX_SCHEMA = "doc_ids array<bigint>, n_words array<bigint>, terms array<bigint>, counts array<bigint>, positions binary"


def _long(hashes: np.ndarray) -> np.ndarray:
    return hashes.view(np.int64)


def build_index(docs: DataFrame, vocabulary: np.ndarray | None = None, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The shards of the positional index, stored.

    ``vocabulary``: sorted term hashes; tokens of other terms keep their position but get no posting,
    as no phrase made of the vocabulary can use them. None indexes every term.
    """
    shared = None if vocabulary is None else docs.sparkSession.sparkContext.broadcast(vocabulary)

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch):
                hashes, first = block.word_hashes(ALPHANUMERIC)
                terms = _long(hashes)
                counts = np.diff(first)
                place = np.arange(len(terms)) + np.repeat(np.arange(block.size) * GAP, counts)
                if shared is not None:
                    at = np.searchsorted(shared.value, terms)
                    known = np.flatnonzero(shared.value[np.minimum(at, len(shared.value) - 1)] == terms) if len(shared.value) else np.zeros(0, int)
                    terms, place = terms[known], place[known]
                order = np.argsort(terms, kind="stable")
                own, sizes = np.unique(terms[order], return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [
                        list_array_of(part.column(0)),
                        one_list(counts),
                        one_list(own),
                        one_list(sizes),
                        pa.array([place[order].astype(np.int64).tobytes()], pa.binary()),
                    ],
                    names=["doc_ids", "n_words", "terms", "counts", "positions"],
                )

    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return stored(narrow.mapInArrow(shards, INDEX_SCHEMA))


def one_list(values: np.ndarray) -> pa.ListArray:
    return list_array(values.astype(np.int64), np.array([len(values)]), pa.int64())


def list_array_of(column: pa.Array) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array([0, len(column)], pa.int32()), column.cast(pa.int64()))


def has_near(positions: np.ndarray, low: np.ndarray, high: np.ndarray, wanted: np.ndarray, slack: int) -> np.ndarray:
    """Is there a position within slack of each wanted one in the ascending stretch [low, high)?

    A binary search for all candidates at once, each in the list of its own term.
    """
    low, end, wanted = low.copy(), high.copy(), wanted - slack
    while True:
        open_ = low < end
        if not open_.any():
            break
        middle = (low + end) >> 1
        less = open_ & (positions[np.minimum(middle, len(positions) - 1)] < wanted)
        low = np.where(less, middle + 1, low)
        end = np.where(open_ & ~less, middle, end)
    return (low < high) & (positions[np.minimum(low, len(positions) - 1)] <= wanted + 2 * slack)


def search_shard(terms: np.ndarray, counts: np.ndarray, positions: np.ndarray, phrases: np.ndarray, slack: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """(phrase, start) of all places where the phrase stands; phrases are rows of term hashes."""
    none = np.zeros(0, np.int64), np.zeros(0, np.int64)
    if not len(terms) or not len(phrases):
        return none
    at = np.minimum(np.searchsorted(terms, phrases), len(terms) - 1)
    alive = np.flatnonzero((terms[at] == phrases).all(1))
    at = at[alive]
    begins = np.concatenate(([0], np.cumsum(counts)))
    rarest_first = np.argsort(counts[at], axis=1, kind="stable")
    row = np.arange(len(at))
    lead = at[row, rarest_first[:, 0]]
    sizes = counts[lead]
    row = np.repeat(row, sizes)
    start = positions[ranges(begins[lead], sizes)] - np.repeat(rarest_first[:, 0], sizes)
    for k in range(1, phrases.shape[1]):
        if not len(row):
            return none
        offset = rarest_first[row, k]
        term = at[row, offset]
        keep = has_near(positions, begins[term], begins[term + 1], start + offset, slack)
        row, start = row[keep], start[keep]
    return alive[row], start


class Phrases:
    """Test items as term hashes; gives all their windows, some thousand at a time."""

    CHUNK = 1 << 14

    def __init__(self, items: list[tuple[int, str | None]], window: int = WINDOW):
        hashes, first = Block(pa.array([t for _, t in items], pa.string())).word_hashes(ALPHANUMERIC)
        counts = np.diff(first)
        self.terms = _long(hashes)
        lengths = np.minimum(counts, window)
        per_item = np.where(counts > 0, counts - lengths + 1, 0)
        self.starts = ranges(first[:-1], per_item)
        self.lengths = np.repeat(lengths, per_item)
        self.items = np.repeat(np.array([i for i, _ in items], np.int64), per_item)

    def windows(self) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(length, rows of terms, item of each row)"""
        for length in np.unique(self.lengths):
            mine = np.flatnonzero(self.lengths == length)
            for k in range(0, len(mine), self.CHUNK):
                some = mine[k : k + self.CHUNK]
                yield int(length), self.terms[self.starts[some][:, None] + np.arange(length)], self.items[some]


def covered(spans: np.ndarray, documents: int) -> np.ndarray:
    """Words of each document in any of the spans (document, start, end); memory follows the spans, not the places."""
    doc, start, end = spans[np.argsort(spans[:, 1], kind="stable")].T
    before = np.concatenate(([0], np.maximum.accumulate(end)[:-1])) if len(end) else end
    return np.bincount(doc, np.maximum(0, end - np.maximum(start, before)), documents).astype(np.int64)


def phrase_matches(index: DataFrame, phrases: Phrases, slack: int = 0) -> DataFrame:
    """For each document of the index: words, hit words and the items with windows in it.

    With slack the words of the nominal place count as hit.
    """
    shared = index.sparkSession.sparkContext.broadcast(phrases)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in range(batch.num_rows):
                ids, *arrays = (batch.column(k)[r].values for k in range(4))
                n_words, terms, counts = (x.to_numpy(zero_copy_only=False) for x in arrays)
                positions = np.frombuffer(batch.column(4)[r].as_py(), np.int64)
                first = np.concatenate(([0], np.cumsum(n_words + GAP)))
                spans = [np.zeros((0, 3), np.int64)]
                pairs = [np.zeros((0, 2), np.int64)]
                for length, rows, items in shared.value.windows():
                    phrase, start = search_shard(terms, counts, positions, rows, slack)
                    doc = np.searchsorted(first, start, "right") - 1
                    spans.append(np.stack([doc, np.maximum(start, first[doc]), np.minimum(start + length, first[doc] + n_words[doc])], 1))
                    pairs.append(np.stack([doc, items[phrase]], 1))
                pairs = np.unique(np.concatenate(pairs), axis=0)
                yield pa.RecordBatch.from_arrays(
                    [
                        ids,
                        pa.array(n_words),
                        pa.array(covered(np.concatenate(spans), len(n_words))),
                        list_array(pairs[:, 1], np.bincount(pairs[:, 0], minlength=len(n_words)), pa.int64()),
                    ],
                    names=["doc_id", "n_words", "n_hit", "items"],
                )

    return index.mapInArrow(match, "doc_id bigint, n_words bigint, n_hit bigint, items array<bigint>")


def find_phrases(docs: DataFrame, phrases: list[str], slack: int = 0) -> DataFrame:
    """Exact (slack 0) or proximity matches of whole phrases; an item is the phrase's index."""
    return phrase_matches(build_index(docs), Phrases(list(enumerate(phrases)), window=GAP // 4), slack)


def decontaminate(docs: DataFrame, benchmark: DataFrame, item_id: str = "item_id", text: str = "text", doc_id: str = "doc_id", limit: int = ITEM_BYTES) -> DataFrame:
    """doc_id, n_words, n_hit, items of every document.

    The test set goes to all workers, so its size is checked first: a larger one is an error, never cut.
    Items with NULL item_id are left out, as they can't be named.
    """
    items = benchmark.select(F.col(item_id).cast("bigint").alias("i"), F.col(text).alias("t")).where("i IS NOT NULL")
    size = items.select(F.sum(F.coalesce(F.octet_length("t"), F.lit(0)))).first()[0] or 0
    if size > limit:
        raise ValueError(f"the benchmark has {size} bytes, above {limit}; match it in parts")
    phrases = Phrases([(r.i, r.t) for r in items.collect()])
    return phrase_matches(build_index(docs, np.unique(phrases.terms), text, doc_id), phrases)
