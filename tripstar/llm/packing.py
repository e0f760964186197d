"""Packing of documents into training windows by lexical retrieval.

A document's ids are cut into whole windows and one rest. Rests are dealt by weighted MinHashes of their ids, rare ids
weighing most as in BM25: rests that share their rare ids get equal keys, and within a key the next ones go
on separating, so that similar ones come together. Consecutive ones make shards of SHARD rests. Each shard has a BM25 inverted index of its
rests, with document frequencies and the average length taken over all rests. A window starts with the
next unused rest; its heaviest terms are looked up, and the best unused neighbours follow until the
window is full. The neighbour that does not fit is cut, and what remains of it starts the next window.
So only the last window of a shard can be short.

Defined cases: NULL or empty text is the end id alone; every row is packed by itself, also repeated ones;
NULL doc_id stays; other columns are not read.
"""

from __future__ import annotations

import os
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from tripstar.llm.bpe import default_tokenizer, encoder
from tripstar.llm.tables import shuffle_partitions, stored
from tripstar.llm.text import U64, blocks, mix64, ranges

WINDOW = 1024
SHARD = 2048
KEYS = 4
QUERY_TERMS = 24
K1, B = 1.2, 0.75
VOCABULARY = 1 << 16
END = 0

PIECES = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, offset bigint, ids binary"
NAMES = [c.split()[0] for c in PIECES.split(", ")]


def crc(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def sequence_number(partition: int, count: int, rest: bool) -> int:
    """Unique among whole windows (odd) and among packed ones (even)."""
    return ((partition << 32 | count) << 1) | (not rest)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) if rows else [()] * len(NAMES)
    kinds = [pa.int64()] * 7 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=NAMES)


def tokenized(docs: DataFrame, path: str, window: int, keep_ids: bool) -> DataFrame:
    """Whole windows with their sequence, and rests (sequence NULL) with ids."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        partition, count = TaskContext.get().partitionId(), 0
        for batch in batches:
            for part, block in blocks(batch):
                ids, sizes = encoder(path).encode(block)
                first = np.cumsum(sizes) - sizes
                rows = []
                for doc, a, n in zip(part.column("doc_id").to_pylist(), first.tolist(), sizes.tolist(), strict=True):
                    own = np.append(ids[a : a + n], np.uint16(END))
                    for at in range(0, n + 1, window):
                        piece = own[at : at + window]
                        if len(piece) == window:
                            number = sequence_number(partition, count, False)
                            rows.append((doc, at, window, crc(piece), n + 1, number, 0, piece.tobytes() if keep_ids else None))
                            count += 1
                        else:
                            rows.append((doc, at, len(piece), crc(piece), n + 1, None, None, piece.tobytes()))
                yield _batch(rows)

    return docs.mapInArrow(cut, PIECES)


def rest_statistics(rests: DataFrame) -> tuple[np.ndarray, int, float]:
    """Document frequency of each id, number of rests, average length; over all rests."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, last = np.zeros(VOCABULARY, np.int64), np.zeros(VOCABULARY, np.int64)
        for batch in batches:
            for rest in batch.column("ids").to_pylist():
                ids = np.frombuffer(rest, np.uint16)
                at = np.arange(len(ids))
                last[ids] = at
                seen[ids[last[ids] == at]] += 1  # each id once, where it stands last
        used = np.flatnonzero(seen)
        yield pa.RecordBatch.from_arrays([pa.array(used, pa.int32()), pa.array(seen[used])], names=["id", "n"])

    frequency = np.zeros(VOCABULARY, np.int64)
    counted = rests.select("ids").mapInArrow(count, "id int, n bigint").groupBy("id").agg(F.sum("n").alias("n"))
    for row in counted.collect():  # a row for each id of the vocabulary at most
        frequency[row.id] = row.n
    n, tokens = rests.agg(F.count("*"), F.coalesce(F.sum("length"), F.lit(0))).first()
    return frequency, n, tokens / max(n, 1)


def marks(idf: np.ndarray, frequency: np.ndarray) -> list[np.ndarray]:
    """For each key a number for each id, exponentially distributed with a rate that grows with the id's rarity; an id
    of one rest brings nothing together and has none.

    The least of a rest's numbers is its key: an id wins in proportion to its rate, and two rests agree with the
    probability of their weighted overlap.
    """
    draws = [(mix64(np.arange(1, VOCABULARY + 1, dtype=U64) + U64(k << 32)) >> U64(11)).astype(np.float64) + 0.5 for k in range(1, KEYS + 1)]
    rate = idf * (1 - 1 / np.maximum(frequency, 1))
    return [np.where(rate > 0, -np.log(d / (1 << 53)) / np.maximum(rate, 1e-300), np.inf) for d in draws]


def keyed(rests: DataFrame, of_ids) -> DataFrame:
    """The rests with key_0, key_1, ...; of_ids() gives the numbers of the ids."""

    def key(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = of_ids()
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = batch.column("ids").to_pylist()
            ids = np.frombuffer(b"".join(rows), np.uint16)
            first = np.cumsum([0, *(len(r) // 2 for r in rows[:-1])])
            keys = [pa.array(np.minimum.reduceat(n[ids], first)) for n in numbers]
            yield pa.RecordBatch.from_arrays([*batch.columns, *keys], names=[*batch.schema.names, *(f"key_{k}" for k in range(KEYS))])

    kinds = ", ".join(f"key_{k} double" for k in range(KEYS))
    return rests.select("doc_id", "start", "doc_tokens", "ids").mapInArrow(key, f"doc_id bigint, start bigint, doc_tokens bigint, ids binary, {kinds}")


class Index:
    """BM25 inverted index of the rests of one shard."""

    def __init__(self, rests: list[np.ndarray], idf: np.ndarray, average: float):
        sizes = np.array([len(r) for r in rests])
        code = np.repeat(np.arange(len(rests)), sizes) * VOCABULARY + np.concatenate(rests)
        code, tf = np.unique(code, return_counts=True)
        owner, term = code // VOCABULARY, code % VOCABULARY
        weight = idf[term] * tf * (K1 + 1) / (tf + K1 * (1 - B + B * sizes[owner] / average))
        self.first = np.searchsorted(owner, np.arange(len(rests) + 1))
        self._term, self._weight = term, weight
        order = np.argsort(term, kind="stable")
        self._owner, self._posted = owner[order], weight[order]
        self._begin = np.searchsorted(term[order], np.arange(VOCABULARY + 1))
        self._n = len(rests)

    def scores(self, row: int) -> np.ndarray:
        """BM25 of every rest for the heaviest terms of one."""
        a, b = self.first[row], self.first[row + 1]
        best = a + np.argsort(-self._weight[a:b], kind="stable")[:QUERY_TERMS]
        terms = self._term[best]
        at = ranges(self._begin[terms], self._begin[terms + 1] - self._begin[terms])
        return np.bincount(self._owner[at], weights=self._posted[at], minlength=self._n)


def fill(rests: list[np.ndarray], index: Index, window: int) -> Iterator[list[tuple[int, int, int]]]:
    """Windows as lists of (rest, from, to)."""
    unused = np.ones(len(rests), bool)
    following, seed, seed_from = 0, -1, 0
    while True:
        if seed < 0:
            while following < len(rests) and not unused[following]:
                following += 1
            if following == len(rests):
                return
            seed, seed_from = following, 0
            unused[seed] = False
        pieces, free = [(seed, seed_from, len(rests[seed]))], window - len(rests[seed]) + seed_from
        score = index.scores(seed)
        score[~unused] = -1.0
        seed = -1
        while free:
            row = int(score.argmax())  # the first of equal ones; each is taken once, so no order of all is needed
            if not unused[row]:
                break
            unused[row], score[row] = False, -1.0
            take = min(free, len(rests[row]))
            pieces.append((row, 0, take))
            free -= take
            if take < len(rests[row]):
                seed, seed_from = row, take
        yield pieces


def pack(docs: DataFrame, tokenizer: str | None = None, window: int = WINDOW, shard: int = SHARD, keep_ids: bool = True, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """One row for each piece: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (16-bit, if kept)."""
    spark = docs.sparkSession
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    pieces = stored(tokenized(narrow, tokenizer or default_tokenizer(), window, keep_ids))
    rests = pieces.where("sequence_id IS NULL")
    frequency, n, average = rest_statistics(rests)
    idf = np.log(1 + (n - frequency + 0.5) / (frequency + 0.5))
    shared = spark.sparkContext.broadcast((idf, average, frequency))  # two numbers for each id of the vocabulary

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        partition, count = TaskContext.get().partitionId(), 0
        for table in _shards(batches, shard):
            doc, start, tokens = (table.column(c).to_pylist() for c in ("doc_id", "start", "doc_tokens"))
            ids = [np.frombuffer(x, np.uint16) for x in table.column("ids").to_pylist()]
            rows = []
            for pieces in fill(ids, Index(ids, *shared.value[:2]), window):
                number, offset = sequence_number(partition, count, True), 0
                count += 1
                for row, a, b in pieces:
                    piece = ids[row][a:b]
                    rows.append((doc[row], start[row] + a, b - a, crc(piece), tokens[row], number, offset, piece.tobytes() if keep_ids else None))
                    offset += b - a
            yield _batch(rows)

    order = [*(f"key_{k}" for k in range(KEYS)), "doc_id", "start"]
    dealt = keyed(rests, lambda: marks(shared.value[0], shared.value[2])).repartitionByRange(shuffle_partitions(spark), *order).sortWithinPartitions(*order)
    filled = dealt.mapInArrow(packed, PIECES)
    every = pieces.where("sequence_id IS NOT NULL").unionByName(filled)
    return every if keep_ids else every.drop("ids")


def _shards(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[pa.Table]:
    held, n = [], 0
    for batch in batches:
        while batch.num_rows:
            part = batch.slice(0, size - n)
            held.append(part)
            n += part.num_rows
            batch = batch.slice(part.num_rows)
            if n == size:
                yield pa.Table.from_batches(held)
                held, n = [], 0
    if held:
        yield pa.Table.from_batches(held)
