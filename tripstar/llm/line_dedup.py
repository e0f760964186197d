"""Line dedup with two Bloom filters.

1. The key hashes of all lines are dealt to segments by their high bits, packed per task, and each
   segment runs through two Bloom filters: a hash goes into the first when it is new and into the
   second when the first already holds it. Only the second filters are kept; they hold all repeated
   keys and few others. A document counts each of its keys once.
2. Lines whose key is in the second filters are suspected repeats. Only these are shuffled, as whole
   keys: one aggregation confirms repeats and picks the smallest document.
3. Each document drops its lines of confirmed keys that belong to an earlier document.

The number of segments follows the number of lines, so one segment is a bounded amount of work. The
second filters go to the workers in rounds of at most ``round_bytes``; each round reads the texts again.

Defined cases: NULL or empty text is one empty line; rows of one doc_id are one document; rows with
NULL doc_id take no part and keep their lines; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tripstar.llm.tables import stored
from tripstar.llm.text import LOWER, NOT_SPACE, U64, Block, blocks, forget, mix64, span_hashes
from tripstar.session import small_batches

MIN_CODE_POINTS = 10
SEGMENT_LINES = 1 << 20
BITS_PER_LINE = 12
PROBES = 6
ROUND_BYTES = 64 << 20


class Lines:
    """The lines of a block: whole and stripped bounds, key hashes and lengths in code points."""

    def __init__(self, block: Block):
        data = block.data
        breaks = np.flatnonzero(data == 10)  # each text is followed by one
        self.starts = np.concatenate(([0], breaks[:-1] + 1)) if len(breaks) else breaks
        self.ends = breaks
        self.counts = np.diff(np.concatenate(([0], np.searchsorted(breaks, block.ends, "right"))))
        # from the bounds of visible stretches, as an array of one number for each byte is many times the block
        first, last, _ = block.words(NOT_SPACE)
        self.key_starts = np.minimum(np.append(first, len(data))[np.searchsorted(first, self.starts)], self.ends)
        self.key_ends = np.maximum(np.append(0, last)[np.searchsorted(last, self.ends, "right")], self.key_starts)
        inner = np.flatnonzero((data & 0xC0) == 0x80)  # bytes that begin no code point
        self.lengths = self.key_ends - self.key_starts - np.searchsorted(inner, self.key_ends) + np.searchsorted(inner, self.key_starts)
        self.hashes = span_hashes(data, self.key_starts, self.key_ends, LOWER)
        self.docs = np.repeat(np.arange(block.size), self.counts)


def probes(hashes: np.ndarray, bits: int) -> np.ndarray:
    """Bit numbers of each hash, one row per probe; ``bits`` is a power of two."""
    second = mix64(hashes) | U64(1)
    steps = np.arange(PROBES, dtype=U64)[:, None]
    return ((hashes + steps * second) & U64(bits - 1)).astype(np.int64)


class Bloom:
    def __init__(self, bits: int, words: np.ndarray | None = None):
        self.bits = bits
        self.words = np.zeros(bits >> 3, np.uint8) if words is None else words

    def has(self, hashes: np.ndarray) -> np.ndarray:
        at = probes(hashes, self.bits)
        return ((self.words[at >> 3] >> (at & 7).astype(np.uint8)) & 1).all(0)

    def add(self, hashes: np.ndarray) -> None:
        at = probes(hashes, self.bits).ravel()
        np.bitwise_or.at(self.words, at >> 3, np.left_shift(np.uint8(1), (at & 7).astype(np.uint8)))


def seen_twice(chunks: Iterator[np.ndarray], bits: int) -> Bloom:
    """The second filter after all hashes of a segment went by."""
    once, twice = Bloom(bits), Bloom(bits)
    for hashes in chunks:
        new, counts = np.unique(hashes, return_counts=True)
        twice.add(new[(counts > 1) | once.has(new)])
        once.add(new)
    return twice


def segments_of(hashes: np.ndarray, n: int) -> np.ndarray:
    return ((hashes >> U64(32)) * U64(n) >> U64(32)).astype(np.int64)


def line_filters(docs: DataFrame, segments: int) -> DataFrame:
    """segment, twice: the second filter of each segment."""
    bits = 1 << (int(SEGMENT_LINES * BITS_PER_LINE * 1.5) - 1).bit_length()

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            found = []
            for _, block in blocks(batch):
                lines = Lines(block)
                wanted = lines.lengths >= MIN_CODE_POINTS
                pair = np.stack([lines.docs[wanted].astype(U64), lines.hashes[wanted]])
                order = np.lexsort(pair)
                pair = pair[:, order]
                fresh = np.ones(pair.shape[1], bool)
                fresh[1:] = (pair[:, 1:] != pair[:, :-1]).any(0)
                found.append(pair[1, fresh])
            hashes = np.sort(np.concatenate(found)) if found else np.zeros(0, U64)
            own, first = np.unique(segments_of(hashes, segments), return_index=True)
            parts = np.split(hashes, first[1:])
            yield pa.RecordBatch.from_arrays(
                [pa.array(own, pa.int32()), pa.array([p.tobytes() for p in parts][: len(own)], pa.binary())], names=["segment", "hashes"]
            )

    def filtered(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        chunks = (np.frombuffer(x.as_py(), U64) for batch in batches for x in batch.column("hashes"))
        yield pa.RecordBatch.from_arrays([pa.array([key[0].as_py()], pa.int32()), pa.array([seen_twice(chunks, bits).words.tobytes()])], names=["segment", "twice"])

    return docs.mapInArrow(packed, "segment int, hashes binary").groupBy("segment").applyInArrow(filtered, "segment int, twice binary")


def suspects(docs: DataFrame, filters: DataFrame, segments: int, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """doc_id, key, hash of the lines whose key the second filters hold, once per row of docs."""
    spark = docs.sparkSession
    per_round = max(1, round_bytes // (1 << (int(SEGMENT_LINES * BITS_PER_LINE * 1.5) - 1).bit_length() - 3))
    found = None
    for low in range(0, segments, per_round):
        rows = filters.where(F.col("segment").between(low, low + per_round - 1)).collect()
        shared = spark.sparkContext.broadcast({r.segment: np.frombuffer(r.twice, np.uint8) for r in rows})

        def suspected(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            forget()
            twice = {k: Bloom(len(w) * 8, w) for k, w in shared.value.items()}
            for batch in batches:
                for part, block in blocks(batch):
                    lines = Lines(block)
                    hit = np.zeros(len(lines.hashes), bool)
                    long = np.flatnonzero(lines.lengths >= MIN_CODE_POINTS)
                    own = segments_of(lines.hashes[long], segments)
                    for k in np.unique(own):
                        if int(k) in twice:
                            mine = long[own == k]
                            hit[mine] = twice[int(k)].has(lines.hashes[mine])
                    at = np.flatnonzero(hit)
                    _, first = np.unique(np.stack([lines.docs[at], lines.hashes[at].view(np.int64)]), axis=1, return_index=True) if len(at) else (None, at)
                    at = at[first]
                    folded = LOWER[block.data].tobytes()
                    keys = [folded[a:b] for a, b in zip(lines.key_starts[at], lines.key_ends[at], strict=True)]
                    yield pa.RecordBatch.from_arrays(
                        [part.column("doc_id").take(pa.array(lines.docs[at])), pa.array(keys, pa.binary()).cast(pa.string()), pa.array(lines.hashes[at].view(np.int64))],
                        names=["doc_id", "key", "hash"],
                    )

        part = docs.mapInArrow(suspected, "doc_id bigint, key string, hash bigint")
        found = part if found is None else found.unionByName(part)
    return found


def dropped_keys(docs: DataFrame, round_bytes: int = ROUND_BYTES) -> DataFrame:
    """doc_id, hashes: the keys whose lines a document loses, as hashes to be looked up in that document."""
    n_lines = docs.select(F.sum(F.length("text") - F.length(F.replace("text", F.lit("\n"))) + 1)).first()[0] or 0
    segments = 1 + int(n_lines) // SEGMENT_LINES
    with small_batches(docs.sparkSession):
        lines = stored(suspects(docs, stored(line_filters(docs, segments)), segments, round_bytes))
    # stored, so that the join below deals both sides anew and a very common key can be split
    repeated = stored(lines.groupBy("key").agg(F.min("doc_id").alias("keeper"), F.max("doc_id").alias("last")).where("keeper < last"))
    later = lines.join(repeated, "key").where("doc_id > keeper")
    return later.groupBy("doc_id").agg(F.collect_set("hash").alias("hashes"))


def drop_lines(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", keep: tuple[str, ...] = (), round_bytes: int = ROUND_BYTES) -> DataFrame:
    """doc_id, text without repeated lines, n_lines, n_dropped, rest: one row for each row of docs.

    ``rest`` is a struct of the columns named in ``keep``, as they were; NULL if none are.
    """
    kept_columns = F.struct(*(F.col(f"`{c}`") for c in keep)) if keep else F.lit(None).cast("int")
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"), kept_columns.alias("rest"))
    losses = dropped_keys(narrow.where("doc_id IS NOT NULL").select("doc_id", "text"), round_bytes)

    def cleaned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part, block in blocks(batch):
                lines = Lines(block)
                lists = part.column("hashes")
                sizes = lists.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)
                lost = lists.flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                owner = np.repeat(np.arange(block.size), sizes)
                mark = mix64(lost.view(U64) ^ mix64(owner.astype(U64)))
                gone = np.isin(mix64(lines.hashes ^ mix64(lines.docs.astype(U64))), mark) & (lines.lengths >= MIN_CODE_POINTS)
                dropped = np.bincount(lines.docs[gone], minlength=block.size)
                sizes = lines.ends + 1 - lines.starts  # dropped lines go with their line feeds
                left = block.data[np.repeat(~gone, sizes)].tobytes()
                kept = np.concatenate(([0], np.cumsum(np.where(gone, 0, sizes))))[np.concatenate(([0], np.cumsum(lines.counts)))]
                texts = []
                for a, b in zip(kept[:-1], kept[1:], strict=True):
                    texts.append(left[a : max(a, b - 1)])  # each line left ends with a line feed
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string()), pa.array(lines.counts.astype(np.int64)), pa.array(dropped.astype(np.int64)), part.column("rest")],
                    names=["doc_id", "text", "n_lines", "n_dropped", "rest"],
                )

    schema = T.StructType.fromDDL("doc_id bigint, text string, n_lines bigint, n_dropped bigint").add(narrow.schema["rest"])
    return narrow.join(losses, "doc_id", "left").mapInArrow(cleaned, schema)

