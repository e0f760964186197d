"""Interpolated modified Kneser-Ney n-gram model of any order, counted in Spark, kept as sorted hash arrays.

Counting: tasks count their own tokens and n-grams first, then hash shards add up. N-grams are dealt by the word
before the last, so the shard that gets the longest ones also holds every shorter one that ends in the same two
words with all words before it: one shuffle gives all levels. The number of shards follows the number of
tokens, and the followers of a very frequent word are dealt over as many shards as its count asks
for, so no shard grows with the corpus or with one word. Sums of contexts that end in such a word meet in
the shards of their own hashes.

Levels: the longest n-grams, and those that begin at the start of a text, have their occurrences; shorter ones the
number of different words before them. Each level is discounted (modified Kneser-Ney) and
interpolated with the next shorter one, the last with the uniform distribution over all known tokens and one
unknown. Before a text stand order - 1 start marks, so each token has a whole context.

Files: plain arrays in one file for each kind and shard, under the shared folder: ascending hashes (buckets of about ten
by their first bits, then 32 bits; all 64 for single tokens) and their counts. Workers memory-map them and look up the distinct keys
of a block in ascending order. The model is never gathered in the driver or copied into a worker. It names the
files that were written: one of theirs that a worker can't see is an error, and at most MAPPED are open at a time.

Defined cases: NULL or empty text is the end token alone; without training rows every token has the
probability of the one unknown token, 1; rows are scored each by itself; rows with NULL doc_id are scored;
other columns are not read.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import unquote, urlparse

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from tripstar.llm.tables import stored
from tripstar.llm.text import NOT_SPACE, U64, Block, blocks, mix64
from tripstar.session import scratch_folder

ORDER = 3
SHARD_TOKENS = 2 << 20
TASK_BYTES = 12 << 20
MAPPED = 512  # array files that a worker holds open
WORD_BITS = 40  # of a word's hash within n-grams
WORD_BYTES = WORD_BITS // 8
START, END = (mix64(np.array([k], U64))[0] for k in (0xA11CE, 0xB0B))
FIRST = START >> U64(64 - WORD_BITS)

TALLIES = 5
PART = "shard int, columns array<binary>"


@dataclass(frozen=True)
class Model:
    folder: str
    order: int
    shards: int
    tokens: int
    types: int
    frequent: dict[int, int]  # word (40 bits) -> shards of its followers; at most tokens / SHARD_TOKENS words
    discounts: tuple[tuple[float, float, float], ...]  # of the levels 1 to order
    word_counts: tuple[int, int, int]  # words with a count of one, two, more at level 1
    word_total: int  # sum of all counts at level 1
    files: frozenset[tuple[str, int]]  # the kinds and shards that were written; all others are empty


def tokens_of(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of all texts, each closed by the end token, and the number of tokens of each."""
    words, first = block.word_hashes(NOT_SPACE)
    counts = np.diff(first) + 1
    tokens = np.empty(len(words) + block.size, U64)
    last = np.cumsum(counts) - 1
    word = np.ones(len(tokens), bool)
    word[last] = False
    tokens[word] = words
    tokens[last] = END
    return tokens, counts


def short(hashes: np.ndarray) -> np.ndarray:
    return hashes >> U64(64 - WORD_BITS)


def columns_of(tokens: np.ndarray, sizes: np.ndarray, order: int) -> list[np.ndarray]:
    """For each token: the word before it, itself, then the second, third, ... word before it.

    The first m columns are what an m-gram consists of, and where sorted, equal m-grams are neighbours at every m.
    """
    word = short(tokens)
    place = np.arange(len(tokens)) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    before = []
    for k in range(1, order):
        column = np.full(len(word), FIRST, U64)
        column[k:] = word[: len(word) - k] if k < len(word) else column[k:]
        column[place < k] = FIRST
        before.append(column)
    return [*before[:1], word, *before[1:]]


def oldest(columns: list[np.ndarray], m: int) -> np.ndarray:
    return columns[0 if m == 2 else m - 1]


def pair_hash(before: np.ndarray, word: np.ndarray) -> np.ndarray:
    return mix64(before * U64(0x9E3779B97F4A7C15) + mix64(word))


def context_hash(columns: list[np.ndarray], m: int) -> np.ndarray:
    """Hash of the m - 1 words before the last."""
    found = mix64(oldest(columns, m))
    for k in range(m - 2, 0, -1):
        found = pair_hash(found, columns[0 if k == 1 else k])
    return found


def edges(columns: list[np.ndarray]) -> np.ndarray:
    """Whether a row differs from the one before it."""
    new = np.zeros(len(columns[0]), bool)
    new[:1] = True
    for column in columns:
        new[1:] |= column[1:] != column[:-1]
    return new


def summed(keys: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Ascending distinct keys with the sums of their counts (a vector or a row each)."""
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    new = np.flatnonzero(edges([keys]))
    return keys[new], np.add.reduceat(counts[order], new) if len(new) else counts[:0]


def sorting(columns: list[np.ndarray]) -> np.ndarray:
    """Order of the rows, column by column; by one number for each row where the columns' ranks fit into 64 bits."""
    ranks = [np.unique(c, return_inverse=True) for c in columns]
    bits = [len(values).bit_length() for values, _ in ranks]
    if sum(bits) > 64:
        return np.lexsort([r for _, r in ranks[::-1]])
    key = np.zeros(len(columns[0]), U64)
    for n, (_, rank) in zip(bits, ranks, strict=True):
        key = (key << U64(n)) | rank.astype(U64)
    return np.argsort(key)


def distinct(columns: list[np.ndarray], counts: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Sorted distinct n-grams with the sums of their counts."""
    order = sorting(columns)
    columns = [c[order] for c in columns]
    new = np.flatnonzero(edges(columns))
    return [c[new] for c in columns], np.add.reduceat(counts[order], new) if len(new) else counts[:0]


def shard_of(hashes: np.ndarray, shards: int) -> np.ndarray:
    return (mix64(hashes) % U64(shards)).astype(np.int64)


def by_shard(shard: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Each shard that occurs with the places of its rows, in their order."""
    order = np.argsort(shard, kind="stable")
    own, first = np.unique(shard[order], return_index=True)
    return list(zip(own.tolist(), np.split(order, first[1:]), strict=True)) if len(own) else []


def gram_shard(before: np.ndarray, word: np.ndarray, shards: int, frequent: dict[int, int]) -> np.ndarray:
    """By the word before the last, so that its followers meet; those of a frequent word are spread."""
    spread = np.zeros(len(before), U64)
    mine, parts = spread_parts(before, frequent)
    spread[mine] = mix64(word[mine]) % parts
    return ((mix64(before) % U64(shards) + spread) % U64(shards)).astype(np.int64)


def spread_parts(before: np.ndarray, frequent: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Which words have their followers dealt over several shards, and over how many each of them."""
    hot = np.array(sorted(w for w, n in frequent.items() if n > 1), U64)
    if not len(hot):
        return np.zeros(len(before), bool), np.zeros(0, U64)
    parts = np.array([frequent[int(h)] for h in hot], U64)
    at = np.minimum(np.searchsorted(hot, before), len(hot) - 1)
    mine = hot[at] == before
    return mine, parts[at[mine]]


def _planes(values: np.ndarray, width: int) -> bytes:
    """The low bytes of values, all first bytes, then all second ones: near values compress well."""
    return values.astype("<u8").view(np.uint8).reshape(-1, 8)[:, width - 1 :: -1].T.tobytes() if len(values) else b""


def _values(data: bytes, width: int) -> np.ndarray:
    planes = np.frombuffer(data, np.uint8).reshape(width, -1)
    out = np.zeros((planes.shape[1], 8), np.uint8)
    out[:, width - 1 :: -1] = planes.T
    return out.reshape(-1).view("<u8").astype(U64)


def _narrow(counts: np.ndarray) -> bytes:
    return counts.astype(np.min_scalar_type(int(counts.max(initial=0)))).tobytes()


def _counts(data: bytes, n: int) -> np.ndarray:
    return np.frombuffer(data, f"<u{len(data) // n}").astype(np.int64) if n else np.zeros(0, np.int64)


def numbered(values: np.ndarray, width: int) -> list[bytes]:
    """The different values, frequent ones first, and the number of each value among them."""
    different, number, n = np.unique(values, return_inverse=True, return_counts=True)
    rank = np.empty(len(n), np.int64)
    rank[by := np.argsort(-n, kind="stable")] = np.arange(len(n))
    return [_planes(different[by], width), _planes(rank[number].astype(U64), _width(len(n)))]


def _width(n: int) -> int:
    return -(-n.bit_length() // 8)


def folded(columns: list[np.ndarray], counts: np.ndarray, width: int) -> list[bytes]:
    """Sorted rows with each run of equal beginnings stored once: the first column, then for each other one its
    values, their numbers and bits that say where a run begins, then the counts; each compressed."""
    out, new = [], np.zeros(len(counts), bool)
    for depth, column in enumerate(columns):
        above, new = new, new | edges([column])
        at = np.flatnonzero(new)
        out += [*numbered(column[at], width), np.packbits(above[at]).tobytes()] if depth else [_planes(column[at], width)]
    pack = zstandard.ZstdCompressor(level=1)
    return [pack.compress(x) for x in (*out, _narrow(counts))]


def unfolded(parts: list[bytes], width: int) -> tuple[list[np.ndarray], np.ndarray]:
    unpack = zstandard.ZstdDecompressor()
    first, *rest, counts = (unpack.decompress(p) for p in parts)
    columns = [_values(first, width)]
    for different, number, bits in zip(rest[::3], rest[1::3], rest[2::3], strict=True):
        values = _values(different, width)
        rank = _values(number, _width(len(values))).astype(np.int64)
        run = np.cumsum(np.unpackbits(np.frombuffer(bits, np.uint8), count=len(rank))) - 1
        columns = [*(c[run] for c in columns), values[rank]]
    return columns, _counts(counts, len(columns[-1]))


def _parts(shard: np.ndarray, columns: list[np.ndarray], counts: np.ndarray, width: int) -> pa.RecordBatch:
    """One row for each shard, its rows in the order given."""
    rows = [(s, folded([c[mine] for c in columns], counts[mine], width)) for s, mine in by_shard(shard)]
    return pa.RecordBatch.from_arrays([pa.array([s for s, _ in rows], pa.int32()), pa.array([c for _, c in rows], pa.list_(pa.binary()))], names=["shard", "columns"])


def _gathered(rows: Iterator[list[bytes]], width: int) -> tuple[list[np.ndarray], np.ndarray]:
    found = [unfolded(parts, width) for parts in rows]
    return [np.concatenate(c) for c in zip(*(f for f, _ in found), strict=True)], np.concatenate([n for _, n in found])


def _lists(batches: Iterator[pa.RecordBatch]) -> Iterator[list[bytes]]:
    for batch in batches:
        yield from batch.column("columns").to_pylist()


def local_path(folder: str) -> str:
    """The shared folder as workers open it."""
    url = urlparse(folder)
    if url.scheme not in ("", "file"):
        raise ValueError(f"workers can't memory-map {folder}; pass a folder on a file system that all of them mount")
    return unquote(url.path)


def file_of(folder: str, kind: str, shard: int) -> str:
    return f"{folder}/{kind}-{shard}.arrays"


def save(folder: str, kind: str, shard: int, arrays: dict[str, np.ndarray]) -> None:
    """The arrays of a shard in one file. It appears when complete, so an attempt that ran twice does no harm."""
    os.makedirs(folder, exist_ok=True)
    head, at = {}, 0
    for name, values in arrays.items():
        head[name] = (values.dtype.str, at, len(values))
        at += -(-values.nbytes // 8) * 8
    text = json.dumps(head).encode()
    text += b" " * (-len(text) % 8)
    path = file_of(folder, kind, shard)
    with open(own := f"{path}.{uuid.uuid4().hex}", "wb") as out:
        out.write(len(text).to_bytes(8, "little") + text)
        for values in arrays.values():
            out.write(values.tobytes() + bytes(-values.nbytes % 8))
    os.replace(own, path)


def mapped(path: str) -> dict[str, np.ndarray]:
    data = np.memmap(path, np.uint8, "r")
    start = 8 + int.from_bytes(data[:8].tobytes(), "little")
    head = json.loads(data[8:start].tobytes())
    return {name: np.frombuffer(data, kind, n, start + at) if n else np.zeros(0, kind) for name, (kind, at, n) in head.items()}


def key_arrays(keys: np.ndarray, whole: bool) -> tuple[np.ndarray, dict[str, np.ndarray]]:
    """Order of the keys, and as arrays: where each bucket of first bits starts, and the next 32 bits (or all) of each key."""
    order = np.argsort(keys)
    keys = keys[order]
    bits = max(0, len(keys).bit_length() - 4)  # about ten keys in a bucket
    bucket, rest = bucket_of(keys, bits, whole)
    start = np.zeros((1 << bits) + 1, "<u4")
    start[1:] = np.cumsum(np.bincount(bucket, minlength=1 << bits))
    return order, {"start": start, "rest": rest}


def bucket_of(keys: np.ndarray, bits: int, whole: bool) -> tuple[np.ndarray, np.ndarray]:
    bucket = (keys >> U64(64 - bits)).astype(np.int64) if bits else np.zeros(len(keys), np.int64)
    return bucket, keys.astype("<u8") if whole else (keys >> U64(32 - bits) & U64(0xFFFFFFFF)).astype("<u4")


def count_arrays(counts: np.ndarray) -> dict[str, np.ndarray]:
    """A byte for each count; those from 255 on stand beside it."""
    large = np.flatnonzero(counts >= 255)
    return {"counts": np.minimum(counts, 255).astype(np.uint8), "large_at": large.astype("<u4"), "large": counts[large].astype("<i8")}


def row_arrays(rows: np.ndarray) -> dict[str, np.ndarray]:
    """Rows as numbers of different rows, frequent ones first, so that most numbers take a byte."""
    if not len(rows):
        return {**count_arrays(np.zeros(0, np.int64)), "rows": np.zeros(0, "<i8")}
    code = np.zeros(len(rows), U64)
    for column in rows.T:
        code = pair_hash(code, column.astype(U64))
    _, first, number, n = np.unique(code, return_index=True, return_inverse=True, return_counts=True)
    rank = np.empty(len(n), np.int64)
    rank[by := np.argsort(-n, kind="stable")] = np.arange(len(n))
    return {**count_arrays(rank[number]), "rows": rows[first[by]].astype("<i8").ravel()}


def _tallies(n: np.ndarray) -> list[int]:
    """How many counts are 1, 2, 3, 4, and more."""
    return [*(int((n == k).sum()) for k in (1, 2, 3, 4)), int((n > 4).sum())]


def discounts(tallies: list[int]) -> tuple[float, float, float]:
    n1, n2, n3, n4 = tallies[:4]
    if not (n1 and n2 and n3):
        return 0.5, 1.0, 1.5
    y = n1 / (n1 + 2 * n2)
    found = (1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3)
    return tuple(min(max(d, 0.05), k + 0.95) for k, d in enumerate(found))


def _emitted(batches: Iterator[pa.RecordBatch], part, flush) -> Iterator[pa.RecordBatch]:
    """flush(parts) for each TASK_BYTES of text, where part(block) is what a block gives."""
    parts, size = [], 0
    for batch in batches:
        for _, block in blocks(batch):
            parts.append(part(block))
            size += len(block.data)
            if size > TASK_BYTES:
                yield flush(parts)
                parts, size = [], 0
    if parts:
        yield flush(parts)


def emit_words(batches: Iterator[pa.RecordBatch], shards: int) -> Iterator[pa.RecordBatch]:
    def flush(parts):
        keys, counts = summed(np.concatenate([k for k, _ in parts]), np.concatenate([c for _, c in parts]))
        return _parts(shard_of(keys, shards), [keys], counts, 8)

    return _emitted(batches, lambda block: np.unique(tokens_of(block)[0], return_counts=True), flush)


def emit_grams(batches: Iterator[pa.RecordBatch], order: int, shards: int, frequent: dict[int, int]) -> Iterator[pa.RecordBatch]:
    def flush(parts):
        columns = [np.concatenate(c) for c in zip(*parts, strict=True)]
        columns, counts = distinct(columns, np.ones(len(columns[0]), np.int64))
        return _parts(gram_shard(columns[0], columns[1], shards, frequent), columns, counts, WORD_BYTES)

    return _emitted(batches, lambda block: columns_of(*tokens_of(block), order), flush)


def context_rows(contexts: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct contexts, the place of one n-gram of each, and rows: followers counted once, twice, more often; all counts."""
    order = np.argsort(contexts, kind="stable")
    first = np.flatnonzero(edges([contexts[order]]))
    n = counts[order]
    sums = [np.add.reduceat(x.astype(np.int64), first) if len(first) else np.zeros(0, np.int64) for x in (n == 1, n == 2, n > 2, n)]
    return contexts[order[first]], order[first], np.column_stack(sums)


def _rows_as_bytes(keys: np.ndarray, rows: np.ndarray) -> list[bytes]:
    return [keys.astype("<u8").tobytes(), rows.astype("<i8").tobytes()]


def fit(docs: DataFrame, order: int = ORDER, folder: str | None = None, shard_tokens: int = SHARD_TOKENS, text: str = "text") -> Model:
    """Count all rows of docs and write the model below folder (by default, a new one in the shared folder)."""
    if order < 1:
        raise ValueError("the order of the model is 1 at least")
    spark = docs.sparkSession
    narrow = docs.select(F.col(text).alias("text"))
    target = local_path(folder or scratch_folder(spark))
    # a token takes two bytes at least, so this bounds the tokens from above
    size = narrow.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)), F.count("*")).first()
    shards = 1 + (size[0] // 6 + size[1]) // shard_tokens

    def word_shard(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = key[0].as_py()
        (keys,), counts = _gathered(_lists(batches), 8)
        keys, counts = summed(keys, counts)
        by, arrays = key_arrays(keys, True)
        save(target, "word", shard, arrays | count_arrays(counts[by]))
        hot = counts > shard_tokens
        lists = [pa.array([x], pa.list_(pa.int64())) for x in (short(keys[hot]).astype(np.int64), counts[hot], _tallies(counts))]
        yield pa.RecordBatch.from_arrays([pa.array([shard], pa.int32()), pa.array([int(counts.sum())]), pa.array([len(keys)]), *lists], names=["shard", "tokens", "types", "hot", "hot_counts", "tallies"])

    parts = narrow.mapInArrow(lambda batches: emit_words(batches, shards), PART)
    schema = "shard int, tokens bigint, types bigint, hot array<bigint>, hot_counts array<bigint>, tallies array<bigint>"
    rows = stored(parts.groupBy("shard").applyInArrow(word_shard, schema)).collect()
    files = [("word", r.shard) for r in rows]
    tokens, types = sum(r.tokens for r in rows), sum(r.types for r in rows)
    frequent = {int(FIRST): 1 + size[1] // shard_tokens}
    for r in rows:
        for word, n in zip(r.hot, r.hot_counts, strict=True):
            frequent[word] = 1 + n // shard_tokens
    levels = [np.array([r.tallies for r in rows], np.int64).reshape(-1, TALLIES).sum(0).tolist()]
    total = tokens

    def gram_shards(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Writes all levels of one shard; returns its parts of level 1 and of spread contexts, and its tallies."""
        shard, names = key[0].as_py(), ["kind", "shard", "columns", "tallies"]
        columns, counts = distinct(*_gathered(_lists(batches), WORD_BYTES))
        tallies, parts = [], []
        for m in range(order, 1, -1):
            contexts = context_hash(columns, m)
            by, arrays = key_arrays(pair_hash(contexts, columns[1]), False)
            save(target, f"gram{m}", shard, arrays | count_arrays(counts[by]))
            tallies.append(_tallies(counts))
            own, at, sums = context_rows(contexts, counts)
            spread, _ = spread_parts(columns[0][at], frequent)
            by, arrays = key_arrays(own[~spread], False)
            save(target, f"context{m}", shard, arrays | row_arrays(sums[~spread][by]))
            own, sums = own[spread], sums[spread]
            parts += [(m, s, _rows_as_bytes(own[mine], sums[mine])) for s, mine in by_shard(shard_of(own, shards))]
            if m > 2:
                each = np.where(oldest(columns, m - 1) == FIRST, counts, 1)
                columns = columns[: m - 1]
                first = np.flatnonzero(edges(columns))
                columns, counts = [c[first] for c in columns], np.add.reduceat(each, first)
        words, each = summed(columns[1], np.ones(len(columns[1]), np.int64))
        level = _parts(shard_of(words, shards), [words], each, WORD_BYTES)
        parts += [(1, s, c) for s, c in zip(*(level.column(n).to_pylist() for n in ("shard", "columns")), strict=True)]
        parts = [(*p, None) for p in parts] + [(0, shard, None, [n for t in tallies[::-1] for n in t])]
        kinds = (pa.int32(), pa.int32(), pa.list_(pa.binary()), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*parts, strict=True), kinds, strict=True)], names=names)

    def second_shards(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, shard = (k.as_py() for k in key)
        if kind == 1:
            (words,), counts = _gathered(_lists(batches), WORD_BYTES)
            words, counts = summed(words, counts)
            by, arrays = key_arrays(mix64(words), False)
            save(target, "continuation", shard, arrays | count_arrays(counts[by]))
            tallies = [*_tallies(counts), int(counts.sum())]
        else:
            found = [(np.frombuffer(k, "<u8"), np.frombuffer(n, "<i8").reshape(-1, 4)) for k, n in _lists(batches)]
            keys, sums = summed(np.concatenate([k for k, _ in found]), np.concatenate([n for _, n in found]))
            by, arrays = key_arrays(keys, False)
            save(target, f"spread{kind}", shard, arrays | row_arrays(sums[by]))
            tallies = []
        yield pa.RecordBatch.from_arrays([pa.array([kind], pa.int32()), pa.array([shard], pa.int32()), pa.array([tallies], pa.list_(pa.int64()))], names=["kind", "shard", "tallies"])

    if order > 1:
        parts = narrow.mapInArrow(lambda batches: emit_grams(batches, order, shards, frequent), PART)
        counted = stored(parts.groupBy("shard").applyInArrow(gram_shards, "kind int, shard int, columns array<binary>, tallies array<bigint>"))
        second = counted.where("kind > 0").select("kind", "shard", "columns").groupBy("kind", "shard")
        later = stored(second.applyInArrow(second_shards, "kind int, shard int, tallies array<bigint>")).collect()
        own = counted.where("kind = 0").select("shard", "tallies").collect()
        files += [(f"{kind}{m}", r.shard) for r in own for m in range(2, order + 1) for kind in ("gram", "context")]
        files += [("continuation" if r.kind == 1 else f"spread{r.kind}", r.shard) for r in later]
        words = np.array([r.tallies for r in later if r.kind == 1], np.int64).reshape(-1, TALLIES + 1).sum(0).tolist()
        grams = np.array([r.tallies for r in own], np.int64).reshape(-1, order - 1, TALLIES).sum(0).tolist()
        levels, total = [words[:TALLIES], *grams], words[TALLIES]
    return Model(
        folder=target,
        order=order,
        shards=shards,
        tokens=tokens,
        types=types,
        frequent=frequent,
        discounts=tuple(discounts(t) for t in levels),
        word_counts=(levels[0][0], levels[0][1], sum(levels[0][2:])),
        word_total=total,
        files=frozenset(files),
    )


class Tables:
    """The array files of a model, mapped when first used."""

    def __init__(self, model: Model):
        self.model, self._open = model, {}

    def _map(self, kind: str, shard: int) -> dict[str, np.ndarray] | None:
        key = kind, shard
        if key not in self._open:
            if key not in self.model.files:  # no row fell into the shard
                return None
            path = file_of(self.model.folder, kind, shard)
            if not os.path.exists(path):
                raise FileNotFoundError(f"{path} of the model is missing; is its folder mounted on this worker?")
            while len(self._open) >= MAPPED:
                del self._open[next(iter(self._open))]  # the map opened first
            self._open[key] = mapped(path)
        return self._open[key]

    def look_up(self, kind: str, keys: np.ndarray, shard: np.ndarray, width: int = 1) -> np.ndarray:
        """A row of width values for each key, 0 where it is absent. Distinct keys are read once, in the order of the files."""
        if not len(keys):
            return np.zeros((0, width), np.int64)
        bits = self.model.shards.bit_length()
        own, inverse = np.unique((shard.astype(U64) << U64(64 - bits)) | (keys >> U64(bits)), return_inverse=True)
        some = np.empty(len(own), np.int64)
        some[inverse] = np.arange(len(keys))
        keys = keys[some]
        out = np.zeros((len(own), width), np.int64)
        files, first = np.unique(own >> U64(64 - bits), return_index=True)
        for s, a, b in zip(files.tolist(), first.tolist(), [*first[1:].tolist(), len(own)], strict=True):
            have = self._map(kind, s)
            if have is None or not len(have["rest"]):
                continue
            at, hit = places(have["start"], have["rest"], keys[a:b])
            at, mine = at[hit], a + np.flatnonzero(hit)
            number = have["counts"][at].astype(np.int64)
            big = np.flatnonzero(number == 255)
            if len(big):
                number[big] = have["large"][np.searchsorted(have["large_at"], at[big])]
            out[mine] = have["rows"].reshape(-1, width)[number] if "rows" in have else number[:, None]
        return out[inverse]


def places(start: np.ndarray, rest: np.ndarray, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each key stands, and whether it is there at all: bisection within the keys' buckets, all at once."""
    bucket, wanted = bucket_of(keys, (len(start) - 1).bit_length() - 1, rest.dtype.itemsize == 8)
    low, high = start[bucket].astype(np.int64), start[bucket + 1].astype(np.int64)
    end, last = high.copy(), len(rest) - 1
    for _ in range(int((high - low).max(initial=0)).bit_length()):
        middle = (low + high) >> 1
        right = (rest[np.minimum(middle, last)] < wanted) & (low < high)
        low, high = np.where(right, middle + 1, low), np.where(right, high, middle)
    return low, (low < end) & (rest[np.minimum(low, last)] == wanted)


_TABLES: dict[str, Tables] = {}


def tables(model: Model) -> Tables:
    if model.folder not in _TABLES:
        _TABLES.clear()
        _TABLES[model.folder] = Tables(model)
    return _TABLES[model.folder]


def _discount(counts: np.ndarray, d: tuple[float, float, float]) -> np.ndarray:
    return np.array([0.0, *d])[np.minimum(counts, 3)]


def log_probabilities(model: Model, tokens: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each token its training count and log10 probability after the tokens before it."""
    have, m = tables(model), model
    types, inverse = np.unique(tokens, return_inverse=True)
    count = have.look_up("word", types, shard_of(types, m.shards))[:, 0]
    uniform = 1 / (m.types + 1)
    if not m.word_total:
        return count[inverse], np.full(len(tokens), np.log10(uniform))
    words = short(types)
    after = count if m.order == 1 else have.look_up("continuation", mix64(words), shard_of(words, m.shards))[:, 0]
    saved = sum(d * n for d, n in zip(m.discounts[0], m.word_counts, strict=True)) / m.word_total
    p = (np.maximum(after - _discount(after, m.discounts[0]), 0) / m.word_total + saved * uniform)[inverse]

    columns = columns_of(tokens, sizes, m.order) if m.order > 1 else []
    if columns:
        place = gram_shard(columns[0], columns[1], m.shards, m.frequent)
        context_place, (spread, _) = shard_of(columns[0], m.shards), spread_parts(columns[0], m.frequent)
    for level, d in enumerate(m.discounts[1:], 2):
        contexts = context_hash(columns, level)
        seen = have.look_up(f"gram{level}", pair_hash(contexts, columns[1]), place)[:, 0]
        followers = np.zeros((len(tokens), 4), np.int64)
        followers[~spread] = have.look_up(f"context{level}", contexts[~spread], context_place[~spread], 4)
        followers[spread] = have.look_up(f"spread{level}", contexts[spread], shard_of(contexts[spread], m.shards), 4)
        total = followers[:, 3]
        share = np.where(total > 0, followers[:, :3] @ np.array(d) / np.maximum(total, 1), 1.0)
        higher = np.maximum(seen - _discount(seen, d), 0) / np.maximum(total, 1)
        p = np.where(total > 0, higher, 0) + share * p
    return count[inverse], np.log10(p)


def score(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, n_known, base_score (add-one unigrams), score (this model): log10 probabilities."""

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch):
                tokens, sizes = tokens_of(block)
                count, log_p = log_probabilities(model, tokens, sizes)
                base = np.log10((count + 1) / (model.tokens + model.types + 1))
                first = np.cumsum(sizes) - sizes
                sums = [np.add.reduceat(x, first) for x in ((count > 0).astype(np.int64), base, log_p)]
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(sizes), *map(pa.array, sums)], names=["doc_id", "n_tokens", "n_known", "base_score", "score"])

    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    return narrow.mapInArrow(scored, "doc_id bigint, n_tokens bigint, n_known bigint, base_score double, score double")
