"""Vectorised work on UTF-8 texts inside Arrow tasks: blocks, words, hashes.

Everything here runs within one Spark task on one block of whole rows. A block holds about
``BLOCK_BYTES`` of text, or one row if that row is longer, so memory follows the longest text.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

BLOCK_BYTES = 2 << 20
_POWERS_STEP = 18

U64 = np.uint64
_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only some C libraries have it
_BASE = 0x9E3779B97F4A7C15 | 1  # odd, so that it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
IDENTITY = np.arange(256, dtype=np.uint8)


def _byte_class(*outside: tuple[int, int]) -> np.ndarray:
    table = np.ones(256, bool)
    for low, high in outside:
        table[low : high + 1] = False
    return table


#: Bytes of a word: all but white space, and letters, digits and everything beyond ASCII (upper case
#: counts, as A-Z is folded first).
NOT_SPACE = _byte_class((0x20, 0x20), (0x09, 0x0D))
ALPHANUMERIC = _byte_class((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F))


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijection that spreads the bits of 64-bit values."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def byte_values(seed: int) -> np.ndarray:
    """A random 64-bit value for each byte; another seed gives an independent hash."""
    return mix64(np.arange(1, 257, dtype=U64) * U64(0x632BE59BD9B4E019) + U64(seed))


class _Powers:
    """Powers of the base and of its inverse, grown on demand; one copy per worker process."""

    def __init__(self):
        self.up = self.down = np.ones(1, U64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = -(-n >> _POWERS_STEP) << _POWERS_STEP  # no doubling, as workers keep the tables
            for name, base in (("up", _BASE), ("down", _INVERSE)):
                table = np.full(size, base, U64)
                table[0] = 1
                np.cumprod(table, out=table)
                setattr(self, name, table)
        return self.up, self.down


_POWERS = _Powers()


class PrefixHash:
    """Polynomial hashes of all substrings of a byte array, from one array of prefix sums.

    Modulo 2**64 strings like the doubling sequence and its complement collide from 1,024 bytes on, so this is
    for the short windows of suffix sorting only; words and lines take ``span_hashes``.
    """

    def __init__(self, data: np.ndarray, values: np.ndarray):
        up, self._down = _POWERS.get(len(data) + 1)
        self._sums = np.zeros(len(data) + 1, U64)
        np.cumsum(values[data] * up[: len(data)], out=self._sums[1:])

    def raw(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._sums[ends] - self._sums[starts]) * self._down[starts]

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return mix64(self.raw(starts, ends))


VALUES = byte_values(1)
OTHER_VALUES = byte_values(2)

LONG = 64  # bytes; longer spans are hashed one by one
_LOW_BYTES = np.array([(1 << 8 * k) - 1 for k in range(9)], U64)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, fold: np.ndarray = IDENTITY) -> np.ndarray:
    """64-bit hash of each span of the folded bytes.

    Eight bytes at a time go through a chain of bijections that begins with the length; spans above LONG bytes
    go through BLAKE2b. Neither is linear in the bytes, so repetitive texts don't collide by construction.
    """
    folded = np.zeros(len(data) + 8, np.uint8)
    folded[: len(data)] = fold[data]
    eight = np.ndarray(len(data) + 1, "<u8", folded, strides=(1,))
    sizes = ends - starts
    hashes = mix64(sizes.astype(U64) + U64(_BASE))
    open_ = np.flatnonzero((sizes > 0) & (sizes <= LONG))
    done = 0
    while len(open_):
        left = sizes[open_] - done
        chunk = eight[starts[open_] + done] & _LOW_BYTES[np.minimum(left, 8)]
        hashes[open_] = mix64(hashes[open_] ^ chunk)
        open_ = open_[left > 8]
        done += 8
    for k in np.flatnonzero(sizes > LONG):
        hashes[k] = int.from_bytes(blake2b(folded[starts[k] : ends[k]], digest_size=8).digest(), "little")
    return hashes


class Block:
    """Some whole texts as one byte array; each text is followed by one line feed."""

    def __init__(self, texts: pa.Array):
        texts = texts.fill_null("")
        joined = pc.binary_join_element_wise(texts.cast(pa.binary()), b"", b"\n")
        _, offsets, data = joined.buffers()
        at = np.frombuffer(offsets, np.int32)[joined.offset : joined.offset + len(joined) + 1]
        self.data = np.frombuffer(data, np.uint8)[at[0] : at[-1]]
        self.starts = at[:-1].astype(np.int64) - at[0]
        self.ends = at[1:].astype(np.int64) - at[0] - 1  # without the line feed
        self.size = len(texts)

    def words(self, word_bytes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Starts and ends of all words, and for each text the index of its first word (one more at the end)."""
        inside = word_bytes[self.data]
        edge = np.flatnonzero(inside[1:] != inside[:-1]) + 1
        if len(inside) and inside[0]:
            edge = np.concatenate(([0], edge))
        starts, ends = edge[::2], edge[1::2]  # a text ends outside a word, so edges come in pairs
        first = np.searchsorted(starts, np.append(self.starts, len(self.data)))
        return starts, ends, first

    def word_hashes(self, word_bytes: np.ndarray, fold: np.ndarray = LOWER):
        starts, ends, first = self.words(word_bytes)
        return span_hashes(self.data, starts, ends, fold), first


def give_back() -> None:
    """Hand freed memory back to the system, as worker processes live on from one job to the next."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


#: What tasks leave in their worker process for later tasks of the same operator; large.
KEPT: dict[str, object] = {}


def forget() -> None:
    """Hand back what tasks of another operator left in this worker process."""
    if KEPT:
        KEPT.clear()
        give_back()


def slices(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text, or one row if that row is longer."""
    column = batch.column(text)
    sizes = pc.binary_length(column).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64) + 1
    total = np.cumsum(sizes)
    at = 0
    while at < len(sizes):
        before = total[at - 1] if at else 0
        end = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(at, end - at)
        at = end
    give_back()


def blocks(batch: pa.RecordBatch, text: str = "text", limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, Block]]:
    """Slices of a batch with their texts."""
    for part in slices(batch, text, limit):
        yield part, Block(part.column(text))


def ngram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words that begin at each index; the last n - 1 indexes are absent."""
    if len(words) < n:
        return np.zeros(0, U64)
    total = np.zeros(len(words) - n + 1, U64)
    for k in range(n):
        total = total * U64(_BASE) + words[k : len(words) - n + 1 + k]
    return mix64(total)


def ranges(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after another."""
    total = int(counts.sum())
    if not total:
        return np.zeros(0, np.int64)
    shift = np.repeat(starts - np.concatenate(([0], np.cumsum(counts)[:-1])), counts)
    return np.arange(total, dtype=np.int64) + shift


def list_array(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.ListArray:
    offsets = np.concatenate(([0], np.cumsum(counts))).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))
