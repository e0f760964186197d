"""CRC-32 of many words and of runs of words at once, by array passes.

The register is linear: the checksum of two joined byte strings is that of the first one, moved on by the
length of the second, xor that of the second. Moving on is a lookup in four tables of 256 values.
"""

from __future__ import annotations

import zlib

import numpy as np

U32 = np.uint32
_POLYNOMIAL = 0xEDB88320  # fixed value: the reflected polynomial of CRC-32
_SHORT = 64  # words up to here go byte by byte over all words; lengths below it have a table of their own


def _byte_table() -> np.ndarray:
    table = np.arange(256, dtype=U32)
    for _ in range(8):
        table = np.where(table & U32(1), (table >> U32(1)) ^ U32(_POLYNOMIAL), table >> U32(1))
    return table


_TABLE = _byte_table()


def _step(register: np.ndarray) -> np.ndarray:
    """One zero byte further."""
    return _TABLE[register & U32(255)] ^ (register >> U32(8))


def _moved(tables: np.ndarray, register: np.ndarray) -> np.ndarray:
    """Further by the distance that the tables (4 x 256) stand for."""
    out = tables[0][register & U32(255)]
    for b in range(1, 4):
        out = out ^ tables[b][(register >> U32(8 * b)) & U32(255)]
    return out


def _distance_tables() -> tuple[np.ndarray, list[np.ndarray]]:
    """Tables for 0 to _SHORT - 1 bytes, and for _SHORT, 2 * _SHORT, 4 * _SHORT, ... bytes."""
    now = np.stack([np.arange(256, dtype=U32) << U32(8 * b) for b in range(4)])
    short = []
    for _ in range(_SHORT):
        short.append(now)
        now = _step(now)
    doubled = [now]
    while _SHORT << len(doubled) < 1 << 31:
        doubled.append(_moved(doubled[-1], doubled[-1]))
    return np.stack(short), doubled


_SHORT_TABLES, _DOUBLED = _distance_tables()


def moved_on(checksums: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Each checksum as if so many bytes followed (to be xored with theirs)."""
    low = lengths & (_SHORT - 1)
    out = _SHORT_TABLES[low, 0, checksums & U32(255)]
    for b in range(1, 4):
        out = out ^ _SHORT_TABLES[low, b, (checksums >> U32(8 * b)) & U32(255)]
    for k, table in enumerate(_DOUBLED):
        far = np.flatnonzero((lengths >> (k + 6)) & 1)
        if len(far):
            out[far] = _moved(table, out[far])
        elif not (lengths >> (k + 6)).any():
            break
    return out


def of_words(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """CRC-32 of data[start:end] for each word."""
    lengths = ends - starts
    order = np.argsort(-np.minimum(lengths, _SHORT + 1).astype(np.int8), kind="stable")  # longest first
    size = lengths[order]
    register = np.full(len(starts), 0xFFFFFFFF, U32)
    at = starts[order]
    left = np.searchsorted(-size.clip(max=_SHORT + 1), -np.arange(_SHORT + 1), side="left")  # words longer than j
    for j in range(int(min(size.max(initial=0), _SHORT))):
        n = left[j]
        now = register[:n]
        register[:n] = _TABLE[(now ^ data[at[:n] + j]) & U32(255)] ^ (now >> U32(8))
    out = np.empty(len(starts), U32)
    out[order] = register ^ U32(0xFFFFFFFF)
    for k in np.flatnonzero(lengths > _SHORT):
        out[k] = zlib.crc32(data[starts[k] : ends[k]].tobytes())
    return out


def followed_by(checksums: np.ndarray, byte: int) -> np.ndarray:
    """Checksums with one more byte."""
    register = checksums ^ U32(0xFFFFFFFF)
    return (_TABLE[(register ^ U32(byte)) & U32(255)] ^ (register >> U32(8))) ^ U32(0xFFFFFFFF)


def runs(words: np.ndarray, lengths: np.ndarray, longest: int) -> list[np.ndarray]:
    """For each width up to longest the CRC-32 of that many consecutive words joined by one space; as many shorter as wider."""
    out = [words]
    for width in range(2, longest + 1):
        n = max(0, len(words) - width + 1)
        out.append(moved_on(followed_by(out[-1][:n], 32), lengths[width - 1 : width - 1 + n]) ^ words[width - 1 : width - 1 + n])
    return out
