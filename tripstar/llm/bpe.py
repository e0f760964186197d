"""Token ids of many texts: each distinct stretch is encoded once.

The byte-level pattern never lets a pre-token run across the place between a visible character and the white space
after it, between a letter and what is none, or around a lone line feed. It looks ahead at white space only, never
back, so a text may be cut at these places without changing its ids.

New stretches are encoded many at once, joined by line feeds, whose id then tells them apart.
"""

from __future__ import annotations

import numpy as np
from tokenizers import Tokenizer

from tripstar.llm.text import KEPT, Block, ranges, span_hashes

CACHE = 1 << 21  # stretches remembered by a worker, in about 20 bytes each
ENCODED_AT_ONCE = 1 << 10  # the tokenizer's own results are large

BLANK, LINE_FEED = 0x20, 0x0A

#: What a byte is, as bits. VISIBLE and LETTER: a character of ASCII that is no white space, a letter of ASCII. LEAD: first
#: byte of the two-byte characters from U+00C0 on, none of which is white space; LETTER_LEAD: up to U+023F, letters but for two
VISIBLE, LETTER, SPACE, NO_LETTER, SECOND, LEAD, LETTER_LEAD = (1 << k for k in range(7))
KIND = np.zeros(256, np.uint8)
KIND[0x21:0x7F] |= VISIBLE
KIND[[*range(0x41, 0x5B), *range(0x61, 0x7B)]] |= LETTER
KIND[[*range(0x09, 0x0E), BLANK]] |= SPACE
KIND[:0x80] |= np.where(KIND[:0x80] & LETTER, 0, NO_LETTER).astype(np.uint8)
KIND[0x80:0xC0] |= SECOND
KIND[0xC3:0xE0] |= LEAD
KIND[0xC3:0xC9] |= LETTER_LEAD


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


class Encoder:
    """One per worker process and tokenizer file."""

    def __init__(self, path: str):
        self._tokenizer = Tokenizer.from_file(path)
        self._tokenizer.encode_special_tokens = True  # their strings in a text are ordinary text
        self._line_feed = self._tokenizer.encode("\n", add_special_tokens=False).ids
        self._forget()
        if self._tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids are kept in 16 bits")

    def _forget(self) -> None:
        self._keys = np.zeros(0, np.uint64)  # ascending hashes of known stretches
        self._first = np.zeros(0, np.int64)  # where their ids begin
        self._size = np.zeros(0, np.int32)
        self._ids = np.zeros(1 << 16, np.uint16)
        self._used = 0

    def _encoded(self, pieces: list[bytes], joined: bool) -> tuple[np.ndarray, np.ndarray]:
        """ids of all pieces, and the number of ids of each. Pieces to be joined hold no line feed."""
        if joined and len(self._line_feed) == 1:
            text = b"\n".join([*pieces, b""]).decode()
            ids = np.array(self._tokenizer.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.uint16)
            between = ids == self._line_feed[0]
            after = np.flatnonzero(between)
            if len(after) == len(pieces):
                return ids[~between], np.diff(after, prepend=-1) - 1
        found = [e.ids for e in self._tokenizer.encode_batch_fast([p.decode() for p in pieces], add_special_tokens=False)]
        return np.array([i for ids in found for i in ids], np.uint16), np.array([len(ids) for ids in found], np.int64)

    def _learn(self, hashes: np.ndarray, pieces: list[bytes], joined: np.ndarray) -> None:
        order = np.argsort(joined, kind="stable")
        hashes, alone = hashes[order], len(pieces) - int(joined.sum())
        pieces = [pieces[k] for k in order.tolist()]
        bounds = [*range(0, alone, ENCODED_AT_ONCE), *range(alone, len(pieces), ENCODED_AT_ONCE), len(pieces)]
        found = [self._encoded(pieces[a:b], a >= alone) for a, b in zip(bounds, bounds[1:], strict=False)]
        sizes = np.concatenate([n for _, n in found])
        end = self._used + int(sizes.sum())
        if end > len(self._ids):
            grown = np.zeros(max(end, 2 * len(self._ids)), np.uint16)
            grown[: self._used] = self._ids[: self._used]
            self._ids = grown
        self._ids[self._used : end] = np.concatenate([ids for ids, _ in found])
        begin = self._used + np.cumsum(sizes) - sizes
        order = np.argsort(hashes)
        hashes, begin, sizes = hashes[order], begin[order], sizes[order]
        at = np.searchsorted(self._keys, hashes)
        self._keys = np.insert(self._keys, at, hashes)
        self._first = np.insert(self._first, at, begin)
        self._size = np.insert(self._size, at, sizes)
        self._used = end

    def _known(self, hashes: np.ndarray) -> np.ndarray:
        if not len(self._keys):
            return np.zeros(len(hashes), bool)
        return self._keys[np.minimum(np.searchsorted(self._keys, hashes), len(self._keys) - 1)] == hashes

    def encode(self, block: Block) -> tuple[np.ndarray, np.ndarray]:
        """ids of all texts of the block, and the number of ids of each text."""
        data = block.data
        begins, visible = stretches(block)
        starts = np.flatnonzero(begins)
        ends = np.append(starts[1:], len(data))
        inside = np.ones(len(data), bool)
        inside[block.ends] = False
        inside = inside[starts]  # not the line feeds between texts
        starts, ends = starts[inside], ends[inside]
        if not len(starts):
            return np.zeros(0, np.uint16), np.zeros(block.size, np.int64)
        hashes = span_hashes(data, starts, ends)
        own, inverse = np.unique(hashes, return_inverse=True)
        if len(self._keys) > CACHE:
            self._forget()
        new = np.flatnonzero(~self._known(own))
        if len(new):
            one = np.empty(len(own), np.int64)
            one[inverse] = np.arange(len(hashes))  # any of the equal ones
            a, b = starts[one[new]], ends[one[new]]
            character = a + ((data[a] == BLANK) & (b - a > 1))  # the first one behind a blank
            line_feeds = np.flatnonzero(data == LINE_FEED)
            joined = (KIND[data[character]] & (VISIBLE | LEAD) > 0) & visible[b - 1] & (np.searchsorted(line_feeds, a) == np.searchsorted(line_feeds, b))
            raw = data.tobytes()
            self._learn(own[new], [raw[x:y] for x, y in zip(a.tolist(), b.tolist(), strict=True)], joined)
        place = np.searchsorted(self._keys, own)[inverse]
        sizes = self._size[place].astype(np.int64)
        ids = self._ids[ranges(self._first[place], sizes)]
        total = np.concatenate(([0], np.cumsum(sizes)))
        return ids, np.diff(total[np.searchsorted(starts, np.append(block.starts, len(data)))])


def stretches(block: Block) -> tuple[np.ndarray, np.ndarray]:
    """For each byte whether a stretch, or the line feed after a text, begins there; and whether a visible character ends there."""
    data = block.data
    kind = KIND[data]
    end = kind & (VISIBLE | LETTER)  # of the character that ends here
    two = (kind[1:] // SECOND) & (kind[:-1] // LEAD) & 1
    sign = (data[:-1] == 0xC3) & (data[1:] & 0xDF == 0x97)  # U+00D7 and U+00F7
    end[1:] |= two * VISIBLE | (two & (kind[:-1] // LETTER_LEAD) & ~sign) * LETTER
    visible = end & VISIBLE > 0
    begins = np.zeros(len(data), bool)
    begins[1:] = visible[:-1] & (kind[1:] & SPACE > 0) | (end[:-1] & LETTER > 0) & (kind[1:] & NO_LETTER > 0)
    begins[2:] |= visible[:-2] & (data[1:-1] == LINE_FEED) & (kind[2:] & (VISIBLE | LEAD) > 0)
    begins[block.starts] = begins[block.ends] = True
    return begins, visible


def encoder(path: str) -> Encoder:
    if path not in KEPT:
        KEPT[path] = Encoder(path)
    return KEPT[path]
