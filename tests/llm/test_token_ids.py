"""Ids by stretches against the tokenizer on whole texts, and how much of a text reaches the tokenizer."""

import random

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tripstar.llm import bpe, packing
from tripstar.llm.text import Block

PLAIN = Tokenizer.from_file(bpe.default_tokenizer())
PLAIN.encode_special_tokens = True

ODD = [
    *["a", "Zz", "the", "'s", "'", "'ll", "é", "×", "÷", "ȿ", "ɀ", "Ȁ", "ǀ", "ñ", "ß", "é", "́", "Ω", ";", "д", "文", "\U0001d11e", "ª", "º", "²", "½", "٣"],
    *["0", "12", ",", ".", "!!", "-", "_", "\x00", "\x1c", "\x1f", "\x7f", "<|endoftext|>"],
    *[" ", " ", " ", "  ", "\n", "\n", "\n\n", "\t", "\r", "\r\n", "\x0b", "\x0c", "\x85", "\xa0"],
    *map(chr, [0x301, 0x37E, 0x1680, 0x2003, 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0x200B, 0xFEFF, 0x23F, 0x240]),
]


def same_as_whole(texts, encoder):
    ids, sizes = encoder.encode(Block(pa.array(texts, pa.string())))
    want = [PLAIN.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sizes.tolist() == [len(w) for w in want]
    assert ids.tolist() == [i for w in want for i in w]


@pytest.mark.parametrize("seed", range(4))
def test_odd_characters(seed):
    rng = random.Random(seed)
    encoder = bpe.Encoder(bpe.default_tokenizer())
    for _ in range(5):
        texts = ["".join(rng.choices(ODD, k=rng.randint(0, 40))) for _ in range(1500)]
        texts[3] = None
        same_as_whole(texts, encoder)  # later ones find some stretches known


def test_every_pair_and_triple_of_odd_strings():
    encoder = bpe.Encoder(bpe.default_tokenizer())
    same_as_whole([a + b for a in ODD for b in ODD], encoder)
    some = [x for x in ODD if x in ("a", "é", "×", "文", "'s", "0", ",", " ", "  ", "\n", "\t", "\xa0", "\x85", "\u0301")]
    same_as_whole([f"x{a}{b}{c}y" for a in some for b in some for c in some], encoder)


def test_no_texts():
    for texts in ([], [None], ["", None, ""], ["\n"], ["", "a", ""]):
        same_as_whole(texts, bpe.Encoder(bpe.default_tokenizer()))


def test_few_strings_reach_the_tokenizer():
    """Words are encoded once whatever sign or line feed follows them, and many in one string."""
    words, signs = [a + b + c for a in "bdfgklmnprst" for b in "aeiouéü" for c in "lmnrst"], [",", ".", "!", "?", ";", ":", ")", "?!", ".\nThe", '"', ""]
    texts = [" ".join(w + s for w in words) + " end" for s in signs]
    encoder, seen = bpe.Encoder(bpe.default_tokenizer()), []

    class Counting:
        def encode_batch_fast(self, strings, **how):
            seen.extend(strings)
            return PLAIN.encode_batch_fast(strings, **how)

    encoder._tokenizer = Counting()
    same_as_whole(texts, encoder)
    assert sum(map(len, seen)) < 2 * sum(len(w) + 2 for w in words)
    assert len(seen) < len(words) / 10


def test_unjoined_when_line_feeds_do_not_tell_apart():
    encoder = bpe.Encoder(bpe.default_tokenizer())
    encoder._line_feed = PLAIN.encode(",").ids
    same_as_whole(["some words of a text", "other words, of another"], encoder)


def test_windows_are_filled_in_order_of_score():
    """Each window takes the best unused rests, ties by place, as a full ranking gives them."""
    rng = np.random.default_rng(3)
    rests = [rng.integers(0, 40, n).astype(np.uint16) for n in rng.integers(1, 50, 200)]
    rests += [rests[5]] * 7 + [np.array([50 + k], np.uint16) for k in range(9)]  # equal scores, and none at all
    index = packing.Index(rests, np.linspace(0.1, 5, packing.VOCABULARY), float(np.mean([len(r) for r in rests])))
    unused, seed, want = list(range(len(rests))), None, []
    while unused or seed:
        row, begin = seed or (unused.pop(0), 0)
        window, free, seed = [(row, begin, len(rests[row]))], 128 - len(rests[row]) + begin, None
        score = index.scores(row)
        for other in sorted(unused, key=lambda r: (-score[r], r)):
            if not free:
                break
            unused.remove(other)
            take = min(free, len(rests[other]))
            window.append((other, 0, take))
            free -= take
            seed = (other, take) if take < len(rests[other]) else None
        want.append(window)
    assert list(packing.fill(rests, index, 128)) == want
