"""Texts whose polynomial hashes modulo 2**64 are equal: the doubling sequence and its complement."""

import numpy as np
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from tripstar.llm import decontamination, kneser_ney, line_dedup, minhash, text, token_counts
from tripstar.llm.bpe import default_tokenizer, encoder


def doubled(steps):
    s, t = "a", "b"
    for _ in range(steps):
        s, t = s + t, t + s
    return s, t


PAIRS = [doubled(10), doubled(11), doubled(14)]


def test_spans_against_python():
    raw = "Ab c é ".encode() + b"x" * 63 + b" " + b"x" * 64 + b" " + b"x" * 65 + b" " + b"X" * 65 + b" ab x"
    block = text.Block(pa.array([raw.decode()]))
    starts, ends, _ = block.words(text.NOT_SPACE)
    words = [raw[a:b].lower() for a, b in zip(starts, ends, strict=True)]
    hashes = block.word_hashes(text.NOT_SPACE)[0].tolist()
    assert len(set(hashes)) == len(set(words))
    assert len(set(zip(words, hashes, strict=True))) == len(set(words))
    assert len(text.span_hashes(np.zeros(0, np.uint8), np.zeros(0, np.int64), np.zeros(0, np.int64))) == 0


@pytest.mark.parametrize("pair", PAIRS)
def test_words_differ(pair):
    hashes = text.Block(pa.array(pair)).word_hashes(text.NOT_SPACE)[0]
    assert hashes[0] != hashes[1]


@pytest.mark.parametrize("pair", PAIRS[:2])
def test_lines(frame, pair):
    s, t = pair
    docs = [(1, s), (2, f"{s}\n{t}"), (3, "something else")]
    got = {r.doc_id: (r.n_dropped, r.text) for r in line_dedup.drop_lines(frame(docs)).collect()}
    assert got == {1: (0, s), 2: (1, t), 3: (0, "something else")}


@pytest.mark.parametrize("pair", PAIRS[:2])
def test_phrases(spark, frame, pair):
    s, t = pair
    items = spark.createDataFrame([(7, s)], "item_id bigint, text string")
    got = {r.doc_id: (r.n_hit, list(r["items"])) for r in decontamination.decontaminate(frame([(1, s), (2, t)]), items).collect()}
    assert got == {1: (1, [7]), 2: (0, [])}


def test_near_duplicates(frame):
    s, t = PAIRS[0]
    got = {r.doc_id: (r.component_id, r.n_shingles) for r in minhash.near_duplicates(frame([(1, f"{s} b c d e"), (2, f"{t} b c d e")])).collect()}
    assert got == {1: (1, 1), 2: (2, 1)}


def test_token_ids(frame):
    s, t = PAIRS[0]
    plain = Tokenizer.from_file(default_tokenizer())
    ids, sizes = encoder(default_tokenizer()).encode(text.Block(pa.array([s, t])))
    wanted = [plain.encode(x, add_special_tokens=False).ids for x in (s, t)]
    assert sizes.tolist() == [len(w) for w in wanted]
    assert ids.tolist() == wanted[0] + wanted[1]
    got = {r.doc_id: r.n_tokens for r in token_counts.counted(frame([(1, s), (2, t)]), ["byte_bpe_50k"]).collect()}
    assert got == {1: len(wanted[0]), 2: len(wanted[1])}


def test_known_words(frame):
    s, t = PAIRS[0]
    model = kneser_ney.fit(frame([(1, s)]))
    got = {r.doc_id: r.n_known for r in kneser_ney.score(frame([(1, s), (2, t)]), model).collect()}
    assert got == {1: 2, 2: 1}  # the end is known
