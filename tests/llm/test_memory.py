"""Python workers stay small from one stage of the pipeline to the next."""

import random
import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tripstar.llm import bpe, line_dedup, text, toxicity

BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def test_lines_need_few_bytes_for_each_byte():
    line = "a line of some words as texts have them, with é and 文字\n"
    block = text.Block(pa.array([line * 40] * 800))
    tracemalloc.start()
    line_dedup.Lines(block)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 16 * len(block.data)


def test_line_bounds_against_python():
    rng = random.Random(5)
    texts = ["".join(rng.choices(["a", "B", " ", "\t", "\r", "\x0b", "\n", "é", "文", " "], k=rng.randint(0, 30))) for _ in range(300)]
    texts[7] = None
    block = text.Block(pa.array(texts))
    lines = line_dedup.Lines(block)
    raw = block.data.tobytes()
    want = [line for t in texts for line in (t or "").split("\n")]
    keys = [w.strip(" \t\n\x0b\x0c\r") for w in want]
    assert [raw[a:b].decode() for a, b in zip(lines.starts, lines.ends, strict=True)] == want
    assert [raw[a:b].decode() for a, b in zip(lines.key_starts, lines.key_ends, strict=True)] == keys
    assert lines.lengths.tolist() == [len(k) for k in keys]
    assert np.bincount(lines.docs).tolist() == lines.counts.tolist()
    assert len(line_dedup.Lines(text.Block(pa.array([], pa.string()))).hashes) == 0


def test_encoder_goes_when_another_operator_begins():
    path = bpe.default_tokenizer()
    assert bpe.encoder(path) is bpe.encoder(path)
    text.forget()
    assert not text.KEPT


@pytest.mark.parametrize("module", [line_dedup, toxicity])
def test_texts_come_in_small_batches(spark, frame, monkeypatch, module):
    docs = frame([(k, f"line {k % 7} of the pool\n{'idiot' if k % 2 else 'friend'} number {k}") for k in range(40)])
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id bigint, toxic int")
    before, seen, stored = spark.conf.get(BATCH_BYTES), [], module.stored
    monkeypatch.setattr(module, "stored", lambda table: (seen.append(spark.conf.get(BATCH_BYTES)), stored(table))[1])
    if module is line_dedup:
        line_dedup.drop_lines(docs).count()
    else:
        toxicity.fit(docs, labels)
    assert "4m" in seen[0]
    assert spark.conf.get(BATCH_BYTES) == before
