"""Toxicity, decontamination, line dedup, personal data, token counts."""

import random
import re
from fractions import Fraction

import brute
import pytest
from oracle import difference, duckdb_tables

from tripstar.llm import decontamination, line_dedup, oracle_sql, pii, queries, token_counts, toxicity

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(oracle_sql.all_sql()))
def test_oracle(spark, name):
    assert difference(queries.all_queries()[name](spark, SF), duckdb_tables(SF), oracle_sql.all_sql()[name]) == ""


# toxicity


def test_fold():
    assert toxicity.fold("Idiоt, 1D1OT! Ｉdiot i$h don't") == " idiot idiot idiot ish don t "
    assert toxicity.fold(None) == toxicity.fold("") == " "


def test_exceptions_and_beginnings():
    matcher = toxicity.Matcher({" clown ": 3.0, " mor": 1.0, " moron ": 2.0})
    assert list(matcher.words(" class clown ").values()) == []
    assert list(matcher.words(" a clown and morons and moron ").values()) == [3.0, 1.0, 2.0]


def test_toxicity_learns(spark, frame):
    rng = random.Random(3)
    plain = [f"w{k}" for k in range(300)]
    rows, labels = [], []
    for i in range(300):
        words = rng.choices(plain, k=60)
        if i % 5 == 0:
            words[::12] = ["zorkblat"] * 5
        rows.append((i, " ".join(words)))
        labels.append((i, int(i % 5 == 0)))
    labels += [(None, 1), (7, None), (99999, 1)]
    model = toxicity.fit(frame(rows[:200]), spark.createDataFrame(labels, "doc_id bigint, toxic int"))
    scored = toxicity.score(frame([*rows[200:], (1000, None), (1001, "")]), model).collect()
    assert len(scored) == 102 and all(0 <= r.score <= 1 for r in scored)
    for r in scored:
        assert (r.score >= 0.7) == (r.doc_id < 1000 and r.doc_id % 5 == 0)


def test_toxicity_without_labels(spark, frame, odd_rows):
    model = toxicity.fit(frame(odd_rows), spark.createDataFrame([], "doc_id bigint, toxic int"))
    assert {r.score for r in toxicity.score(frame(odd_rows), model).collect()} == {0.5}
    assert toxicity.score(frame([]), model).count() == 0


def test_toxicity_held_out(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    held = [(r.predicted, labels[r.doc_id]) for r in queries.op1_toxicity(spark, sf).collect() if r.held_out and r.doc_id in labels]
    hits = sum(p and y for p, y in held)
    assert hits >= 0.75 * sum(y for _, y in held) and hits >= 0.9 * sum(p for p, _ in held)


# decontamination


def test_windows(frame, spark):
    rng = random.Random(1)
    items = [(k, " ".join(rng.choices("abcdef", k=n))) for k, n in enumerate([0, 1, 3, 9, 10, 11, 30])] + [(50, None), (51, "Same Words, twice"), (52, "same words twice")]
    docs = [(k, " ".join(rng.choices("abcdef", k=rng.randint(0, 60)))) for k in range(60)]
    docs += [(100, "x " + items[6][1].upper() + " y"), (101, "SAME-words: twice! same words"), (102, None), (102, None)]
    benchmark = spark.createDataFrame(items, "item_id bigint, text string")
    got = decontamination.decontaminate(frame(docs), benchmark).collect()
    assert sorted((r.doc_id, r.n_words, r.n_hit, tuple(sorted(map(str, r["items"])))) for r in got) == sorted(brute.decontaminated(docs, items))


def test_phrases_and_proximity(frame):
    docs = [(1, "the quick brown fox jumps"), (2, "the quick and brown fox"), (3, "fox brown quick")]
    exact = {r.doc_id: r["items"] for r in decontamination.find_phrases(frame(docs), ["quick brown fox", "fox jumps"]).collect()}
    assert exact == {1: [0, 1], 2: [], 3: []}
    near = {r.doc_id: r["items"] for r in decontamination.find_phrases(frame(docs), ["quick brown fox"], slack=1).collect()}
    assert near == {1: [0], 2: [0], 3: []}


def test_decontamination_odd(spark, frame, odd_rows):
    empty = spark.createDataFrame([], "item_id bigint, text string")
    got = decontamination.decontaminate(frame(odd_rows), empty).collect()
    assert len(got) == len(odd_rows) and all(r.n_hit == 0 for r in got)
    some = spark.createDataFrame([(1, "wort wort"), (None, "text")], "item_id bigint, text string")
    got = decontamination.decontaminate(frame(odd_rows), some).collect()
    want = brute.decontaminated(odd_rows, [(1, "wort wort")])
    assert sorted((r.doc_id or -1, r.n_words, r.n_hit) for r in got) == sorted((i or -1, n, h) for i, n, h, _ in want)
    assert decontamination.decontaminate(frame([]), some).count() == 0
    with pytest.raises(ValueError):
        decontamination.decontaminate(frame([]), some, limit=3)


# line dedup


def test_lines(frame):
    rng = random.Random(2)
    pool = [f"line number {k} of the pool" for k in range(40)] + ["short", "", "  Padded line of the pool \t", "padded LINE of the pool"]
    docs = [(k, "\n".join(rng.choices(pool, k=rng.randint(0, 12)))) for k in range(150)]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_lines(frame(docs)).collect()}
    assert got == brute.lines_left(docs)


def test_lines_in_rounds(frame, monkeypatch):
    monkeypatch.setattr(line_dedup, "SEGMENT_LINES", 64)
    docs = [(k, f"a line that many share\nown line of document {k}\nline of the pair {k // 2}") for k in range(200)]
    got = {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in line_dedup.drop_lines(frame(docs), round_bytes=1).collect()}
    assert got == brute.lines_left(docs)


def test_lines_odd(frame, odd_rows):
    got = line_dedup.drop_lines(frame(odd_rows), keep=("key", "rest")).collect()
    assert len(got) == len(odd_rows) and {r.rest.key for r in got} == {"clash"}
    named = {(i, t) for i, t in odd_rows if i is not None}
    want = brute.lines_left(named)
    assert {r.doc_id: (r.n_lines, r.n_dropped, r.text) for r in got if r.doc_id is not None} == want
    assert sorted(r.text for r in got if r.doc_id is None) == sorted(t or "" for i, t in odd_rows if i is None)
    assert line_dedup.drop_lines(frame([])).count() == 0


# personal data


def test_base_spans():
    rng = random.Random(1)
    parts = ["1", "2", "34", "255", "256", " ", "-", ".", "@", "a", "b.c", "+", "(", ")", "é", "4111111111111111", "x@y.z", "0"]
    for _ in range(5000):
        text = "".join(rng.choice(parts) for _ in range(rng.randint(0, 24)))
        assert [(s.kind, s.start, s.end) for s in pii.find(text) if s.kind in pii.BASE] == brute.personal(text), text


def test_added_spans():
    kinds = {s.kind for s in pii.find("IBAN DE89 3704 0044 0532 0130 00, SSN 123-45-6789, phone 555-123-4567")}
    assert kinds == {"iban", "ssn", "local_phone"}
    assert pii.find("DE89 3704 0044 0532 0130 01 and 555-123-4567 and 000-12-3456") == []
    assert pii.masked("write to a@b.org now") == "write to [email] now" and pii.masked(None) is None


def test_personal_data_odd(frame, odd_rows):
    got = pii.find_personal_data(frame(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    assert sorted(len(r.spans) for r in got)[-1] == 4
    long = "9" * 200_000 + " " + "a" * 200_000 + " 1." * 1000
    assert pii.find(long) == []


# token counts


def test_rollup(spark, frame):
    rollup = token_counts.Rollup(spark)
    old = token_counts.counted(frame([(1, "a b c"), (2, "d"), (3, None)]), ["words-1"])
    assert rollup.commit("one", token_counts.inserted(old)) and not rollup.commit("one", token_counts.inserted(old))
    new = token_counts.counted(frame([(1, "a b")]), ["words-1"])
    rollup.commit("two", token_counts.revised(old.where("doc_id = 1"), new))
    assert [(r.n_docs, r.n_tokens) for r in rollup.totals().collect()] == [(3, 3)]
    # rows of an attempt that was never recorded
    token_counts.inserted(old).write.parquet(rollup._delta("three", "lost"))
    again = token_counts.Rollup(spark, rollup.folder)
    again.commit("four", token_counts.deleted(old.where("doc_id > 1")))
    assert [(r.n_docs, r.n_tokens) for r in again.totals().collect()] == [(1, 2)]
    again.commit("five", token_counts.deleted(new))
    again.commit("six", token_counts.deleted(new.limit(0)))
    assert again.totals().count() == 0


def test_rollup_batch_names_and_compaction(spark, frame, monkeypatch):
    monkeypatch.setattr(token_counts, "COMPACT_AFTER", 3)
    rollup = token_counts.Rollup(spark)
    counts = token_counts.inserted(token_counts.counted(frame([(1, "a b c")]), ["words-1"])).cache()
    names = ["a/b", "x=1 y:z%", "", "..", "none", "ü" * 300, "a"]
    for k, name in enumerate(names):
        assert rollup.commit(name, counts)
        assert [(r.n_docs, r.n_tokens) for r in rollup.totals().collect()] == [(k + 1, 3 * k + 3)]
    assert rollup._generation() == 2 and len(rollup._later(2)) == 1
    # held batches stay recorded, and a generation that broke off before its list doesn't count
    counts.write.parquet(f"{rollup.folder}/totals/3")
    again = token_counts.Rollup(spark, rollup.folder)
    assert not any(again.commit(name, counts) for name in names)
    assert [(r.n_docs, r.n_tokens) for r in again.totals().collect()] == [(7, 21)]
    again.compact()
    again.compact()
    assert again._generation() == 3 and again._later(3) == []
    assert [(r.n_docs, r.n_tokens) for r in again.totals().collect()] == [(7, 21)]


def test_corpus_history_odd(spark, frame, odd_rows):
    rollup = token_counts.Rollup(spark)
    got = token_counts.corpus_history(frame(odd_rows), "long", ["words-1"], rollup).collect()
    seen, docs, tokens = {}, 0, 0
    for i, t in odd_rows:
        if t is not None and i is not None:
            seen[t] = min(seen.get(t, i), i)
    for i, t in odd_rows:
        if t is None or i is None or seen[t] >= i:
            docs, tokens = docs + 1, tokens + len(re.findall(r"[^\x20\x09-\x0D]+", (t or "").replace("long", "")))
    assert [(r.n_docs, r.n_tokens) for r in got] == [(docs, tokens)]
    assert token_counts.corpus_history(frame([]), "long", ["words-1"], token_counts.Rollup(spark)).count() == 0


def test_token_counters(frame, odd_rows):
    from tokenizers import Tokenizer

    from tripstar.llm.bpe import default_tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    got = token_counts.counted(frame(odd_rows), list(token_counts.COUNTERS)).collect()
    for name, count in (("words-1", lambda t: len(brute.spaced(t))), ("words-2", lambda t: len(brute.alphanumeric(t))), ("byte_bpe_50k", lambda t: len(tokenizer.encode(t or "", add_special_tokens=False).ids))):
        assert sorted((r.doc_id or -1, r.n_tokens) for r in got if r.tokenizer == name) == sorted((i or -1, count(t)) for i, t in odd_rows)


def test_fraction_default():
    from tripstar.llm import minhash

    assert minhash.near_duplicates.__defaults__[0] == Fraction(4, 5)
