"""Suffix dedup, near-dedup, packing, neighbours, language model, pipeline."""

import collections
import math
import os
import random
import zlib
from fractions import Fraction

import brute
import corpus_pipeline
import numpy as np
import pyarrow as pa
import pytest

from tripstar.llm import kneser_ney, minhash, neighbours, packing, suffix_dedup, tables
from tripstar.llm.bpe import default_tokenizer
from tripstar.llm.components import components
from tripstar.session import settings

SF = "/root/testdata/sf0.001"


# suffix dedup


def test_suffix_array():
    rng = random.Random(1)
    for n in (0, 1, 2, 50, 400):
        data = bytes(rng.choices(b"ab", k=n))
        assert suffix_dedup.suffix_array(data).tolist() == sorted(range(n), key=lambda k: data[k:])
    assert suffix_dedup.suffix_array(b"a" * 300).tolist() == list(range(299, -1, -1))


def removed(df):
    return {r.doc_id: (r.n_bytes, r.n_bytes - len(r.kept), len(r.spans) // 2, bytes(r.kept)) for r in df.collect()}


@pytest.mark.parametrize("small", [False, True])
def test_repeats(frame, monkeypatch, small):
    if small:
        monkeypatch.setattr(suffix_dedup, "TASK_BYTES", 300)
        monkeypatch.setattr(suffix_dedup, "CHUNK_ROWS", 16)
    rng = random.Random(4)
    passages = ["".join(rng.choices("abcdefghij é", k=rng.randint(60, 260))) for _ in range(12)]
    docs = []
    for i in range(80):
        parts = [rng.choice(passages)[rng.randint(0, 30) :] if rng.random() < 0.6 else "".join(rng.choices("klmnopqr ", k=rng.randint(0, 120))) for _ in range(rng.randint(0, 6))]
        docs.append((i * 7 % 80, "".join(parts)))
    docs += [(200, "z" * 900), (201, "ab" * 300), (202, "ab" * 300 + "!"), (203, "z" * 99), (204, None), (205, "")]
    assert removed(suffix_dedup.remove_repeats(frame(docs))) == brute.unrepeated(docs)


def test_repeats_odd(frame, odd_rows):
    got = suffix_dedup.remove_repeats(frame(odd_rows)).collect()
    assert len(got) == len(odd_rows)
    shorter = [(i, t[-2000:] if t else t) for i, t in odd_rows]
    named = {(i, t) for i, t in shorter if i is not None}
    assert {k: v for k, v in removed(suffix_dedup.remove_repeats(frame(shorter))).items() if k is not None} == brute.unrepeated(named)
    assert all(bytes(r.kept).decode() == (t or "") for r, t in zip(sorted((r for r in got if r.doc_id is None), key=lambda r: r.n_bytes), sorted((t or "" for i, t in odd_rows if i is None), key=len), strict=True))
    assert suffix_dedup.remove_repeats(frame([])).count() == 0


# near-dedup


@pytest.mark.parametrize("hot", [8, 256])
def test_repeats_at_the_edges_of_a_passage(spark, frame, monkeypatch, hot):
    rng, most = random.Random(4), []
    passage = "".join(rng.choices("abcdefgh ", k=400))
    docs = [(k, "".join(rng.choices("ijklmnop ", k=150)) + passage + "".join(rng.choices("qrstuvw ", k=150))) for k in range(600)]
    docs += [docs[5], docs[6], (700, docs[7][1]), (None, passage)]
    inner = suffix_dedup._sorted_repeats

    def counted(classes, length):
        classes = tables.stored(classes)
        most.append(classes.groupBy("anchor").count().agg({"count": "max"}).first()[0])
        return inner(classes, length)

    monkeypatch.setattr(suffix_dedup, "HOT_CLASSES", hot)
    monkeypatch.setattr(suffix_dedup, "_sorted_repeats", counted)
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "50" if hot == 8 else "10000"}):  # anchors over several batches
        got = removed(suffix_dedup.remove_repeats(frame(docs)))
    assert {i: r for i, r in got.items() if i is not None} == brute.unrepeated({(i, t) for i, t in docs if i is not None})
    assert most[0] <= hot  # not a class for each document


def test_components(spark):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(40)] + [(100, k) for k in range(101, 160)] + [tuple(rng.sample(range(200, 300), 2)) for _ in range(60)] + [(7, 7)]
    graph = collections.defaultdict(set)
    for a, b in edges:
        graph[a].add(b)
        graph[b].add(a)
    want = {}
    for node in sorted(graph):
        if node not in want:
            stack = [node]
            while stack:
                x = stack.pop()
                if x not in want:
                    want[x] = node
                    stack.extend(graph[x])
    got = {r.node: r.component for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def families(rng, n):
    docs = []
    for _ in range(n):
        base = [f"w{rng.randint(0, 4000)}" for _ in range(rng.randint(8, 90))]
        for _ in range(rng.randint(1, 9)):
            own = list(base)
            for _ in range(rng.randint(0, 4)):
                own[rng.randrange(len(own))] = f"x{rng.randint(0, 999)}"
            docs.append(" ".join(own))
    rng.shuffle(docs)
    return [(3 * k + 1, t) for k, t in enumerate(docs)]


@pytest.mark.parametrize("block", [512, 8])
def test_near_duplicates(frame, monkeypatch, block):
    monkeypatch.setattr(minhash, "BLOCK", block)
    docs = [*families(random.Random(6), 60), (2000, "a b c"), (2001, "A  B\nc"), (2002, None), (2003, ""), (2004, "a b c d")]
    for share in (Fraction(85, 100), Fraction(4, 5)):
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(docs), threshold=share).collect()}
        assert got == brute.near_groups(docs, share.numerator, share.denominator)


def test_near_duplicates_shuffled_scan(frame, monkeypatch):
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 0)
    docs = families(random.Random(7), 15)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(frame(docs)).collect()}
    assert got == brute.near_groups(docs, 4, 5)


def test_near_duplicates_odd(frame, odd_rows):
    got = minhash.near_duplicates(frame(odd_rows)).collect()
    assert len(got) == len(odd_rows) and all(r.component_id is None for r in got if r.doc_id is None)
    want = brute.near_groups([(i, t) for i, t in odd_rows if i is not None], 4, 5)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got if r.doc_id is not None} == want
    assert minhash.near_duplicates(frame([])).count() == 0


# packing


def check_packed(rows, docs, window):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(default_tokenizer())
    ids = collections.defaultdict(list)
    for i, t in docs:
        ids[i].append([*tokenizer.encode(t or "", add_special_tokens=False).ids, 0])
    pieces, sequences = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        pieces[r.doc_id].append(r)
        sequences[r.sequence_id].append(r)
        own = np.frombuffer(r.ids, np.uint16)
        assert len(own) == r.length and zlib.crc32(own.astype("<u4").tobytes()) == r.ids_crc32
        assert any(len(x) == r.doc_tokens and x[r.start : r.start + r.length] == own.tolist() for x in ids[r.doc_id])
    for i, lists in ids.items():
        assert sum(r.length for r in pieces[i]) == sum(map(len, lists))
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += window - at
    return padding


def test_packing(spark):
    docs = [(r.doc_id, r.text) for r in tables.documents(spark, SF).collect()]
    rows = packing.pack(tables.documents(spark, SF), window=256, shard=64).collect()
    assert check_packed(rows, docs, 256) <= 256 * (8 + len(docs) / 64)


def test_packing_prefers_neighbours(frame):
    rng = random.Random(8)
    topics = [
        "river mountain forest valley lake stone tree snow cloud rain wind grass".split(),
        "market price bank money trade stock credit loan profit tax wage cost".split(),
        "goal team match player coach league score ball win season cup fans".split(),
    ]
    docs = [(k, " ".join(rng.choices(topics[k % 3], k=60))) for k in range(60)]
    rows = packing.pack(frame(docs, partitions=1), window=512, shard=1000).collect()
    together = collections.defaultdict(list)
    for r in rows:
        together[r.sequence_id].append(r.doc_id % 3)
    same = sum(collections.Counter(x).most_common(1)[0][1] for x in together.values())
    assert same > 0.6 * len(rows)


def test_packing_odd(frame, odd_rows):
    check_packed(packing.pack(frame(odd_rows)).collect(), odd_rows, 1024)
    assert packing.pack(frame([])).count() == 0


# neighbours


def test_retrieval_scores():
    """BM25 of the index against the formula, worked out rest by rest."""
    rng = np.random.default_rng(7)
    rests = [rng.zipf(1.4, n).astype(np.uint16) % 300 for n in rng.integers(1, 60, 40)]
    seen = np.bincount(np.concatenate([np.unique(r) for r in rests]), minlength=packing.VOCABULARY)
    idf = np.log(1 + (len(rests) - seen + 0.5) / (seen + 0.5))
    average = sum(map(len, rests)) / len(rests)
    index = packing.Index(rests, idf, average)

    def weight(term, rest):
        tf = int((rest == term).sum())
        return idf[term] * tf * (packing.K1 + 1) / (tf + packing.K1 * (1 - packing.B + packing.B * len(rest) / average))

    for row in range(len(rests)):
        terms = sorted(set(rests[row].tolist()), key=lambda t: (-weight(t, rests[row]), t))[: packing.QUERY_TERMS]
        assert index.scores(row) == pytest.approx([sum(weight(t, r) for t in terms) for r in rests])


def test_keys_bring_rare_ids_together():
    """Rests that share their rare ids get equal keys far more often than those that share a frequent one."""
    idf, frequency = np.full(packing.VOCABULARY, 6.0), np.full(packing.VOCABULARY, 100)
    idf[:10], frequency[:10] = 0.03, 100_000
    numbers = packing.marks(idf, frequency)
    rng = np.random.default_rng(8)
    rare = rng.integers(10, packing.VOCABULARY, (500, 12))
    common = np.arange(10)

    def agree(a, b):
        return np.mean([n[x].min() == n[y].min() for n in numbers for x, y in zip(a, b, strict=True)])

    with_common = [np.concatenate([r, common]) for r in rare]
    assert agree(rare, with_common) > 0.95
    assert agree(with_common[1:], with_common[:-1]) < 0.05


def test_hilbert_curve_is_a_curve():
    cells = np.stack(np.meshgrid(*[np.arange(8)] * 3, indexing="ij"), -1).reshape(-1, 3)
    keys = neighbours.hilbert_keys(cells, 3)
    path = cells[np.argsort(keys)]
    assert sorted(keys.tolist()) == list(range(512)) and (np.abs(np.diff(path, axis=0)).sum(1) == 1).all()


def exact(rows, step, k):
    good = [(i, np.array(v, float)) for i, v in rows if i is not None and v is not None and len(v) == 8 and all(x is not None and math.isfinite(x) for x in v) and any(v)]
    return {i: sorted(((-float(x @ y), j) for j, y in good if j != i))[:k] for i, x in good if i % step == 0}


def test_neighbours(spark):
    rng = np.random.default_rng(9)
    rows = [(k, (rng.standard_normal(8) * rng.uniform(0.2, 3)).astype(np.float32).tolist()) for k in range(700)]
    same = rng.standard_normal(8).astype(np.float32).tolist()
    rows += [(1000 + k, same) for k in range(200)]
    rows += [(3000, None), (3010, []), (3020, [0.0] * 8), (3030, [1.0] * 7 + [None]), (3040, [math.nan] * 8), (3050, [1.0] * 3), (None, same), (1000, same)]
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").selectExpr("*", "1 AS point", "2 AS v", "3 AS score").repartition(5)
    found = collections.defaultdict(list)
    for r in neighbours.nearest(df, lambda i: i % 10 == 0, k=7, curves=32, window=64).collect():
        found[r.query_id].append(r)
    want, hits = exact(dict(rows).items(), 10, 7), 0
    assert set(found) == set(want)
    for q, best in want.items():
        own = sorted(found[q], key=lambda r: r.rank)
        assert [r.rank for r in own] == list(range(1, 8))
        assert [(-r.score, r.vec_id) for r in own] == sorted((-r.score, r.vec_id) for r in own)
        hits += len({r.vec_id for r in own} & {j for _, j in best})
    assert hits >= 0.95 * 7 * len(want)
    for r in found[1000]:
        assert r.score == pytest.approx(-want[1000][r.rank - 1][0], abs=1e-9) and r.vec_id == want[1000][r.rank - 1][1]


def test_few_vectors(spark):
    schema = "vec_id bigint, embedding array<double>"
    few = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.5, 0.5]), (20, [-1.0, 2.0])], schema)
    got = [(r.query_id, r.rank, r.vec_id, r.score) for r in neighbours.nearest(few, lambda i: i % 20 == 0).orderBy("query_id", "rank").collect()]
    assert got == [(0, 1, 1, 0.5), (0, 2, 20, -1.0), (20, 1, 1, 0.5), (20, 2, 0, -1.0)]
    assert neighbours.nearest(spark.createDataFrame([], schema), lambda i: i % 20 == 0).count() == 0
    assert neighbours.nearest(few.limit(1), lambda i: i % 20 == 0).count() == 0


def test_recall(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    x = {r.vec_id: np.array(r.embedding, float) for r in vectors.collect()}
    ids = np.array(sorted(x))
    points = np.stack([x[i] for i in ids])
    found = collections.defaultdict(set)
    for r in neighbours.nearest(vectors, lambda i: i % 20 == 0).collect():
        found[r.query_id].add(r.vec_id)
    hits = 0
    for q in found:
        s = points @ x[q]
        s[ids == q] = -np.inf
        hits += len(found[q] & set(ids[np.argsort(-s)[:20]].tolist()))
    assert hits >= 0.95 * 20 * len(found)


def test_window_follows_the_sample(spark):
    """Points without structure: a window far too small is widened until the sample is found."""
    rng = np.random.default_rng(12)
    x = rng.standard_normal((6000, 24))
    x /= np.sqrt((x * x).sum(1))[:, None]
    vectors = spark.createDataFrame(list(enumerate(x.tolist())), "vec_id bigint, embedding array<double>").repartition(6)
    products = x @ x.T
    np.fill_diagonal(products, -np.inf)

    def share(sample):
        found = neighbours.nearest(vectors, lambda i: i % 50 == 0, k=10, curves=4, window=4, sample=sample).collect()
        return sum(r.vec_id in set(np.argsort(-products[r.query_id])[:10].tolist()) for r in found) / (120 * 10)

    assert share(0) < 0.8 and share(64) >= 0.93


# language model


@pytest.mark.parametrize(("order", "shard_tokens"), [(1, 50), (2, 50), (3, kneser_ney.SHARD_TOKENS), (3, 50), (4, 400)])
def test_language_model(frame, order, shard_tokens):
    rng = random.Random(10)
    texts = [" ".join(f"w{int(rng.paretovariate(0.9)) % 200}" for _ in range(rng.randint(0, 40))) for _ in range(150)] + [None, "", "W1 w2"]
    model = kneser_ney.fit(frame(list(enumerate(texts))), order, shard_tokens=shard_tokens)
    plain = brute.KneserNey(texts, order)
    assert (model.tokens, model.types) == (sum(plain.count.values()), len(plain.count))
    others = [*texts[:20], "unknown words w1", None]
    rows = {r.doc_id: r for r in kneser_ney.score(frame(list(enumerate(others))), model).collect()}
    for i, t in enumerate(others):
        tokens = plain.tokens(t)
        assert (rows[i].n_tokens, rows[i].n_known) == (len(tokens), sum(plain.count[x] > 0 for x in tokens))
        assert rows[i].score == pytest.approx(plain.score(t), rel=1e-9) and rows[i].base_score == pytest.approx(plain.base(t), rel=1e-9)


@pytest.mark.parametrize("order", [1, 2, 3, 4])
def test_model_is_a_distribution(frame, order):
    model = kneser_ney.fit(frame([(0, "a b a c a b"), (1, "b c b a")]), order)
    words = ["a", "b", "c", "never"]
    tokens = [kneser_ney.tokens_of(kneser_ney.Block(pa.array([w])))[0][0] for w in words] + [kneser_ney.END]
    for before in (tokens[:1], tokens[1:3], tokens[3:4]):
        text = [np.array([*before, w], np.uint64) for w in tokens]
        last = [kneser_ney.log_probabilities(model, t, np.array([len(t)]))[1][-1] for t in text]
        assert sum(10**x for x in last) == pytest.approx(1.0)


def test_folded_rows():
    rng = np.random.default_rng(4)
    for n, width in ((1, 1), (300, 2), (3000, 4)):
        columns, counts = kneser_ney.distinct([rng.integers(0, 9, n).astype(np.uint64) for _ in range(width)], rng.integers(1, 400, n))
        back, again = kneser_ney.unfolded(kneser_ney.folded(columns, counts, 5), 5)
        assert all((x == y).all() for x, y in zip(columns, back, strict=True)) and (again == counts).all()


def test_counts_and_keys_of_a_file(tmp_path):
    rng = np.random.default_rng(5)
    keys = np.unique(rng.integers(0, 1 << 63, 5000).astype(np.uint64) * np.uint64(2))
    values = np.where(rng.random(len(keys)) < 0.1, rng.integers(250, 1 << 40, len(keys)), rng.integers(1, 256, len(keys)))
    table = np.column_stack([values % 7, values % 400])
    for whole in (False, True):
        for n in (0, 1, 20, len(keys)):
            by, arrays = kneser_ney.key_arrays(keys[:n][::-1], whole)
            kneser_ney.save(str(tmp_path), "k", 0, arrays | kneser_ney.count_arrays(values[:n][::-1][by]))
            kneser_ney.save(str(tmp_path), "r", 0, arrays | kneser_ney.row_arrays(table[:n][::-1][by]))
            model = kneser_ney.Model(str(tmp_path), 2, 1, 0, 0, {}, (), (0, 0, 0), 0, frozenset([("k", 0), ("r", 0)]))
            asked = np.concatenate([keys[:n], keys + np.uint64((1 << 40) + 1), keys[:n]])
            where = np.zeros(len(asked), np.int64)
            absent = [0] * len(keys)
            got = kneser_ney.Tables(model)
            assert got.look_up("k", asked, where)[:, 0].tolist() == [*values[:n], *absent, *values[:n]]
            assert (got.look_up("r", asked, where, 2) == np.concatenate([table[:n], np.zeros((len(keys), 2), int), table[:n]])).all()


def test_language_model_missing_file(frame, monkeypatch):
    texts = list(enumerate(["a b c a b", "b c d e", "c a b"] * 20))
    model = kneser_ney.fit(frame(texts), shard_tokens=50)
    whole = sorted(r.score for r in kneser_ney.score(frame(texts), model).collect())
    monkeypatch.setattr(kneser_ney, "MAPPED", 2)
    kneser_ney._TABLES.clear()
    have = kneser_ney.Tables(model)
    tokens, sizes = kneser_ney.tokens_of(kneser_ney.Block(pa.array([t for _, t in texts])))
    monkeypatch.setattr(kneser_ney, "tables", lambda m: have)
    _, log_p = kneser_ney.log_probabilities(model, tokens, sizes)
    assert np.allclose(sorted(np.add.reduceat(log_p, np.cumsum(sizes) - sizes)), whole)
    assert len(have._open) <= 2
    assert {k for k, _ in model.files} == {"word", "continuation", "gram2", "gram3", "context2", "context3", "spread2", "spread3"}
    for kind in ("word", "continuation", "gram2", "gram3", "context2", "context3", "spread3"):
        path = kneser_ney.file_of(model.folder, kind, min(s for k, s in model.files if k == kind))
        os.replace(path, path + ".away")
        have._open.clear()
        with pytest.raises(FileNotFoundError):
            kneser_ney.log_probabilities(model, tokens, sizes)
        os.replace(path + ".away", path)


def test_language_model_odd(frame, odd_rows):
    model = kneser_ney.fit(frame(odd_rows))
    got = kneser_ney.score(frame(odd_rows), model).collect()
    assert len(got) == len(odd_rows) and all(r.score <= 0 for r in got)
    nothing = kneser_ney.fit(frame([]))
    assert {(r.n_known, r.score, r.base_score) for r in kneser_ney.score(frame(odd_rows), nothing).collect()} == {(0, 0.0, 0.0)}
    assert kneser_ney.score(frame([]), model).count() == 0
    with pytest.raises(ValueError):
        kneser_ney.local_path("s3a://bucket/models")


# pipeline


def test_pipeline_stages(spark, frame):
    """Each stage against a plain version, on the output of the one before."""
    docs = tables.documents(spark, SF)
    kept = {r.doc_id: r.text for r in docs.collect()}
    benchmark = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = tables.stored(stage(spark, docs, SF))
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        now = {r.doc_id: r.text for r in docs.collect()}
        assert docs.count() == len(now)
        if name == "toxicity":
            assert set(now) < set(kept) and all(kept[i] == t for i, t in now.items())
        elif name == "line_dedup":
            assert now == {i: x[2] for i, x in brute.lines_left(kept.items()).items()}
            assert all(r.n_chars == len(r.text) for r in docs.collect())
        elif name == "near_dedup":
            assert now == {i: kept[i] for i, x in brute.near_groups(kept.items(), 4, 5).items() if x[1] == i}
        else:
            assert now == {i: kept[i] for i, _, hit, _ in brute.decontaminated(kept.items(), benchmark) if not hit}
        kept = now
    rows = packing.pack(docs).collect()
    check_packed(rows, list(kept.items()), 1024)
    last = corpus_pipeline.STAGES[-1][1](spark, docs, SF)
    assert {(r.doc_id, r.start, r.length) for r in last.collect()} == {(r.doc_id, r.start, r.length) for r in rows}


def test_pipeline_odd(spark, frame, odd_rows):
    docs = frame(odd_rows)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = tables.stored(stage(spark, docs, SF))
        assert docs.columns == frame(odd_rows).columns
    assert {None, 0, 1} <= {r.doc_id for r in docs.collect()}
    assert corpus_pipeline.STAGES[-1][1](spark, docs, SF).count() > 0
    docs = frame([], clash=False)
    for _, stage in corpus_pipeline.STAGES:
        docs = tables.stored(stage(spark, docs, SF))
        assert docs.count() == 0
