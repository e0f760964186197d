"""Importance resampling, exact search and clustering against plain versions."""

import hashlib
import math
import random
import zlib

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from tripstar.llm import clustering, crc, pivot_search, resampling

# checksums


def test_checksums():
    rng = random.Random(1)
    words = [bytes(rng.choices(range(256), k=rng.choice([1, 2, 9, 63, 64, 65, 66, 127, 128, 129, 1000, 70000]))) for _ in range(200)]
    lengths = np.array([len(w) for w in words])
    ends = np.cumsum(lengths + 1) - 1
    got = crc.of_words(np.frombuffer(b" ".join(words), np.uint8), ends - lengths, ends)
    assert got.tolist() == [zlib.crc32(w) for w in words]
    for n, sums in enumerate(crc.runs(got, lengths, 4), 1):
        assert sums.tolist() == [zlib.crc32(b" ".join(words[k : k + n])) for k in range(len(words) - n + 1)]


# resampling


def plain_features(text, width, buckets):
    words = brute.alphanumeric(text)
    return [zlib.crc32(" ".join(words[k : k + n]).encode()) % buckets for n in range(1, width + 1) for k in range(len(words) - n + 1)]


def plain_resample(docs, items, percent, salt, least, width=2, buckets=10_000):
    """Sorted (doc_id, features, weight, score, rank)"""
    own = [plain_features(t, width, buckets) for _, t in docs]
    source, target = ([0] * buckets for _ in range(2))
    for counts, sets in ((source, own), (target, [plain_features(t, width, buckets) for t in items])):
        for fs in sets:
            for f in fs:
                counts[f] += 1
    gain = [math.floor(1000 * math.log((t + 1) * (sum(source) + buckets) / ((s + 1) * (sum(target) + buckets)))) for s, t in zip(source, target, strict=True)]
    rows = []
    for (i, text), fs in zip(docs, own, strict=True):
        h = int(hashlib.sha256(f"{salt}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[f] for f in fs) // len(fs) if fs else 0
        rows.append([i, len(fs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, len(brute.alphanumeric(text))])
    fit = sorted((r for r in rows if r[5] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    for place, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[4] = place
    return sorted((tuple(r[:5]) for r in rows), key=str)


def resampled(df):
    return sorted((tuple(r) for r in df.select("doc_id", "n_features", "weight", "score", "rank").collect()), key=str)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(5)
    near, far = [f"t{k}" for k in range(60)] + ["É한", "x" * 90], [f"s{k}" for k in range(90)]
    docs = [(i, " ".join(rng.choices(near if i % 3 else far, k=rng.randint(0, 60)))) for i in range(400)]
    return docs, [(f"i{k}", " ".join(rng.choices(near, k=30))) for k in range(20)]


@pytest.mark.parametrize("percent,least,width", [(25, 20, 2), (3, 0, 1), (100, 20, 3), (0, 20, 2), (25, 1000, 2)])
def test_resampling(spark, frame, corpus, percent, least, width):
    docs, items = corpus
    target = spark.createDataFrame(items, "item_id string, text string").withColumn("n", F.lit("clash"))
    got = resampling.resample(frame(docs), target, percent, 7, least, width=width, buckets=500, accuracy=50)
    assert resampled(got) == plain_resample(docs, [t for _, t in items], percent, 7, least, width, 500)


def test_bracket_is_widened(frame, spark):
    """A bad sketch costs passes, not results; equal scores are told apart by the ties."""
    rows = spark.range(3000).select("id", (F.col("id") % 3).cast("bigint").alias("score"))
    for wanted in (1, 700, 1001, 2999, 3000):
        chosen, _ = resampling.highest(rows, "score", [F.col("id")], wanted, 3000, accuracy=1)
        kept = sorted((-r.score, r.id) for r in rows.where(chosen).collect())
        assert kept == sorted((-(i % 3), i) for i in range(3000))[:wanted]


def test_resampling_odd(spark, frame, odd_rows):
    target = spark.createDataFrame([("a", None), ("b", "wort end")], "item_id string, text string")
    got = resampled(resampling.resample(frame(odd_rows), target, 50, 7, 20))
    want = plain_resample(odd_rows, [None, "wort end"], 50, 7, 20)
    ranks = sorted(r[4] for r in got if r[4])
    assert ranks == list(range(1, len(ranks) + 1))
    # rows of one doc_id have equal scores, so only the set of their ranks is fixed
    assert sorted(str(r[:4]) for r in got) == sorted(str(r[:4]) for r in want)
    assert ranks == sorted(r[4] for r in want if r[4])
    assert resampling.resample(frame([]), target, 50, 7, 20).count() == 0
    assert resampling.resample(frame(odd_rows), target.limit(0), 50, 7, 0).count() == len(odd_rows)


# vectors


def vectors(spark, rows, clash=True):
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>").repartition(3)
    for name in ("v", "point", "pivot", "distance", "cluster", "norm", "score", "shard", "e", "ids") if clash else ():
        df = df.withColumn(name, F.lit("clash"))
    return df


def some_vectors(n, dimensions=8, seed=3):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, dimensions)) * 2
    rows = [(int(i), [float(np.float32(x)) for x in (centres[rng.integers(6)] + rng.normal(size=dimensions) * (0.1 if i % 2 else 1.0))]) for i in rng.permutation(n)]
    return [(i, rows[0][1] if i % 5 == 0 else v) for i, v in rows]  # a fifth is one vector


NAN, INF = float("nan"), float("inf")
ODD_VECTORS = [(9001, None), (9002, []), (9003, [1.0] * 7 + [None]), (9004, [NAN] * 8), (9050, [INF] + [1.0] * 7), (None, [1.0] * 8), (9005, [1.0] * 3), (9100, [0.0] * 8)]


def plain_top(rows, every, k):
    kept = {i: [math.floor(256 * x) for x in v] for i, v in rows}
    out = []
    for q in (i for i in kept if i % every == 0):
        scored = sorted((-sum(a * b for a, b in zip(kept[q], v, strict=True)), i) for i, v in kept.items() if i != q)
        out += [(q, n, i, -s) for n, (s, i) in enumerate(scored[:k], 1)]
    return sorted(out)


@pytest.mark.parametrize("annulus,queries,pivots", [(16, 4, 7), (1024, 1024, 64), (1, 1, 1)])
def test_exact_search(spark, monkeypatch, annulus, queries, pivots):
    monkeypatch.setattr(pivot_search, "ANNULUS", annulus)
    monkeypatch.setattr(pivot_search, "QUERIES", queries)
    rows = some_vectors(300)
    odd = [*rows, *ODD_VECTORS, rows[0], rows[1], rows[1]]
    got = pivot_search.top_products(vectors(spark, odd), lambda i: i % 10 == 0, k=5, pivots=pivots)
    assert got.dtypes == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert sorted(map(tuple, got.collect())) == plain_top([*rows, ODD_VECTORS[-1]], 10, 5)


def test_exact_search_prunes(monkeypatch):
    """Annuli that cannot hold a better vector are not compared."""
    rng = np.random.default_rng(1)
    data = np.concatenate([c + rng.integers(-3, 4, (500, 8)) for c in rng.integers(-200, 200, (8, 8))]).astype(float)
    pivots = np.array([data[k * 500 : (k + 1) * 500].mean(0) for k in range(8)])
    rings = [pivot_search.Annulus(k, d.min(), d.max(), (v * v).sum(1).max(), v, np.arange(500) + 500 * k, np.arange(500) + 500 * k) for k in range(8) for v in [data[k * 500 : (k + 1) * 500]] for d in [pivot_search.distances(v, pivots[k : k + 1])]]
    seen = []
    plain = pivot_search.products
    monkeypatch.setattr(pivot_search, "products", lambda a, b: seen.append(a.shape[0] * b.shape[0]) or plain(a, b))
    q = data[::100]
    found = pivot_search.expand(rings, pivots, q, np.full(len(q), pivot_search.NOTHING), 5)
    scores = q @ data.T
    for row, (_, _, got) in zip(scores, found, strict=True):
        assert got.tolist() == sorted(row, reverse=True)[:5]
    assert sum(seen) < scores.size / 2


def test_exact_search_large_and_few(spark):
    big = [(i, [float(1 << 20) - i, -float(1 << 19) * i]) for i in range(4)]
    got = pivot_search.top_products(vectors(spark, big), lambda i: i % 50 == 0, k=5)
    assert sorted(map(tuple, got.collect())) == plain_top(big, 50, 5)
    for rows in ([], [(0, None)], [(50, [1.0])]):
        assert pivot_search.top_products(vectors(spark, rows), lambda i: i % 50 == 0).count() == 0
    with pytest.raises(Exception, match="beyond"):
        pivot_search.top_products(vectors(spark, [(0, [1e30]), (1, [1.0])]), lambda i: i % 50 == 0).count()


# clustering


def plain_kmeans(rows, k, rounds, salt, dimensions):
    """Sorted (vec_id, cluster, distance, own inertia, inertia, digest)"""
    data = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if v is not None and len(v) == dimensions and all(x is not None and math.isfinite(x) for x in v)]
    centres = [v for _, v in sorted((hashlib.sha256(f"{salt}:{'' if i is None else i}".encode()).hexdigest(), v) for i, v in data)[:k]]

    def nearest(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, c, strict=True)), n) for n, c in enumerate(centres))

    for _ in range(rounds):
        groups = {}
        for _, v in data:
            groups.setdefault(nearest(v)[1], []).append(v)
        centres = [[sum(x) // len(groups[n]) for x in zip(*groups[n], strict=True)] if n in groups else c for n, c in enumerate(centres)]
    found = [(i, *nearest(v)) for i, v in data]
    own = {n: sum(d for _, d, m in found if m == n) for n in range(len(centres))}
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centres]
    return sorted(((i, n, d, own[n], sum(own.values()), digests[n]) for i, d, n in found), key=str)


@pytest.mark.parametrize("k,rounds", [(10, 3), (1, 1), (5, 0), (500, 2)])
def test_clusters(spark, k, rounds):
    rows = some_vectors(120)
    odd = [*rows, *ODD_VECTORS, rows[3], rows[3]]
    points = clustering.integer_vectors(vectors(spark, odd), 8)
    got = clustering.clusters(points, clustering.fit(points, k, rounds, 2))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_kmeans(odd, k, rounds, 2, 8)


def test_clusters_odd(spark):
    points = clustering.integer_vectors(vectors(spark, []), 8)
    assert clustering.clusters(points, clustering.fit(points, 40, 5, 2)).count() == 0
    with pytest.raises(Exception, match="beyond"):
        clustering.integer_vectors(vectors(spark, [(1, [1e30, 1.0])]), 2)
    edge = clustering.largest_component(2) / 256
    rows = [(1, [edge, edge]), (2, [-edge, -edge])]
    points = clustering.integer_vectors(spark.createDataFrame(rows, "vec_id bigint, embedding array<double>"), 2)
    got = clustering.clusters(points, clustering.fit(points, 1, 1, 2))
    assert sorted((tuple(r) for r in got.collect()), key=str) == plain_kmeans(rows, 1, 1, 2, 2)


def test_clusters_use_no_python_workers(spark):
    points = clustering.integer_vectors(vectors(spark, some_vectors(20)), 8)
    model = clustering.seeds(points, 4, 2)
    plan = clustering.assign(points, model)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan
