"""Nearest neighbours by inner product with shifted Hilbert curves.

Equal vectors are collapsed first, keeping their smallest ids, so a vector that fills a third of the table
is one point. One more coordinate makes all points equally long, which turns the largest inner product
into the nearest point. Each curve projects the points by its own random rotation, shifts them, and orders
them along a Hilbert curve. Spark range-partitions all curves at once by (curve, key); within the order
each query is compared with the points of its block and of WINDOW places on both sides, by exact inner
products in double precision. The best of all curves are merged.

The window follows the data: for SAMPLE queries the true neighbours are found by brute force, and the places
between each query and each of them are counted on every curve; the window is the one that holds RECALL of
them, WINDOW at least. So effort grows with the points where they have no structure: see the README for figures.

Defined cases: vectors that are NULL, empty or zero, hold NULL or non-finite components, or differ in length
from the most frequent length take no part; rows with NULL vec_id take no part; of rows with one vec_id
and one vector only one counts; other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from tripstar.llm.tables import shuffle_partitions, stored

CURVES = 64
DIMENSIONS = 12
BITS = 5
WINDOW = 256
BLOCK = 256
SAMPLE = 64  # queries whose true neighbours set the window
RECALL = 0.97
SEED = 99


def hilbert_keys(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Place of each row of coordinates (below 2**bits) on the Hilbert curve.

    Level by level from the top bit: the curve enters a cell turned and mirrored as its parent says, which
    is undone on the lower bits; the Gray code of the result is the place.
    """
    x = cells.T.astype(np.uint64).copy()
    n = len(x)
    one = np.uint64(1)
    for level in range(bits - 1, 0, -1):
        top, low = np.uint64(level), (one << np.uint64(level)) - one
        for i in range(n):
            mirrored = (x[i] >> top) & one == one
            swap = np.where(mirrored, np.uint64(0), (x[0] ^ x[i]) & low)
            x[0] ^= np.where(mirrored, low, swap)
            x[i] ^= swap
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip = np.zeros_like(x[0])
    for level in range(bits - 1, 0, -1):
        flip ^= np.where((x[n - 1] >> np.uint64(level)) & one == one, (one << np.uint64(level)) - one, np.uint64(0))
    x ^= flip
    key = np.zeros(x.shape[1], np.uint64)
    for level in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << one) | ((x[i] >> np.uint64(level)) & one)
    return key


def curve_keys(points: np.ndarray, curve: int) -> np.ndarray:
    """Keys of points of length 1 at most along one curve."""
    rng = np.random.default_rng([SEED, curve])
    size = points.shape[1]
    rotation, _ = np.linalg.qr(rng.standard_normal((size, size)))
    used = rotation[:, : min(DIMENSIONS, size)]
    spread = points @ used * np.sqrt(size) + rng.uniform(-0.5, 0.5, used.shape[1])
    cells = np.clip((spread + 4) / 8 * (1 << BITS), 0, (1 << BITS) - 1).astype(np.int64)
    return hilbert_keys(cells).view(np.int64)


def _matrix(column: pa.ChunkedArray | pa.Array, kind: str) -> np.ndarray:
    rows = column.to_pylist()
    return np.frombuffer(b"".join(rows), kind).reshape(len(rows), -1).astype(np.float64)


def number_kind(vectors: DataFrame, embedding: str) -> str:
    """How components are stored in bytes: single precision if the column has it, double precision else."""
    return "<f4" if vectors.schema[embedding].dataType.elementType == T.FloatType() else "<f8"


def usable(vectors: DataFrame, vec_id: str, embedding: str, kind: str) -> DataFrame:
    """vec_id, v: rows that take part, v as bytes."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).cast("array<double>").alias("e")).where("vec_id IS NOT NULL AND e IS NOT NULL AND size(e) > 0")
    sizes = rows.groupBy(F.size("e").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    rows = rows.where(F.size("e") == (sizes[0].n if sizes else 0))

    def clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = batch.column("e").flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, -1) + 0.0  # no negative zeros
            good = np.flatnonzero(np.isfinite(x).all(1) & (x != 0).any(1))
            yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pa.array(good)), pa.array([r.tobytes() for r in x[good].astype(kind)], pa.binary())], names=["vec_id", "v"])

    return rows.mapInArrow(clean, "vec_id bigint, v binary")


def distinct_points(rows: DataFrame, keep: int) -> DataFrame:
    """point (smallest vec_id), v, ids (the smallest of the vector's vec_ids, at most keep), asks."""

    def combine(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            groups: dict[bytes, tuple[set, list]] = {}
            for i, v, q in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                ids, asks = groups.setdefault(v, (set(), [False]))
                ids.add(i)
                asks[0] |= q
            lists = [sorted(ids)[:keep] for ids, _ in groups.values()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(groups), pa.binary()), pa.array(lists, pa.list_(pa.int64())), pa.array([a[0] for _, a in groups.values()], pa.bool_())], names=["v", "ids", "asks"]
            )

    parts = rows.mapInArrow(combine, "v binary, ids array<bigint>, asks boolean")
    ids = F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))), 1, keep)
    return parts.groupBy("v").agg(ids.alias("ids"), F.max("asks").alias("asks")).withColumn("point", F.col("ids")[0])


def on_sphere(v: pa.ChunkedArray | pa.Array, longest: float, number: str) -> tuple[np.ndarray, np.ndarray]:
    """Vectors as points of length 1, by one more coordinate, and as queries, by their direction."""
    x = _matrix(v, number) / longest
    length = np.sqrt((x * x).sum(1))
    data = np.column_stack([x, np.sqrt(np.maximum(1 - length**2, 0))])
    return data, np.column_stack([x / length[:, None], np.zeros(len(x))])


def along_curves(points: DataFrame, longest: float, curves: int, number: str) -> DataFrame:
    """curve, key, point, v, asked: each point once on each curve, and points that ask once more as a query."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                data, query = on_sphere(part.column("v"), longest, number)
                asks = np.flatnonzero(part.column("asks").to_numpy(zero_copy_only=False))
                query = query[asks]
                for curve in range(curves):
                    for kind, coordinates, own in ((False, data, part), (True, query, part.take(pa.array(asks)))):
                        n = own.num_rows
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(n, curve, np.int32)), pa.array(curve_keys(coordinates, curve)), own.column("point"), own.column("v"), pa.array(np.full(n, kind))],
                            names=["curve", "key", "point", "v", "asked"],
                        )

    return points.select("point", "v", "asks").mapInArrow(place, "curve int, key bigint, point bigint, v binary, asked boolean")


def best_of(scores: np.ndarray, ids: np.ndarray, k: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each row of scores the k best (ids, scores); ties at the end are all kept."""
    for row in scores:
        if len(row) > k:
            mine = np.flatnonzero(row >= np.partition(row, len(row) - k)[len(row) - k])
        else:
            mine = np.arange(len(row))
        mine = mine[np.lexsort((ids[mine], -row[mine]))][: 2 * k]
        yield ids[mine], row[mine]


def search_windows(placed: DataFrame, k: int, window: int, partitions: int, number: str) -> DataFrame:
    """query (point), found array<struct<score, point>>: the best of one block of one curve."""
    hit = pa.list_(pa.struct([("score", pa.float64()), ("point", pa.int64())]))

    def ordered(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
        """Consecutive rows of one curve, each table with the last 2 * window rows of the one before."""
        held, curve, fresh = None, None, 0
        for batch in batches:
            curves = batch.column("curve").to_numpy()
            for part in np.split(np.arange(batch.num_rows), np.flatnonzero(np.diff(curves)) + 1):
                if not len(part):
                    continue
                rows = pa.Table.from_batches([batch.slice(part[0], len(part))])
                if curve != curves[part[0]]:
                    if held is not None:
                        yield held, fresh, True
                    held, curve, fresh = rows, curves[part[0]], 0
                else:
                    held = pa.concat_tables([held, rows])
                if held.num_rows > 4 * window + 28 * BLOCK:
                    yield held, fresh, False
                    # queries before here had their whole window; the rest is looked at again
                    done = held.num_rows - window
                    start = max(0, done - window)
                    held, fresh = held.slice(start), done - start
        if held is not None:
            yield held, fresh, True

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, fresh, last in ordered(batches):
            asked = table.column("asked").to_numpy()
            point, x = table.column("point").to_numpy(), _matrix(table.column("v"), number)
            queries = np.flatnonzero(asked)
            queries = queries[(queries >= fresh) & (queries < (len(asked) if last else len(asked) - window))]
            names, lists = [], []
            for first in range(0, len(asked), BLOCK):
                mine = queries[(queries >= first) & (queries < first + BLOCK)]
                low, high = max(0, first - window), min(len(asked), first + BLOCK + window)
                data = low + np.flatnonzero(~asked[low:high])
                if not len(mine) or not len(data):
                    continue
                for q, (ids, scores) in zip(point[mine], best_of(x[mine] @ x[data].T, point[data], k), strict=True):
                    names.append(q)
                    lists.append([{"score": s, "point": p} for s, p in zip(scores.tolist(), ids.tolist(), strict=True)])
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int64()), pa.array(lists, hit)], names=["query", "found"])

    dealt = placed.repartitionByRange(partitions, "curve", "key").sortWithinPartitions("curve", "key", "point")
    return dealt.mapInArrow(search, "query bigint, found array<struct<score: double, point: bigint>>")


def true_neighbours(points: DataFrame, sample: list, k: int, number: str) -> DataFrame:
    """query, point, v: the k nearest points of each sampled one, by brute force."""
    names = np.array([r.point for r in sample])
    asked = np.frombuffer(b"".join(bytes(r.v) for r in sample), number).reshape(len(sample), -1).astype(np.float64)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scores, ids, vectors = np.zeros((len(names), 0)), np.zeros((len(names), 0), np.int64), np.zeros((len(names), 0), object)
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                part = batch.slice(at, 2048)
                point, raw = part.column("point").to_numpy(), np.array(part.column("v").to_pylist(), object)
                new = asked @ _matrix(part.column("v"), number).T
                new[names[:, None] == point] = -np.inf
                scores = np.concatenate([scores, new], axis=1)
                ids, vectors = (np.concatenate([old, np.broadcast_to(x, new.shape)], axis=1) for old, x in ((ids, point), (vectors, raw)))
                best = np.argsort(-scores, axis=1, kind="stable")[:, :k]
                scores, ids, vectors = (np.take_along_axis(x, best, 1) for x in (scores, ids, vectors))
        row, column = np.nonzero(np.isfinite(scores))
        yield pa.RecordBatch.from_arrays(
            [pa.array(names[row]), pa.array(scores[row, column]), pa.array(ids[row, column]), pa.array(vectors[row, column], pa.binary())], names=["query", "score", "point", "v"]
        )

    found = points.select("point", "v").mapInArrow(search, "query bigint, score double, point bigint, v binary")
    order = F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "point", "v")))
    return found.groupBy("query").agg(F.slice(order, 1, k).alias("all")).select("query", F.explode("all").alias("hit")).select("query", "hit.point", "hit.v")


def fitted_window(points: DataFrame, k: int, longest: float, curves: int, number: str, sample: int, recall: float) -> int:
    """The least window in which that share of the true neighbours of sampled queries lies on some curve."""
    some = points.where("asks").select("point", "v").orderBy(F.xxhash64("point"), "point").limit(sample).collect()
    pairs = true_neighbours(points, some, k, number).collect() if some else []  # sample * k rows
    if not pairs:
        return 0
    place = {r.point: i for i, r in enumerate(some)}
    _, queries = on_sphere(pa.array([bytes(r.v) for r in some], pa.binary()), longest, number)
    near, _ = on_sphere(pa.array([bytes(r.v) for r in pairs], pa.binary()), longest, number)
    keys = np.array([np.concatenate([curve_keys(queries, c), curve_keys(near, c)]) for c in range(curves)])
    bounds = [np.unique(row) for row in keys]

    def between(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [np.zeros(len(b) + 1, np.int64) for b in bounds]
        for batch in batches:
            for at in range(0, batch.num_rows, 2048):
                data, _ = on_sphere(batch.column("v").slice(at, 2048), longest, number)
                for c, b in enumerate(bounds):
                    counts[c] += np.bincount(np.searchsorted(b, curve_keys(data, c), "right"), minlength=len(b) + 1)
        for c, n in enumerate(counts):
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), c, np.int32)), pa.array(np.arange(len(n))), pa.array(n)], names=["curve", "slot", "n"])

    counted = points.select("v").mapInArrow(between, "curve int, slot bigint, n bigint").groupBy("curve", "slot").agg(F.sum("n").alias("n"))
    counts = [np.zeros(len(b) + 1, np.int64) for b in bounds]
    for r in counted.collect():  # curves * sample * (k + 1) rows
        counts[r.curve][r.slot] = r.n
    asked = np.array([place[r.query] for r in pairs])
    apart = np.full(len(pairs), np.iinfo(np.int64).max)
    for row, b, n in zip(keys, bounds, counts, strict=True):
        rank = np.cumsum(n)[np.searchsorted(b, row)]
        apart = np.minimum(apart, np.abs(rank[len(some) :] - rank[asked]))
    return int(np.quantile(apart, recall, method="higher"))


def reranked(pairs: DataFrame, number: str) -> DataFrame:
    """query, point, score of pairs (query, point, v, w), each score worked out in the same way."""

    def rerank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                scores = (_matrix(batch.column("v"), number) * _matrix(batch.column("w"), number)).sum(1)
                yield pa.RecordBatch.from_arrays([batch.column("query"), batch.column("point"), pa.array(scores)], names=["query", "point", "score"])

    return pairs.select("query", "point", "v", "w").mapInArrow(rerank, "query bigint, point bigint, score double")


def nearest(
    vectors: DataFrame, is_query, k: int = 20, curves: int = CURVES, window: int = WINDOW, sample: int = SAMPLE, recall: float = RECALL, vec_id: str = "vec_id", embedding: str = "embedding"
) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of each row for which is_query(vec_id) holds.

    The window is the given one or, if larger, what the sample needs for that recall (sample 0: the given one).
    """
    spark = vectors.sparkSession
    number = number_kind(vectors, embedding)
    rows = stored(usable(vectors, vec_id, embedding, number).withColumn("q", is_query(F.col("vec_id"))))
    points = stored(distinct_points(rows, k + 1))

    def lengths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                longest = np.sqrt((_matrix(batch.column("v"), number) ** 2).sum(1)).max()
                yield pa.RecordBatch.from_arrays([pa.array([1]), pa.array([float(longest)])], names=["n", "longest"])

    longest = points.select("v").mapInArrow(lengths, "n bigint, longest double").agg(F.max("longest")).first()[0] or 1.0
    n, asking = points.agg(F.count("*"), F.count_if("asks")).first()
    # queries stand among the points, each once on every curve
    window = max(window, int(fitted_window(points, k, longest, curves, number, sample, recall) * (1 + asking / max(n, 1))))
    partitions = max(shuffle_partitions(spark), curves * n // max(1 << 16, 16 * window))
    found = search_windows(along_curves(points, longest, curves, number), k + 1, window, partitions, number)
    hits = stored(found.select("query", F.explode("found").alias("hit")).groupBy("query", "hit.point").agg(F.max("hit.score").alias("score")))
    # a few more than asked for: their scores are worked out anew, which may change the order of near ties
    order = F.sort_array(F.collect_list(F.struct("score", "point")), asc=False)
    best = hits.groupBy("query").agg(F.slice(order, 1, k + 5).alias("best")).select("query", F.explode("best.point").alias("point"))
    pairs = best.join(points.select("point", "v"), "point").join(points.select(F.col("point").alias("query"), F.col("v").alias("w")), "query")
    ids = reranked(pairs, number).join(points.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("vec_id"))
    answers = ids.groupBy("query").agg(F.slice(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("s"), "vec_id"))), 1, k + 1).alias("all"))
    asking = rows.where("q").select("vec_id", "v").distinct().withColumnRenamed("vec_id", "query_id")
    asking = asking.join(points.select("v", F.col("point").alias("query")), "v").select("query_id", "query")
    own = asking.join(answers, "query")
    rest = F.slice(F.filter("all", lambda h: h["vec_id"] != F.col("query_id")), 1, k)
    ranked = own.select("query_id", F.posexplode(rest).alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), (-F.col("hit.s")).alias("score"))
