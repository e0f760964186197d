"""Exact search of the largest integer inner products with a pivot-distance index.

Components are floored to integers. Each distinct vector is keyed by its nearest pivot and its distance from it, and
the table is range-partitioned and sorted by that key: runs of ``ANNULUS`` vectors of one pivot are annuli around
it, and a partition of the index is a shard. As q.x = (|q|^2 + |x|^2 - |q - x|^2) / 2, and the triangle
inequality gives |q - x| >= ||q - p| - |x - p||, the distances of an annulus and its longest vector bound every
inner product in it. A query first looks into its own annulus, which gives it a score to beat. It is then sent to the
shards whose bound reaches that score; there it takes the annuli nearest first and leaves out each whose bound stays
below the score of its last place, which rises as it goes. Nothing that could count is left out, so the
result is exact; vectors without structure, all about equally far apart, simply stop later.

Tasks hold one shard (``SHARD_VECTORS`` at most, about) and ``QUERIES`` queries at a time. The driver sees at most ``SAMPLE``
vectors, for the choice of pivots, and one row for each pivot and shard.

Defined cases: vectors that are NULL, empty, hold NULL or non-finite components, or differ in length from the most
frequent length (of two: the longer) take no part; rows with NULL vec_id take no part; of rows with one vec_id one
counts (the smallest vector, by its bytes); zero vectors count; other columns are not read. A component beyond ``limit_of`` raises
an error, as a score would not fit into a BIGINT.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripstar.llm.tables import shuffle_partitions, stored

SCALE = 256
PIVOTS = 64
SAMPLE = 4096
SAMPLE_ROUNDS = 5
ANNULUS = 1024
QUERIES = 1024
SHARD_VECTORS = 1 << 19


def limit_of(dimensions: int) -> int:
    """Largest component for which all products of two vectors stay within 2**60."""
    return min((1 << 31) - 1, math.isqrt((1 << 60) // max(1, dimensions)))


def packed(vectors: np.ndarray) -> pa.Array:
    """A binary value for each row."""
    data = np.ascontiguousarray(vectors)
    width = data.shape[1] * data.itemsize
    offsets = np.arange(len(data) + 1, dtype=np.int64) * width
    return pa.Array.from_buffers(pa.large_binary(), len(data), [None, pa.py_buffer(offsets), pa.py_buffer(data)]).cast(pa.binary())


def unpacked(column: pa.Array) -> np.ndarray:
    """Rows of packed integers as float64; all hold equally many."""
    if not len(column):
        return np.zeros((0, 0))
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    at = np.frombuffer(column.buffers()[1], np.int32)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(column.buffers()[2], np.uint8)[at[0] : at[-1]] if at[-1] > at[0] else np.zeros(0, np.uint8)
    return data.view(np.int32).reshape(len(column), -1).astype(np.float64)


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Exact inner products of whole numbers as int64."""
    longest = math.sqrt((a * a).sum(1).max(initial=0) * (b * b).sum(1).max(initial=0))
    if longest < 1 << 52:  # no partial sum is longer, so float64 holds them all
        return (a @ b.T).astype(np.int64)
    return a.astype(np.int64) @ b.T.astype(np.int64)


def distances(vectors: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (vectors * vectors).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * (vectors @ pivots.T)
    return np.sqrt(np.maximum(square, 0))


def bound(norm: np.ndarray, own: np.ndarray, low, high, longest) -> np.ndarray:
    """No inner product of a query (squared norm, distance from the pivot) with vectors between low and high from the pivot, of squared norm up to longest, is above this."""
    gap = np.maximum(0, np.maximum(low - own, own - high))
    most = norm + longest
    return (most - gap * gap) / 2 + most * 1e-9 + 1e-6  # the distances are rounded


def integer_rows(vectors: DataFrame, vec_id: str, embedding: str, scale: int) -> DataFrame:
    """vec_id, v (packed integers) of the vectors that take part."""
    rows = vectors.select(F.col(vec_id).cast("bigint").alias("vec_id"), F.col(embedding).alias("e")).where("vec_id IS NOT NULL")

    def proper(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    kept = rows.where((F.size("e") > 0) & F.forall("e", proper))
    sizes = kept.groupBy(F.size("e").alias("n")).count().orderBy(F.desc("count"), F.desc("n")).limit(1).collect()
    dimensions = sizes[0].n if sizes else 0
    limit = limit_of(dimensions)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                numbers = np.asarray(batch.column("e").flatten(), np.float64).reshape(batch.num_rows, -1)
                whole = np.floor(numbers * scale)
                if np.abs(whole).max() > limit:
                    raise OverflowError(f"a component is beyond {limit}")
                yield pa.RecordBatch.from_arrays([batch.column("vec_id"), packed(whole.astype(np.int32))], names=["vec_id", "v"])

    whole_rows = kept.where(F.size("e") == dimensions).mapInArrow(pack, "vec_id bigint, v binary")
    return whole_rows.groupBy("vec_id").agg(F.min("v").alias("v"))


def distinct_points(rows: DataFrame, asked: Column, ids: int) -> DataFrame:
    """point, v, first, ids (the smallest), asks of each distinct vector."""
    order = Window.partitionBy("v").orderBy("vec_id")
    smallest = rows.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= ids)
    points = smallest.groupBy("v").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    asking = rows.where(asked).select("v").distinct().withColumn("asks", F.lit(True))
    marked = points.join(asking, "v", "left")
    return marked.select(F.monotonically_increasing_id().alias("point"), "v", F.col("ids")[0].alias("first"), "ids", F.coalesce("asks", F.lit(False)).alias("asks"))


def choose_pivots(points: DataFrame, pivots: int) -> np.ndarray:
    """Centres of a bounded sample of the vectors (those with the smallest hashes)."""
    sample = points.select("v", F.xxhash64("v").alias("h")).orderBy("h", "v").limit(SAMPLE).collect()
    data = np.array([np.frombuffer(row.v, np.int32) for row in sample], np.float64)
    centres = data[:pivots]
    for _ in range(SAMPLE_ROUNDS if len(data) > pivots else 0):
        nearest = distances(data, centres).argmin(1)
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, data)
        n = np.bincount(nearest, minlength=len(centres))
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


INDEX = "shard int, pivot int, distance double, point bigint, first bigint, v binary, asks boolean"


def build_index(points: DataFrame, pivots: np.ndarray, shards: int) -> DataFrame:
    """The points sorted by (pivot, distance), dealt into shards, stored."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                away = distances(unpacked(batch.column("v")), pivots)
                nearest = away.argmin(1)
                columns = [pa.array(nearest.astype(np.int32)), pa.array(away[np.arange(len(away)), nearest])]
                yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c) for c in ("point", "first", "v", "asks"))], names=["pivot", "distance", "point", "first", "v", "asks"])

    placed = points.select("point", "first", "v", "asks").mapInArrow(place, INDEX.removeprefix("shard int, "))
    dealt = placed.repartitionByRange(shards, "pivot", "distance", "point").sortWithinPartitions("pivot", "distance", "point")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(np.full(batch.num_rows, shard, np.int32)), *batch.columns], names=["shard", *batch.schema.names])

    return stored(dealt.mapInArrow(number, INDEX))


@dataclass(frozen=True)
class Annulus:
    """Vectors at similar distances from one pivot."""

    pivot: int
    low: float
    high: float
    longest: float
    vectors: np.ndarray
    points: np.ndarray
    firsts: np.ndarray


def annuli(rows: pa.Table) -> Iterator[tuple[Annulus, np.ndarray]]:
    """Sorted rows of an index cut into annuli, each with the places of its rows."""
    pivot, distance = rows.column("pivot").to_numpy(), rows.column("distance").to_numpy()
    points, firsts = rows.column("point").to_numpy(), rows.column("first").to_numpy()
    edges = np.flatnonzero(np.diff(pivot)) + 1
    for start, end in zip([0, *edges], [*edges, len(pivot)], strict=True):
        for a in range(start, end, ANNULUS):
            b = min(end, a + ANNULUS)
            v = unpacked(rows.column("v").slice(a, b - a))
            yield Annulus(int(pivot[a]), distance[a], distance[b - 1], (v * v).sum(1).max(), v, points[a:b], firsts[a:b]), np.arange(a, b)


def best_of(scores: np.ndarray, firsts: np.ndarray, points: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best: highest score, then smallest vec_id."""
    if len(scores) > k:
        mine = np.flatnonzero(scores >= np.partition(scores, len(scores) - k)[len(scores) - k])
    else:
        mine = np.arange(len(scores))
    return mine[np.lexsort((points[mine], firsts[mine], -scores[mine]))][:k]


#: Below every score.
NOTHING = -(1 << 62)


def first_scores(index: DataFrame, pivots: np.ndarray, summary: list[tuple], k: int) -> DataFrame:
    """point, v, least, shards: each query, the score that it has to beat (that of its k-th best in its own annulus) and where it has to look."""
    shard = np.array([row[0] for row in summary], np.int64)
    where = np.array([row[1] for row in summary], np.int64)
    low, high, longest = (np.array([row[c] for row in summary], np.float64) for c in (2, 3, 4))

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = pa.Table.from_batches([batch])
            asks = batch.column("asks").to_numpy(zero_copy_only=False)
            for ring, places in annuli(table) if batch.num_rows else ():
                mine = np.flatnonzero(asks[places])
                if not len(mine):
                    continue
                q = ring.vectors[mine]
                scores = products(q, ring.vectors)
                least = np.partition(scores, scores.shape[1] - k, axis=1)[:, scores.shape[1] - k] if scores.shape[1] >= k else np.full(len(q), NOTHING)
                reach = bound((q * q).sum(1)[:, None], distances(q, pivots)[:, where], low, high, longest) >= least[:, None]
                lists = [np.unique(shard[row]).tolist() for row in reach]
                columns = [pa.array(ring.points[mine]), table.column("v").take(pa.array(places[mine])).combine_chunks(), pa.array(least), pa.array(lists, pa.list_(pa.int32()))]
                yield pa.RecordBatch.from_arrays(columns, names=["point", "v", "least", "shards"])

    return index.select("pivot", "distance", "point", "first", "v", "asks").mapInArrow(look, "point bigint, v binary, least bigint, shards array<int>")


def expand(rings: list[Annulus], pivots: np.ndarray, q: np.ndarray, least: np.ndarray, k: int):
    """(query place, points, firsts, scores) of the best k of each query in the annuli, nearest annuli first."""
    away, norm = distances(q, pivots), (q * q).sum(1)
    bounds = np.array([bound(norm, away[:, r.pivot], r.low, r.high, r.longest) for r in rings]).T
    least = least.copy()
    best = [(np.zeros(0, np.int64),) * 3 for _ in q]
    for at in np.argsort(-bounds.max(0), kind="stable"):
        ring = rings[at]
        open_ = np.flatnonzero(bounds[:, at] >= least)
        if not len(open_):
            continue
        for place, scores in zip(open_, products(q[open_], ring.vectors), strict=True):
            new = np.flatnonzero(scores >= least[place])
            if not len(new):
                continue
            points, firsts, own = (np.concatenate(x) for x in zip(best[place], (ring.points[new], ring.firsts[new], scores[new]), strict=True))
            top = best_of(own, firsts, points, k)
            best[place] = points[top], firsts[top], own[top]
            if len(top) == k:
                least[place] = max(least[place], own[top[-1]])
    return best


def search_shards(index: DataFrame, queries: DataFrame, pivots: np.ndarray, k: int, shards: int) -> DataFrame:
    """query (point), point, first, score: the best of each query in each shard that it reaches."""
    columns = ["shard", "asked", "pivot", "distance", "point", "first", "v", "least"]
    data = index.selectExpr("shard", "false AS asked", "pivot", "distance", "point", "first", "v", "0L AS least")
    sent = queries.select("point", "v", "least", F.explode("shards").alias("shard"))
    asked = sent.selectExpr("shard", "true AS asked", "0 AS pivot", "0D AS distance", "point", "0L AS first", "v", "least")
    dealt = data.unionByName(asked).repartition(shards, "shard").sortWithinPartitions(*columns[:5])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rings: list[Annulus] = []
        now = None
        for batch in batches:
            shard, asked = batch.column("shard").to_numpy(), batch.column("asked").to_numpy(zero_copy_only=False)
            edges = np.flatnonzero((np.diff(shard) != 0) | (np.diff(asked.astype(np.int8)) != 0)) + 1
            for a, b in zip([0, *edges], [*edges, len(shard)], strict=True):
                if a == b:
                    continue
                if shard[a] != now:
                    held, rings, now = [], [], shard[a]
                if not asked[a]:
                    held.append(batch.slice(a, b - a))
                    continue
                if held:
                    rings, held = [ring for ring, _ in annuli(pa.Table.from_batches(held).combine_chunks())], []
                for first in range(a, b, QUERIES):
                    part = batch.slice(first, min(b, first + QUERIES) - first)
                    found = expand(rings, pivots, unpacked(part.column("v")), part.column("least").to_numpy(), k) if rings else []
                    if found:
                        name = np.repeat(part.column("point").to_numpy(), [len(f[0]) for f in found])
                        yield pa.RecordBatch.from_arrays([pa.array(name), *(pa.array(np.concatenate(x)) for x in zip(*found, strict=True))], names=["query", "point", "first", "score"])

    return dealt.select(columns).mapInArrow(search, "query bigint, point bigint, first bigint, score bigint")


def top_products(vectors: DataFrame, is_query: Callable[[Column], Column], k: int = 5, pivots: int = PIVOTS, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """query_id, rank, vec_id, score: the k largest inner products of each row for which is_query(vec_id) holds, with all other rows."""
    rows = stored(integer_rows(vectors, vec_id, embedding, scale))
    asked = is_query(F.col("vec_id"))
    # one more point than asked for, as a query's own point may hold no other row
    points = stored(distinct_points(rows, asked, k + 1))
    chosen = choose_pivots(points, pivots)
    if not len(chosen):
        return rows.selectExpr("vec_id AS query_id", "0 AS rank", "vec_id", "0L AS score").limit(0)
    shards = max(shuffle_partitions(rows.sparkSession), -(-points.count() // SHARD_VECTORS))
    index = build_index(points, chosen, shards)

    def longest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays([batch.column("shard"), batch.column("pivot"), batch.column("distance"), pa.array((unpacked(batch.column("v")) ** 2).sum(1))], names=["shard", "pivot", "distance", "norm"])

    norms = index.select("shard", "pivot", "distance", "v").mapInArrow(longest, "shard int, pivot int, distance double, norm double")
    summary = norms.groupBy("shard", "pivot").agg(F.min("distance"), F.max("distance"), F.max("norm")).collect()  # at most shards + pivots rows
    queries = stored(first_scores(index, chosen, [tuple(row) for row in summary], k + 1))
    hits = search_shards(index, queries, chosen, k + 1, shards)

    better = Window.partitionBy("query").orderBy(F.desc("score"), "first", "point")
    best = hits.withColumn("_n", F.row_number().over(better)).where(F.col("_n") <= k + 1)
    each = best.join(points.select("point", "ids"), "point").select("query", "score", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    named = each.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= k + 1)
    answer = F.array_sort(F.collect_list(F.struct(F.col("_n").alias("n"), "vec_id", "score")))
    answers = stored(named.groupBy("query").agg(answer.alias("found")))

    asking = rows.where(asked).withColumnRenamed("vec_id", "query_id")
    own = asking.join(points.where("asks").select("v", F.col("point").alias("query")), "v").select("query_id", "query").join(answers, "query")
    others = F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k)
    ranked = own.select("query_id", F.posexplode(others).alias("at", "hit"))
    return ranked.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"), F.col("hit.score").alias("score"))
