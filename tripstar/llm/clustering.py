"""k-means over integer vectors, wholly in DataFrame expressions.

Components are floored to integers, so distances, sums and centroids are exact and every run gives the same
result. A round is one job: each vector is compared with a literal array of centroids (``zip_with`` and
``aggregate`` give the inner product, from which the squared distance follows), ``array_min`` of structs takes
the nearest, and sums of columns by cluster give the next centroids. Partial sums are taken before the shuffle,
so a cluster that holds most rows costs no more than others. Only centroids, at most k vectors, reach the driver.

Defined cases: vectors that are NULL, of another number of components than asked for, or holding NULL or non-finite
components take no part; a NULL vec_id counts as empty text for the choice of seeds and stays in the result;
repeated rows are vectors of their own (seeds with one vec_id: smaller components first); with fewer vectors than k there
are as many centroids as vectors; an empty table gives no rows; other columns are not read. A component beyond
``largest_component`` raises an error, as a distance would not fit into a BIGINT.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from tripstar.llm.tables import stored

SCALE = 256


@dataclass(frozen=True)
class Clustering:
    """Centroids by number; an empty list where there was no vector."""

    centroids: tuple[tuple[int, ...], ...]


def largest_component(dimensions: int) -> int:
    """Up to here no squared distance between two vectors exceeds a BIGINT."""
    return math.isqrt((1 << 60) // max(1, dimensions))


def integer_vectors(vectors: DataFrame, dimensions: int, vec_id: str = "vec_id", embedding: str = "embedding", scale: int = SCALE) -> DataFrame:
    """vec_id, v (array of floor(scale * component)), norm (sum of squares) of the vectors that take part, stored."""
    limit = largest_component(dimensions)
    rows = vectors.select(F.col(vec_id).alias("vec_id"), F.col(embedding).alias("e"))

    def proper(x: Column) -> Column:
        x = x.cast("double")
        return x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))

    kept = rows.where((F.size("e") == dimensions) & F.forall("e", proper))
    ints = kept.select("vec_id", F.transform("e", lambda x: F.floor(x.cast("double") * scale)).alias("v"))
    beyond = F.exists("v", lambda x: (x > limit) | (x < -limit))
    checked = ints.select("vec_id", F.when(beyond, F.raise_error(F.lit(f"a component is beyond {limit}"))).otherwise(F.col("v")).alias("v"))
    return stored(checked.withColumn("norm", F.aggregate("v", F.lit(0).cast("bigint"), lambda s, x: s + x * x)))


def seeds(points: DataFrame, k: int, salt: int) -> Clustering:
    """The k vectors with the smallest SHA-256 of ``salt:vec_id``."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = points.select(F.sha2(name, 256).alias("h"), "v").orderBy("h", "v").limit(k).collect()
    return Clustering(tuple(tuple(row.v) for row in first))


def assign(points: DataFrame, model: Clustering) -> DataFrame:
    """vec_id, v, cluster, distance: each vector with its nearest centroid; ties go to the smaller number."""
    texts = [f"struct({sum(x * x for x in c)}L AS norm, array({', '.join(f'{x}L' for x in c)}) AS c, {k} AS cluster)" for k, c in enumerate(model.centroids)]
    if not texts:
        return points.select("vec_id", "v", F.lit(None).cast("int").alias("cluster"), F.lit(None).cast("bigint").alias("distance"))
    inner = "aggregate(zip_with(v, t.c, (a, b) -> a * b), 0L, (s, x) -> s + x)"
    nearest = F.expr(f"array_min(transform(array({', '.join(texts)}), t -> struct(t.norm - 2L * {inner} AS distance, t.cluster AS cluster)))")
    found = points.withColumn("_nearest", nearest)
    return found.select("vec_id", "v", F.col("_nearest.cluster").alias("cluster"), (F.col("_nearest.distance") + F.col("norm")).alias("distance"))


def moved(points: DataFrame, model: Clustering) -> Clustering:
    """Each centroid replaced by the floored mean of its vectors; one without vectors stays."""
    dimensions = len(model.centroids[0])
    sums = [F.sum(F.col("v")[i]).alias(f"s{i}") for i in range(dimensions)]
    new = list(model.centroids)
    for row in assign(points, model).groupBy("cluster").agg(F.count(F.lit(1)).alias("n"), *sums).collect():  # at most k rows
        new[row.cluster] = tuple(row[f"s{i}"] // row.n for i in range(dimensions))
    return Clustering(tuple(new))


def fit(points: DataFrame, k: int, rounds: int, salt: int) -> Clustering:
    model = seeds(points, k, salt)
    for _ in range(rounds):
        if model.centroids:
            model = moved(points, model)
    return model


def clusters(points: DataFrame, model: Clustering) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256 of every vector."""
    spark = points.sparkSession
    assigned = stored(assign(points, model).drop("v"))
    inertia = {row.cluster: row.total for row in assigned.groupBy("cluster").agg(F.sum("distance").alias("total")).collect()}  # at most k rows
    total = sum(x for x in inertia.values() if x is not None)
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in model.centroids]
    rows = [(k, inertia.get(k), total, digest) for k, digest in enumerate(digests)]
    facts = spark.createDataFrame(rows, "cluster int, cluster_inertia bigint, inertia bigint, centroid_sha256 string")
    return assigned.join(F.broadcast(facts), "cluster").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
