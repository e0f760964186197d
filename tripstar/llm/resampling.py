"""Importance resampling: draw the documents that look most like a target set.

Features are runs of words, hashed into buckets. Counts of all documents and of the target give each bucket a gain
(log ratio with one added to each count); an array of gains scores every document, and Gumbel noise from a hash of
its doc_id makes the highest scores a random draw by weight. The cutoff is found without sorting all scores: a quantile
sketch proposes a bracket, exact counts of the scores above and within it show whether it holds the cutoff (if not it is
widened), and only the bracket is sorted. The drawn rows are ranked by places in a range-partitioned order.

Arrays of ``buckets`` counts or gains are all that tasks share; no group of rows is collected anywhere.

Defined cases: NULL and empty texts have no features and weight 0, and are never drawn if ``least_words`` is above 0; a NULL
doc_id counts as empty text in the hash and comes last among equal scores; repeated rows are documents of their own, ties
between rows of one doc_id fall either way but each rank is given once; an empty table gives no rows; without target
texts all gains follow from the documents alone; other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tripstar.llm import crc
from tripstar.llm.tables import shuffle_partitions, stored
from tripstar.llm.text import ALPHANUMERIC, LOWER, Block, blocks
from tripstar.operators.positions import row_places

BUCKETS = 10_000
WIDTH = 2
ACCURACY = 1000  # of the quantile sketch: its error is one part in so many of all rows
RANK_ROWS = 1 << 20  # rows of one partition while ranking


def features(block: Block, width: int, buckets: int) -> tuple[list[np.ndarray], np.ndarray]:
    """For each run length the bucket at each word of the block (-1 where the run would leave the text), and each text's first word."""
    starts, ends, first = block.words(ALPHANUMERIC)
    words = crc.of_words(LOWER[block.data], starts, ends)
    last = np.repeat(first[1:], np.diff(first))  # end of the text of each word
    found = []
    for n, sums in enumerate(crc.runs(words, ends - starts, width), 1):
        bucket = np.full(len(words), -1, np.int64)
        bucket[: len(sums)] = sums % crc.U32(buckets)
        bucket[np.arange(len(words)) + n > last] = -1
        found.append(bucket)
    return found, first


def bucket_counts(texts: DataFrame, width: int = WIDTH, buckets: int = BUCKETS, text: str = "text") -> np.ndarray:
    """How many features of all texts fall into each bucket."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, block in blocks(batch):
                for bucket in features(block, width, buckets)[0]:
                    total += np.bincount(bucket[bucket >= 0], minlength=buckets)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    counted = texts.select(F.col(text).cast("string").alias("text")).mapInArrow(count, "bucket int, n bigint")
    out = np.zeros(buckets, np.int64)
    for row in counted.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most one row a bucket
        out[row.bucket] = row.n
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln) of each bucket's share in the target over that in the source, one added to each count."""
    n, all_source, all_target = len(source), float(source.sum()), float(target.sum())
    ratios = (target + 1.0) * (all_source + n) / ((source + 1.0) * (all_target + n))
    return np.array([math.floor(1000 * math.log(x)) for x in ratios.tolist()], np.int64)


def weigh(docs: DataFrame, gain: np.ndarray, width: int = WIDTH, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_words, n_features, weight (floored mean gain) of each document."""
    kind = docs.schema[doc_id].dataType.simpleString()

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        padded = np.append(gain, 0)  # bucket -1 adds nothing
        for batch in batches:
            for part, block in blocks(batch):
                found, first = features(block, width, len(gain))
                total, n = np.zeros(block.size, np.int64), np.zeros(block.size, np.int64)
                for bucket in found:
                    for into, value in ((total, padded[bucket]), (n, bucket >= 0)):
                        sums = np.concatenate(([0], np.cumsum(value)))
                        into += sums[first[1:]] - sums[first[:-1]]
                weight = np.floor_divide(total, np.maximum(n, 1))
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), pa.array(np.diff(first)), pa.array(n), pa.array(weight)], names=["doc_id", "n_words", "n_features", "weight"])

    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).cast("string").alias("text"))
    return rows.mapInArrow(score, f"doc_id {kind}, n_words bigint, n_features bigint, weight bigint")


def gumbel(salt: int, doc_id: str = "doc_id") -> Column:
    """floor(1000 x) of a standard Gumbel value that follows from the SHA-256 of ``salt:doc_id``."""
    name = F.concat(F.lit(f"{salt}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(name, 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def bracket(rows: DataFrame, score: str, wanted: int, total: int, accuracy: int = ACCURACY) -> tuple[Column, int]:
    """A condition that holds the ``wanted``-th highest score, and the exact number of scores above it."""
    margin = 2 / accuracy
    while True:
        low_share, high_share = 1 - wanted / total - margin, 1 - wanted / total + margin
        shares = [min(max(x, 0.0), 1.0) for x in (low_share, high_share)]
        low, high = rows.agg(F.percentile_approx(score, shares, accuracy).alias("p")).first().p
        column = F.col(score)
        above = (column > high) if high_share < 1 else F.lit(False)
        below = (column < low) if low_share > 0 else F.lit(False)
        over, under = rows.agg(F.count_if(above), F.count_if(below)).first()
        if over < wanted <= total - under:
            return ~above & ~below, over
        margin *= 4  # the sketch was off; in the end the bracket holds all rows


def highest(rows: DataFrame, score: str, ties: list[Column], wanted: int, total: int, accuracy: int = ACCURACY) -> tuple[Column, list[Column]]:
    """A condition for the ``wanted`` first rows by falling score and then ``ties`` (which tell all rows apart), and that order."""
    order = [-F.col(score), *ties]
    inside, over = bracket(rows, score, wanted, total, accuracy)
    keys = [f"_k{i}" for i in range(len(order))]
    within = rows.where(inside).select(*[c.alias(k) for c, k in zip(order, keys, strict=True)])
    ranked = row_places(within, [F.col(k) for k in keys], partitions_for(within, total), "_place")
    last = ranked.where(F.col("_place") == wanted - over - 1).first()
    cut = F.struct(*[F.lit(last[k]).cast(within.schema[k].dataType).alias(k) for k in keys])
    return F.struct(*[c.alias(k) for c, k in zip(order, keys, strict=True)]) <= cut, order


def partitions_for(rows: DataFrame, total: int) -> int:
    return max(shuffle_partitions(rows.sparkSession), -(-total // RANK_ROWS))


def resample(docs: DataFrame, target: DataFrame, percent: int, salt: int, least_words: int, width: int = WIDTH, buckets: int = BUCKETS, doc_id: str = "doc_id", text: str = "text", accuracy: int = ACCURACY) -> DataFrame:
    """doc_id, n_features, weight, score, rank of each document; rank is NULL for those that are not drawn."""
    gain = gains(bucket_counts(docs, width, buckets, text), bucket_counts(target, width, buckets, text))
    scored = weigh(docs, gain, width, doc_id, text).withColumn("score", F.col("weight") + gumbel(salt))
    rows = stored(scored.withColumn("row", F.monotonically_increasing_id()))
    fit = F.col("n_words") >= least_words
    total = rows.where(fit).count()
    wanted = percent * total // 100
    columns = ["doc_id", "n_features", "weight", "score"]
    if not wanted:
        return rows.select(*columns, F.lit(None).cast("bigint").alias("rank"))
    ties = [F.col("doc_id").isNull(), F.col("doc_id"), F.col("row")]
    chosen, order = highest(rows.where(fit), "score", ties, wanted, total, accuracy)
    drawn = fit & chosen
    ranked = row_places(rows.where(drawn), order, partitions_for(rows, wanted), "_place")
    return ranked.select(*columns, (F.col("_place") + 1).alias("rank")).unionByName(rows.where(~drawn).select(*columns, F.lit(None).cast("bigint").alias("rank")))
