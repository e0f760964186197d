"""MinHash near-dedup with circulant signatures.

A document is its set of distinct word shingles. Signature coordinate k is the minimum, over the set, of
one permutation circularly shifted by k: shingles are placed on a ring by a first permutation (their
hash) and a second permutation of the ring is read from the place on, so all coordinates of one shingle
are one contiguous stretch of a table. Signatures are cut into bands.

1. Equal sets are one class, with the smallest doc_id as representative.
2. Per bucket (equal band), every member is a candidate with the bucket's smallest member only: a
   number of candidates in proportion to the members, however large the bucket. Candidates whose
   signatures differ too much are left out, the others are confirmed on full sets.
3. Buckets that still hold several components are completed: members are compared by signature in
   blocks, which gives families of possible links; within a family all pairs of members from
   different components are confirmed on full sets, again in blocks. Only links come out.
4. Components over all links.

A link is missed only if its two sets share no band, or if their signatures differ by five standard
deviations more than expected; the number of bands follows the threshold, so that either is rarer
than one in a million even for a link just at the threshold.

Defined cases: NULL or empty text has the empty set and no links; fewer words than a shingle are one
shingle; rows with NULL doc_id have no links and component_id NULL; rows of one doc_id are one document
in the links; other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripstar.llm.components import components
from tripstar.llm.tables import stored
from tripstar.llm.text import NOT_SPACE, U64, blocks, mix64, ngram_hashes

SHINGLE = 5
ROWS = 6  # coordinates in a band
MISS = 1e-6
RING_BITS = 20
BLOCK = 512  # members of a bucket or family that meet in one task
BROADCAST_ROWS = 1 << 20  # rows of (doc_id, groups) sent to the scan of texts; beyond, the scan is shuffled


class Circulant:
    """The permutation of the ring, laid out so that all shifts of a place are one slice."""

    def __init__(self, coordinates: int):
        size = 1 << RING_BITS
        ring = np.random.default_rng(20231).permutation(size).astype(np.uint32)
        self._windows = np.lib.stride_tricks.sliding_window_view(np.concatenate([ring, ring[:coordinates]]), coordinates)

    def signature(self, shingles: np.ndarray) -> np.ndarray:
        places = (shingles >> U64(64 - RING_BITS)).astype(np.int64)
        parts = [self._windows[places[k : k + 4096]].min(0) for k in range(0, len(places), 4096)]
        return np.min(parts, axis=0)


def bands_for(threshold: float) -> int:
    return math.ceil(math.log(MISS) / math.log(1 - threshold**ROWS))


def shingle_sets(batch: pa.RecordBatch, width: int = SHINGLE) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of each row of the batch."""
    at = 0
    for part, block in blocks(batch):
        words, first = block.word_hashes(NOT_SPACE)
        grams = ngram_hashes(words, width)
        for d in range(block.size):
            a, b = first[d], first[d + 1]
            if b - a >= width:
                yield at + d, np.unique(grams[a : b - width + 1])
            elif b > a:
                yield at + d, ngram_hashes(words[a:b], b - a) ^ U64(b - a)
            else:
                yield at + d, np.zeros(0, U64)
        at += part.num_rows


def sketches(docs: DataFrame, bands: int, width: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles, class, bands, signature (low bytes), of every row."""

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        circulant = Circulant(bands * ROWS)
        weights = mix64(np.arange(1, ROWS + 1, dtype=U64)) | U64(1)
        salts = mix64(np.arange(1, bands + 1, dtype=U64) * U64(7919))
        for batch in batches:
            sizes, classes, keys, signatures = [], [], [], []
            for _, shingles in shingle_sets(batch, width):
                sizes.append(len(shingles))
                classes.append(hashlib.blake2b(shingles.tobytes(), digest_size=16).digest())
                if len(shingles):
                    row = circulant.signature(shingles)
                    mixed = mix64((row.reshape(bands, ROWS).astype(U64) * weights).sum(1, dtype=U64) ^ salts)
                    keys.append(mixed.view(np.int64))
                    signatures.append(row.astype(np.uint8).tobytes())
                else:
                    keys.append(np.zeros(0, np.int64))
                    signatures.append(b"")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(sizes, pa.int64()), pa.array(classes, pa.binary()), pa.array(keys, pa.list_(pa.int64())), pa.array(signatures, pa.binary())],
                names=["doc_id", "n_shingles", "class", "bands", "signature"],
            )

    return docs.mapInArrow(sketch, "doc_id bigint, n_shingles bigint, class binary, bands array<bigint>, signature binary")


def least_agreement(threshold: float, coordinates: int) -> int:
    """Equal coordinates that a link has, five standard deviations below its expectation."""
    spread = math.sqrt(threshold * (1 - threshold) * coordinates)
    return math.floor(threshold * coordinates - 5 * spread)


def agreeing(candidates: DataFrame, sketch: DataFrame, least: int) -> DataFrame:
    """Candidates (a, b) whose signatures agree in enough coordinates."""
    own = sketch.select("doc_id", "signature")
    both = candidates.join(own.toDF("a", "s"), "a").join(own.toDF("b", "t"), "b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                s, t = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint8).reshape(batch.num_rows, -1) for c in ("s", "t"))
                yield batch.select(["a", "b"]).filter(pa.array((s == t).sum(1) >= least))

    return both.select("a", "b", "s", "t").mapInArrow(near, "a bigint, b bigint")


def grouped_sets(docs: DataFrame, places: DataFrame, width: int) -> DataFrame:
    """For rows (doc_id, groups array<struct<g1, g2, tag>>) the document's set once in each group."""
    if places.count() <= BROADCAST_ROWS:
        places = F.broadcast(places)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = {"g1": [], "g2": [], "tag": [], "doc_id": [], "shingles": []}
            ids, groups = batch.column("doc_id").to_pylist(), batch.column("groups").to_pylist()
            for r, shingles in shingle_sets(batch.select(["doc_id", "text"]), width):
                data = shingles.tobytes()
                for g in groups[r]:
                    rows["g1"].append(g["g1"])
                    rows["g2"].append(g["g2"])
                    rows["tag"].append(g["tag"])
                    rows["doc_id"].append(ids[r])
                    rows["shingles"].append(data)
                if len(rows["g1"]) >= 2000:
                    yield _batch(rows)
                    rows = {k: [] for k in rows}
            yield _batch(rows)

    return docs.join(places, "doc_id").select("doc_id", "text", "groups").mapInArrow(expand, "g1 bigint, g2 bigint, tag bigint, doc_id bigint, shingles binary")


def _batch(rows: dict) -> pa.RecordBatch:
    kinds = [pa.int64()] * 4 + [pa.binary()]
    return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(rows.values(), kinds, strict=True)], names=list(rows))


def _links(pairs: list[tuple[int, int]]) -> pa.RecordBatch:
    columns = np.array(pairs, np.int64).reshape(-1, 2)
    return pa.RecordBatch.from_arrays([pa.array(columns[:, 0]), pa.array(columns[:, 1])], names=["a", "b"])


class Forest:
    """Union-find over row numbers."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y


def is_link(shared, one, other, share: Fraction):
    """shared / union >= share, in whole numbers."""
    return share.denominator * shared >= share.numerator * (one + other - shared)


def confirm_stars(docs: DataFrame, edges: DataFrame, share: Fraction, width: int) -> DataFrame:
    """The edges (a, b) that are links on full sets. Members of one star are dealt in blocks of bounded size."""
    sizes = edges.groupBy("a").agg(F.ceil(F.count("*") / F.lit(BLOCK)).cast("bigint").alias("parts"))
    dealt = edges.join(sizes, "a").withColumn("part", F.pmod(F.xxhash64("b"), "parts"))
    member = dealt.select(F.col("b").alias("doc_id"), F.struct(F.col("a").alias("g1"), F.col("part").alias("g2"), F.lit(1).cast("bigint").alias("tag")).alias("g"))
    centre = dealt.select("a", "part").distinct().select(F.col("a").alias("doc_id"), F.struct(F.col("a").alias("g1"), F.col("part").alias("g2"), F.lit(0).cast("bigint").alias("tag")).alias("g"))
    places = stored(member.unionByName(centre).groupBy("doc_id").agg(F.collect_list("g").alias("groups")))

    def confirm(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        rows = [(tag, doc, np.frombuffer(s, U64)) for tag, doc, s in zip(*(table.column(c).to_pylist() for c in ("tag", "doc_id", "shingles")), strict=True)]
        found = []
        centres = [s for tag, _, s in rows if tag == 0]
        own = key[0].as_py()
        for tag, doc, s in rows:
            if tag and centres and is_link(len(np.intersect1d(centres[0], s, assume_unique=True)), len(centres[0]), len(s), share):
                found.append((own, doc))
        yield _links(found)

    return grouped_sets(docs, places, width).groupBy("g1", "g2").applyInArrow(confirm, "a bigint, b bigint").distinct()


def blocked(rows: DataFrame, group: str) -> DataFrame:
    """Rows (group, doc_id, component, ...) of a group dealt to blocks, and each block to pairs p <= q of blocks.

    The largest component of a group has blocks of its own, which never meet each other: a huge group
    with a few outsiders costs in proportion to its size. A group that fits one block is one pair.
    """
    parts = rows.groupBy(group, "component").agg(F.count("*").alias("n"))
    sizes = parts.groupBy(group).agg(F.max(F.struct("n", "component")).alias("main"), F.sum("n").alias("size"))
    n_main = F.ceil(F.col("main.n") / F.lit(BLOCK)).cast("int")
    n_rest = F.greatest(F.ceil((F.col("size") - F.col("main.n")) / F.lit(BLOCK)), F.lit(1)).cast("int")
    dealt = rows.join(sizes, group).withColumn("rest", n_rest).withColumn("all", F.col("rest") + n_main)
    whole, main = F.col("size") <= BLOCK, F.col("component") == F.col("main.component")
    hashed = F.xxhash64("doc_id")
    block = F.when(whole, 0).when(main, F.col("rest") + F.pmod(hashed, F.col("all") - F.col("rest"))).otherwise(F.pmod(hashed, F.col("rest")))
    last = F.when(whole, 0).when(main, F.col("rest") - 1).otherwise(F.col("all") - 1)
    dealt = dealt.withColumn("block", block.cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), last.cast("int"))))
    dealt = dealt.withColumn("p", F.least("block", "other")).withColumn("q", F.greatest("block", "other"))
    return dealt.drop("main", "size", "rest", "all", "other")


def possible_links(open_rows: DataFrame, least: int) -> DataFrame:
    """A spanning forest (a, b) of the pairs from different components whose signatures agree enough.

    A pair is looked at in the first bucket it shares, so pairs that meet in many buckets count once.
    """

    def compare(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        doc, part, block, band = (table.column(c).to_numpy() for c in ("doc_id", "component", "block", "band"))
        n = len(doc)
        signature = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint8).reshape(n, -1)
        bands = table.column("bands").combine_chunks().flatten().to_numpy().reshape(n, -1)
        forest, found = Forest(n), []
        across = key[1].as_py() != key[2].as_py()
        for i in range(n - 1):
            other = np.flatnonzero((part[i + 1 :] != part[i]) & ((block[i + 1 :] != block[i]) | (not across))) + i + 1
            other = other[(signature[other] == signature[i]).sum(1) >= least]
            other = other[(bands[other] == bands[i]).argmax(1) == band[0]]
            for j in other:
                if forest.join(i, int(j)):
                    found.append((doc[i], doc[j]))
        yield _links(found)

    return open_rows.groupBy("key", "p", "q").applyInArrow(compare, "a bigint, b bigint").distinct()


def confirm_families(docs: DataFrame, members: DataFrame, share: Fraction, width: int) -> DataFrame:
    """Links between members (family, doc_id, component) of different components; only as many as connect them."""
    placed = blocked(members, "family")
    tag = F.shiftleft(F.col("component"), 1).bitwiseOR((F.col("block") == F.col("p")).cast("bigint"))
    places = placed.groupBy("doc_id").agg(
        F.collect_list(F.struct(F.col("family").alias("g1"), (F.col("p") * F.lit(1 << 31) + F.col("q")).cast("bigint").alias("g2"), tag.alias("tag"))).alias("groups")
    )

    def confirm(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches)
        doc, tags = table.column("doc_id").to_numpy(), table.column("tag").to_numpy()
        sets = [np.frombuffer(s, U64) for s in table.column("shingles").to_pylist()]
        component, side = tags >> 1, tags & 1
        across = key[1].as_py() >> 31 != key[1].as_py() & 0x7FFFFFFF
        sizes = np.array([len(s) for s in sets])
        _, term = np.unique(np.concatenate(sets), return_inverse=True)
        first = np.concatenate(([0], np.cumsum(sizes)))
        order = np.argsort(term, kind="stable")
        owner = np.repeat(np.arange(len(sets)), sizes)[order]
        begins = np.concatenate(([0], np.cumsum(np.bincount(term))))
        forest, found = Forest(len(sets)), []
        root = {}
        for i, c in enumerate(component):
            forest.join(root.setdefault(c, i), i)
        for i in range(len(sets)):
            mine = term[first[i] : first[i + 1]]
            other = np.concatenate([owner[begins[t] : begins[t + 1]] for t in mine])
            shared = np.bincount(other, minlength=len(sets))
            linked = np.flatnonzero(is_link(shared, sizes[i], sizes, share) & (component != component[i]) & ((side != side[i]) | (not across)))
            for j in linked:
                if forest.join(i, int(j)):
                    found.append((doc[i], doc[j]))
        yield _links(found)

    return grouped_sets(docs, stored(places), width).groupBy("g1", "g2").applyInArrow(confirm, "a bigint, b bigint")


def near_duplicates(docs: DataFrame, threshold: Fraction = Fraction(4, 5), width: int = SHINGLE, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, n_shingles, component_id (smallest doc_id that can be reached), one row for each row of docs."""
    bands = bands_for(float(threshold))
    least = least_agreement(float(threshold), bands * ROWS)
    docs = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))
    sketch = stored(sketches(docs, bands, width))
    solid = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = stored(solid.groupBy("class").agg(F.min("doc_id").alias("rep")))
    # below 1 / (1 - t) shingles only equal sets reach the threshold
    own = solid.where(F.col("n_shingles") >= math.floor(threshold / (1 - threshold))).join(classes, "class").where("doc_id = rep")
    own = stored(own.select("doc_id", "bands", "signature").dropDuplicates(["doc_id"]))

    rows = own.select("doc_id", F.posexplode("bands").alias("band", "key"))
    shared = rows.groupBy("key").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("z")).where("a < z").select("key", "a")
    buckets = stored(rows.join(shared, "key"))
    stars = buckets.where("a < doc_id").select("a", F.col("doc_id").alias("b")).distinct()
    links = stored(confirm_stars(docs, stored(agreeing(stars, own, least)), share=threshold, width=width))

    joined = stored(components(links))
    part = F.coalesce("component", "doc_id").alias("component")
    named = buckets.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("key", "band", "doc_id", part)
    open_keys = named.groupBy("key").agg(F.min("component").alias("c"), F.max("component").alias("d")).where("c < d").select("key")
    open_rows = blocked(named.join(open_keys, "key", "left_semi"), "key").join(own, "doc_id")
    possible = stored(possible_links(open_rows, least))

    families = components(possible).withColumnRenamed("node", "doc_id").withColumnRenamed("component", "family")
    members = families.join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left").select("family", "doc_id", part)
    more = confirm_families(docs, stored(members), threshold, width)
    final = stored(components(stored(links.unionByName(more))))

    of_class = classes.join(final, classes.rep == final.node, "left").select("class", F.coalesce("component", "rep").alias("component"))
    named = sketch.select("doc_id", "n_shingles", "class").join(of_class, "class", "left")
    alone = F.when((F.col("n_shingles") == 0) | F.col("doc_id").isNull(), F.col("doc_id"))
    return named.select("doc_id", "n_shingles", F.coalesce(alone, F.when(F.col("doc_id").isNotNull(), F.col("component"))).alias("component_id"))
