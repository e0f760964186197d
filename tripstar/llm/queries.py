"""The operators of this folder as queries (spark, sf_dir) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from fractions import Fraction

from pyspark.sql import DataFrame, SparkSession, functions as F

from tripstar.llm import clustering, decontamination, kneser_ney, line_dedup, minhash, neighbours, packing, pii, pivot_search, resampling, suffix_dedup, token_counts, toxicity
from tripstar.llm.tables import documents


def crc_mod(n: int):
    return F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(n))


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").where(crc_mod(3) != 1)
    scored = toxicity.score(docs, toxicity.fit(docs, labels))
    held_out = F.coalesce(crc_mod(3) == 1, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    found = decontamination.decontaminate(documents(spark, sf_dir), benchmark)
    names = F.array_sort(F.transform("items", lambda i: i.cast("string")))
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(names, ",").cast("binary"), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = suffix_dedup.remove_repeats(documents(spark, sf_dir), length=100)
    return found.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).alias("n_removed"),
        (F.size("spans") / 2).cast("bigint").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op4_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = minhash.near_duplicates(documents(spark, sf_dir), threshold=Fraction(85, 100))
    return found.select("*", (F.col("doc_id") == F.col("component_id")).alias("kept"))


def op5_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = F.sha2(F.col("text").cast("binary"), 256)
    return line_dedup.drop_lines(documents(spark, sf_dir)).select("doc_id", "n_lines", "n_dropped", kept.alias("kept_sha256"))


def op6_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find_personal_data(documents(spark, sf_dir))

    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    counts = [F.size(of(kind)).cast("bigint").alias(f"n_{kind}") for kind in pii.BASE]
    return found.select("doc_id", *counts, F.sha2(listed(of(*pii.BASE)).cast("binary"), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), keep_ids=False)


NOTICE = "(This work is licensed|Licensed under)[^\\n]*"


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    rollup = token_counts.Rollup(spark)
    return token_counts.corpus_history(documents(spark, sf_dir), NOTICE, ["words-1", "words-2"], rollup)


def op9_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return neighbours.nearest(vectors, lambda vec_id: vec_id % 20 == 0, k=20)


def op10_kneser_ney(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir).select("doc_id", "text")
    model = kneser_ney.fit(docs.where(crc_mod(7) != 2))
    held_out = F.coalesce(crc_mod(7) == 2, F.lit(False)).alias("held_out")
    known = F.lit(model.tokens).cast("bigint").alias("train_tokens")
    return kneser_ney.score(docs, model).select("doc_id", held_out, "n_tokens", "n_known", known, "base_score", "score")


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    return resampling.resample(documents(spark, sf_dir), benchmark, percent=25, salt=7, least_words=20)


def op12_exact_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return pivot_search.top_products(vectors, lambda vec_id: vec_id % 50 == 0, k=5)


def op13_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    points = clustering.integer_vectors(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), dimensions=64)
    return clustering.clusters(points, clustering.fit(points, k=40, rounds=5, salt=2))


def all_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    text = (op1_toxicity, op2_decontamination, op3_suffix_dedup, op4_minhash, op5_line_dedup, op6_pii, op7_packing, op8_token_counts, op10_kneser_ney, op11_resampling)
    vectors = (op9_neighbours, op12_exact_search, op13_kmeans)
    return {f.__name__: f for f in (*text, *vectors)}
