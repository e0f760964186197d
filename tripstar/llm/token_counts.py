"""Token counts kept up to date by signed deltas.

A batch is a table of signed counts: inserted documents with plus, deleted ones with minus, revised ones
with minus for the old count and plus for the new one. A commit adds up the batch by source, language and
tokenizer version, writes these few rows, and then records the batch. After COMPACT_AFTER batches the totals
are stored as a new generation, which lists the batches it holds; totals are the newest generation plus the
batches recorded since, so history is never counted again.

A batch counts once: a batch that is recorded is not written again, and rows of an attempt that broke
off before its record are never read. Commits of one rollup come from one writer at a time.

Defined cases: NULL source, language or tokenizer is a group of its own; NULL or empty text counts 0 tokens
and 1 document; repeated rows count each; an empty batch is recorded and changes nothing; other columns
are not read.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession, functions as F

from tripstar.llm.bpe import default_tokenizer, encoder
from tripstar.llm.tables import stored
from tripstar.llm.text import ALPHANUMERIC, LOWER, NOT_SPACE, Block, blocks
from tripstar.session import scratch_folder

GROUP = ["source", "lang", "tokenizer"]
DELTAS = "source string, lang string, tokenizer string, n_docs bigint, n_tokens bigint"
RECORDS = "batch string, attempt string"
HELD = "generation int, batch string"
COMPACT_AFTER = 64


def _words(word_bytes: np.ndarray, fold: np.ndarray | None = None) -> Callable[[Block], np.ndarray]:
    return lambda block: np.diff(block.words(word_bytes if fold is None else word_bytes[fold])[2])


#: Tokenizer versions: how many tokens each text of a block has.
COUNTERS: dict[str, Callable[[Block], np.ndarray]] = {
    "words-1": _words(NOT_SPACE),
    "words-2": _words(ALPHANUMERIC, LOWER),
    "byte_bpe_50k": lambda block: encoder(default_tokenizer()).encode(block)[1],
}


def counted(docs: DataFrame, tokenizers: list[str], text: str = "text", keep: tuple[str, ...] = ("doc_id", "source", "lang")) -> DataFrame:
    """The kept columns, tokenizer and n_tokens: a row for each document and tokenizer version."""
    rest = docs.select(*keep, F.col(text).alias("_text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, block in blocks(batch, "_text"):
                columns = part.columns[:-1]
                for name in tokenizers:
                    n = COUNTERS[name](block).astype(np.int64)
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([name] * len(n), pa.string()), pa.array(n)], names=[*keep, "tokenizer", "n_tokens"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest.schema.fields[:-1])
    return rest.mapInArrow(count, f"{fields}, tokenizer string, n_tokens bigint")


def inserted(counts: DataFrame) -> DataFrame:
    return counts.select(*GROUP, F.lit(1).cast("bigint").alias("n_docs"), F.col("n_tokens").cast("bigint").alias("n_tokens"))


def deleted(counts: DataFrame) -> DataFrame:
    return inserted(counts).withColumn("n_docs", -F.col("n_docs")).withColumn("n_tokens", -F.col("n_tokens"))


def revised(old: DataFrame, new: DataFrame) -> DataFrame:
    return deleted(old).unionByName(inserted(new))


class Rollup:
    """Totals below one folder. Opening a folder that holds none yet begins an empty one.

    Batches may have any name; their folders are named by its hash.
    """

    def __init__(self, spark: SparkSession, folder: str | None = None):
        self.spark, self.folder = spark, folder or scratch_folder(spark)
        # empty tables, so that all can always be read
        self._empty(RECORDS, "records/none")
        self._empty(DELTAS, "totals/0")
        self._empty(HELD, "held/0")

    def _empty(self, schema: str, place: str) -> None:
        self.spark.createDataFrame([], schema).coalesce(1).write.mode("ignore").parquet(f"{self.folder}/{place}")

    def records(self) -> DataFrame:
        """batch, attempt: one row for each recorded batch."""
        return self.spark.read.schema(RECORDS).parquet(f"{self.folder}/records/*")

    def _delta(self, batch: str, attempt: str) -> str:
        return f"{self.folder}/deltas/{sha256(batch.encode()).hexdigest()}/{attempt}"

    def _held(self) -> DataFrame:
        """generation, batch: what each finished generation of totals holds."""
        return self.spark.read.schema(HELD).parquet(f"{self.folder}/held/*")

    def _generation(self) -> int:
        return self._held().agg(F.coalesce(F.max("generation"), F.lit(0))).first()[0]

    def _later(self, generation: int) -> list[Row]:
        """Records of the batches that the generation lacks: about COMPACT_AFTER."""
        return self.records().join(self._held().where(F.col("generation") == generation), "batch", "left_anti").collect()

    def _sums(self, generation: int, later: list[Row]) -> DataFrame:
        paths = [f"{self.folder}/totals/{generation}", *(self._delta(r.batch, r.attempt) for r in later)]
        sums = self.spark.read.schema(DELTAS).parquet(*paths).groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        return sums.where("n_docs <> 0 OR n_tokens <> 0")

    def commit(self, batch: str, deltas: DataFrame) -> bool:
        """Add a batch; False if it is recorded already."""
        if not self.records().where(F.col("batch") == batch).isEmpty():
            return False
        attempt = uuid.uuid4().hex
        sums = deltas.groupBy(*GROUP).agg(F.sum("n_docs").alias("n_docs"), F.sum("n_tokens").alias("n_tokens"))
        sums.write.mode("error").parquet(self._delta(batch, attempt))
        record = self.spark.createDataFrame([(batch, attempt)], RECORDS).coalesce(1)
        # a second record of the batch fails
        record.write.mode("error").parquet(f"{self.folder}/records/{sha256(batch.encode()).hexdigest()}")
        if len(self._later(self._generation())) >= COMPACT_AFTER:
            self.compact()
        return True

    def compact(self) -> None:
        """Store the totals as the next generation. It counts once its list of batches is written, last."""
        now = self._generation()
        later = self._later(now)
        if not later:
            return
        self._sums(now, later).write.mode("overwrite").parquet(f"{self.folder}/totals/{now + 1}")
        old = self._held().where(F.col("generation") == now).select("batch")
        held = old.unionByName(self.spark.createDataFrame([(r.batch,) for r in later], "batch string"))
        held.select(F.lit(now + 1).alias("generation"), "batch").write.mode("overwrite").parquet(f"{self.folder}/held/{now + 1}")

    def totals(self) -> DataFrame:
        """source, lang, tokenizer, n_docs, n_tokens; groups without documents are gone."""
        now = self._generation()
        return self._sums(now, self._later(now))


def corpus_history(docs: DataFrame, notice: str, tokenizers: list[str], rollup: Rollup) -> DataFrame:
    """Totals after a corpus was loaded, stripped of a notice, and cleared of later copies.

    Three batches: all documents come in; those that hold the notice are revised; of equal original
    texts all but the smallest doc_id leave again. Each batch is handed in twice and counts once.
    """
    stripped = F.regexp_replace("text", notice, "")
    both = docs.select("doc_id", "source", "lang", "text", stripped.alias("new")).withColumn("changed", ~F.col("text").eqNullSafe(F.col("new")))
    both = both.withColumn("copy", F.sha2("text", 256))
    keep = ("doc_id", "source", "lang", "copy", "changed")
    old = stored(counted(both, tokenizers, keep=keep))
    new = stored(counted(both.where("changed"), tokenizers, text="new", keep=keep))
    now = old.where("NOT changed").unionByName(new)
    first = now.where("copy IS NOT NULL").groupBy("copy").agg(F.min("doc_id").alias("first"))
    later = now.join(first, "copy").where("doc_id > first")
    batches = {"load": inserted(old), "notices": revised(old.where("changed"), new), "copies": deleted(later)}
    for name, deltas in batches.items():
        rollup.commit(name, deltas)
        rollup.commit(name, deltas)
    return rollup.totals()
