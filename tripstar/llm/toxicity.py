"""Toxicity from a weighted lexicon, matched by Aho-Corasick on folded text.

Folding: lower case, compatibility forms and homoglyphs to plain letters, digits and signs inside words to
the letters they stand for, marks and invisible format characters to nothing, everything else to one blank
between words. A lexicon term is a whole word or
the beginning of words; its weight is the log odds of the term between toxic and other training
documents. A word counts with its heaviest term, unless an exception phrase covers it. The evidence of a
document, as it is and by its length, goes through a logistic function fitted on the same training rows.

Training uses at most FIT_ROWS labelled rows, taken in the order of a hash of doc_id. All their terms are
counted and weighed in Spark; every term with enough evidence enters the lexicon.

Defined cases: NULL or empty text has no evidence and gets the score of that; a document with several
labels is toxic if one says so; NULL labels and labels without document are left out; without both
kinds of training rows every score is 0.5; other columns are not read.
"""

from __future__ import annotations

import math
import re
import unicodedata
from bisect import bisect_right
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import accumulate

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from tripstar.llm.tables import stored
from tripstar.llm.text import forget, slices
from tripstar.session import small_batches

FIT_ROWS = 200_000
PREFIXES = range(4, 11)
LEAST_EVIDENCE = 14.0  # log-likelihood ratio that a term needs to enter the lexicon
THRESHOLD = 0.7
SEED_WEIGHT = 3.0  # of a seed word that the training rows don't speak against

# Letters that look like Latin ones, and digits and signs read as letters.
HOMOGLYPHS = {
    "а": "a", "е": "e", "о": "o", "р": "p", "с": "c", "у": "y", "х": "x", "і": "i", "ј": "j", "ѕ": "s", "һ": "h", "ԁ": "d", "ԛ": "q", "ԝ": "w", "м": "m", "т": "t", "к": "k", "ɡ": "g", "ı": "i",
    "α": "a", "ο": "o", "ρ": "p", "ν": "v", "ι": "i", "κ": "k", "τ": "t", "υ": "u", "ε": "e", "χ": "x",
}
SUBSTITUTES = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "8": "b", "9": "g"}
SIGNS = {"@": "a", "$": "s", "!": "i"}
EXCEPTIONS = ("trash can", "trash bin", "clown fish", "class clown", "pond scum", "sore loser")
# Insults known before any training.
SEEDS = (
    "idiot", "idiots", "moron", "morons", "imbecile", "stupid", "dumb", "scum", "trash", "garbage", "pathetic", "disgusting", "worthless",
    "loser", "losers", "clown", "filth", "vermin", "bastard", "bitch", "asshole", "dumbass", "retard", "slut", "whore", "fuck", "fucking", "shit",
    "arschloch", "dummkopf", "connard", "salaud", "cabron", "pendejo", "imbecil",
)

_SIGN_INSIDE = re.compile(r"(?<=\w)[@$!](?=\w)")


class _Folding(dict):
    """Translation of one character; worked out when first met."""

    def __missing__(self, code: int) -> str:
        parts = unicodedata.normalize("NFKD", chr(code)).lower()
        char = unicodedata.normalize("NFKC", "".join(c for c in parts if unicodedata.category(c) not in ("Cf", "Mn", "Me")))
        char = "".join(SUBSTITUTES.get(c, HOMOGLYPHS.get(c, c)) for c in char)
        self[code] = out = "".join(c if c.isalnum() else " " for c in char)
        return out


_FOLDING = _Folding()


def fold(text: str | None) -> str:
    """Words of the folded text, each with a blank before and after."""
    if not text:
        return " "
    if "@" in text or "$" in text or "!" in text:
        text = _SIGN_INSIDE.sub(lambda m: SIGNS[m[0]], text)
    return f" {' '.join(text.translate(_FOLDING).split())} "


def terms_of(folded: str) -> set[str]:
    """Every whole word, and every beginning of a longer word."""
    found = set()
    for word in set(folded.split()):
        found.add(f" {word} ")
        found.update(f" {word[:n]}" for n in PREFIXES if n < len(word))
    return found


class Matcher:
    """Aho-Corasick automaton over the terms and the exception phrases."""

    def __init__(self, weights: dict[str, float], exceptions: tuple[str, ...] = EXCEPTIONS):
        self.automaton = ahocorasick.Automaton()
        for term, weight in weights.items():
            self.automaton.add_word(term, (len(term), weight))
        for phrase in exceptions:
            if f" {phrase} " not in weights:
                self.automaton.add_word(f" {phrase} ", (len(phrase) + 2, 0.0))
        self.any = len(self.automaton) > 0
        if self.any:
            self.automaton.make_automaton()

    def words(self, folded: str) -> dict[int, float]:
        """Position and weight of the words that count."""
        best, excepted = {}, []
        if self.any:
            for end, (size, weight) in self.automaton.iter(folded):
                at = end - size + 1
                if not weight:
                    excepted.append((at, end))
                elif weight > best.get(at, 0.0):
                    best[at] = weight
        if excepted:
            excepted.sort()
            starts = [a for a, _ in excepted]
            reach = list(accumulate((b for _, b in excepted), max))
            best = {at: weight for at, weight in best.items() if not (k := bisect_right(starts, at)) or reach[k - 1] <= at}
        return best

    def features(self, folded: str) -> tuple[float, ...]:
        weights = self.words(folded).values()
        total, words = sum(weights), folded.count(" ") - 1
        return math.log1p(total), math.log1p(100 * total / (words + 10)), math.log1p(words), max(weights, default=0.0), math.log1p(len(weights))


@dataclass
class Model:
    weights: dict[str, float] = field(default_factory=dict)
    exceptions: tuple[str, ...] = EXCEPTIONS
    centre: np.ndarray = field(default_factory=lambda: np.zeros(5))
    scale: np.ndarray = field(default_factory=lambda: np.ones(5))
    slopes: np.ndarray = field(default_factory=lambda: np.zeros(6))

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = (features - self.centre) / self.scale
        return 1 / (1 + np.exp(-np.clip(self.slopes[0] + x @ self.slopes[1:], -35, 35)))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1.0, steps: int = 40) -> np.ndarray:
    """Newton steps for a logistic regression with intercept first; the intercept is not shrunk."""
    x = np.column_stack([np.ones(len(x)), x])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    b = np.zeros(x.shape[1])
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(x @ b, -35, 35)))
        step = np.linalg.solve((x.T * np.maximum(p * (1 - p), 1e-9)) @ x + penalty, x.T @ (y - p) - penalty @ b)
        b += np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    return b


def _evidence(a: Column, n: int, b: Column, m: int) -> Column:
    """Log-likelihood ratio of a of n against b of m."""
    share = (a + b) / (n + m)
    parts = [(a, n * share), (b, m * share), (n - a, n * (1 - share)), (m - b, m * (1 - share))]
    terms = [F.when(k > 0, k * F.log(k / F.greatest(e, F.lit(1e-300)))).otherwise(0.0) for k, e in parts]
    return 2 * (terms[0] + terms[1] + terms[2] + terms[3])


def _term_counts(train: DataFrame) -> DataFrame:
    """term, a, b: toxic and other documents that hold the term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = Counter(), Counter()

        def flush() -> pa.RecordBatch:
            terms = list(counts[0].keys() | counts[1].keys())
            columns = [pa.array(terms, pa.string()), *(pa.array([c[t] for t in terms], pa.int64()) for c in (counts[1], counts[0]))]
            for c in counts:
                c.clear()
            return pa.RecordBatch.from_arrays(columns, names=["term", "a", "b"])

        for batch in batches:
            for toxic, folded in zip(batch.column("toxic").to_pylist(), batch.column("folded").to_pylist(), strict=True):
                counts[toxic > 0].update(terms_of(folded))
                if len(counts[0]) + len(counts[1]) > 1 << 18:
                    yield flush()
        yield flush()

    return train.select("toxic", "folded").mapInArrow(count, "term string, a bigint, b bigint").groupBy("term").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))


def weighed_terms(train: DataFrame, n: int, m: int) -> DataFrame:
    """term, weight, evidence of all terms, from n toxic and m other folded documents."""
    a, b = F.col("a"), F.col("b")
    weight = F.log((a + 0.5) / (n - a + 0.5)) - F.log((b + 0.5) / (m - b + 0.5))
    return _term_counts(train).where("a > 2").select("term", weight.alias("weight"), _evidence(a, n, b, m).alias("evidence"))


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, text: str = "text", doc_id: str = "doc_id", toxic: str = "toxic", exceptions: tuple[str, ...] = EXCEPTIONS) -> Model:
    """Lexicon and logistic function from labelled documents; words within exception phrases never count."""
    chosen = labels.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(toxic).cast("int").alias("toxic")).where("doc_id IS NOT NULL AND toxic IS NOT NULL")
    chosen = chosen.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    narrow = docs.select(F.col(doc_id).cast("bigint").alias("doc_id"), F.col(text).alias("text"))

    def folded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        for batch in batches:
            for part in slices(batch):
                yield pa.RecordBatch.from_arrays([part.column("toxic"), pa.array([fold(t) for t in part.column("text").to_pylist()], pa.string())], names=["toxic", "folded"])

    # at most ``rows`` labels of a few bytes each are sent to the workers
    with small_batches(docs.sparkSession):
        train = stored(narrow.join(F.broadcast(chosen), "doc_id").select("toxic", "text").mapInArrow(folded, "toxic int, folded string"))
    sizes = {r.toxic: r["count"] for r in train.groupBy("toxic").count().collect()}
    n, m = sizes.get(1, 0), sizes.get(0, 0)
    if not n or not m:
        return Model()
    weights = {f" {fold(w).strip()} ": SEED_WEIGHT for w in SEEDS}
    wanted = F.col("term").isin(*weights) | ((F.col("weight") > 1) & (F.col("evidence") >= LEAST_EVIDENCE))
    # the lexicon: the few terms that at most ``rows`` documents give that much evidence for
    for r in weighed_terms(train, n, m).where(wanted).collect():
        if r.weight > 1 and r.evidence >= LEAST_EVIDENCE:
            weights[r.term] = max(r.weight, weights.get(r.term, 0.0))
        elif r.weight <= 0:
            weights.pop(r.term, None)
    model = Model(weights, tuple(fold(e).strip() for e in exceptions))
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        matcher = Matcher(shared.value.weights, shared.value.exceptions)
        for batch in batches:
            rows = [matcher.features(t) for t in batch.column("folded").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("toxic"), pa.array(rows, pa.list_(pa.float64()))], names=["toxic", "x"])

    table = train.mapInArrow(features, "toxic int, x array<double>").toPandas()
    x, y = np.stack(table["x"].to_numpy()), (table["toxic"] > 0).to_numpy(float)
    model.centre, model.scale = x.mean(0), np.maximum(x.std(0), 1e-6)
    model.slopes = logistic((x - model.centre) / model.scale, y)
    return model


def score(docs: DataFrame, model: Model, text: str = "text", into: str = "score") -> DataFrame:
    """docs with its score added as the column ``into``; a column of that name is replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forget()
        matcher = Matcher(shared.value.weights, shared.value.exceptions)
        for batch in batches:
            for part in slices(batch, text):
                rows = [matcher.features(fold(t)) for t in part.column(text).to_pylist()]
                scores = shared.value.scores(np.array(rows).reshape(-1, 5))
                yield pa.RecordBatch.from_arrays([*part.columns, pa.array(scores)], names=[*part.schema.names, into])

    rest = docs.select(*(F.col(f"`{c}`") for c in docs.columns if c != into))
    return rest.mapInArrow(scored, T.StructType([*rest.schema.fields, T.StructField(into, T.DoubleType())]))
