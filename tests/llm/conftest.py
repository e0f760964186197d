import pytest
from pyspark.sql import types as T

DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()), T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType())]
)
# names that operators use inside themselves
CLASHING = ["score", "key", "band", "component", "class", "spans", "n_words", "folded", "hash", "rest", "start", "length", "v", "point", "items"]

LONG = "wort " * 30000 + "end"
ODD_TEXTS = [
    None,
    "",
    " \n\t ",
    "a",
    "one line\none line\nthe very same long line\n",
    "The very same long line\nother text that is here only once",
    LONG,
    LONG,
    "é" * 500,
    "x" * 5000,
    "IDIOT 1d10t idiоt 한국어 　 mail me: a.b@c.de, +49 (30) 123-4567, 4111 1111 1111 1111, 10.0.0.1",
    "\n\n\n",
]


@pytest.fixture(scope="session")
def frame(spark):
    """Documents from (doc_id, text) pairs, dealt over several partitions, with columns of clashing names."""

    def make(rows, clash=True, partitions=4):
        full = [(i, t, "en", "s", None if t is None else len(t)) for i, t in rows]
        df = spark.createDataFrame(full, DOCUMENTS).repartition(partitions)
        if clash:
            for name in CLASHING:
                df = df.selectExpr("*", f"'clash' AS `{name}`")
        return df

    return make


@pytest.fixture(scope="session")
def odd_rows():
    """NULL and empty texts, very long ones, ties, repeated rows and rows without doc_id."""
    rows = [(k, t) for k, t in enumerate(ODD_TEXTS)]
    return [*rows, rows[4], rows[6], (None, None), (None, "the very same long line"), (None, "text without a number " * 20)]
