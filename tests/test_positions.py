"""Places and running sums in a given order."""

import random

from pyspark.sql import functions as F

from tripstar.operators.positions import row_places, sums_before


def test_places_and_sums(spark):
    rng = random.Random(2)
    rows = [(rng.choice("aab"), i, rng.randint(0, 5)) for i in range(500)]
    df = spark.createDataFrame(rows, "k string, i int, n bigint").repartition(7)
    order = [F.col("k"), F.desc("i")]
    expected = sorted(rows, key=lambda r: (r[0], -r[1]))
    placed = row_places(df, order, 5, "place").collect()
    assert sorted((r.place, r.k, r.i) for r in placed) == [(p, k, i) for p, (k, i, _) in enumerate(expected)]
    found = sums_before(df, order, 5, before=F.col("n"), place=F.lit(1)).collect()
    sums = {(r.k, r.i): r.before for r in found}
    assert sorted((r.place, r.k, r.i) for r in found) == [(p, k, i) for p, (k, i, _) in enumerate(expected)]
    total = 0
    for k, i, n in expected:
        assert sums[k, i] == total
        total += n


def test_one_key_and_no_rows(spark):
    same = spark.range(100).select(F.lit(1).alias("k"), "id")
    assert sorted(r.p for r in row_places(same, [F.col("k")], 4, "p").collect()) == list(range(100))
    assert row_places(same.limit(0), [F.col("id")], 4, "p").count() == 0
    assert sums_before(same.limit(0), [F.col("id")], 4, p=F.col("id")).count() == 0
