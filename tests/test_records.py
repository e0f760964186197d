"""Records with quoted line breaks against a plain reader, whatever the splits."""

import csv
import io
import random

import numpy as np
import pytest

from tripstar.session import session_with
from tripstar.sources import records


def line_end(line, inside):
    """One character at a time."""
    state = "quoted" if inside else "start"
    for ch in line:
        if state == "quoted":
            state = "quote" if ch == '"' else "quoted"
        elif state == "quote" and ch == '"':
            state = "quoted"
        elif ch == ",":
            state = "start"
        elif state == "start" and ch == '"':
            state = "quoted"
        else:
            state = "plain"
    return state == "quoted"


def some_lines(seed, n=400):
    rng = random.Random(seed)
    return ["".join(rng.choices('ab,"', weights=(4, 1, 2, rng.choice((0, 1, 3))), k=rng.randint(0, 14))) for _ in range(n)]


def test_line_ends(spark):
    lines = some_lines(1) + ['"' + 'a""' * 50_000, ",".join(['"x,y"'] * 50_000) + ',"z', '"' + "a" * 500_000]
    df = spark.createDataFrame([(x,) for x in lines], "value string").selectExpr("'p' AS _path", "0L AS _block", "value")
    for row in records.line_ends(df).collect():
        assert (row.outside, row.inside) == (line_end(row.value, False), line_end(row.value, True)), row.value[:50]


def test_runs_compose():
    for seed in range(20):
        lines = some_lines(seed, 30)
        flags = [np.array([line_end(x, b) for x in lines]) for b in (False, True)]
        for begins in (False, True):
            state, want = begins, []
            for line in lines:
                state = line_end(line, state)
                want.append(state)
            assert records.ends_inside(*flags, begins).tolist() == want


def written(path, rows):
    with open(path, "w", encoding="utf-8", newline="") as out:
        csv.writer(out, lineterminator="\n").writerows(rows)


@pytest.mark.parametrize("split", [90, 1 << 20])
def test_records_of_any_splits(spark, tmp_path, split):
    rng = random.Random(split)
    want = []
    for k in range(3):
        words = ["x", "a,b", "two\nlines", '"', "many\n\n\nlines\n" * 3, "", 'q"\n"', ",\n,"]
        rows = [["id", "head\nline" if k == 1 else "text", "more"]] + [[f"{k}-{i}", rng.choice(words), rng.choice(words)] for i in range(30)]
        written(tmp_path / f"{k}.csv", rows)
        want += rows[1:]
    small = session_with(spark, {"spark.sql.files.maxPartitionBytes": str(split), "spark.sql.files.openCostInBytes": "1"})
    found, broken = records.read_records(small, [str(tmp_path / f"{k}.csv") for k in range(3)], str(tmp_path / "out"))
    got = [next(csv.reader(io.StringIO(row.value, newline=""))) for row in found.collect()]
    assert sorted(got) == sorted(want) and broken == []


def test_open_end(spark, tmp_path):
    (tmp_path / "a.csv").write_text('h,i\n1,"x\n2,3\n')
    (tmp_path / "b.csv").write_text("h,i\n1,2\n\n \t\n3,4")
    found, broken = records.read_records(spark, [str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], str(tmp_path / "out"))
    assert sorted(r.value for r in found.collect()) == ["1,2", "3,4"]
    assert [b.rsplit("/", 1)[1] for b in broken] == ["a.csv"]
