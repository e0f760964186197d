"""The stream of file names."""

from sample import clean_line, sample, write_csv

from tripstar.sources import layers
from tripstar.streaming.file_stream import ingest_stream


def drain(spark, layout, checkpoint, **options):
    query = ingest_stream(spark, layout, checkpoint, **options)
    query.awaitTermination(120)
    assert query.exception() is None


def counts(spark, layout):
    rows = layers.saved_counts(spark, layout).collect()
    return {(r.layer, r.source_file[-11:-4]): r.records for r in rows}


def test_each_file_is_taken_once(spark, layout, tmp_path):
    checkpoint = str(tmp_path / "checkpoint")
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", sample(2, 1))
    write_csv(layout.raw, "yellow_tripdata_2019-02.csv", [clean_line(2, "2019-02-01")], order=[5, 4, 3, 2, 1, 0])
    drain(spark, layout, checkpoint, max_files_per_trigger=1)
    first = counts(spark, layout)
    assert first == {("silver", "2019-01"): 2, ("quarantine", "2019-01"): 1, ("silver", "2019-02"): 1}
    runs = {r.run_id for r in layers.latest_metrics(spark, layout).collect()}
    assert len(runs) == 2

    drain(spark, layout, checkpoint)
    assert counts(spark, layout) == first

    write_csv(layout.raw, "yellow_tripdata_2019-03.csv", sample(4, 0, "2019-03-01"))
    drain(spark, layout, checkpoint)
    assert counts(spark, layout) == {**first, ("silver", "2019-03"): 4}
    got = [r.source_file for r in layers.latest_metrics(spark, layout).collect() if r.run_id not in runs]
    assert got == ["yellow_tripdata_2019-03.csv"]


def test_fresh_checkpoint_and_rejected_files(spark, layout, tmp_path):
    write_csv(layout.raw, "yellow_tripdata_2019-01.csv", sample(2, 1))
    bad = f"{layout.raw}/yellow_tripdata_2019-02.csv"
    with open(bad, "w", encoding="utf-8") as out:
        out.write("a,b\n1,2\n")
    drain(spark, layout, str(tmp_path / "one"))
    before = {r.source_file: r.run_id for r in layers.latest_metrics(spark, layout).collect()}
    drain(spark, layout, str(tmp_path / "two"))  # knows nothing of the first
    after = {r.source_file: r.run_id for r in layers.latest_metrics(spark, layout).collect()}
    good = "yellow_tripdata_2019-01.csv"
    assert after[good] == before[good]
    write_csv(layout.raw, "yellow_tripdata_2019-02.csv", sample(3, 0, "2019-02-01"))
    drain(spark, layout, str(tmp_path / "two"))  # no new name, but the file was rejected before
    assert counts(spark, layout)[("silver", "2019-02")] == 3
