import json

from pyspark.sql import functions as F

from studyloom.operators import progress
from studyloom.streaming import incremental as inc


def test_runs_process_each_key_once_and_retry_failures(spark, tmp_path):
    ledger, output = str(tmp_path / "ledger"), str(tmp_path / "out")
    healed = {"on": False}

    def process(df):
        bad = (F.col("key") == "k2") & (not healed["on"])
        return df.withColumns({"ok": ~bad, "error": F.when(bad, "boom"),
                               "value": F.upper("key")})

    def work(*keys):
        return spark.createDataFrame([(k,) for k in keys], "key string")

    first = inc.run_pending(work("k1", "k2"), ledger, "zip", "key", process, output)
    assert {r.key for r in first.collect()} == {"k1", "k2"}
    healed["on"] = True
    second = inc.run_pending(work("k1", "k2", "k3"), ledger, "zip", "key", process, output)
    assert {r.key for r in second.collect()} == {"k2", "k3"}
    third = inc.run_pending(work("k1", "k2", "k3"), ledger, "zip", "key", process, output)
    assert third.isEmpty()
    once = process(work("k1", "k2", "k3")).select("key", "ok", "value")
    total = inc.latest_results(spark.read.parquet(output), "key").select("key", "ok", "value")
    assert total.exceptAll(once).isEmpty() and once.exceptAll(total).isEmpty()
    tries = {(r.key, r.attempt, r.status) for r in inc.read_ledger(spark, ledger).collect()}
    assert tries == {("k1", 1, "ok"), ("k2", 1, "failed"), ("k2", 2, "ok"), ("k3", 1, "ok")}


def test_failures_may_be_settled(spark):
    ledger = spark.createDataFrame([("j", "a", "failed", 1), ("j", "b", "ok", 1),
                                    ("j", "c", "ok", 1), ("j", "c", "failed", 2)],
                                   "job string, key string, status string, attempt int")
    work = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "key string")
    assert {r.key for r in progress.pending(work, ledger, "key").collect()} == {"a", "c", "d"}
    assert {r.key for r in inc.disc_images_to_extract(
        work.withColumnRenamed("key", "path"), ledger, retry_failed=False)
        .withColumnRenamed("path", "key").collect()} == {"d"}


def test_failed_location_is_run_again(spark):
    locations = spark.createDataFrame([("a",), ("b",), ("c",)], "location string")
    ledger = spark.createDataFrame([("a", "failed", 1), ("b", "ok", 2)],
                                   "location string, status string, ts int")
    got = {r.location for r in progress.locations_to_run(locations, ledger).collect()}
    assert got == {"a", "c"}


def test_stream_takes_only_new_files(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")
    (source / "a.dcm").write_text("1")
    inc.run_available(inc.new_files(spark, str(source)), out, checkpoint)
    (source / "b.dcm").write_text("22")
    inc.run_available(inc.new_files(spark, str(source)), out, checkpoint)
    inc.run_available(inc.new_files(spark, str(source)), out, checkpoint)
    rows = spark.read.parquet(out).collect()
    assert sorted(r.path.rsplit("/", 1)[1] for r in rows) == ["a.dcm", "b.dcm"]
    assert len({r.batch for r in rows}) == 2


def test_stream_of_records_with_transform(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    (source / "s.jsonl").write_text(json.dumps({"patient_id": "P1"}) + "\n")
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def parse(batch):
        return batch.select("source_file", F.from_json("value", "patient_id string").alias("r")) \
            .select("source_file", "r.*")

    inc.run_available(inc.new_lines(spark, str(source)), out, checkpoint, parse)
    assert spark.read.parquet(out).first().patient_id == "P1"


def test_archives_are_done_when_noted_present_and_readable(spark):
    studies = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "study string")
    ledger = spark.createDataFrame([("a", "ok", 1), ("b", "ok", 1), ("c", "ok", 1),
                                    ("c", "failed", 2)], "key string, status string, ts int")
    archives = spark.createDataFrame([("a", True), ("b", False), ("c", True)],
                                     "study string, readable boolean")
    got = {r.study for r in progress.studies_to_archive(studies, ledger, archives).collect()}
    assert got == {"b", "c", "d"}


def test_one_bad_or_missing_part_undoes_an_archive(spark):
    studies = spark.createDataFrame([(x,) for x in "abc"], "study string")
    ledger = spark.createDataFrame([(x, "ok", 1) for x in "abc"],
                                   "key string, status string, ts int")
    archives = spark.createDataFrame(
        [("a", True, 2), ("a", True, 2), ("b", True, 2), ("b", False, 2), ("c", True, 2)],
        "study string, readable boolean, parts int")
    got = {r.study for r in progress.studies_to_archive(studies, ledger, archives).collect()}
    assert got == {"b", "c"}


def test_series_are_done_by_ledger_or_output_files(spark):
    tracker = spark.createDataFrame([("h1",), ("h2",), ("h3",), ("h4",)], "hash_id string")
    ledger = spark.createDataFrame([("h1", "ok"), ("Er_h2", "failed")],
                                   "key string, status string")
    files = [f"/o/{d}/{n}" for d, names in {
        "h3": ["x.nii.gz", "h3.json", "PATIENT_DATA_h3.zip"], "h4": ["x.nii", "h4.json"]}.items()
        for n in names]
    listing = spark.createDataFrame([(f,) for f in files], "path string")
    got = {r.hash_id for r in progress.series_to_convert(tracker, ledger, listing).collect()}
    assert got == {"h2", "h4"}
