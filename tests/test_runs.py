import pytest
from pyspark.sql import functions as F

from studyloom.operators import reports, studies
from studyloom.plans import runs

SCHEMA = "source_file string, original_records long, after_dedup long, problem string"


@pytest.fixture
def checked(spark):
    rows = [("a", 12, 11, None), ("b", 4, 4, None), ("skip", 30, 30, None), ("bad", None, None, "x")]
    return studies.apply_filters(spark.createDataFrame(rows, SCHEMA),
                                 [studies.minimum_files(F.col("after_dedup"), 10)])


def test_details_and_totals_come_from_one_pass(spark, checked, tmp_path):
    calls = spark.sparkContext.accumulator(0)

    def counted(batches):
        for batch in batches:
            calls.add(batch.num_rows)
            yield batch

    seen = checked.mapInArrow(counted, checked.schema)
    figures = runs.write_filter_run(seen, str(tmp_path), {"min_files": "10"},
                                    F.col("source_file") == "skip", F.col("problem"))
    assert calls.value == 4
    details = {r.source_file: r for r in spark.read.json(str(tmp_path / "details")).collect()}
    assert {k: r.status for k, r in details.items()} == {
        "a": "PASSED", "b": "FAILED", "skip": "SKIPPED", "bad": "ERROR"}
    assert details["a"].output_file == "S3_processForStore_a" and details["bad"].error == "x"
    assert details["a"].filter_results == ["Filter 1: Passed: 11 files >= 10 minimum"]
    want = studies.filter_statistics(checked, F.col("source_file") == "skip",
                                     F.col("problem").isNotNull()).first().asDict()
    assert {k: figures[k] for k in want} == want and figures["seconds"] > 0
    document = spark.read.json(str(tmp_path / "document")).first()
    assert document.parameters.min_files == "10"
    assert document.summary.files_passed_filters == 1 and document.processing_timestamp


def test_extraction_run_has_mean_seconds(spark, tmp_path):
    docs = spark.createDataFrame(
        [("/a.pdf", "PATIENT NAME: A\nSTUDY: CT chest " + "x" * 60), ("/b.pdf", "n/a")],
        "file_path string, text string")
    figures = runs.write_extraction_run(reports.extract_reports(docs), str(tmp_path), {})
    assert figures["total_documents"] == 2 and figures["failed_extractions"] == 1
    assert figures["success_rate"] == 50.0
    assert figures["mean_seconds"] == figures["seconds"] / 2
    assert spark.read.parquet(str(tmp_path / "results")).count() == 2


def test_progress_is_reported_while_jobs_run(spark, tmp_path):
    heard = []

    def slow(batches):
        import time

        for batch in batches:
            time.sleep(0.6)
            yield batch

    df = spark.range(0, 16, 1, 16).mapInArrow(slow, "id long")
    figures = runs.observed_write(
        df, lambda x: x.write.parquet(str(tmp_path / "out")), [F.sum("id").alias("total")],
        progress=lambda done, known, text: heard.append((done, known, text)))
    assert figures["total"] == 120
    assert heard[-1] == (16, 16, "run: done") and any(t == "run: running" for _, _, t in heard)
    assert all(done <= known for done, known, _ in heard)


def test_a_failed_run_says_so(spark):
    heard = []
    with pytest.raises(Exception), runs.reporting(spark, "x", lambda *a: heard.append(a)):
        spark.range(1).select(F.raise_error(F.lit("no"))).collect()
    assert heard[-1][2] == "x: failed"
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None
