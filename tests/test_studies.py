from studyloom.catalog.fixtures import Tables
from studyloom.catalog import fixtures
from studyloom.operators import studies as ops

ROWS = [("s1", "a", 3), ("s1", "a", 1), ("s1", "b", 2), ("s2", None, 5), ("s2", None, 4)]


def test_dedup_with_counts_keeps_first_positions_and_counts_from_one_exchange(spark):
    slices = spark.createDataFrame(ROWS, "study string, value string, line_no long")
    kept = ops.dedup_with_counts(slices, "study", ["value"], tasks=3)
    assert kept._jdf.queryExecution().executedPlan().toString().count("Exchange ") == 1
    assert sorted(map(tuple, kept.collect()), key=str) == [
        ("s1", "a", 1, 3, 2), ("s1", "b", 2, 3, 2), ("s2", None, 4, 2, 1)]


def test_dedup_and_counts_are_the_same_in_a_given_number_of_tasks(spark):
    slices = spark.createDataFrame(ROWS, "study string, value string, line_no long")
    for run in (ops.exact_dedup, ops.dedup_counts):
        assert sorted(map(str, run(slices, "study", ["value"], tasks=7).collect())) == sorted(
            map(str, run(slices, "study", ["value"]).collect()))


def test_tasks_follow_the_rows_of_the_input(spark, monkeypatch):
    folder = "/root/testdata/sf0.001"
    assert Tables(spark, folder).tasks() is None
    monkeypatch.setattr(fixtures, "TASK_ROWS", 500)
    few = Tables(spark, folder)
    assert few.tasks() == -(-few.spark.read.parquet(f"{folder}/lineitem.parquet").count() // 500)
    assert few.lineitem.rdd.getNumPartitions() == few.tasks()
