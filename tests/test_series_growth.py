"""Series figures: rows of a task, ordered steps and what travels with a slice."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from studyloom.functions import geometry as geo
from studyloom.operators import series as ops, skew

KEYS = ["study", "series_number"]
SCHEMA = ("study string, series_number string, line_no int, file_path string, "
          "image_orientation_patient string, image_position_patient string, "
          "pixel_spacing string, slice_thickness string")
FLAT = "[1, 0, 0, 0, 1, 0]"


def slices(spark, n=60):
    return spark.createDataFrame(
        [(f"s{i % 20}", "1", i, f"/f{i}", FLAT, f"[0, 0, {i}]", "0.5\\0.5", "2") for i in range(n)],
        SCHEMA)


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("figures", [ops.series_affine, ops.series_analysis])
def test_rows_of_a_task_do_not_grow(spark, monkeypatch, figures):
    want = figures(slices(spark), KEYS).orderBy("study").collect()
    monkeypatch.setattr(skew, "TASK_ROWS", 6)
    df = figures(slices(spark), KEYS)
    physical = df._jdf.queryExecution().executedPlan().toString()
    assert re.findall(r"Exchange hashpartitioning\(.*, (\d+)\)", physical) == ["10"]
    assert df.orderBy("study").collect() == want


def test_affine_orders_by_locations_only_if_there_are_any(spark):
    df = slices(spark)
    assert plan(ops.series_affine(df, KEYS)).count("Window [") == 1
    located = df.withColumn("slice_location", F.lit("1"))
    assert plan(ops.series_affine(located, KEYS)).count("Window [") == 2


def test_affine_takes_the_thickness_of_the_slice_it_uses(spark):
    """Slices with one path and line go by their texts, as in the SQL; not by the least thickness."""
    data = [("s", "1", 1, "/f", "A", "x", "1", "5"), ("s", "1", 1, "/f", "B", "x", "1", "2")]
    assert ops.series_affine(spark.createDataFrame(data, SCHEMA), KEYS).first().used_spacing == 5.0


def test_analysis_exchanges_the_first_slice_as_one_value(spark):
    df = ops.series_analysis(slices(spark), KEYS)
    scan = re.findall(r"Relation \[([^\]]*)\] parquet", plan(df))
    assert len(scan) == 1 and scan[0].count(",") == 4  # the keys, two facts and the first slice
    assert "lambda" not in plan(df.select("geometry_errors", "geometry_warnings"))


def test_large_groups_are_counted_one_by_one_only_in_full_sums(spark, monkeypatch):
    df = spark.createDataFrame([("a",)] * 9 + [("b",)] * 3 + [(None,)] * 7 + [("c",)] * 4, "k string")
    for sums in (1, 2, 65_536):
        monkeypatch.setattr(skew, "SIZE_SUMS", sums)
        assert {r.k for r in skew.large_groups(df, ["k"], 5).collect()} == {"a", None}
        assert skew.large_groups(df, ["k"], 30) is None and skew.large_groups(df, ["k"], 9) is None


@pytest.mark.parametrize("value, expected", [
    ("[1, 2, 3]", [1, 2, 3]), ("[1,2,3]", [1, 2, 3]), ("[-1.5e1, .5, +2.]", [-15, .5, 2]),
    ("1, 2, 3", [1, 2, 3]), ("[1,  2, 3]", [1, 2, 3]), ("[1 0, 2, 3]", [10, 2, 3]),
    ("[,1,,2,3,]", [1, 2, 3]), ("[1, 2, 3, 4]", [1, 2, 3]), ("[[1, 2, 3]]", [1, 2, 3]),
    ("[1, 2, 3] ", None), ("[1, 2, 3d]", None), ("[1, 2, NaN]", None), ("[1, 2]", None),
    ("[1, 2, 3, x]", None), ("[]", None), ("", None), ("1", None), ("[1, 2, 0x1p3]", None)])
def test_vectors_of_usual_and_other_form(one, value, expected):
    assert one(geo.parse_position(F.col("v")), v=value) == expected


@pytest.mark.parametrize("value, expected", [
    (" 1.5\t", 1.5), ("\x0b2\x0c\r\n", 2), (" 1", None), ("1 2", None), ("1f", None),
    ("NaN", None), ("Infinity", None), ("", None), (" ", None), (".", None), ("1e3", 1000)])
def test_numbers(one, value, expected):
    assert one(geo.parse_number(F.col("v")), v=value) == expected
