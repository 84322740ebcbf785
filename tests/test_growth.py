"""Steps whose cost grew faster than their input: looked for in plans and generated code."""

from __future__ import annotations

import re

import pytest

from studyloom.catalog import mapping_queries, report_queries, series_queries, study_queries
from studyloom.catalog.fixtures import VIEWS, Tables
from studyloom.functions.text import name_tokens

FOLDER = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def scans(df, column: str) -> int:
    return len(re.findall(rf"Relation \[[^\]]*{column}#", plan(df)))


def test_studies_count_slices_before_their_texts(spark):
    t = Tables(spark, FOLDER)
    assert "n_slices" in plan(t.studies)
    t.slices.createOrReplaceTempView("slices")
    plain = spark.sql(VIEWS["studies"][0])
    assert t.studies.exceptAll(plain).isEmpty() and plain.exceptAll(t.studies).isEmpty()


def test_matched_rows_are_written_once(spark):
    new = mapping_queries.matched(Tables(spark, FOLDER)).new
    assert "Join" not in plan(new) and "Window" not in plan(new)
    assert {"new_id", "hospital", "is_duplicate", "unique_number"} <= set(new.columns)


def test_copies_of_slices_come_from_one_scan(spark):
    assert scans(study_queries.doubled(Tables(spark, FOLDER)), "l_orderkey") == 1


def test_geometry_methods_are_small_enough_to_compile(spark, capsys):
    df = series_queries.parse_geometry(Tables(spark, FOLDER))
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        df.explain("codegen")
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", capsys.readouterr().out)]
    assert sizes and max(sizes) < 8000  # the JVM never compiles a longer method


def test_texts_are_exchanged_before_they_are_cut(spark):
    settings = {"spark.sql.files.maxPartitionBytes": "4000", "spark.sql.files.openCostInBytes": "0"}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df = report_queries.assembled(Tables(spark, FOLDER))
        physical = df._jdf.queryExecution().executedPlan().toString()
    finally:
        for key in settings:
            spark.conf.unset(key)
    assert len(re.findall(r"Exchange hashpartitioning", physical)) == 1
    assert "REPARTITION_BY_NUM" in physical


@pytest.mark.parametrize("name, expected", [
    ("DOE^JOHN doe", ["DOE", "JOHN"]), ("^ ^", []), (None, [])])
def test_name_tokens(one, name, expected):
    from pyspark.sql import functions as F
    assert one(name_tokens(F.col("n")), n=name) == expected
