import random

from pyspark.sql import Window, functions as F

from studyloom.operators import skew


def test_number_rows_with_sections_equals_row_number(spark):
    rows = [(f"s{i % 3 if i % 4 else 0}", i) for i in range(500)]
    df = spark.createDataFrame(rows, "g string, p long")
    got = skew.number_rows(df, ["g", "p"], "n", start=10001)
    want = df.withColumn("n", 10000 + F.row_number().over(Window.orderBy("g", "p")))
    assert sorted(map(tuple, got.select("g", "p", "n").collect())) == sorted(
        map(tuple, want.collect()))


def test_number_rows_with_nulls_ties_and_groups(spark):
    rows = [(None, 3, "a"), (None, None, "b"), ("x", 1, "c"), ("x", 1, "d"), ("x", 1, "e"),
            ("x", 9, "f"), ("y", 2, "g")]
    df = spark.createDataFrame(rows, "g string, p long, text string")
    whole = sorted((r.n, r.g, r.p) for r in skew.number_rows(df, ["g", "p"], "n").collect())
    assert whole == [(1, None, None), (2, None, 3), (3, "x", 1), (4, "x", 1), (5, "x", 1),
                     (6, "x", 9), (7, "y", 2)]
    inside = sorted((str(r.g), r.n, r.p) for r in skew.number_rows(
        df, ["g", "p"], "n", start=0, within=["g"]).collect())
    assert inside == [("None", 0, None), ("None", 1, 3), ("x", 0, 1), ("x", 1, 1), ("x", 2, 1),
                      ("x", 3, 9), ("y", 0, 2)]
    assert skew.number_rows(df.limit(0), ["g", "p"], "n").count() == 0


def test_numbering_moves_keys_only(spark):
    df = spark.range(1000).selectExpr("id % 7 as g", "id as p", "repeat('x', 100) as text")
    ranges = skew._key_ranges(df, ["g", "p"])
    assert ranges.columns == ["g", "p", "_n", "_range"] and ranges.count() == 1000


def test_previous_value_with_sections_equals_lag(spark):
    random.seed(1)
    rows = [("hot", float(x)) for x in random.sample(range(100000), 300)]
    rows += [("cold", 1.0), ("cold", 4.0), (None, 2.0), (None, 3.0)]
    df = spark.createDataFrame(rows, "g string, p double")
    got = skew.previous_value(df, ["g"], "p", "prev", rows=25)
    want = df.withColumn("prev", F.lag("p").over(Window.partitionBy("g").orderBy("p")))
    assert set(map(tuple, got.select("g", "p", "prev").collect())) == set(
        map(tuple, want.collect()))


def test_release_deletes_what_durable_wrote(spark):
    from pathlib import Path

    from studyloom import session

    session.release(spark)
    kept = session.durable(spark.range(3))
    folder = Path(kept.inputFiles()[0].removeprefix("file://")).parent
    assert folder.exists() and session.release(spark) == 1
    assert not folder.exists() and session.release(spark) == 0


def test_release_drops_owned_tables(spark, tmp_path):
    from studyloom import session

    session.release(spark)
    path = session.own(spark, str(tmp_path / "owned"), "owned_numbers")
    spark.range(3).write.option("path", path).saveAsTable("owned_numbers")
    assert session.release(spark) == 1
    assert not spark.catalog.tableExists("owned_numbers") and not (tmp_path / "owned").exists()
