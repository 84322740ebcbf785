import pytest
from pyspark.sql import functions as F

from studyloom.functions import geometry as geo
from studyloom.operators import series as ops

SCHEMA = ("study string, series_number string, line_no int, file_path string, "
          "image_orientation_patient string, image_position_patient string, "
          "pixel_spacing string, slice_thickness string, slice_location string")
FLAT = "[1, 0, 0, 0, 1, 0]"


def rows(positions, orientation=FLAT, study="s", thickness="2", locations=None):
    locations = locations or ["Unknown"] * len(positions)
    return [(study, "1", i, f"/f{i}", orientation, p, "0.5\\0.5", thickness, at)
            for i, (p, at) in enumerate(zip(positions, locations))]


@pytest.mark.parametrize("value, expected", [
    ("[1, 7.0e-016, 0, 0, 0, -1]", [1.0, 7.0e-16, 0.0, 0.0, 0.0, -1.0]),
    ("[1, 0, 0, 0, 1]", None), ("[1, 0, x, 0, 1, 0]", None), ("Unknown", None), (None, None),
    ("[1,,0, 0, 0, 1, 0, 9]", [1.0, 0.0, 0.0, 0.0, 1.0, 0.0]),
])
def test_parse_orientation(one, value, expected):
    assert one(geo.parse_orientation(F.col("v")), v=value) == expected


@pytest.mark.parametrize("value, expected", [
    ("0.5\\0.6", [0.5, 0.6]), ("0.5\\\\0.6", [0.5, 0.6]), ("2/3", [2.0, 3.0]), ("1,2", [1.0, 2.0]),
    ("0.7", [0.7, 0.7]), ("a\\1", None), ("Unknown", None), ("0.5/0.6,0.7", None),
])
def test_parse_spacing(one, value, expected):
    assert one(geo.parse_spacing(F.col("v")), v=value) == expected


def test_spacing_of_even_irregular_single_and_unreadable_series(spark):
    data = rows(["[0, 0, 0]", "[0, 0, 4]", "[0, 0, 2]"], study="even")
    data += rows(["[0, 0, 0]", "[0, 0, 1]", "[0, 0, 9]"], study="odd")
    data += rows(["[0, 0, 0]"], study="single")
    data += rows(["x", "[0, 0, 0]"], study="bad")
    data += rows(["[0, 0, 0]", "[0, 0, 0]", "[0, 0, 3]"], "Unknown", study="no_orientation")
    got = {r.study: r for r in ops.spacing_statistics(
        spark.createDataFrame(data, SCHEMA), ["study", "series_number"]).collect()}
    assert got["even"].slice_spacing == 2.0 and got["even"].spacing_consistent
    assert got["odd"].spacing_success and not got["odd"].spacing_consistent
    assert got["odd"].spacing_warnings == [
        "Inconsistent spacing detected: std=3.500mm, avg=4.500mm"]
    assert got["single"].spacing_warnings == ["Need at least 2 slices for spacing calculation"]
    assert got["bad"].spacing_warnings == ["Insufficient valid spatial information"]
    flat = got["no_orientation"]
    assert (flat.z_fallbacks, flat.num_intervals, flat.min_spacing, flat.max_spacing) == (3, 2, 0, 3)
    assert flat.slice_spacing == 1.5 and flat.std_deviation == 1.5


def test_tilted_series_projects_on_the_normal(spark):
    tilted = "[1, 0, 0, 0, 0, -1]"
    data = rows(["[0, 0, 0]", "[0, 5, 0]"], tilted)
    got = ops.spacing_statistics(spark.createDataFrame(data, SCHEMA),
                                 ["study", "series_number"]).first()
    assert got.slice_spacing == 5.0


def test_affine_uses_positions_then_locations_then_thickness(spark):
    data = rows(["[3, 4, 8]", "[3, 4, 5]"], study="placed")
    data += rows(["x", "x", "x"], study="located", locations=["1", "3", "5"])
    data += rows(["[3, 4, 8]"], study="single", thickness="1500")
    got = {r.study: r for r in ops.series_affine(
        spark.createDataFrame(data, SCHEMA), ["study", "series_number"]).collect()}
    assert got["placed"].affine == [[-0.5, 0.0, 0.0, -3.0], [0.0, -0.5, 0.0, -4.0],
                                    [0.0, 0.0, 3.0, 5.0], [0.0, 0.0, 0.0, 1.0]]
    assert not got["placed"].has_warnings
    assert (got["located"].spacing_source, got["located"].used_spacing) == ("slice_location", 2.0)
    assert got["located"].affine[0] == [1.0, 0.0, 0.0, 0.0] and got["located"].has_warnings
    assert got["single"].used_spacing == 1.5


def test_analysis_readiness_and_texts(spark):
    data = rows([f"[0, 0, {i}]" for i in range(11)], study="ready")
    data += rows([f"[0, 0, {i}]" for i in range(10)], study="few")
    frame = spark.createDataFrame(data, SCHEMA)
    got = {r.study: r for r in ops.series_analysis(frame, ["study", "series_number"]).collect()}
    assert got["ready"].is_ready_for_nifti and not got["few"].is_ready_for_nifti
    assert got["ready"].parsed_slice_thickness == "2.000"
    assert got["ready"].parsed_pixel_spacing == "0.500x0.500"
    no_spacing = frame.withColumn("pixel_spacing", F.lit("Unknown"))
    loose = ops.series_analysis(no_spacing, ["study", "series_number"]).filter("study = 'ready'")
    strict = ops.series_analysis(no_spacing, ["study", "series_number"], strict=True).filter(
        "study = 'ready'")
    assert loose.first().is_ready_for_nifti and not strict.first().is_ready_for_nifti


def test_volume_order_and_flip(spark, one):
    frame = spark.createDataFrame([("v", i / 2, [float(i), 1.0]) for i in (2, 0, 1)],
                                  "series string, at double, pixels array<double>")
    got = ops.stack_volumes(frame, ["series"], "at", slope=2.0, intercept=-1.0).orderBy(
        "place").collect()
    assert [(r.place, r.position) for r in got] == [(1, 0.0), (2, 0.5), (3, 1.0)]
    assert [r.image for r in got] == [[-1.0, 1.0], [1.0, 1.0], [3.0, 1.0]]
    image = F.array(F.array(F.lit(1), F.lit(2)), F.array(F.lit(3), F.lit(4)))
    assert one(geo.flip_rows(image)) == [[4, 3], [2, 1]]


def test_large_series_give_the_same_figures(spark, monkeypatch):
    """Series above the row limit take the other way; figures must not differ."""
    from studyloom.operators import skew

    data = rows([f"[0, 0, {i * i % 7}]" for i in range(40)], study="big",
                locations=[str(i % 9) if i % 5 else "x" for i in range(40)])
    data += rows(["[0, 0, 1]"] * 30, study="one_place") + rows(["x"] * 30, study="unreadable")
    data += rows(["[0, 0, 1]", "[0, 0, 4]"], study="small", locations=["1", "4"])
    data += rows(["[0, 0, 1]"] * 25, study=None)
    frame, keys = spark.createDataFrame(data, SCHEMA), ["study", "series_number"]

    def all_figures():
        return [sorted(repr([round(v, 9) if isinstance(v, float) else v for v in r])
                       for r in df.collect()) for df in (
            ops.spacing_statistics(frame, keys), ops.location_spacing(frame, keys),
            ops.series_affine(frame, keys), ops.series_analysis(frame, keys))]

    ordinary = all_figures()
    monkeypatch.setattr(skew, "SECTION_ROWS", 8)
    assert all_figures() == ordinary


def test_one_exchange_of_the_records(spark):
    frame = spark.createDataFrame(rows(["[0, 0, 0]", "[0, 0, 4]"]), SCHEMA)
    for df in (ops.spacing_statistics(frame, ["study", "series_number"]),
               ops.series_analysis(frame, ["study", "series_number"]),
               ops.series_affine(frame, ["study", "series_number"])):
        df.collect()
        plan = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1]
        assert plan.count("Exchange") == 1 and plan.count("Scan parquet") == 1, plan
