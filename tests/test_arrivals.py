import json

from pyspark.sql import functions as F

from studyloom.operators import series
from studyloom.streaming import arrivals

SCHEMA = ("study string, series_number string, line_no int, file_path string, n_images string, "
          "image_orientation_patient string, image_position_patient string, pixel_spacing string, "
          "slice_thickness string, slice_location string")
KEYS = ["study", "series_number"]
# Quiet times that never and always have passed by the next run.
LONG, SHORT = 86_400, 0.001


def slices(study, places, expected=None):
    return [{"study": study, "series_number": "1", "line_no": z, "file_path": f"/{study}/{z}",
             "n_images": expected, "image_orientation_patient": "[1, 0, 0, 0, 1, 0]",
             "image_position_patient": f"[0, 0, {2 * z}]", "pixel_spacing": "0.5\\0.5",
             "slice_thickness": "2", "slice_location": "Unknown"} for z in places]


def test_series_are_released_when_complete_or_quiet_and_opened_by_late_slices(spark, tmp_path):
    source = tmp_path / "in"
    source.mkdir()
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "cp")

    def arrive(name, rows):
        (source / name).write_text("".join(json.dumps(r) + "\n" for r in rows))

    def run(quiet):
        # a new query each time: the state comes from the checkpoint alone
        stream = spark.readStream.schema(SCHEMA).json(str(source))
        arrivals.analyse_arrivals(stream, KEYS, out, checkpoint, quiet, "n_images")
        found = spark.read.parquet(f"{out}/series")
        return {(r.study, r.release, r.reason, r.total_slices)
                for r in found.select("study", "release", "reason", "total_slices").collect()}

    arrive("a.json", slices("whole", range(4), "4") + slices("half", [0, 1], "4"))
    first = run(LONG)
    assert first == {("whole", 1, "complete", 4)}
    arrive("b.json", slices("half", [2, 3], "4") + slices("open", [0, 2]) + slices(None, [0]))
    second = run(SHORT)
    assert second == first | {("half", 1, "complete", 4)}
    third = run(SHORT)
    assert third == second | {("open", 1, "quiet", 2), (None, 1, "quiet", 1)}
    assert run(SHORT) == third
    arrive("c.json", slices("open", [1]) + slices("whole", [4], "4"))
    fourth = run(SHORT)
    assert fourth == third | {("whole", 2, "complete", 5)}
    assert run(SHORT) == fourth | {("open", 2, "quiet", 3)}

    now = arrivals.current_series(spark.read.parquet(f"{out}/series"), KEYS).drop("reason")
    batch = series.series_analysis(spark.read.schema(SCHEMA).json(str(source)), KEYS)
    assert sorted(now.columns) == sorted(batch.columns)
    text = [F.col(c).cast("string").alias(c) for c in sorted(batch.columns)]
    assert sorted(now.select(*text).collect(), key=str) == sorted(
        batch.select(*text).collect(), key=str)
