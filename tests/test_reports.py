import pytest
from pyspark.sql import functions as F

from studyloom.functions import report_fields
from studyloom.operators import reports as ops


@pytest.mark.parametrize("text, flag", [
    (None, "empty"), ("  \n", "empty"), ("short", "too_short"), ("x" * 50, ""),
    ("Extraction for .doc is not implemented.", "too_short, .doc"),
    ("Extraction for .doc is not implemented." + "x" * 60, ".doc"),
])
def test_quality_flag(one, text, flag):
    assert one(ops.quality_flag(F.col("t")), t=text) == flag


@pytest.mark.parametrize("text, expected", [
    ("PATIENT NAME: John Doe, AGE: 45 years\nGENDER: female\nMRI of the spine with contrast",
     (0, "MRI", "Spine", "John Doe", "45 years", "Female", True)),
    ('"number_of_studies": 3, "imaging_modality": "ct", "contrast_used": false',
     (3, "CT", "Unknown", None, None, None, False)),
    ("2 studies, X-ray, 60 years old, M", (2, "Unknown", "Unknown", None, "60", "Male", None)),
    ("nothing of note", None),
])
def test_fields_by_pattern(spark, text, expected):
    df = spark.createDataFrame([(text,)], "t string")
    data = report_fields.with_text_extraction(df, F.col("t"), "r").first().r
    got = data and (data.number_of_studies, data.imaging_modality, data.body_part,
                    data.patient_info.name, data.patient_info.age, data.patient_info.gender,
                    data.contrast_used)
    assert got == expected


def test_path_resolution_and_package(spark):
    rows = spark.createDataFrame([
        (0, "E:/a.pdf", "empty"), (1, "E:/b.pdf", "empty"), (2, " ", "empty"),
        (3, "E:/c.pdf", "empty"), (4, "E:/a.pdf", "")],
        "position long, file_path string, need_manual_check string")
    listing = spark.createDataFrame([("D:/a.pdf",), ("E:/b.pdf",)], "path string")
    package = ops.manual_package(rows, listing, "position")
    got = {r.position: (r._copied_filename, r.reason) for r in package.collect()}
    assert got == {0: ("ROW_0000_a.pdf", None), 1: ("ROW_0001_b.pdf", None),
                   2: ("", "Empty file path"), 3: ("", "File not found")}
    assert tuple(ops.package_totals(package).first()) == (4, 2, 2)
    results = spark.createDataFrame([("ROW_0001_b.pdf", "text", "success", "native", 1.0)],
                                    "filename string, text string, status string, "
                                    "method string, confidence double")
    back = {r.position: r._extraction_status for r in ops.write_back(package, results).collect()}
    assert back == {0: "", 1: "success", 2: "", 3: ""}


def test_pages_without_kept_tokens_are_left_out(spark):
    tokens = spark.createDataFrame([
        (1, 0, 0, "a", 0.9), (1, 0, 1, "b", 0.2), (1, 1, 2, "c", 0.1), (1, 2, 3, "d", 0.5),
        (2, 0, 0, "x", 0.0)],
        "doc_id long, page int, seq int, token string, confidence double")
    got = {r.doc_id: (r.text, r.kept_tokens, round(r.confidence, 6)) for r in
           ops.assemble_pages(tokens).collect()}
    assert got == {1: ("a\n\nd", 2, 0.7), 2: ("", 0, 0.0)}


def test_long_documents_stay_whole(spark):
    tokens = spark.range(12_000).select(
        F.lit(1).alias("doc_id"), F.col("id").alias("page"), F.lit(0).alias("seq"),
        F.lit("w").alias("token"), F.lit(0.9).alias("confidence"))
    row, = ops.assemble_pages(tokens).collect()
    assert row.page_count == row.kept_tokens == 12_000 and row.text.count("\n\n") == 11_999


@pytest.mark.parametrize("kind, native, read, error, expected", [
    ("pdf", "long enough text", None, None, ("success", "native")),
    ("pdf", "", None, None, ("ocr_failed", "failed")),
    ("pdf", "", "short", None, ("empty_document", "ocr")),
    ("image", None, "long enough text", None, ("success", "ocr")),
    ("docx", "x", None, None, ("empty_document", "native")),
    ("docx", None, None, "PermissionError: no", ("permission_denied", "failed")),
    (None, None, None, None, ("unsupported", "failed")),
])
def test_extraction_status(one, kind, native, read, error, expected):
    result = one(ops.extraction_status(F.col("k"), F.col("n"), F.col("r"), F.col("e")),
                 k=kind, n=native, r=read, e=error)
    assert (result.status, result.method) == expected
    there = one(ops.extraction_status(F.col("k"), F.col("n"), F.col("r"), F.col("e"),
                                      F.lit(False)), k=kind, n=native, r=read, e=error)
    assert there.status == "file_not_found"
