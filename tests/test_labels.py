import pytest
from pyspark.sql import functions as F

from studyloom.functions import labels

SERIES = [
    (None, "YES", ("YES", 0.5)), (None, "UNKNOWN", ("UNKNOWN", 0.0)),
    ("anything", "NO", ("NO", 0.95)), ("Chest W/O", "YES", ("NO", 0.95)),
    ("Chest wo", "YES", ("NO", 0.95)), ("WITHOUT CE 5.0", "YES", ("NO", 0.95)),
    ("Body 5.000 CE", "UNKNOWN", ("YES", 0.95)), ("Cor C", "UNKNOWN", ("YES", 0.9)),
    ("Abd +C", "UNKNOWN", ("YES", 0.9)), ("PLAIN", "YES", ("NO", 0.9)),
    ("POST", "UNKNOWN", ("YES", 0.9)), ("NECK -", "UNKNOWN", ("NO", 0.85)),
    ("EARLY", "UNKNOWN", ("YES", 0.85)), ("2 PHASE", "UNKNOWN", ("YES", 0.7)),
    ("Topogram", "YES", ("YES", 0.6)), ("Topogram", "UNKNOWN", ("UNKNOWN", 0.0)),
]


@pytest.mark.parametrize("series, study, expected", SERIES)
def test_series_contrast_rungs(one, series, study, expected):
    assert tuple(one(labels.series_contrast(F.col("a"), F.col("b")), a=series, b=study)) == expected


@pytest.mark.parametrize("study, protocol, expected", [
    ("WOWITH", None, ("YES", 0.98)), ("WITHOUT CONTRAST", None, ("YES", 0.95)),
    ("ABD WO", None, ("NO", 0.95)), ("ABDOMEN +-C", None, ("NO", 0.95)),
    ("LIVER 3PHASE", None, ("YES", 0.95)), ("HEAD", "ROUTINE WO", ("NO", 0.9)),
    (None, "ABP+CM", ("YES", 0.9)), (None, None, ("UNKNOWN", 0.0)),
])
def test_study_contrast_rungs(one, study, protocol, expected):
    assert tuple(one(labels.study_contrast(F.col("a"), F.col("b")), a=study, b=protocol)) == expected


@pytest.mark.parametrize("part, study, protocol, expected", [
    ("chest_to_pelvis", "HEAD", None, ("CHEST_ABDOMEN_PELVIS", 1.0)),
    ("Unknown", "ABD PEL", None, ("ABDOMEN", 0.85)), ("x", "HEPATIC", None, ("LIVER", 0.85)),
    (None, "ABP", None, ("ABDOMEN_PELVIS", 0.85)), (None, None, "LUMBAR", ("SPINE", 0.85)),
    (None, "CERVICAL SPINE", None, ("NECK", 0.85)), (None, "none", None, ("UNKNOWN", 0.0)),
])
def test_body_part_rungs(one, part, study, protocol, expected):
    got = one(labels.body_part(F.col("a"), F.col("b"), F.col("c")), a=part, b=study, c=protocol)
    assert tuple(got) == expected


@pytest.mark.parametrize("series, fixed, expected", [
    ("PRE ART", False, ("NON_CONTRAST", 0.9)), ("late", False, ("DELAY", 0.9)),
    ("EQUIL", False, ("EQUILIBRIUM", 0.9)), ("AX 5 MIN", False, ("DELAY", 0.8)),
    ("AX 2 MIN", False, ("UNKNOWN", 0.0)), ("3 MM", False, ("DELAY", 0.7)),
    ("SCAN 25S", False, ("UNKNOWN", 0.0)), ("SCAN 25S", True, ("ARTERIAL", 0.8)),
    ("SCAN 70S", True, ("PORTAL", 0.8)), ("SCAN 180S", True, ("DELAY", 0.8)),
    (None, False, ("UNKNOWN", 0.0)),
])
def test_phase_rungs(one, series, fixed, expected):
    assert tuple(one(labels.contrast_phase(F.col("a"), fixed), a=series)) == expected


@pytest.mark.parametrize("image, series, expected", [
    (None, "MPR", ("UNKNOWN", 0.0)), ("ORIGINAL\\MIP", None, ("MIP", 1.0)),
    ("DERIVED", "thin mpr", ("MPR", 0.9)), ("DERIVED", "SAG MIP", ("MPR", 0.8)),
    ("DERIVED", "MIP", ("MIP", 0.9)), ("DERIVED", "3D", ("VOLUME", 0.8)),
    ("PRIMARY\\AXIAL", "x", ("AXIAL", 0.6)), ("PRIMARY", None, ("UNKNOWN", 0.0)),
])
def test_reconstruction_rungs(one, image, series, expected):
    assert tuple(one(labels.reconstruction_type(F.col("a"), F.col("b")), a=image, b=series)) == expected


@pytest.mark.parametrize("image, series, expected", [
    ("AXIAL", "COR", ("AXIAL", 0.8)), ("x", "score", ("CORONAL", 0.9)),
    (None, "sag", ("SAGITTAL", 0.9)), (None, "MAX", ("AXIAL", 0.9)), (None, "q", ("UNKNOWN", 0.0)),
])
def test_orientation_rungs(one, image, series, expected):
    assert tuple(one(labels.image_orientation(F.col("a"), F.col("b")), a=image, b=series)) == expected


@pytest.mark.parametrize("parsed, series, expected", [
    ("1.250", "5 mm", (1.25, 1.0)), ("", "5. mm", (5.0, 0.7)), ("0", "x", (None, 0.0)),
    (None, None, (None, 0.0)),
])
def test_thickness_rungs(one, parsed, series, expected):
    assert tuple(one(labels.slice_thickness(F.col("a"), F.col("b")), a=parsed, b=series)) == expected


def test_weak_labels_are_gated(spark):
    row = spark.createDataFrame([("PRIMARY\\AXIAL", "Topogram", "WITH", None, None, None)],
                                "image_type string, study_series_description string, "
                                "study_description string, study_protocol string, "
                                "study_body_part string, parsed_slice_thickness string")
    got = labels.label_series(row).first()
    assert got.reconstruction_type == "UNKNOWN" and got.reconstruction_confidence == 0.6
    assert got.series_contrast_enhanced == "UNKNOWN" and got.series_contrast_confidence == 0.6
    assert got.image_orientation == "AXIAL" and got.study_contrast_enhanced == "YES"
