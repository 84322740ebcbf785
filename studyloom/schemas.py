"""Record layouts shared by the stages."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F, types as T

# The fields of one slice record, in file order.
SLICE_FIELDS = [
    "file_path", "patient_name", "patient_id", "patient_age", "study_date", "study_time",
    "study_description", "study_modality", "study_body_part", "study_series_number",
    "study_series_description", "study_protocol", "station_name", "institution_name",
    "study_comments", "series_number", "slice_thickness", "image_orientation_patient",
    "image_position_patient", "pixel_spacing", "image_type", "slice_location",
]

# The header tag behind each slice field.
SLICE_TAGS = {
    "patient_name": "PatientName",
    "patient_id": "PatientID",
    "patient_age": "PatientAge",
    "study_date": "StudyDate",
    "study_time": "StudyTime",
    "study_description": "StudyDescription",
    "study_modality": "Modality",
    "study_body_part": "BodyPartExamined",
    "study_series_number": "SeriesNumber",
    "study_series_description": "SeriesDescription",
    "study_protocol": "ProtocolName",
    "station_name": "StationName",
    "institution_name": "InstitutionName",
    "study_comments": "StudyComments",
    "series_number": "SeriesNumber",
    "slice_thickness": "SliceThickness",
    "image_orientation_patient": "ImageOrientationPatient",
    "image_position_patient": "ImagePositionPatient",
    "pixel_spacing": "PixelSpacing",
    "image_type": "ImageType",
    "slice_location": "SliceLocation",
}

SLICE_SCHEMA = T.StructType([T.StructField(f, T.StringType()) for f in SLICE_FIELDS])

# The fields a study summary takes from the first slice.
SUMMARY_FIELDS = ["patient_id", "patient_name", "study_date", "patient_age", "study_modality",
                  "study_body_part", "institution_name"]

LEDGER_SCHEMA = T.StructType([
    T.StructField("job", T.StringType()),
    T.StructField("key", T.StringType()),
    T.StructField("status", T.StringType()),
    T.StructField("attempt", T.IntegerType()),
    T.StructField("ts", T.TimestampType()),
    T.StructField("error", T.StringType()),
])

# The result of one report extraction.
EXTRACTION_SCHEMA = T.StructType([
    T.StructField("number_of_studies", T.IntegerType()),
    T.StructField("imaging_indication", T.StringType()),
    T.StructField("imaging_modality", T.StringType()),
    T.StructField("body_part", T.StringType()),
    T.StructField("current_disease_list", T.ArrayType(T.StringType())),
    T.StructField("previous_disease_list", T.ArrayType(T.StringType())),
    T.StructField("previous_interventions", T.ArrayType(T.StringType())),
    T.StructField("patient_info", T.StructType([
        T.StructField("name", T.StringType()),
        T.StructField("ids", T.ArrayType(T.StructType([
            T.StructField("id_value", T.StringType()),
            T.StructField("id_type", T.StringType()),
        ]))),
        T.StructField("patient_number", T.StringType()),
        T.StructField("age", T.StringType()),
        T.StructField("gender", T.StringType()),
    ])),
    T.StructField("contrast_used", T.BooleanType()),
    T.StructField("findings_summary", T.StringType()),
    T.StructField("impression", T.StringType()),
])


def require_columns(df: DataFrame, required: Sequence[str],
                    optional: Sequence[str] = ()) -> DataFrame:
    """Fail on a missing required column; add a missing optional one as null text."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(
            f"missing required columns: {', '.join(missing)}; available: {', '.join(df.columns)}")
    absent = {c: F.lit(None).cast("string") for c in optional if c not in df.columns}
    return df.withColumns(absent) if absent else df
