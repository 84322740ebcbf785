"""Public and protected metadata of a series, and the table that links them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from studyloom.functions import geometry as geo, jsontext, privacy
from studyloom.operators.series import ORDER, geometry_figures

PUBLIC_SPATIAL = ["slice_thickness", "pixel_spacing", "image_orientation_patient",
                  "image_position_patient"]


def _field(df: DataFrame, name: str) -> Column:
    return F.col(name) if name in df.columns else F.lit("")


def series_heads(slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """First slice of every series with the geometry flags of the whole series and its hash."""
    fields = [c for c in slices.columns if c not in keys and c not in ORDER]
    heads = geo.with_geometry(slices).groupBy(*keys).agg(
        F.min(F.struct(*ORDER, *fields)).alias("_first"), *geometry_figures())
    flags = [c for c in heads.columns if c not in keys and c != "_first"]
    wide = heads.select(*keys, *[F.col(f"_first.{c}").alias(c) for c in (*ORDER, *fields)], *flags)
    return wide.withColumn("hash_id", privacy.series_hash(
        F.col("patient_id"), F.col("study_date"), F.col("series_number"),
        F.col("institution_name")))


def with_shifts(df: DataFrame, salt: str) -> DataFrame:
    """Add the constant shifts of the patient and the shifted date and age."""
    shifts = df.withColumns({
        "date_shift_days": privacy.shift_days(F.col("patient_id"), salt),
        "age_jitter_years": privacy.shift_years(F.col("patient_id"), salt),
    })
    return shifts.withColumns({
        "shifted_study_date": privacy.shifted_date(F.col("study_date"),
                                                   F.col("date_shift_days")),
        "shifted_patient_age": privacy.jittered_age(F.col("patient_age"),
                                                    F.col("age_jitter_years")),
    })


def _validation(heads: DataFrame) -> Column:
    return F.struct("has_orientation", "has_position", "has_pixel_spacing",
                    "has_slice_thickness", "validation_warnings_count",
                    "validation_errors_count")


def with_sharing_document(heads: DataFrame, salt: str | None = None) -> DataFrame:
    """Add `public`, the technical document of the series without patient data.

    With a salt the shifted date and age are part of it, as in the older layout.
    """
    # Keys of the document.
    parts = {
        "hash_id": F.col("hash_id"),
        "spatial_parameters": F.struct(
            *PUBLIC_SPATIAL, F.col("total_slices"), _field(heads, "rows").alias("rows"),
            _field(heads, "columns").alias("columns"), F.col("study_modality").alias("modality")),
        "imaging_parameters": F.struct(*[_field(heads, c).alias(c) for c in (
            "bits_allocated", "bits_stored", "pixel_representation", "rescale_slope",
            "rescale_intercept", "image_type")]),
        "geometry_validation": _validation(heads),
    }
    source = heads
    if salt is not None:
        source = with_shifts(heads, salt)
        parts["shifted_information"] = F.struct("shifted_study_date", "shifted_patient_age")
    document = F.struct(*[c.alias(k) for k, c in parts.items()])
    return source.withColumn("public", F.to_json(document, {"ignoreNullFields": "false"}))


def with_protected_document(heads: DataFrame, salt: str, key: str | Column) -> DataFrame:
    """Add `protected`, the full document, encrypted with a key of 16, 24 or 32 bytes."""
    wide = with_shifts(heads, salt)
    record = F.create_map(*[c for f in heads.columns if heads.schema[f].dataType.simpleString()
                            == "string" for c in (F.lit(f), F.col(f))])
    # Keys of the document.
    document = F.struct(
        "hash_id",
        F.struct("patient_id", "patient_name", "patient_age", "shifted_study_date",
                 "shifted_patient_age", F.col("study_date").alias("original_study_date"))
        .alias("patient_information"),
        F.struct("study_modality", "institution_name", "station_name", "series_number",
                 *[_field(heads, c).alias(c) for c in (
                     "study_time", "study_series_description", "study_description",
                     "study_body_part", "study_protocol", "study_comments")]).alias("study_information"),
        F.struct(*PUBLIC_SPATIAL, "image_type").alias("technical_parameters"),
        _validation(heads).alias("geometry_analysis"),
        jsontext.drop_empty_fields(record).alias("additional_fields"),
        F.struct(F.lit("COMPREHENSIVE_PATIENT_DATA").alias("data_type"),
                 F.lit(True).alias("contains_phi")).alias("data_classification"))
    secret = F.lit(key) if isinstance(key, str) else key
    return wide.withColumn("protected", F.aes_encrypt(F.to_json(document), secret))


def series_files(slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """File paths of each series, one row per file."""
    return slices.select(*keys, "file_path")


def reidentification_table(heads: DataFrame, salt: str) -> DataFrame:
    """Hash to original and shifted values, with the series' source and the time of writing; belongs in
    a restricted place."""
    return with_shifts(heads, salt).select(
        "hash_id", F.col("patient_id").alias("original_patient_id"),
        F.col("patient_name").alias("original_patient_name"),
        F.col("study_date").alias("original_study_date"), "shifted_study_date",
        "date_shift_days", "age_jitter_years", "series_number",
        F.col("institution_name").alias("institution"),
        _field(heads, "source_folder").alias("source_folder"),
        F.current_timestamp().alias("created_timestamp"))
