"""Queries over pseudonyms and metadata documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from studyloom.catalog.fixtures import Tables
from studyloom.catalog.registry import query
from studyloom.functions import jsontext, privacy
from studyloom.operators import metadata as ops

# Only for the shared test data; real runs pass their own secret.
SALT = "check"
DAYS = f"(('0x' || substr(sha256(concat(patient_id, '{SALT}')), 1, 8))::bigint % 1461 - 730)::integer"
YEARS = f"(('0x' || substr(sha256(concat(patient_id, '{SALT}')), 9, 8))::bigint % 5 - 2)::integer"
MOVED_DATE = f"strftime(strptime(study_date, '%Y%m%d')::date + {DAYS}, '%Y%m%d')"
MOVED_AGE = f"printf('%03dY', greatest(1, replace(patient_age, 'Y', '')::integer + {YEARS}))"
HASH = "substr(sha256(concat(patient_id, '_', study_date, '_', series_number, '_', institution_name)), 1, 16)"
ORDER = ("line_no, file_path, patient_name, patient_id, patient_age, study_date, study_modality, station_name, institution_name, slice_thickness, image_orientation_patient, "
         "image_position_patient, pixel_spacing, image_type")
HEADS = f"""heads as (select *, {HASH} as hash_id from (select *, row_number() over (partition by study_no, series_number order by {ORDER}) as rn,
  count(*) over (partition by study_no, series_number) as total_slices, bool_or(image_orientation_patient <> 'Unknown') over (partition by study_no, series_number) as has_orientation,
  bool_or(slice_thickness <> 'Unknown') over (partition by study_no, series_number) as has_slice_thickness from slices) x where rn = 1)"""


@query("series_hash", "slices", f"select file_path, line_no, {HASH} as hash_id, case when image_orientation_patient = 'Unknown' then concat('Er_', {HASH}) else {HASH} end as ledger_key from slices")
def series_hash(t: Tables) -> DataFrame:
    key = privacy.series_hash(F.col("patient_id"), F.col("study_date"), F.col("series_number"),
                              F.col("institution_name"))
    failed = F.col("image_orientation_patient") == "Unknown"
    return t.slices.select("file_path", "line_no", key.alias("hash_id"),
                           privacy.error_key(key, failed).alias("ledger_key"))


@query("patient_shift", "studies", f"select distinct patient_id, {DAYS} as date_shift_days, {YEARS} as age_jitter_years from studies")
def patient_shift(t: Tables) -> DataFrame:
    return t.studies.select("patient_id").distinct().select(
        "patient_id", privacy.shift_days(F.col("patient_id"), SALT).alias("date_shift_days"),
        privacy.shift_years(F.col("patient_id"), SALT).alias("age_jitter_years"))


@query("date_shift", "studies", f"""
select study_no, case when study_no % 9 = 0 then 'Unknown' when study_no % 9 = 1 then '' else {MOVED_DATE} end as shifted from studies
""")
def date_shift(t: Tables) -> DataFrame:
    n = F.col("study_no") % 9
    date = F.when(n == 0, "Unknown").when(n == 1, "").otherwise(F.col("study_date"))
    return t.studies.select("study_no", privacy.shifted_date(
        date, privacy.shift_days(F.col("patient_id"), SALT)).alias("shifted"))


@query("age_jitter", "studies", f"""
select study_no, case when study_no % 9 = 0 then 'Unknown' when study_no % 9 = 1 then '12M' else {MOVED_AGE} end as jittered from studies
""")
def age_jitter(t: Tables) -> DataFrame:
    n = F.col("study_no") % 9
    age = F.when(n == 0, "Unknown").when(n == 1, "12M").otherwise(F.col("patient_age"))
    return t.studies.select("study_no", privacy.jittered_age(
        age, privacy.shift_years(F.col("patient_id"), SALT)).alias("jittered"))


@query("reident_map", "slices", f"""with {HEADS}
select hash_id, patient_id as original_patient_id, patient_name as original_patient_name, study_date as original_study_date, {MOVED_DATE} as shifted_study_date, {DAYS} as date_shift_days, {YEARS} as age_jitter_years,
 series_number, institution_name as institution, concat('site_', series_number) as source_folder from heads
""")
def reident_map(t: Tables) -> DataFrame:
    slices = t.slices.withColumn("source_folder", F.concat(F.lit("site_"), "series_number"))
    return ops.reidentification_table(
        ops.series_heads(slices, ["study_no", "series_number"]), SALT).drop("created_timestamp")


@query("metadata_split", "slices", f"""with {HEADS}
select hash_id, slice_thickness, pixel_spacing, image_orientation_patient, total_slices, study_modality as modality, image_type, has_orientation, has_slice_thickness, true as readable, patient_id as hidden_patient_id from heads
""")
def metadata_split(t: Tables) -> DataFrame:
    """Public document fields, and the patient id read back from the protected document."""
    key = "0123456789abcdef"
    heads = ops.series_heads(t.slices, ["study_no", "series_number"])
    both = ops.with_protected_document(ops.with_sharing_document(heads), SALT, key)
    opened = both.withColumn("opened", F.aes_decrypt("protected", F.lit(key)).cast("string"))

    def at(path: str):
        return F.get_json_object("public", path)

    return opened.select(
        "hash_id", at("$.spatial_parameters.slice_thickness").alias("slice_thickness"),
        at("$.spatial_parameters.pixel_spacing").alias("pixel_spacing"),
        at("$.spatial_parameters.image_orientation_patient").alias("image_orientation_patient"),
        at("$.spatial_parameters.total_slices").cast("bigint").alias("total_slices"),
        at("$.spatial_parameters.modality").alias("modality"),
        at("$.imaging_parameters.image_type").alias("image_type"),
        at("$.geometry_validation.has_orientation").cast("boolean").alias("has_orientation"),
        at("$.geometry_validation.has_slice_thickness").cast("boolean")
        .alias("has_slice_thickness"),
        F.try_parse_json("opened").isNotNull().alias("readable"),
        F.get_json_object("opened", "$.patient_information.patient_id")
        .alias("hidden_patient_id"))


@query("drop_empty_fields", "studies", """
select study_no, concat('{', concat_ws(',', case when patient_id <> 'Unknown' then concat('"patient_id":"', patient_id, '"') end, concat('"study_date":"', study_date, '"')), '}') as kept from studies
""")
def drop_empty_fields(t: Tables) -> DataFrame:
    record = F.create_map(
        F.lit("patient_id"), F.col("patient_id"), F.lit("study_date"), F.col("study_date"),
        F.lit("original_study_date"), F.col("study_date"), F.lit("comment"), F.lit(""))
    return t.studies.select("study_no", jsontext.canonical_json(
        jsontext.drop_empty_fields(record)).alias("kept"))
