"""Queries over slice records and studies."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, functions as F

from studyloom.catalog.fixtures import Tables
from studyloom.catalog.registry import query
from studyloom.functions import jsontext, text
from studyloom.operators import studies as ops
from studyloom.plans import runs
from studyloom.session import ensure_checkpoint_dir, own

RECORD = ["file_path", "patient_name", "patient_id", "patient_age", "study_date",
          "study_modality", "station_name", "institution_name", "series_number",
          "slice_thickness", "image_orientation_patient", "image_position_patient",
          "pixel_spacing", "image_type"]
SUMMARY = ["patient_id", "patient_name", "study_date", "patient_age", "study_modality",
           "institution_name"]
MIN_FILES = 3

KEY_SQL = (r"regexp_replace(concat(study_date, '_._', patient_id, '_._', "
           r"coalesce(nullif(station_name, ''), nullif(institution_name, ''), 'Unknown'), "
           r"'_._Study.jsonl'), '[\\/:*?""<>|]', '_', 'g')").replace('""', '"')
RECORD_SQL = ", ".join(RECORD)


def doubled(t: Tables) -> DataFrame:
    """All slices plus a second copy of every third study, as a crashed re-run leaves them."""
    copies = F.when(F.col("study_no") % 3 == 0, F.array(F.lit(0), F.lit(100))).otherwise(
        F.array(F.lit(0)))
    return ops.with_study_key(t.slices).withColumn("_later", F.explode(copies)).withColumn(
        "line_no", F.col("line_no") + F.col("_later")).drop("_later")


DOUBLED_SQL = f"""
doubled as (
  select *, {KEY_SQL} as source_file from (
    select * from slices
    union all
    select * replace (line_no + 100 as line_no) from slices where study_no % 3 = 0) x),
deduped as (
  select source_file, {RECORD_SQL}, min(line_no) as line_no from doubled group by all)"""


def deduped(t: Tables) -> DataFrame:
    return ops.exact_dedup(doubled(t), "source_file", RECORD, tasks=t.tasks())


def keyed(t: Tables) -> DataFrame:
    return ops.gathered(ops.with_study_key(t.slices), "source_file", t.tasks())


@query("study_summary", "slices", f"""
with keyed as (select *, {KEY_SQL} as source_file from slices),
ranked as (select *, row_number() over (partition by source_file order by line_no, file_path) as rn,
  count(*) over (partition by source_file) as ct_objects_count from keyed)
select patient_id, patient_name, study_date, patient_age, study_modality, institution_name,
  source_file, ct_objects_count, regexp_replace(file_path, '/[^/]*$', '') as dicom_folder_path
from ranked where rn = 1
""")
def study_summary(t: Tables) -> DataFrame:
    return ops.study_summary(keyed(t), fields=SUMMARY)


@query("summary_totals", "slices", f"""
with counts as (select {KEY_SQL} as source_file, count(*) as n from slices group by 1)
select count(*) as total_records, sum(n)::bigint as total_ct_objects, round(avg(n), 6) as mean_ct_objects from counts
""")
def summary_totals(t: Tables) -> DataFrame:
    summary = ops.study_summary(keyed(t), fields=SUMMARY)
    return ops.summary_totals(summary).withColumn(
        "mean_ct_objects", F.round("mean_ct_objects", 6))


@query("exact_dedup", "slices", f"with {DOUBLED_SQL[1:]} select * from deduped")
def exact_dedup(t: Tables) -> DataFrame:
    return deduped(t)


@query("dedup_counts", "slices", f"""with {DOUBLED_SQL[1:]},
a as (select source_file, count(*) as original_records from doubled group by 1),
b as (select source_file, count(*) as after_dedup from deduped group by 1)
select source_file, original_records, after_dedup,
 concat('Removed ', original_records - after_dedup, ' duplicates (', original_records, ' -> ', after_dedup, ')') as dedup_reason
from a join b using (source_file)
""")
def dedup_counts(t: Tables) -> DataFrame:
    return ops.dedup_counts(doubled(t), "source_file", RECORD, tasks=t.tasks())


@query("canonical_record", "slices", """
select canonical, count(*) as copies from (
 select concat('{"patient_id":"', patient_id, '","series_number":"', series_number, '","study_date":"', study_date, '"}') as canonical from slices) x
group by 1
""")
def canonical_record(t: Tables) -> DataFrame:
    fields = ["study_date", "series_number", "patient_id"]
    open_record = F.create_map(*[c for f in fields for c in (F.lit(f), F.col(f))])
    return (t.slices.select(jsontext.canonical_json(open_record).alias("canonical"))
            .groupBy("canonical").agg(F.count(F.lit(1)).alias("copies")))


def filtered(t: Tables) -> DataFrame:
    return with_filters(ops.dedup_counts(doubled(t), "source_file", RECORD, tasks=t.tasks()))


def with_filters(counts: DataFrame) -> DataFrame:
    long_name = ops.StudyFilter(~F.col("source_file").contains("Unknown"),
                                F.when(F.col("source_file").contains("Unknown"),
                                       F.lit("Failed: missing header value"))
                                .otherwise(F.lit("Passed: header complete")))
    return ops.apply_filters(
        counts, [ops.minimum_files(F.col("after_dedup"), MIN_FILES), long_name])


FILTERED_SQL = f"""{DOUBLED_SQL},
a as (select source_file, count(*) as original_records from doubled group by 1),
b as (select source_file, count(*) as after_dedup from deduped group by 1),
filtered as (select *, after_dedup >= {MIN_FILES} as enough, not contains(source_file, 'Unknown') as complete
  from a join b using (source_file))"""


@query("min_files_filter", "slices", f"""with {DOUBLED_SQL[1:]},
ranked as (select *, row_number() over (partition by source_file order by line_no, file_path) as rn,
  count(*) over (partition by source_file) as ct_objects_count from deduped)
select patient_id, patient_name, study_date, patient_age, study_modality, institution_name,
  source_file, ct_objects_count, regexp_replace(file_path, '/[^/]*$', '') as dicom_folder_path
from ranked where rn = 1 and ct_objects_count >= {MIN_FILES}
""")
def min_files_filter(t: Tables) -> DataFrame:
    return ops.study_summary(deduped(t), fields=SUMMARY).filter(
        F.col("ct_objects_count") >= MIN_FILES)


@query("filter_reasons", "slices", f"""with {FILTERED_SQL[1:]}
select source_file, original_records, after_dedup, enough and complete as passed,
 concat_ws('; ', concat('Filter 1: ', case when enough then concat('Passed: ', after_dedup, ' files >= {MIN_FILES} minimum')
   else concat('Failed: ', after_dedup, ' files < {MIN_FILES} minimum') end),
   case when enough then concat('Filter 2: ', case when complete then 'Passed: header complete' else 'Failed: missing header value' end) end) as filter_results
from filtered
""")
def filter_reasons(t: Tables) -> DataFrame:
    return filtered(t).select("source_file", "original_records", "after_dedup", "passed",
                              F.array_join("filter_results", "; ").alias("filter_results"))


FILTER_STATS_SQL = f"""with {FILTERED_SQL[1:]}
select count(*) as total_files_found, count_if(skip)::bigint as files_skipped, count_if(not skip)::bigint as files_processed,
 count_if(not skip and enough and complete)::bigint as files_passed_filters,
 count_if(not skip and not (enough and complete))::bigint as files_failed_filters,
 sum(original_records) filter (where not skip)::bigint as total_records_original,
 sum(after_dedup) filter (where not skip)::bigint as total_records_after_dedup,
 coalesce(sum(after_dedup) filter (where not skip and enough and complete), 0)::bigint as total_records_final
from (select *, starts_with(source_file, '1992') as skip from filtered) x
"""


@query("filter_stats", "slices", FILTER_STATS_SQL)
def filter_stats(t: Tables) -> DataFrame:
    return ops.filter_statistics(filtered(t), skipped=F.col("source_file").startswith("1992"))


@query("observed_filter_run", "slices", FILTER_STATS_SQL)
def observed_filter_run(t: Tables) -> DataFrame:
    """The totals that a run collects while it writes its details."""
    folder = own(t.spark, f"{ensure_checkpoint_dir(t.spark)}/run-{uuid.uuid4().hex}")
    figures = runs.write_filter_run(filtered(t), folder, {"min_files": str(MIN_FILES)},
                                    skipped=F.col("source_file").startswith("1992"))
    return t.spark.read.json(f"{folder}/document").select(
        *[f"summary.{name}" for name in figures if name != "seconds"])


@query("filter_run_details", "slices", f"""with {FILTERED_SQL[1:]}
select source_file, case when skip then 'SKIPPED' when enough and complete then 'PASSED' else 'FAILED' end as status, case when not skip then original_records end as original_records,
 case when not skip then after_dedup end as after_dedup, case when not skip and enough and complete then after_dedup end as final_records,
 case when not skip and enough and complete then concat('S3_processForStore_', source_file) end as output_file
from (select *, starts_with(source_file, '1992') as skip from filtered) x
""")
def filter_run_details(t: Tables) -> DataFrame:
    return runs.file_details(filtered(t), F.col("source_file").startswith("1992")).drop(
        "filter_results", "error")


@query("filtered_store", "slices", f"""with {FILTERED_SQL[1:]}
select d.* from deduped d join filtered f using (source_file) where enough and complete
""")
def filtered_store(t: Tables) -> DataFrame:
    counted = ops.dedup_with_counts(doubled(t), "source_file", RECORD, tasks=t.tasks())
    return with_filters(counted).filter("passed").select("source_file", *RECORD, "line_no")


@query("study_name_sanitise", "", r"""
with names as (
 select concat(p_name, ':', p_brand, '*', p_type, '?.jsonl') as raw from part
 union all select url as raw from pages),
safe as (select raw, regexp_replace(raw, '[\\/:*?"<>|]', '_', 'g') as s from names),
capped as (select raw, case when length(s) > 255 and contains(s, '.')
   then concat(case when room >= 0 then left(stem, room) else left(stem, greatest(length(stem) + room, 0)) end, '.', ext)
   else left(s, 255) end as c
  from (select *, regexp_replace(s, '\.[^.]*$', '') as stem, regexp_extract(s, '([^.]*)$', 1) as ext,
   254 - length(regexp_extract(s, '([^.]*)$', 1)) as room from safe) x)
select raw, coalesce(nullif(trim(c, ' .'), ''), 'unnamed_file') as safe_name,
 regexp_replace(concat('S3_processForStore_', coalesce(nullif(trim(c, ' .'), ''), 'unnamed_file')), '^S3_processForStore_', '') as same_name
from capped
""")
def study_name_sanitise(t: Tables) -> DataFrame:
    raw = t.part.select(F.concat("p_name", F.lit(":"), "p_brand", F.lit("*"), "p_type",
                                 F.lit("?.jsonl")).alias("raw")).unionByName(
        t.pages.select(F.col("url").alias("raw")))
    safe = text.safe_file_name(F.col("raw"), longest=255)
    return raw.select(
        "raw", safe.alias("safe_name"),
        text.study_name(F.concat(F.lit("S3_processForStore_"), safe, F.lit(".zip")))
        .alias("same_name"))


@query("source_counts", "both_sites", """
select source_folder, count(*) as patient_count from both_sites group by rollup (source_folder)
""")
def source_counts(t: Tables) -> DataFrame:
    return ops.source_counts(t.both_sites, "source_folder")
