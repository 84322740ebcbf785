"""Queries over file listings and progress ledgers."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from studyloom.catalog.fixtures import Tables
from studyloom.catalog.registry import query
from studyloom.functions import privacy, text
from studyloom.operators import files, progress, series
from studyloom.operators.top import first_rows

PATHS_SQL = """paths as (select file_path as path from slices union all select url from pages)"""


def paths(t: Tables) -> DataFrame:
    return t.slices.select(F.col("file_path").alias("path")).unionByName(
        t.pages.select(F.col("url").alias("path")))


EXT = r"case when contains(regexp_extract(path, '([^/\\]*)$', 1), '.') then lower(regexp_extract(regexp_extract(path, '([^/\\]*)$', 1), '\.([^.]*)$', 1)) else '' end"
KIND = f"case when {EXT} in ('dcm', '') then 'dicom' when {EXT} in ('pdf', 'doc', 'docx') then 'document' when {EXT} in ('png', 'jpg', 'jpeg') then 'image' end"


@query("file_kinds", "slices", f"""with {PATHS_SQL}
select path, {KIND} as kind from paths
""")
def file_kinds(t: Tables) -> DataFrame:
    return paths(t).select("path", files.file_kind(F.col("path")).alias("kind"))


@query("folder_index", "slices", f"""
with paths as (select file_path as path from slices),
kinds as (select *, regexp_replace(path, '/[^/]*$', '') as folder, {KIND} as kind from paths)
select replace(trim(folder, '/'), '/', '_._') as folder_key, folder, count(*) as files, count(*) filter (where kind = 'dicom') as dicom_files,
 count(*) filter (where kind = 'document') as document_files, count(*) filter (where kind = 'image') as image_files from kinds group by 1, 2
""")
def folder_index(t: Tables) -> DataFrame:
    return files.folder_index(t.slices.select(F.col("file_path").alias("path")))


@query("folder_files", "slices", f"""
with paths as (select file_path as path from slices),
kinds as (select *, replace(trim(regexp_replace(path, '/[^/]*$', ''), '/'), '/', '_._') as folder_key, {KIND} as kind from paths)
select folder_key, kind, path from kinds where kind is not null
""")
def folder_files(t: Tables) -> DataFrame:
    return files.folder_files(t.slices.select(F.col("file_path").alias("path")))


@query("folder_contents", "slices", f"""
with paths as (select file_path as path from slices)
select regexp_replace(path, '/[^/]*$', '') as folder, count(*) as total_files, count(*) filter (where {EXT} = 'dcm') as dcm_files, count(*) filter (where {EXT} = '') as no_extension_files from paths group by 1
""")
def folder_contents(t: Tables) -> DataFrame:
    return files.folder_contents(t.slices.select(F.col("file_path").alias("path")))


@query("existence_split", "slices listing", """
select study_no, count(*) filter (where file_path in (select path from listing)) as existing, count(*) filter (where file_path not in (select path from listing)) as missing from slices where file_path <> '' group by 1
""")
def existence_split(t: Tables) -> DataFrame:
    return files.existence_counts(t.slices, t.listing, ["study_no"])


@query("missing_files", "slices listing", """
select study_no, file_path, line_no from slices where file_path not in (select path from listing)
""")
def missing_files(t: Tables) -> DataFrame:
    return files.missing_records(t.slices, t.listing).select("study_no", "file_path", "line_no")


ARCHIVES_SQL = """archives as (select study_no, count(*) as n_files, sum(length)::bigint as original_size, sum(length * 3 // 5)::bigint as compressed_size
  from (select file_path, study_no, substr(image_position_patient, 8, length(image_position_patient) - 8)::double * 1000 as q from slices) s
  join (select path, max(length) as length from listing group by 1) l on s.file_path = l.path group by 1)"""


def archives(t: Tables) -> DataFrame:
    sizes = t.listing.groupBy("path").agg(F.max("length").alias("length"))
    found = t.slices.select("study_no", "file_path").join(
        sizes, F.col("file_path") == F.col("path"))
    return found.groupBy("study_no").agg(
        F.count(F.lit(1)).alias("n_files"), F.sum("length").alias("original_size"),
        F.sum(F.floor(F.col("length") * 3 / 5)).alias("compressed_size"))


@query("archive_stats", "slices listing", f"""with {ARCHIVES_SQL}
select count(*) as studies, sum(n_files)::bigint as total_files, 0::bigint as missing_files, sum(original_size)::bigint as original_size, sum(compressed_size)::bigint as compressed_size,
 round((1 - sum(compressed_size)::double / sum(original_size)) * 100, 6) as saved_percent from archives
""")
def archive_stats(t: Tables) -> DataFrame:
    totals = files.archive_totals(archives(t).withColumn("missing", F.lit(0).cast("bigint")))
    return totals.drop("original_text", "compressed_text").withColumn(
        "saved_percent", F.round("saved_percent", 6))


@query("archive_ratio", "slices listing", f"""with {ARCHIVES_SQL}
select study_no, round(case when original_size > 0 then (1 - compressed_size::double / original_size) * 100 else 0 end, 6) as saved_percent from archives
""")
def archive_ratio(t: Tables) -> DataFrame:
    return archives(t).select("study_no", F.round(text.saved_ratio(
        F.col("original_size"), F.col("compressed_size")), 6).alias("saved_percent"))


@query("human_size", "slices listing", f"""with {ARCHIVES_SQL}, sizes as (select study_no, original_size * (study_no % 5) * (study_no % 5) * 100 as size from archives)
select study_no, size, case when size = 0 then '0 B' when size < 1024 then printf('%.2f B', size::double) when size < 1048576 then printf('%.2f KB', size / 1024.0::double)
 when size < 1073741824 then printf('%.2f MB', size / 1048576.0::double) else printf('%.2f GB', size / 1073741824.0::double) end as size_text from sizes
""")
def human_size(t: Tables) -> DataFrame:
    n = F.col("study_no") % 5
    sizes = archives(t).select("study_no", (F.col("original_size") * n * n * 100).alias("size"))
    return sizes.withColumn("size_text", text.human_size(F.col("size")))


@query("unsafe_paths", "slices", f"""with {PATHS_SQL},
entries as (select case when length(path) % 3 = 0 then substr(path, 2) when length(path) % 3 = 1 then concat('a/..', path) else path end as entry from paths)
select entry, starts_with(entry, '/') or contains(entry, '..') as unsafe from entries
""")
def unsafe_paths(t: Tables) -> DataFrame:
    path, n = F.col("path"), F.length("path") % 3
    entry = F.when(n == 0, F.substr(path, F.lit(2))).when(
        n == 1, F.concat(F.lit("a/.."), path)).otherwise(path)
    return paths(t).select(entry.alias("entry")).withColumn(
        "unsafe", text.unsafe_path(F.col("entry")))


@query("project_names", "slices", r"""
with folders as (select distinct regexp_replace(file_path, '/[^/]*$', '') as folder from slices),
named as (select folder, concat(folder, '/a b&c.', length(folder), '/') as location from folders)
select location, concat(regexp_extract(folder, '([^/]*)$', 1), '_._a_b_c_', length(folder)) as project, printf('batch_%03d', length(folder)) as custom,
 concat(replace(trim(folder, '/'), '/', '_._'), '_._a b&c') as flat_name
from named
""")
def project_names(t: Tables) -> DataFrame:
    folder = text.parent_folder(F.col("file_path"))
    folders = t.slices.select(folder.alias("folder")).distinct()
    located = folders.withColumn("location", F.concat(
        "folder", F.lit("/a b&c."), F.length("folder").cast("string"), F.lit("/")))
    return located.select(
        "location", text.project_name(F.col("location"), F.lit(1)).alias("project"),
        text.custom_project_name("batch", F.length("folder")).alias("custom"),
        text.flat_archive_name(F.concat("folder", F.lit("/a b&c.iso"))).alias("flat_name"))


@query("content_md5", "", "select doc_id, md5(text) as checksum from documents")
def content_md5(t: Tables) -> DataFrame:
    return t.documents.select("doc_id", F.md5(F.col("text").cast("binary")).alias("checksum"))


@query("pending_anti", "ledger", """
select o_orderkey, cast(o_orderkey as varchar) as key from orders where cast(o_orderkey as varchar) not in (select key from ledger where status = 'ok')
""")
def pending_anti(t: Tables) -> DataFrame:
    work = t.orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("key"))
    return progress.pending(work, t.ledger, "key")


@query("pending_no_retry", "ledger", """
select o_orderkey, cast(o_orderkey as varchar) as key from orders where cast(o_orderkey as varchar) not in (select key from ledger where status <> 'pending')
""")
def pending_no_retry(t: Tables) -> DataFrame:
    work = t.orders.select("o_orderkey", F.col("o_orderkey").cast("string").alias("key"))
    return progress.pending(work, t.ledger, "key", retry_failed=False)


TRACKED_SQL = """tracker as (select *, substr(sha256(concat(patient_id, '_', study_date, '_', series_number, '_', institution_name)), 1, 16) as hash_id
  from (select study_no, series_number, count(*) as slice_count from slices group by 1, 2) c join studies using (study_no)),
outcomes as (select hash_id, max(case when study_no % 3 = 0 then 1 else 0 end) as failed from tracker where study_no % 2 = 0 group by 1),
tracked as (select t.study_no, t.series_number, t.hash_id, t.slice_count, case when o.hash_id is null then 'pending' else 'completed' end as processing_status, o.failed = 0 as success,
  case when o.failed = 1 then 'unreadable' end as error_message from tracker t left join outcomes o using (hash_id))"""


def tracked(t: Tables) -> DataFrame:
    slices = t.slices.select("study_no", "series_number")
    studies = t.studies.select("study_no", "patient_id", "study_date", "institution_name")
    tracker = series.series_tracker(studies, slices, ["study_no"])
    failed = F.col("study_no") % 3 == 0
    ledger = tracker.filter(F.col("study_no") % 2 == 0).select(
        privacy.error_key(F.col("hash_id"), failed).alias("key"),
        F.when(failed, "failed").otherwise("ok").alias("status"), F.lit("2024-01-01").alias("ts"),
        failed.cast("int").alias("attempt"),
        F.when(failed, "unreadable").alias("error"))
    return progress.track_series(tracker, ledger)


@query("tracker_update", "slices studies", f"with {TRACKED_SQL} select * from tracked")
def tracker_update(t: Tables) -> DataFrame:
    return tracked(t).select("study_no", "series_number", "hash_id", "slice_count",
                             "processing_status", "success", "error_message")


@query("tracker_summary", "slices studies", f"""with {TRACKED_SQL},
c as (select count(*) as total_series, count(*) filter (where processing_status = 'pending') as pending, count(*) filter (where success) as successful, count(*) filter (where not success) as failed from tracked)
select *, printf('%.1f%%', (total_series - pending)::double / total_series * 100) as processing_rate from c
""")
def tracker_summary(t: Tables) -> DataFrame:
    return progress.tracker_summary(tracked(t))


@query("run_summary", "ledger", """
with c as (select count(*) as processed, count(*) filter (where status = 'ok') as successful, count(*) filter (where status <> 'ok') as failed, count(*) filter (where status = 'pending') as already_processed from ledger)
select *, printf('%.1f%%', successful::double / processed * 100) as success_rate from c
""")
def run_summary(t: Tables) -> DataFrame:
    return progress.run_summary(t.ledger, F.col("status") == "ok", F.col("status") == "pending")


@query("location_progress", "ledger", """
select location, count(*) filter (where status = 'ok') as completed, count(*) filter (where status = 'failed') as failed, count(*) filter (where status = 'pending') as pending from ledger group by 1
""")
def location_progress(t: Tables) -> DataFrame:
    return progress.location_progress(t.ledger)


@query("location_resume", "ledger", """
with locations as (select distinct concat('location_', o_custkey % 30) as location from orders),
last as (select location, status, row_number() over (partition by location order by ts desc, key desc, status desc) as rn from ledger)
select location from locations left join (select * from last where rn = 1) l using (location) where coalesce(status, 'pending') <> 'ok'
""")
def location_resume(t: Tables) -> DataFrame:
    locations = t.orders.select(F.concat(
        F.lit("location_"), (F.col("o_custkey") % 30).cast("string")).alias("location")).distinct()
    return progress.locations_to_run(locations, t.ledger)


@query("latest_done", "ledger", """
select key, status, ts, location from ledger where status = 'ok' order by ts desc, key desc limit 10
""")
def latest_done(t: Tables) -> DataFrame:
    return progress.latest_done(t.ledger)


@query("first_rows", "label_text", """
select series_id, image_type, study_series_description from label_text order by series_id limit 100
""")
def first_rows_query(t: Tables) -> DataFrame:
    return first_rows(t.label_text.select("series_id", "image_type", "study_series_description"),
                      ["series_id"], 100)


@query("distinct_extensions", "slices", f"""with {PATHS_SQL} select distinct {EXT} as extension from paths""")
def distinct_extensions(t: Tables) -> DataFrame:
    return paths(t).select(text.file_extension(F.col("path")).alias("extension")).distinct() \
        .orderBy("extension")
