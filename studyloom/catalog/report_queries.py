"""Queries over reports, extraction and text assembly."""

from __future__ import annotations

import uuid
from math import ceil

from pyspark.sql import DataFrame, Window, functions as F

from studyloom.catalog.fixtures import Tables
from studyloom.catalog.registry import query
from studyloom.functions import jsontext, report_fields, text
from studyloom.functions.staging import computed_once
from studyloom.operators import reports as ops
from studyloom.operators.skew import number_rows
from studyloom.session import ensure_checkpoint_dir, own
from studyloom.sources import documents

TRIM = "trim({c}, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))"
FLAG_SQL = f"""concat_ws(', ', case when coalesce({TRIM.format(c='report_text')}, '') = '' then 'empty' when length({TRIM.format(c='report_text')}) < 50 then 'too_short' end,
  case when contains(report_text, 'Extraction for .doc is not implemented.') then '.doc' end)"""
FLAGGED_SQL = f"flagged as (select *, {FLAG_SQL} as need_manual_check from reports)"


@query("report_flags", "reports", f"""with {FLAGGED_SQL}
select doc_id, file_path, source_processed_dir, need_manual_check from flagged
""")
def report_flags(t: Tables) -> DataFrame:
    return ops.flag_reports(t.reports).select(
        "doc_id", "file_path", "source_processed_dir", "need_manual_check")


@query("report_stats", "reports", f"""with {FLAGGED_SQL}
select count(*) as total_reports, round(avg(length(report_text)), 4) as mean_length, count(*) filter (where need_manual_check <> '') as total_flagged,
 round(count(*) filter (where need_manual_check <> '') / count(*) * 100, 4) as flagged_percent, count(*) filter (where contains(need_manual_check, 'empty')) as empty,
 count(*) filter (where contains(need_manual_check, 'too_short')) as too_short, count(*) filter (where contains(need_manual_check, '.doc')) as doc_not_implemented,
 count(*) filter (where need_manual_check = '') as clean from flagged
""")
def report_stats(t: Tables) -> DataFrame:
    return ops.report_statistics(ops.flag_reports(t.reports)).withColumns({
        "mean_length": F.round("mean_length", 4),
        "flagged_percent": F.round("flagged_percent", 4)})


@query("report_by_source", "reports", """
select source_processed_dir, count(*) as reports from reports group by rollup (source_processed_dir)
""")
def report_by_source(t: Tables) -> DataFrame:
    return t.reports.rollup("source_processed_dir").agg(F.count(F.lit(1)).alias("reports"))


def write_report_maps(reports: DataFrame) -> str:
    """One JSON map of file path to text per source, as sites deliver them; the folder."""
    order = Window.partitionBy("source_processed_dir").orderBy("file_path")
    entry = F.to_json(F.create_map("file_path", "report_text"), {"ignoreNullFields": "false"})
    lines = reports.select("source_processed_dir", F.concat(
        F.when(F.lag("file_path").over(order).isNull(), "{").otherwise(","),
        F.substr(entry, F.lit(2), F.length(entry) - 2),
        F.when(F.lead("file_path").over(order).isNull(), "}").otherwise("")).alias("value"))
    spark = reports.sparkSession
    folder = own(spark, f"{ensure_checkpoint_dir(spark)}/maps-{uuid.uuid4().hex}")
    lines.write.partitionBy("source_processed_dir").text(folder)
    return folder


@query("document_map_scan", "reports", f"""
select source_processed_dir, file_path, length(report_text) as text_length, md5(report_text) as text_md5, {FLAG_SQL} as need_manual_check from reports
""")
def document_map_scan(t: Tables) -> DataFrame:
    """Reports written as large JSON maps and read back in splits."""
    folder = write_report_maps(t.reports.withColumn(
        "source_processed_dir", F.coalesce("source_processed_dir", F.lit(""))))
    rows = documents.read_document_maps(t.spark, f"{folder}/*")
    site = F.url_decode(F.regexp_extract("source_json_file", "source_processed_dir=([^/]*)/", 1))
    return ops.flag_reports(rows).select(
        site.alias("source_processed_dir"), "file_path",
        F.length("report_text").alias("text_length"), F.md5("report_text").alias("text_md5"),
        "need_manual_check")


PACKAGE_SQL = f"""{FLAGGED_SQL},
rows as (select *, row_number() over (order by doc_id) - 1 as position, case when doc_id % 37 = 0 then ' ' else concat('E:', file_path) end as given from flagged),
files as (select case when doc_id % 4 = 3 then concat('E:', file_path) else concat('D:', file_path) end as path from flagged where doc_id % 4 <> 0),
moved as (select *, case when substr(given, 2, 1) = ':' then concat('D:', substr(given, 3)) else given end as modified_path from rows where trim(need_manual_check) <> ''),
resolved as (select m.*, case when trim(given) <> '' then coalesce(a.path, b.path) end as resolved_path
  from moved m left join files a on a.path = modified_path left join files b on b.path = given),
package as (select *, case when trim(given) = '' then 'Empty file path' when resolved_path is null then 'File not found' end as reason,
  case when resolved_path is not null then printf('ROW_%04d_%s', position, regexp_extract(resolved_path, '([^/]*)$', 1)) else '' end as copied from resolved)"""


def packaged(t: Tables) -> DataFrame:
    flagged = ops.flag_reports(t.reports)
    numbered = number_rows(flagged, ["doc_id"], "position", start=0)
    rows = numbered.withColumn("file_path", F.when(F.col("doc_id") % 37 == 0, " ").otherwise(
        F.concat(F.lit("E:"), "file_path")))
    drive = F.when(F.col("doc_id") % 4 == 3, "E:").otherwise("D:")
    files = t.reports.filter(F.col("doc_id") % 4 != 0).select(
        F.concat(drive, "file_path").alias("path"))
    return ops.manual_package(rows, files, "position")


@query("manual_check_manifest", "reports", f"""with {PACKAGE_SQL}
select doc_id, position, given as file_path, need_manual_check, copied as _copied_filename, '' as _extraction_status from package
""")
def manual_check_manifest(t: Tables) -> DataFrame:
    return packaged(t).select("doc_id", "position", "file_path", "need_manual_check",
                              "_copied_filename", "_extraction_status")


@query("path_resolution", "reports", f"""with {PACKAGE_SQL}
select position as row_index, given as original_path, modified_path, reason from package where reason is not null
""")
def path_resolution(t: Tables) -> DataFrame:
    return ops.package_failures(packaged(t), "position")


@query("package_totals", "reports", f"""with {PACKAGE_SQL}
select count(*) as total_rows, count(*) filter (where reason is null) as files_copied, count(*) filter (where reason is not null) as files_failed from package
""")
def package_totals(t: Tables) -> DataFrame:
    return ops.package_totals(packaged(t))


TOKENS_SQL = """split as (select doc_id, string_split(text, ' ') as w from documents),
tokens as (select doc_id, unnest(w) as token, unnest(range(1, len(w) + 1)) as seq from split),
rated as (select *, (seq * 37 % 100) / 100.0 as confidence, seq // 200 as page from tokens),
pages as (select doc_id, page, string_agg(token, ' ' order by seq) filter (where confidence >= 0.3) as page_text, count(*) filter (where confidence >= 0.3) as kept,
  sum(confidence::double) filter (where confidence >= 0.3) as total from rated group by 1, 2),
texts as (select doc_id, trim(coalesce(string_agg(page_text, concat(chr(10), chr(10)) order by page) filter (where kept > 0), ''), concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13))) as text,
  sum(kept)::bigint as kept_tokens, count(*) as page_count, case when sum(kept) > 0 then sum(total) / sum(kept) else 0.0 end as confidence from pages group by 1)"""


# Documents per task where these would fill more tasks than the session's shuffle partitions.
TASK_DOCUMENTS = 2_500


def spread_documents(t: Tables) -> DataFrame:
    """Documents by doc_id in tasks whose rows do not grow with the input."""
    least = int(t.spark.conf.get("spark.sql.shuffle.partitions"))
    tasks = max(least, ceil(t.documents.count() / TASK_DOCUMENTS))
    return t.documents.select("doc_id", "text").repartition(tasks, "doc_id")


def assembled(t: Tables) -> DataFrame:
    # whole texts are exchanged, not their tokens: what follows is grouped within a document
    words = spread_documents(t).select("doc_id", F.posexplode(F.split("text", " ")).alias("p", "token"))
    seq = F.col("p") + 1
    tokens = words.select("doc_id", (F.floor(seq / 200)).alias("page"), seq.alias("seq"), "token",
                          ((seq * 37 % 100) / 100).alias("confidence"))
    return ops.assemble_pages(tokens)


@query("token_assembly", "", f"""with {TOKENS_SQL}
select doc_id, md5(text) as text_md5, length(text) as text_length, kept_tokens, page_count, round(confidence, 6) as confidence from texts
""")
def token_assembly(t: Tables) -> DataFrame:
    return assembled(t).select(
        "doc_id", F.md5(F.col("text").cast("binary")).alias("text_md5"),
        F.length("text").alias("text_length"), "kept_tokens", "page_count",
        F.round("confidence", 6).alias("confidence"))


@query("writeback_join", "reports", f"""with {PACKAGE_SQL}, {TOKENS_SQL}
select p.doc_id, copied as _copied_filename, coalesce(length(x.text), 0) as extracted_length, case when x.doc_id is null then '' else 'success' end as _extraction_status,
 round(x.confidence, 6) as _extraction_confidence
from package p left join texts x on x.doc_id = p.doc_id and p.copied <> '' and p.doc_id % 2 = 0
""")
def writeback_join(t: Tables) -> DataFrame:
    package = packaged(t)
    done = package.filter((F.col("_copied_filename") != "") & (F.col("doc_id") % 2 == 0)).select(
        "doc_id", F.col("_copied_filename").alias("filename"))
    results = done.join(assembled(t), "doc_id").select(
        "filename", "text", F.lit("success").alias("status"), F.lit("ocr").alias("method"),
        "confidence")
    return ops.write_back(package, results).select(
        "doc_id", "_copied_filename", F.length("_extracted_text").alias("extracted_length"),
        "_extraction_status",
        F.round("_extraction_confidence", 6).alias("_extraction_confidence"))


@query("doc_map_explode", "reports", "select file_path, report_text from reports")
def doc_map_explode(t: Tables) -> DataFrame:
    packed = t.reports.groupBy((F.floor(F.col("doc_id") / 50)).alias("file_no")).agg(
        F.to_json(F.map_from_entries(F.collect_list(F.struct("file_path", "report_text"))))
        .alias("body"))
    return packed.select(F.explode(F.from_json("body", "map<string,string>")).alias(
        "file_path", "report_text"))


FIELDS_SQL = r"""trimmed as (select *, length(trim(text)) < 10 as short from report_text),
read as (select *,
  coalesce(try_cast(nullif(regexp_extract(text, '(?i)(\d+)\s*stud(?:y|ies)', 1), '') as integer), 0) as n,
  upper(nullif(regexp_extract(text, '(?i)\b(CT|MRI|X-ray|Ultrasound|PET|SPECT|Mammography)\b', 1), '')) as m,
  nullif(regexp_extract(text, '(?i)\b(Head|Neck|Chest|Abdomen|Pelvis|Spine|Extremities)\b', 1), '') as b,
  trim(nullif(regexp_extract(text, '(?i)PATIENT\s+NAME[:\s]*([^\n,]+)', 1), '')) as pname,
  trim(nullif(regexp_extract(text, '(?i)AGE[:\s]*([^\n,]+)', 1), '')) as age,
  lower(trim(nullif(regexp_extract(text, '(?i)GENDER[:\s]*([^\n,]+)', 1), ''))) as g,
  contains(lower(text), 'with contrast') as wc from trimmed),
found as (select *, not short and (n > 0 or m is not null or pname is not null or age is not null) as good from read)"""


@query("report_fields", "report_text", f"""with {FIELDS_SQL}
select report_id, n as number_of_studies, case when m in ('CT', 'MRI', 'PET', 'SPECT') then m else 'Unknown' end as imaging_modality,
 coalesce(concat(upper(left(b, 1)), lower(substr(b, 2))), 'Unknown') as body_part, pname as name, age,
 case when g in ('m', 'male') then 'Male' when g in ('f', 'female') then 'Female' end as gender, case when wc then true end as contrast_used
from found where good
""")
def report_fields_query(t: Tables) -> DataFrame:
    data = F.col("extraction_data")
    good = ops.extract_reports(t.report_text).filter("extraction_successful")
    return good.select(
        "report_id", data["number_of_studies"].alias("number_of_studies"),
        data["imaging_modality"].alias("imaging_modality"), data["body_part"].alias("body_part"),
        data["patient_info"]["name"].alias("name"), data["patient_info"]["age"].alias("age"),
        data["patient_info"]["gender"].alias("gender"),
        data["contrast_used"].alias("contrast_used"))


@query("extraction_failures", "report_text", f"""with {FIELDS_SQL}
select file_path, 'empty_document' as error_type, '{report_fields.SHORT_MESSAGE}' as error_message, length(text) as text_length from found where short
union all select file_path, 'parsing_failure', 'No field found', length(text) from found where not short and not good
""")
def extraction_failures(t: Tables) -> DataFrame:
    return ops.extraction_failures(ops.extract_reports(t.report_text))


@query("extraction_split", "report_text", f"""with {FIELDS_SQL}
select file_path, regexp_extract(file_path, '([^/]*)$', 1) as file_name, '/r' as parent_directory, length(text) as text_length, n as number_of_studies from found where good
""")
def extraction_split(t: Tables) -> DataFrame:
    return ops.extraction_successes(ops.extract_reports(t.report_text)).select(
        "file_path", "file_name", "parent_directory", "text_length",
        F.col("extraction_data.number_of_studies").alias("number_of_studies"))


@query("extraction_stats", "report_text", f"""with {FIELDS_SQL},
s as (select *, report_id % 10 = 3 as skip from found)
select count(*) as total_documents, count(*) filter (where not skip) as processed_documents, count(*) filter (where not skip and good) as successful_extractions,
 count(*) filter (where not skip and not good) as failed_extractions, count(*) filter (where skip) as skipped_documents, count(*) filter (where not skip and good and n = 0) as empty_documents,
 round(count(*) filter (where not skip and good) / greatest(count(*) filter (where not skip), 1) * 100, 4) as success_rate from s
""")
def extraction_stats(t: Tables) -> DataFrame:
    stats = ops.extraction_statistics(ops.extract_reports(t.report_text),
                                      skipped=F.col("report_id") % 10 == 3)
    return stats.withColumn("success_rate", F.round("success_rate", 4))


@query("document_fields", "", r"""
with read as (select doc_id, length(text) as text_length, nullif(regexp_extract(text, '(?i)(\d+)y', 1), '') as digits_y from documents)
select doc_id, text_length, digits_y from read
""")
def document_fields(t: Tables) -> DataFrame:
    return t.documents.select(
        "doc_id", F.length("text").alias("text_length"),
        report_fields.first_match(F.col("text"), [r"(\d+)y"]).alias("digits_y"))


@query("json_clean", "", r"""
select event_id, concat(left(props, length(props) - 1), ', "s": "a, b: {c: 1, }", "t": [1, 2], "note": 3}') as cleaned
from events
""")
def json_clean(t: Tables) -> DataFrame:
    raw = F.concat(F.lit(" "), F.expr("left(props, length(props) - 1)"),
                   F.lit(', "s": "a, b: {c: 1, }", "t": [1, 2, ], note: 3, }'))
    return t.events.select("event_id", jsontext.clean_json(raw).alias("cleaned"))


@query("json_salvage", "", r"""
select event_id, regexp_extract(props, '"k"\s*:\s*(\d+)', 1) as k, event_type as gender, '1' as number_of_studies, 'CT' as modality, 'Chest' as body_part,
 case when event_id % 2 = 0 then 'null' end as impression
from events
""")
def json_salvage(t: Tables) -> DataFrame:
    missing = F.when(F.col("event_id") % 2 == 0, F.lit('"null"')).otherwise(F.lit("null"))
    broken = F.concat(F.lit("a ct of the chest: "), F.expr("left(props, length(props) - 1)"),
                      F.lit(', "impression": '), missing,
                      F.lit(', "gender" : "'), "event_type", F.lit('" , "x'))
    paired = computed_once(t.events.withColumn("raw", broken),
                           pairs=jsontext.salvage_pairs(F.col("raw")))
    hinted = computed_once(paired, hinted=jsontext.add_hints(F.col("pairs"), F.col("raw")))
    return hinted.select("event_id", *[
        F.try_element_at("hinted", F.lit(k)).alias(k)
        for k in ("k", "gender", "number_of_studies", "modality", "body_part", "impression")])


@query("json_fence", "", r"""
select event_id, props as body, props as first_json from events
""")
def json_fence(t: Tables) -> DataFrame:
    fenced = F.concat(F.lit("```json\n"), "props", F.lit("\n```"))
    prose = F.concat(F.lit("Here it is: {broken "), fenced)
    return t.events.select("event_id", jsontext.strip_fence(fenced).alias("body"),
                           jsontext.first_valid_json(prose).alias("first_json"))


@query("response_ladder", "", r"""
select event_id, case when event_id % 4 = 0 then 'structured' when event_id % 4 = 1 then 'content_json' when event_id % 4 = 2 then 'reasoning_json' when value > 50 then 'intelligent_parsing' end as method,
 case when event_id % 4 in (0, 1, 2) then user_id::integer when value > 50 then 3 end as number_of_studies,
 case when event_id % 4 in (0, 1) then 'MRI' when event_id % 4 = 2 then 'Unknown' when value > 50 then 'CT' end as imaging_modality,
 case when event_id % 4 = 0 then 'a, b: c' when event_id % 4 = 2 then 'null' end as findings_summary
from events
""")
def response_ladder(t: Tables) -> DataFrame:
    count = F.col("user_id").cast("string")
    kind = F.col("event_id") % 4
    whole = F.concat(F.lit('{"number_of_studies": '), count,
                     F.lit(', "imaging_modality": "MRI", "findings_summary": "a, b: c", '
                           '"current_disease_list": []}'))
    cut = F.concat(F.lit('so "number_of_studies": '), count, F.lit(', "imaging_modality": "MRI" , "findings_summary": null,'))
    reasoned = F.concat(F.lit('"number_of_studies" : '), count, F.lit(' then "findings_summary": "null"'))
    prose = F.when(F.col("value") > 50, F.lit("3 studies, CT scan")).otherwise(F.lit("none"))
    answers = t.events.select(
        "event_id", F.when(kind == 0, whole).when(kind == 1, cut).when(kind == 3, prose)
        .alias("content"), F.when(kind == 2, reasoned).alias("reasoning"))
    parsed = report_fields.parse_responses(answers)
    return parsed.select("event_id", F.col("parsing_method").alias("method"),
                         "extraction_data.number_of_studies", "extraction_data.imaging_modality",
                         "extraction_data.findings_summary")


HTML_SQL = r"""trim(regexp_replace(replace(replace(replace(replace(replace(replace(
 regexp_replace(regexp_replace(regexp_replace(html, '(?is)<(script|style)[^>]*>.*?</(script|style)>', ' ', 'g'), '(?s)<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'),
 '&nbsp;', ' '), '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&amp;', '&'), '[ \t\r\n]+', ' ', 'g'))"""


@query("html_text_job", "", f"""
with shown as (select page_id, {HTML_SQL} as body from pages)
select page_id, case when length(body) >= 10 then 'success' else 'empty_document' end as status, 'native' as method, md5(body) as text_md5, length(body) as text_length from shown
""")
def html_text_job(t: Tables) -> DataFrame:
    shown = t.pages.select("page_id", ops.html_text(F.col("html")).alias("body"))
    status = shown.withColumn("r", ops.extraction_status(
        F.lit("docx"), F.col("body"), F.lit(None).cast("string"), F.lit(None).cast("string")))
    return status.select("page_id", "r.status", "r.method",
                         F.md5(F.col("r.text").cast("binary")).alias("text_md5"),
                         F.length("r.text").alias("text_length"))


@query("status_tally", "reports", """
with kinds as (select doc_id, case doc_id % 7 when 0 then 'ocr_failed' when 1 then 'ocr_fallback' when 2 then 'corrupted' else case when length(trim(report_text, concat(' ', chr(9), chr(10), chr(11), chr(12), chr(13)))) >= 10 then 'success' else 'empty_document' end end as status from reports)
select count(*) as total_files, count(*) filter (where status in ('success', 'ocr_fallback')) as successful, count(*) filter (where status = 'ocr_fallback') as ocr_used,
 count(*) filter (where status = 'empty_document') as empty, count(*) filter (where status in ('ocr_failed', 'corrupted')) as failed from kinds
""")
def status_tally(t: Tables) -> DataFrame:
    n = F.col("doc_id") % 7
    none = F.lit(None).cast("string")
    kind = F.when(n <= 1, "pdf").otherwise("docx")
    native = F.when(n > 1, F.col("report_text")).otherwise("")
    scanned = F.when(n == 1, F.concat(F.lit("scanned page "), text.strip(F.col("report_text"))))
    rows = t.reports.withColumn("r", ops.extraction_status(
        kind, native, scanned, F.when(n == 2, F.lit("bad file")).otherwise(none)))
    return ops.status_tally(rows.select("r.status"))
