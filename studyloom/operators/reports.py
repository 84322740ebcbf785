"""Report tables: quality flags, statistics, manual-check package, extraction results."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from studyloom.functions import report_fields as fields, text

# The message written for an unread .doc file, and the shortest clean report.
DOC_MESSAGE = "Extraction for .doc is not implemented."
SHORTEST_REPORT = 50
# A token below this confidence is dropped; shorter texts count as empty.
TOKEN_CONFIDENCE = 0.3
SHORTEST_TEXT = 10
# File types the text extraction knows, by extension.
FILE_TYPES = {
    "pdf": ["pdf"],
    "docx": ["docx"],
    "doc": ["doc"],
    "image": ["jpg", "jpeg", "png", "tiff", "tif", "bmp", "gif"],
}


def quality_flag(report: Column) -> Column:
    """`empty`, `too_short` and `.doc`, joined; '' for a clean report."""
    trimmed = text.strip(report)
    return F.concat_ws(
        ", ",
        F.when(text.blank(report), "empty").when(F.length(trimmed) < SHORTEST_REPORT, "too_short"),
        F.when(report.contains(DOC_MESSAGE), ".doc"))


def flag_reports(reports: DataFrame) -> DataFrame:
    return reports.withColumn("need_manual_check", quality_flag(F.col("report_text")))


def report_statistics(flagged: DataFrame) -> DataFrame:
    flag = F.col("need_manual_check")
    total, bad = F.count(F.lit(1)), F.count_if(flag != "")
    return flagged.agg(
        total.alias("total_reports"),
        F.avg(F.coalesce(F.length("report_text"), F.lit(0))).alias("mean_length"),
        bad.alias("total_flagged"),
        F.when(total > 0, bad / total * 100).alias("flagged_percent"),
        F.count_if(flag.contains("empty")).alias("empty"),
        F.count_if(flag.contains("too_short")).alias("too_short"),
        F.count_if(flag.contains(".doc")).alias("doc_not_implemented"),
        (total - bad).alias("clean"))


def needs_check(flagged: DataFrame) -> DataFrame:
    return flagged.filter(~text.blank(F.col("need_manual_check")))


def resolve_paths(rows: DataFrame, listing: DataFrame, drive: str = "D",
                  path: str = "file_path") -> DataFrame:
    """Add `resolved_path` and `reason`: the path on another drive if it exists, else as it is."""
    files = listing.select("path").distinct()
    moved = text.swap_drive(F.col(path), drive)
    on_drive = files.select(F.col("path").alias("_moved_path"))
    as_given = files.select(F.col("path").alias("_given_path"))
    joined = (
        rows.withColumn("modified_path", moved)
        .join(on_drive, F.col("modified_path") == F.col("_moved_path"), "left")
        .join(as_given, F.col(path) == F.col("_given_path"), "left")
    )
    no_path = text.blank(F.col(path))
    found = F.coalesce("_moved_path", "_given_path")
    return joined.withColumns({
        "resolved_path": F.when(~no_path, found),
        "reason": F.when(no_path, "Empty file path").when(found.isNull(), "File not found"),
    }).drop("_moved_path", "_given_path")


def manual_package(flagged: DataFrame, listing: DataFrame, position: str,
                   drive: str = "D") -> DataFrame:
    """Rows for manual extraction; `position` is the 0-based row of the unfiltered table."""
    resolved = resolve_paths(needs_check(flagged), listing, drive)
    copied = F.when(F.col("resolved_path").isNotNull(), text.package_file_name(
        F.col(position), F.col("resolved_path"))).otherwise(F.lit(""))
    return resolved.withColumns({
        "_copied_filename": copied,
        "_extraction_status": F.lit(""),
        "_extracted_text": F.lit(""),
    })


def package_failures(package: DataFrame, position: str) -> DataFrame:
    return package.filter(F.col("reason").isNotNull()).select(
        F.col(position).alias("row_index"), F.col("file_path").alias("original_path"),
        "modified_path", "reason")


def package_totals(package: DataFrame) -> DataFrame:
    return package.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("reason").isNull()).alias("files_copied"),
        F.count_if(F.col("reason").isNotNull()).alias("files_failed"))


def write_back(package: DataFrame, results: DataFrame) -> DataFrame:
    """Put extraction results on package rows by file name; rows without one keep theirs."""
    found = results.select(
        F.col("filename").alias("_copied_filename"), F.col("text").alias("_text"),
        F.col("status").alias("_status"), F.col("method").alias("_extraction_method"),
        F.col("confidence").alias("_extraction_confidence"))
    return (
        package.join(found, "_copied_filename", "left")
        .withColumn("_extracted_text", F.coalesce("_text", "_extracted_text"))
        .withColumn("_extraction_status", F.coalesce("_status", "_extraction_status"))
        .drop("_text", "_status")
    )


def assemble_pages(tokens: DataFrame, document: str = "doc_id",
                   threshold: float = TOKEN_CONFIDENCE) -> DataFrame:
    """Recognised tokens to the text of each document, with the mean confidence of kept tokens.

    `tokens(document, page, seq, token, confidence)`; tokens of a page are joined by
    spaces, pages by an empty line. A document is one row, however long.
    """
    keep = F.col("confidence") >= threshold
    pages = tokens.groupBy(document, "page").agg(
        F.array_sort(F.collect_list(F.when(keep, F.struct("seq", "token")))).alias("_tokens"),
        F.count_if(keep).alias("_kept"),
        F.sum(F.when(keep, F.col("confidence"))).alias("_confidence"))
    words = F.array_join(F.transform("_tokens", lambda t: t["token"]), " ")
    whole = pages.withColumn("_text", words).groupBy(document).agg(
        F.array_sort(F.collect_list(F.when(F.col("_kept") > 0, F.struct("page", "_text"))))
        .alias("_pages"),
        F.sum("_kept").alias("_kept"), F.sum("_confidence").alias("_total"),
        F.count(F.lit(1)).alias("_page_count"))
    full = text.strip(F.array_join(F.transform("_pages", lambda p: p["_text"]), "\n\n"))
    return whole.select(
        document, full.alias("text"), F.col("_kept").alias("kept_tokens"),
        F.col("_page_count").alias("page_count"),
        F.when(F.col("_kept") > 0, F.col("_total") / F.col("_kept"))
        .otherwise(F.lit(0.0)).alias("confidence"))


def file_type(path: Column) -> Column:
    extension = text.file_extension(path)
    kinds = None
    for kind, extensions in FILE_TYPES.items():
        kinds = (F.when if kinds is None else kinds.when)(extension.isin(extensions), kind)
    return kinds


def extraction_status(kind: Column, extracted: Column, recognised: Column, error: Column,
                      exists: Column | None = None) -> Column:
    """Struct of text, status, method and error of one text extraction.

    `extracted` is the native text, `recognised` the text read from images (null if
    that was not possible), `error` the exception, with `PermissionError` as prefix
    where access was denied.
    """
    def result(value: Column, status: str, method: str, message: Column) -> Column:
        return F.struct(F.coalesce(value, F.lit("")).alias("text"),
                        F.lit(status).alias("status"), F.lit(method).alias("method"),
                        F.coalesce(message, F.lit("")).alias("error_message"))

    there = exists if exists is not None else F.lit(True)
    native, read = text.strip(extracted), text.strip(recognised)
    long_native = F.coalesce(F.length(native) >= SHORTEST_TEXT, F.lit(False))
    long_read = F.coalesce(F.length(read) >= SHORTEST_TEXT, F.lit(False))
    none = F.lit("")
    return (
        F.when(~there, result(none, "file_not_found", "failed", F.lit("File not found")))
        .when(kind.isNull(), result(none, "unsupported", "failed",
                                    F.lit("Unsupported file type")))
        .when(error.startswith("PermissionError"),
              result(none, "permission_denied", "failed", error))
        .when(error.isNotNull() & (kind == "image"), result(none, "ocr_failed", "failed", error))
        .when(error.isNotNull(), result(none, "corrupted", "failed", error))
        .when((kind == "image") & long_read, result(read, "success", "ocr", none))
        .when(long_native, result(native, "success", "native", none))
        .when(kind.isin("pdf", "image") & recognised.isNull(),
              result(none, "ocr_failed", "failed", F.lit("OCR not available")))
        .when((kind == "pdf") & long_read, result(read, "ocr_fallback", "ocr", none))
        .when(kind.isin("pdf", "image"), result(read, "empty_document", "ocr",
                                                F.lit("OCR extracted very little text")))
        .otherwise(result(native, "empty_document", "native",
                          F.lit("Document contains very little text")))
    )


def html_text(html: Column) -> Column:
    """Visible text of a page."""
    bare = F.regexp_replace(html, r"(?is)<(script|style)[^>]*>.*?</(script|style)>", " ")
    bare = F.regexp_replace(bare, r"(?s)<!--.*?-->", " ")
    bare = F.regexp_replace(bare, r"<[^>]*>", " ")
    for entity, character in [("&nbsp;", " "), ("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'),
                              ("&#39;", "'"), ("&amp;", "&")]:
        bare = F.replace(bare, F.lit(entity), F.lit(character))
    return F.btrim(F.regexp_replace(bare, r"[ \t\r\n]+", " "))


def status_tally(results: DataFrame, status: str = "status") -> DataFrame:
    s = F.col(status)
    good = s.isin("success", "ocr_fallback")
    return results.agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(good).alias("successful"),
        F.count_if(s == "ocr_fallback").alias("ocr_used"),
        F.count_if(s == "empty_document").alias("empty"),
        F.count_if(~good & (s != "empty_document")).alias("failed"))


def extract_reports(documents: DataFrame, body: str = "text", path: str = "file_path") -> DataFrame:
    """Rule extraction of every document: result struct, or error type and message."""
    too_short = (text.blank(F.col(body))
                 | (F.length(text.strip(F.col(body))) < fields.SHORTEST_DOCUMENT))
    read = fields.with_text_extraction(documents.withColumn("_short", too_short), F.col(body),
                                       "extraction_data", ~F.col("_short"))
    return read.withColumns({
        "extraction_successful": F.col("extraction_data").isNotNull(),
        "error_type": F.when(F.col("_short"), "empty_document")
        .when(F.col("extraction_data").isNull(), "parsing_failure"),
        "error_message": F.when(F.col("_short"), fields.SHORT_MESSAGE)
        .when(F.col("extraction_data").isNull(), "No field found"),
        "text_length": F.coalesce(F.length(body), F.lit(0)),
        "file_name": text.base_name(F.col(path)),
        "parent_directory": text.parent_folder(F.col(path)),
    }).drop("_short")


def extraction_failures(extracted: DataFrame, path: str = "file_path") -> DataFrame:
    return extracted.filter(~F.col("extraction_successful")).select(
        path, "error_type", "error_message", "text_length")


def extraction_successes(extracted: DataFrame, path: str = "file_path") -> DataFrame:
    return extracted.filter("extraction_successful").select(
        path, "file_name", "parent_directory", "text_length", "extraction_data")


def extraction_figures(skipped: Column | None = None) -> list[Column]:
    """Totals of an extraction run as aggregates of `extract_reports`."""
    skip = skipped if skipped is not None else F.lit(False)
    good = ~skip & F.col("extraction_successful")
    processed = F.count_if(~skip)
    return [
        F.count(F.lit(1)).alias("total_documents"),
        processed.alias("processed_documents"),
        F.count_if(good).alias("successful_extractions"),
        F.count_if(~skip & ~F.col("extraction_successful")).alias("failed_extractions"),
        F.count_if(skip).alias("skipped_documents"),
        F.count_if(good & (F.col("extraction_data.number_of_studies") == 0))
        .alias("empty_documents"),
        (F.count_if(good) / F.greatest(processed, F.lit(1)) * 100).alias("success_rate")]


def extraction_statistics(extracted: DataFrame, skipped: Column | None = None) -> DataFrame:
    return extracted.agg(*extraction_figures(skipped))
