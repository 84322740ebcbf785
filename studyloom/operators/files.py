"""File listings: kinds, folders, existence, archive totals."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from studyloom.functions import text

# Kinds of files by extension; other files are left out.
KINDS = {
    "dicom": ["dcm", ""],
    "document": ["pdf", "doc", "docx"],
    "image": ["png", "jpg", "jpeg"],
}


def file_kind(path: Column) -> Column:
    extension = text.file_extension(path)
    kinds = None
    for kind, extensions in KINDS.items():
        kinds = (F.when if kinds is None else kinds.when)(extension.isin(extensions), kind)
    return kinds


def classified(listing: DataFrame, root: str = "") -> DataFrame:
    """Files of a known kind with their folder and folder key relative to `root`."""
    folder = text.parent_folder(F.col("path"))
    relative = F.btrim(F.substr(folder, F.lit(len(root.rstrip("/")) + 1)), F.lit("/"))
    return listing.withColumns({
        "kind": file_kind(F.col("path")), "folder": folder,
        "folder_key": text.folder_key(relative),
    }).filter(F.col("kind").isNotNull())


def folder_index(listing: DataFrame, root: str = "") -> DataFrame:
    """One row per folder: files, and files of each kind; folders without any kind stay."""
    folder = text.parent_folder(F.col("path"))
    relative = F.btrim(F.substr(folder, F.lit(len(root.rstrip("/")) + 1)), F.lit("/"))
    kinds = listing.select(text.folder_key(relative).alias("folder_key"),
                           folder.alias("folder"), file_kind(F.col("path")).alias("kind"))
    return kinds.groupBy("folder_key", "folder").agg(
        F.count(F.lit(1)).alias("files"),
        *[F.count_if(F.col("kind") == k).alias(f"{k}_files") for k in KINDS])


def folder_files(listing: DataFrame, root: str = "") -> DataFrame:
    """Files per folder and kind, one row per file whatever the size of a folder."""
    return classified(listing, root).select("folder_key", "kind", "path")


def folder_contents(listing: DataFrame) -> DataFrame:
    """Per folder: all files, `.dcm` files, files without an extension."""
    extension = text.file_extension(F.col("path"))
    return listing.groupBy(text.parent_folder(F.col("path")).alias("folder")).agg(
        F.count(F.lit(1)).alias("total_files"),
        F.count_if(extension == "dcm").alias("dcm_files"),
        F.count_if(~text.base_name(F.col("path")).contains(".")).alias("no_extension_files"))


def valid_records(records: DataFrame, path: str = "file_path") -> DataFrame:
    return records.filter(F.coalesce(F.col(path) != "", F.lit(False)))


def existing_records(records: DataFrame, listing: DataFrame,
                     path: str = "file_path") -> DataFrame:
    files = listing.select(F.col("path").alias(path))
    return valid_records(records, path).join(files, path, "left_semi")


def missing_records(records: DataFrame, listing: DataFrame,
                    path: str = "file_path") -> DataFrame:
    files = listing.select(F.col("path").alias(path))
    return valid_records(records, path).join(files, path, "left_anti")


def existence_counts(records: DataFrame, listing: DataFrame, keys: Sequence[str],
                     path: str = "file_path") -> DataFrame:
    """Per study: records whose file exists, and missing ones."""
    files = listing.select(F.col("path").alias(path)).distinct().withColumn(
        "_there", F.lit(True))
    return valid_records(records, path).join(files, path, "left").groupBy(*keys).agg(
        F.count_if(F.col("_there")).alias("existing"),
        F.count_if(F.col("_there").isNull()).alias("missing"))


def archive_totals(archives: DataFrame) -> DataFrame:
    """Totals over per-study archive results."""
    totals = archives.agg(
        F.count(F.lit(1)).alias("studies"), F.sum("n_files").alias("total_files"),
        F.sum("missing").alias("missing_files"),
        F.sum("original_size").alias("original_size"),
        F.sum("compressed_size").alias("compressed_size"))
    return totals.withColumns({
        "saved_percent": text.saved_ratio(F.col("original_size"), F.col("compressed_size")),
        "original_text": text.human_size(F.col("original_size")),
        "compressed_text": text.human_size(F.col("compressed_size")),
    })


def sample_present(archives: DataFrame, listing: DataFrame, sample: int = 5) -> DataFrame:
    """Archives whose first extracted entries all exist below the target folder."""
    entries = archives.select("path", F.explode(F.slice("extracted_files", 1, sample))
                              .alias("_entry"), "extract_path")
    wanted = entries.select("path", F.concat_ws("/", "extract_path", "_entry").alias("_file"))
    files = listing.select(F.col("path").alias("_file"))
    absent = wanted.join(files, "_file", "left_anti").select("path").distinct()
    return archives.join(absent, "path", "left_anti")


