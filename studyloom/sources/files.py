"""File listings, slice records in JSON lines, archives."""

from __future__ import annotations

import hashlib
import io
import re
import zipfile
from collections.abc import Iterator, Sequence

import pandas as pd
from pyarrow import fs
from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from studyloom.functions import text
from studyloom.schemas import SLICE_SCHEMA, SLICE_TAGS
from studyloom.session import durable

# Files that are never slice records.
SKIP_FILES = [
    "ALL_PATIENTS_inCT.json",
    "ALL_PATIENTS_inCT.jsonl",
    "summary.jsonl",
    "CONCAT_ALL.jsonl",
    "processed_files.jsonl",
    "temp.jsonl",
    "backup.jsonl",
    "test.jsonl",
    "S2_ALL_PATIENTS_inCT.json",
    "S2_ALL_PATIENTS_inCT.xlsx",
]

# The skip lists of the filter stage and of the study archives.
FILTER_SKIP_FILES = [
    "ALL_PATIENTS_inCT.json",
    "ALL_PATIENTS_inCT.jsonl",
    "summary.jsonl",
    "CONCAT_ALL.jsonl",
    "processed_files.jsonl",
    "temp.jsonl",
    "backup.jsonl",
    "test.jsonl",
    "S3_processForStore.json",
]
ARCHIVE_SKIP_FILES = [
    ".DS_Store",
    "Thumbs.db",
    "desktop.ini",
    ".gitkeep",
    "README.md",
    "log.txt",
]

# Bytes of a file that are in memory at a time.
_RANGE = 8 << 20

LISTING_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


def plain_path(c: Column) -> Column:
    """Path without the `file:` scheme."""
    return F.regexp_replace(c, "^file:/+", "/")


def list_files(spark: SparkSession, root: str, glob: str | None = None) -> DataFrame:
    """(path, length, modification_time) of the files below `root` that are not empty.

    Contents are not read; `walk` also finds empty files and folders.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.load(root).select(
        plain_path(F.col("path")).alias("path"), "length",
        F.col("modificationTime").alias("modification_time"))


WALK_SCHEMA = ("folder string, path string, is_folder boolean, length bigint, "
               "modification_time timestamp, error string")


def _scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Entries of each folder, or one row with the error that kept it from being read."""
    columns = ["folder", "path", "is_folder", "length", "modification_time", "error"]
    for batch in batches:
        for folder in batch["folder"]:
            try:
                system, inside = fs.FileSystem.from_uri(folder)
                found = system.get_file_info(fs.FileSelector(inside, recursive=False))
            except OSError as problem:
                yield pd.DataFrame([(folder, None, False, None, None, str(problem))],
                                   columns=columns)
                continue
            for start in range(0, len(found), 10_000):
                yield pd.DataFrame(
                    [(folder, f"{folder.rstrip('/')}/{f.base_name}",
                      f.type == fs.FileType.Directory,
                      None if f.size is None else int(f.size), f.mtime, None)
                     for f in found[start:start + 10_000]], columns=columns)


def walk(spark: SparkSession, root: str) -> DataFrame:
    """All folders and files below `root`, empty files and unreadable folders included.

    One level of the tree per round, its folders spread over the tasks; the number of
    rounds is the depth of the tree. Spark's own file reader leaves out empty files.
    """
    level = spark.createDataFrame([(root.rstrip("/") or "/",)], "folder string")
    levels = []
    while not level.isEmpty():
        entries = durable(level.repartition(spark.sparkContext.defaultParallelism, "folder")
                          .mapInPandas(_scan, WALK_SCHEMA))
        levels.append(entries)
        level = entries.filter("is_folder").select(F.col("path").alias("folder"))
    found = levels[0]
    for more in levels[1:]:
        found = found.unionByName(more)
    return found


def folder_status(walked: DataFrame, root: str) -> DataFrame:
    """One row per folder: key, whether it could be read, and the error."""
    every = walked.filter("is_folder").select(F.col("path").alias("folder")).unionByName(
        walked.select("folder")).distinct()
    failed = walked.filter(F.col("error").isNotNull()).select("folder", "error")
    relative = F.btrim(F.substr("folder", F.lit(len(root.rstrip("/")) + 1)), F.lit("/"))
    return every.join(failed, "folder", "left").select(
        text.folder_key(relative).alias("folder_key"), F.col("folder").alias("path"),
        F.when(F.col("error").isNull(), "files_done").otherwise("error").alias("status"),
        F.coalesce("error", F.lit("")).alias("error"))


# A study file: its folder and its name.
STUDY_KEY = ["source_folder", "source_file"]


def skip_listed(df: DataFrame, skip: Sequence[str], file_name: str = "source_file") -> DataFrame:
    return df.filter(~F.col(file_name).isin(list(skip))) if skip else df


def read_records(spark: SparkSession, folder: str, schema: T.StructType = SLICE_SCHEMA,
                 skip: Sequence[str] = SKIP_FILES, glob: str = "*.jsonl") -> DataFrame:
    """JSON-lines records with folder, file name, line number and a flag for bad lines.

    A study file is (source_folder, source_file): equal names in different folders are
    different studies. Blank lines are dropped. `line_no` grows along the file: split offset, then row
    in the split, so it orders lines without being a plain count.
    """
    lines = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        .text(folder)
        .select("value", F.col("_metadata.file_name").alias("source_file"),
                plain_path(F.col("_metadata.file_path")).alias("record_path"),
                text.parent_folder(plain_path(F.col("_metadata.file_path")))
                .alias("source_folder"),
                F.col("_metadata.file_block_start").alias("_block"),
                (F.monotonically_increasing_id() % (1 << 33)).alias("_row"))
    )
    kept = skip_listed(lines, skip).withColumn("value", text.strip(F.col("value"))).filter(
        F.col("value") != "")
    with_bad = T.StructType([*schema.fields, T.StructField("_bad", T.StringType())])
    parsed = kept.withColumn("_r", F.from_json("value", with_bad, {
        "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}))
    return parsed.select(
        *[F.col(f"_r.{f}").alias(f) for f in schema.names if f not in STUDY_KEY], *STUDY_KEY,
        "record_path",
        F.struct("_block", "_row").alias("line_no"), F.col("_r._bad").alias("bad_line"))


def good_records(records: DataFrame) -> DataFrame:
    return records.filter(F.col("bad_line").isNull()).drop("bad_line")


def bad_line_counts(records: DataFrame) -> DataFrame:
    return records.filter(F.col("bad_line").isNotNull()).groupBy(*STUDY_KEY).agg(
        F.count(F.lit(1)).alias("bad_lines"))


def _pattern(glob: str) -> str:
    """Regular expression of a file name pattern with `*` and `?`."""
    return "^" + re.escape(glob).replace(r"\*", ".*").replace(r"\?", ".") + "$"


def line_counts(spark: SparkSession, folder: str, skip: Sequence[str] = SKIP_FILES,
                glob: str = "*.jsonl") -> DataFrame:
    """All lines per file, blank ones included; a file without lines counts 0."""
    files = walk(spark, folder).filter(~F.col("is_folder")).select(
        text.parent_folder(F.col("path")).alias("source_folder"),
        text.base_name(F.col("path")).alias("source_file")).filter(
        F.col("source_file").rlike(_pattern(glob)))
    lines = (
        spark.read.option("pathGlobFilter", glob).option("recursiveFileLookup", "true")
        .text(folder).groupBy(
            text.parent_folder(plain_path(F.col("_metadata.file_path"))).alias("source_folder"),
            F.col("_metadata.file_name").alias("source_file"))
        .agg(F.count(F.lit(1)).alias("_lines"))
    )
    return skip_listed(files.join(lines, STUDY_KEY, "left").withColumn(
        "ct_objects_count", F.coalesce("_lines", F.lit(0))).drop("_lines"), skip)


def normalise_tags(tagged: DataFrame, tags: str = "tags", path: str = "file_path") -> DataFrame:
    """Raw header values, `map<string, array<string>>`, to slice records.

    A missing tag is `Unknown`. Several values are joined by a backslash, or written
    as a list for orientation and position.
    """
    joined = {"pixel_spacing", "image_type"}
    columns = [F.col(path).alias("file_path")]
    for field, tag in SLICE_TAGS.items():
        values = F.try_element_at(F.col(tags), F.lit(tag))
        many = (F.array_join(values, "\\") if field in joined
                else F.concat(F.lit("["), F.array_join(values, ", "), F.lit("]")))
        single = F.get(values, 0)
        value = F.when(F.size(values) > 1, many).otherwise(single)
        if field in joined:
            value = F.nullif(value, F.lit(""))
        columns.append(F.coalesce(value, F.lit("Unknown")).alias(field))
    return tagged.select(*columns)


def _checksums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """MD5 of local files, read range by range; an unreadable one gets an error instead."""
    for batch in batches:
        for row in batch.itertuples(index=False):
            digest, error = hashlib.md5(), None
            try:
                with open(row.path, "rb") as file:
                    while part := file.read(_RANGE):
                        digest.update(part)
            except OSError as problem:
                error = str(problem)
            yield pd.DataFrame([(row.path, row.size, row.mtime,
                                 None if error else digest.hexdigest(), error)],
                               columns=["path", "size", "mtime", "checksum", "error"])


def _mounted(spark: SparkSession, root: str) -> bool:
    """Whether `root` is a plain path of the machines, not one of a store."""
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return system.getUri().getScheme() == "file"


def file_checksums(found: DataFrame, mounted: bool) -> DataFrame:
    """`found(path, length, modificationTime, content)` of the `binaryFile` source to path, size,
    mtime, MD5 and error.

    Files on a mounted path are read in ranges, at any size. Stores that only Spark opens give
    the whole content as one value, which ends at 2 GiB.
    """
    named = found.select(plain_path(F.col("path")).alias("path"), F.col("length").alias("size"),
                         F.col("modificationTime").alias("mtime"), "content")
    if mounted:
        return named.drop("content").mapInPandas(
            _checksums, "path string, size bigint, mtime timestamp, checksum string, error string")
    return named.select("path", "size", "mtime", F.md5("content").alias("checksum"),
                        F.lit(None).cast("string").alias("error"))


def archive_inventory(spark: SparkSession, root: str, integrity: bool = False) -> DataFrame:
    """Zip archives with target folder, size, time, (only if asked for) MD5, and the error that
    kept an archive from being read for it."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", "true")
             .option("pathGlobFilter", "*.zip").load(root))
    named = file_checksums(found, _mounted(spark, root)) if integrity else found.select(
        plain_path(F.col("path")).alias("path"), F.col("length").alias("size"),
        F.col("modificationTime").alias("mtime"), F.lit("").alias("checksum"),
        F.lit(None).cast("string").alias("error"))
    return named.select("path", F.regexp_replace("path", r"\.zip$", "").alias("extract_path"),
                        "size", "mtime", "checksum", "error")


def disc_image_inventory(spark: SparkSession, root: str) -> DataFrame:
    """Disc images with a flat target name, all pending."""
    found = list_files(spark, root, "*.[iI][sS][oO]")
    return found.select("path", text.flat_archive_name(F.col("path")).alias("flat_name"),
                        F.lit("pending").alias("status"))


ENTRY_SCHEMA = ("archive string, entry string, size bigint, safe boolean, content binary, "
                "error string")


def expand_archives(archives: DataFrame, with_content: bool = False) -> DataFrame:
    """Entries of zip archives, one archive at a time inside a task.

    `archives(path, content)` as read by the `binaryFile` source. An entry that is
    absolute or climbs up is marked unsafe and its bytes are never returned; a broken
    archive gives one row with an error.
    """
    def entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for path, content in zip(batch["path"], batch["content"]):
                try:
                    with zipfile.ZipFile(io.BytesIO(content)) as archive:
                        for item in archive.infolist():
                            safe = not item.filename.startswith("/") and ".." not in item.filename
                            body = archive.read(item) if with_content and safe else None
                            yield pd.DataFrame([{
                                "archive": path, "entry": item.filename, "size": item.file_size,
                                "safe": safe, "content": body, "error": None}])
                except (zipfile.BadZipFile, OSError, RuntimeError) as problem:
                    yield pd.DataFrame([{
                        "archive": path, "entry": None, "size": None, "safe": False,
                        "content": None, "error": str(problem)}])

    source = archives.select(plain_path(F.col("path")).alias("path"), "content")
    return source.mapInPandas(entries, ENTRY_SCHEMA)


def expansion_results(entries: DataFrame) -> DataFrame:
    """Per archive: safe entries, whether it succeeded, and why not."""
    safe = F.col("safe") & F.col("entry").isNotNull()
    counted = entries.groupBy("archive").agg(
        F.count_if(safe).alias("file_count"), F.max("error").alias("_error"))
    return counted.select(
        "archive", "file_count",
        (F.col("_error").isNull() & (F.col("file_count") > 0)).alias("extraction_successful"),
        F.when(F.col("_error").isNotNull(), F.col("_error"))
        .when(F.col("file_count") == 0, "No safe files to extract").alias("error"))
