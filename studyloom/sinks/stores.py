"""Stores, documents, archives and packages as output."""

from __future__ import annotations

import json
import zipfile
from pathlib import Path

import pandas as pd
from pyspark.sql import DataFrame, functions as F

from studyloom.sources.documents import SUMMARY_FILE, SUMMARY_SCHEMA

from studyloom.operators.skew import match_keys


def with_bucket(df: DataFrame, study: str, buckets: int) -> DataFrame:
    """Hash bucket of the study, so that a store has a fixed number of folders."""
    return df.withColumn("study_bucket", F.pmod(F.xxhash64(study), F.lit(buckets)).cast("int"))


def append_store(slices: DataFrame, path: str, study: str = "source_file",
                 buckets: int = 64, batch: str | None = None) -> None:
    """Add slices to a store with a folder per bucket of studies.

    With a `batch` name the rows are that batch's own, so a repeated run replaces what it wrote before
    instead of doubling it; without one they are added as they are.
    """
    named = with_bucket(slices, study, buckets)
    if batch is None:
        named.write.mode("append").partitionBy("study_bucket").parquet(path)
        return
    (named.withColumn("batch", F.lit(batch)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("batch", "study_bucket").parquet(path))


def overwrite_batch(df: DataFrame, path: str, batch: str, partition: str = "batch") -> None:
    """Write one batch as its own partition; a repeated batch replaces itself."""
    (df.withColumn(partition, F.lit(batch)).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path))


def write_filtered_store(slices: DataFrame, path: str, study: str = "source_file",
                         prefix: str = "S3_processForStore_", buckets: int = 64) -> None:
    named = slices.withColumn("stored_file", F.concat(F.lit(prefix), F.col(study)))
    (with_bucket(named, study, buckets).write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("study_bucket").parquet(path))


def write_json(df: DataFrame, path: str, keep_nulls: bool = True,
               records_per_file: int | None = None) -> None:
    writer = df.write.mode("overwrite").option("ignoreNullFields", str(not keep_nulls).lower())
    if records_per_file:
        writer = writer.option("maxRecordsPerFile", records_per_file)
    writer.json(path)


def write_site_summary(summary: DataFrame, site: str) -> str:
    """A site's study summary as JSON lines where `documents.read_site_summaries` looks for it."""
    path = f"{site.rstrip('/')}/{SUMMARY_FILE}"
    names = [part.split()[0] for part in SUMMARY_SCHEMA.split(", ")]
    write_json(summary.select(*[c for c in names if c in summary.columns]), path)
    return path


def last_wins(chunks: DataFrame, key: str, chunk: str = "chunk") -> DataFrame:
    """Merge chunks in order: the last chunk of a key counts."""
    rest = [c for c in chunks.columns if c not in (key, chunk)]
    last = chunks.groupBy(key).agg(F.max_by(F.struct(*rest), chunk).alias("_last"))
    return last.select(key, *[F.col(f"_last.{c}").alias(c) for c in rest])


def run_document(summary: DataFrame, parameters: dict[str, str]) -> DataFrame:
    """One-row statistics document of a run: time, parameters and summary."""
    given = F.create_map(*[F.lit(v) for pair in parameters.items() for v in pair]) \
        if parameters else F.create_map().cast("map<string,string>")
    return summary.select(
        F.current_timestamp().alias("processing_timestamp"), given.alias("parameters"),
        F.struct(*summary.columns).alias("summary"))


def write_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """One table per report sheet."""
    for name, table in tables.items():
        table.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/{name}")


def consolidation_report(studies: DataFrame, status: DataFrame) -> dict[str, DataFrame]:
    """The sheets of a consolidation: all studies, per-folder statistics, summary."""
    summary = status.agg(F.sum("patient_count").alias("total_patients"),
                         F.count(F.lit(1)).alias("total_folders"))
    return {"All_Patients": studies, "Folder_Statistics": status, "Summary": summary}


ARCHIVE_SCHEMA = ("study string, part int, archive string, n_files bigint, "
                  "original_size bigint, compressed_size bigint, error string")


def write_study_archives(slices: DataFrame, listing: DataFrame, folder: str,
                         study: str = "source_file", part_bytes: int = 1 << 30,
                         part_files: int = 5_000) -> DataFrame:
    """Zip the existing files of every study with a metadata record beside each file.

    A study larger than `part_bytes` or `part_files` becomes several numbered archives,
    so that no task holds more than about that much. Each is written under a temporary
    name and then moved; a task that runs again replaces its own archive. `folder` and
    the files must be on a mount all executors share. Returns one row per archive;
    missing files are counted by `existence_counts`.
    """
    sizes = listing.select(F.col("path").alias("file_path"), "length").distinct()
    found = slices.join(sizes, "file_path")
    parts = found.groupBy(study).agg(F.greatest(
        F.ceil(F.sum("length") / part_bytes), F.ceil(F.count(F.lit(1)) / part_files), F.lit(1))
        .cast("int").alias("_parts"))
    fields = [f.name for f in slices.schema if f.dataType.simpleString() == "string"]
    rows = match_keys(found, parts, [study]).select(
        F.col(study).alias("study"), "file_path", "_parts",
        F.pmod(F.xxhash64("file_path"), F.col("_parts")).cast("int").alias("part"),
        F.to_json(F.struct(*fields)).alias("record"))

    def build(group: pd.DataFrame) -> pd.DataFrame:
        name = Path(str(group["study"].iloc[0])).stem.removeprefix("S3_processForStore_")
        part, parts = int(group["part"].iloc[0]), int(group["_parts"].iloc[0])
        target = Path(folder) / (f"{name}.zip" if parts == 1 else f"{name}_part{part:03d}.zip")
        target.parent.mkdir(parents=True, exist_ok=True)
        temporary = target.with_suffix(".zip.tmp")
        original, stored, error = 0, 0, None
        try:
            with zipfile.ZipFile(temporary, "w", zipfile.ZIP_DEFLATED) as archive:
                for path, record in zip(group["file_path"], group["record"]):
                    source = Path(path)
                    archive.write(source, source.name)
                    archive.writestr(f"{source.stem}_metadata.json", json.dumps(
                        json.loads(record), ensure_ascii=False, indent=2))
                    original += source.stat().st_size
                    stored += 1
            temporary.replace(target)
        except OSError as problem:
            error = str(problem)
        size = target.stat().st_size if error is None else 0
        return pd.DataFrame([{
            "study": group["study"].iloc[0], "part": part, "archive": str(target),
            "n_files": stored, "original_size": original, "compressed_size": size,
            "error": error}])

    return rows.groupBy("study", "part").applyInPandas(build, ARCHIVE_SCHEMA)
