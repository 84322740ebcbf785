"""Slice records to studies: keys, exact dedup, summaries, filters, run statistics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from studyloom.functions import text
from studyloom.operators.skew import match_keys
from studyloom.schemas import SUMMARY_FIELDS


def with_study_key(slices: DataFrame, alias: str = "source_file") -> DataFrame:
    """Add the study a slice belongs to, as a safe file name; equal names merge."""
    key = text.study_key(F.col("study_date"), F.col("patient_id"), F.col("station_name"),
                         F.col("institution_name"))
    return slices.withColumn(alias, text.safe_file_name(key))


def key_columns(study: str | Sequence[str]) -> list[str]:
    """A study's key is one column or several, as (source_folder, source_file)."""
    return [study] if isinstance(study, str) else list(study)


def gathered(slices: DataFrame, study: str | Sequence[str], tasks: int | None) -> DataFrame:
    """Slices with each study in one of `tasks` tasks, for inputs that outgrow the session's number of
    shuffle partitions; what is grouped by study then needs no further exchange."""
    return slices if tasks is None else slices.repartition(tasks, *key_columns(study))


def exact_dedup(slices: DataFrame, study: str | Sequence[str], record: Sequence[str],
                order: str = "line_no", tasks: int | None = None) -> DataFrame:
    """One row per distinct record of a study, keeping the earliest position.

    Without `tasks` the aggregation combines copies before the shuffle, so a record repeated many
    times costs one row per map task.
    """
    by = key_columns(study)
    keys = [*by, *[c for c in record if c not in by]]
    return gathered(slices, study, tasks).groupBy(*keys).agg(F.min(order).alias(order))


def dedup_with_counts(slices: DataFrame, study: str | Sequence[str], record: Sequence[str],
                      order: str = "line_no", tasks: int | None = None) -> DataFrame:
    """`exact_dedup` with the study's `original_records` and `after_dedup` on every row, from one
    exchange of the records."""
    by = key_columns(study)
    keys = [*by, *[c for c in record if c not in by]]
    whole = Window.partitionBy(*by)
    return (
        slices.repartition(*([] if tasks is None else [tasks]), *by)
        .groupBy(*keys).agg(F.min(order).alias(order), F.count(F.lit(1)).alias("_copies"))
        .withColumns({"original_records": F.sum("_copies").over(whole),
                      "after_dedup": F.count(F.lit(1)).over(whole)}).drop("_copies")
    )


def dedup_counts(slices: DataFrame, study: str | Sequence[str], record: Sequence[str],
                 tasks: int | None = None) -> DataFrame:
    """Records per study before and after exact dedup, with the reason text."""
    by = key_columns(study)
    keys = [*by, *[c for c in record if c not in by]]
    counts = (
        gathered(slices, study, tasks).groupBy(*keys).agg(F.count(F.lit(1)).alias("_copies"))
        .groupBy(*by).agg(F.sum("_copies").alias("original_records"),
                          F.count(F.lit(1)).alias("after_dedup"))
    )
    removed = F.col("original_records") - F.col("after_dedup")
    return counts.withColumn("dedup_reason", F.format_string(
        "Removed %d duplicates (%d -> %d)", removed, F.col("original_records"),
        F.col("after_dedup")))


def first_record(fields: Sequence[str], order: Sequence[str]) -> Column:
    """Fields of the earliest row of a group, as a struct."""
    return F.min_by(F.struct(*fields), F.struct(*order))


def study_summary(slices: DataFrame, study: str | Sequence[str] = "source_file",
                  order: Sequence[str] = ("line_no", "file_path"),
                  fields: Sequence[str] = SUMMARY_FIELDS,
                  count: Column | None = None) -> DataFrame:
    """One row per study: fields of its first slice, slice count, folder of that slice."""
    head = [*fields, *[c for c in ("file_path",) if c not in fields]]
    counted = count if count is not None else F.count(F.lit(1))
    by = key_columns(study)
    return (
        slices.groupBy(*by)
        .agg(first_record(head, order).alias("_first"), counted.alias("ct_objects_count"))
        .select(*[F.col(f"_first.{f}").alias(f) for f in fields], *by,
                F.col("ct_objects_count"),
                text.parent_folder(F.col("_first.file_path")).alias("dicom_folder_path"))
    )


def keep_listed_files(summary: DataFrame, listed: DataFrame,
                      study: str | Sequence[str] = "source_file") -> DataFrame:
    """Empty or unreadable study files stay in the summary with null fields and count 0."""
    by = key_columns(study)
    return match_keys(listed.select(*by).distinct(), summary, by).withColumn(
        "ct_objects_count", F.coalesce("ct_objects_count", F.lit(0)))


def summary_totals(summary: DataFrame) -> DataFrame:
    return summary.agg(
        F.count(F.lit(1)).alias("total_records"),
        F.sum("ct_objects_count").alias("total_ct_objects"),
        F.avg("ct_objects_count").alias("mean_ct_objects"),
    )


class StudyFilter:
    """A predicate over one row per study and the reason text to report."""

    def __init__(self, passed: Column, reason: Column):
        self.passed = F.coalesce(passed, F.lit(False))
        self.reason = F.coalesce(reason, F.lit("ERROR"))


def minimum_files(count: Column, minimum: int = 10) -> StudyFilter:
    return StudyFilter(
        count >= minimum,
        F.when(count >= minimum, F.format_string(f"Passed: %d files >= {minimum} minimum", count))
        .otherwise(F.format_string(f"Failed: %d files < {minimum} minimum", count)))


def apply_filters(studies: DataFrame, filters: Sequence[StudyFilter]) -> DataFrame:
    """Run filters in order and stop reporting after the first failure.

    Adds `passed` and `filter_results`. A null predicate counts as a failure.
    """
    first_failed = F.coalesce(
        *[F.when(~f.passed, F.lit(i)) for i, f in enumerate(filters)], F.lit(len(filters)))
    reasons = F.array(*[
        F.concat(F.lit(f"Filter {i + 1}: "), f.reason) for i, f in enumerate(filters)])
    failed = studies.withColumn("_failed", first_failed)
    return (
        failed.withColumn("passed", F.col("_failed") == len(filters))
        .withColumn("filter_results", F.slice(
            reasons, F.lit(1), F.least(F.col("_failed") + 1, F.lit(len(filters)))))
        .drop("_failed")
    )


def filter_statistics(studies: DataFrame, skipped: Column | None = None,
                      error: Column | None = None) -> DataFrame:
    """Totals of one filter run over the per-study table of `apply_filters`."""
    skip = skipped if skipped is not None else F.lit(False)
    broken = error if error is not None else F.lit(False)
    seen = ~skip & ~broken
    kept = seen & F.col("passed")

    def total(name: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(name))), F.lit(0))

    return studies.agg(
        F.count(F.lit(1)).alias("total_files_found"),
        F.count_if(skip).alias("files_skipped"),
        F.count_if(seen).alias("files_processed"),
        F.count_if(kept).alias("files_passed_filters"),
        F.count_if(~skip & ~kept).alias("files_failed_filters"),
        total("original_records", seen).alias("total_records_original"),
        total("after_dedup", seen).alias("total_records_after_dedup"),
        total("after_dedup", kept).alias("total_records_final"),
    )


def filtered_slices(slices: DataFrame, passed: DataFrame,
                    study: str | Sequence[str]) -> DataFrame:
    """Slices of the studies that passed."""
    by = key_columns(study)
    return slices.join(passed.select(*by), by, "left_semi")


def source_counts(df: DataFrame, source: str, alias: str = "patient_count") -> DataFrame:
    """Rows per source and one total row (null source)."""
    return df.rollup(source).agg(F.count(F.lit(1)).alias(alias))


def source_status(rows: DataFrame, sources: DataFrame, source: str) -> DataFrame:
    """Per source: row count, error flag and message; `sources` has one row each."""
    counts = rows.groupBy(source).agg(F.count(F.lit(1)).alias("patient_count"))
    return (
        match_keys(sources, counts, [source])
        .withColumn("patient_count", F.when(F.col("error_message").isNull(),
                                            F.coalesce("patient_count", F.lit(0)))
                    .otherwise(F.lit(0)))
        .withColumn("has_error", F.col("error_message").isNotNull())
        .withColumn("error_message", F.coalesce("error_message", F.lit("")))
    )
