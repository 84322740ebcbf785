"""The stages in their usual order, each from tables to tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, functions as F

from studyloom.functions import labels, text
from studyloom.operators import consolidate, mapping, reports, series, studies
from studyloom.schemas import SLICE_FIELDS
from studyloom.session import durable
from studyloom.sources import documents, files


@dataclass
class Indexed:
    """Result of indexing one location."""

    records: DataFrame
    summary: DataFrame
    filters: DataFrame
    kept: DataFrame
    statistics: DataFrame


def index_and_filter(spark: SparkSession, folder: str | Sequence[str], min_files: int = 10,
                     skip: Sequence[str] = files.SKIP_FILES) -> Indexed:
    """Record files of one or several locations to study summary and to the studies that pass.

    A study is (source_folder, source_file). The parsed records are written once; everything
    after groups by study. The summary names the project of each study's location.
    """
    study = files.STUDY_KEY
    locations = [folder] if isinstance(folder, str) else list(folder)
    raw = durable(reduce(DataFrame.unionByName, [
        files.read_records(spark, each, skip=skip) for each in locations]))
    records = files.good_records(raw)
    counts = durable(reduce(DataFrame.unionByName, [
        files.line_counts(spark, each, skip).withColumn(
            "project_name", text.project_name(F.lit(each), F.lit(i)))
        for i, each in enumerate(locations, 1)]))
    first = studies.study_summary(records, study, order=["line_no"]).drop("ct_objects_count")
    summary = counts.join(first, study, "left")
    per_study = counts.select(*study).join(
        studies.dedup_counts(records, study, SLICE_FIELDS), study, "left")
    per_study = per_study.fillna({"original_records": 0, "after_dedup": 0})
    checked = studies.apply_filters(
        per_study, [studies.minimum_files(F.col("after_dedup"), min_files)])
    deduped = studies.exact_dedup(records, study, SLICE_FIELDS)
    kept = studies.filtered_slices(deduped, checked.filter("passed"), study)
    return Indexed(records, summary, checked, kept, studies.filter_statistics(checked))


def consolidate_sites(spark: SparkSession, root: str | Sequence[str]) -> DataFrame:
    """Study summaries of all sites to the consolidated table."""
    summaries = documents.read_site_summaries(spark, root)
    good = summaries.filter(F.col("load_error").isNull()).drop("load_error")
    return consolidate.consolidate(durable(consolidate.number_studies(good)))


def label_and_map(consolidated: DataFrame, hospitals: DataFrame, old: DataFrame) -> DataFrame:
    """Hospital labels, then the merge with the old database."""
    gaps = durable(mapping.mapping_gaps(consolidated, hospitals))
    if found := gaps.count():
        raise ValueError(f"hospital map is incomplete: {found} gaps, listed in "
                         f"{gaps.inputFiles()[0].rpartition('/')[0]}")
    labelled = mapping.apply_hospitals(consolidated, hospitals).withColumnRenamed(
        "Hospital", "hospital")
    new = labelled.withColumn("new_id", F.col("unique_number"))
    return mapping.merged_table(mapping.match_databases(new, old))


def label_series(slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Series analysis with labels."""
    return labels.label_series(series.series_analysis(slices, keys))


def extract_site_reports(spark: SparkSession, root: str) -> DataFrame:
    """Flagged reports of all sites with their extracted fields."""
    flagged = documents.read_site_documents(spark, root)
    return reports.extract_reports(flagged, body="report_text")
