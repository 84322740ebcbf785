"""Runs that report on themselves: figures from the pass that writes the result, and progress.

`observe` collects a run's figures while its rows are written, so no second job counts them, and
Spark's status tracker says how far the jobs of a run have come.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from typing import Any

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F

from studyloom.operators import reports
from studyloom.sinks.stores import write_json

#: Called with tasks done, tasks known so far and a line of text.
Progress = Callable[[int, int, str], None]


def _tasks(spark: SparkSession, group: str) -> tuple[int, int]:
    """(done, known) tasks of the jobs of a group."""
    tracker = spark.sparkContext.statusTracker()
    done = known = 0
    for job in tracker.getJobIdsForGroup(group):
        info = tracker.getJobInfo(job)
        for stage in info.stageIds if info else ():
            state = tracker.getStageInfo(stage)
            if state is not None:
                done, known = done + state.numCompletedTasks, known + state.numTasks
    return done, known


@contextmanager
def reporting(spark: SparkSession, name: str, progress: Progress | None,
              every: float = 1.0) -> Iterator[None]:
    """Report the jobs that this thread starts inside the block, about once a second and at the end."""
    if progress is None:
        yield
        return
    group, over = f"{name}-{uuid.uuid4().hex[:8]}", threading.Event()
    before = spark.sparkContext.getLocalProperty("spark.jobGroup.id")
    spark.sparkContext.setJobGroup(group, name)

    def watch() -> None:
        while not over.wait(every):
            progress(*_tasks(spark, group), f"{name}: running")

    watcher = threading.Thread(target=watch, daemon=True)
    watcher.start()
    ended = "failed"
    try:
        yield
        ended = "done"
    finally:
        over.set()
        watcher.join()
        progress(*_tasks(spark, group), f"{name}: {ended}")
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", before)


def observed_write(df: DataFrame, write: Callable[[DataFrame], None], figures: list[Column],
                   name: str = "run", progress: Progress | None = None) -> dict[str, Any]:
    """Write `df` and return its figures and `seconds`, from one pass over its rows.

    `write` starts the job that reads all of the data frame it is given once.
    """
    seen = Observation(f"{name}-{uuid.uuid4().hex[:8]}")
    started = time.monotonic()
    with reporting(df.sparkSession, name, progress):
        write(df.observe(seen, *figures))
    return {**seen.get, "seconds": time.monotonic() - started}


def write_run_document(spark: SparkSession, figures: dict[str, Any], parameters: dict[str, str],
                       path: str) -> None:
    """One-row document of a run: time, parameters and figures."""
    given = F.create_map(*[F.lit(v) for pair in parameters.items() for v in pair]) \
        if parameters else F.create_map().cast("map<string,string>")
    row = spark.range(1).select(
        F.current_timestamp().alias("processing_timestamp"), given.alias("parameters"),
        F.struct(*[F.lit(v).alias(k) for k, v in figures.items()]).alias("summary"))
    write_json(row, path)


def file_details(checked: DataFrame, skipped: Column | None = None, error: Column | None = None,
                 name: str = "source_file", prefix: str = "S3_processForStore_") -> DataFrame:
    """What a filter run did with each study file, from the table of `apply_filters`.

    Status is SKIPPED, ERROR, PASSED or FAILED; only a passed file has an output file and final records.
    """
    skip = skipped if skipped is not None else F.lit(False)
    broken = error.isNotNull() if error is not None else F.lit(False)
    status = (F.when(skip, "SKIPPED").when(broken, "ERROR").when(F.col("passed"), "PASSED")
              .otherwise("FAILED"))
    rows = checked.withColumns({"status": status, "error": error if error is not None
                                else F.lit(None).cast("string")})
    seen, passed = F.col("status").isin("PASSED", "FAILED"), F.col("status") == "PASSED"
    return rows.select(
        *[c for c in ("source_folder", name) if c in checked.columns], "status",
        *[F.when(seen, F.col(c)).alias(c) for c in ("original_records", "after_dedup")],
        F.when(passed, F.col("after_dedup")).alias("final_records"),
        F.when(passed, F.concat(F.lit(prefix), F.col(name))).alias("output_file"),
        F.when(seen, F.col("filter_results")).alias("filter_results"), "error")


def detail_figures() -> list[Column]:
    """Totals of `file_details`, as `studies.filter_statistics` has them."""
    status = F.col("status")

    def total(column: str, where: Column) -> Column:
        return F.coalesce(F.sum(F.when(where, F.col(column))), F.lit(0))

    return [
        F.count(F.lit(1)).alias("total_files_found"),
        F.count_if(status == "SKIPPED").alias("files_skipped"),
        F.count_if(status.isin("PASSED", "FAILED")).alias("files_processed"),
        F.count_if(status == "PASSED").alias("files_passed_filters"),
        F.count_if(status.isin("FAILED", "ERROR")).alias("files_failed_filters"),
        total("original_records", status.isin("PASSED", "FAILED")).alias("total_records_original"),
        total("after_dedup", status.isin("PASSED", "FAILED")).alias("total_records_after_dedup"),
        total("final_records", status == "PASSED").alias("total_records_final")]


def write_filter_run(checked: DataFrame, folder: str, parameters: dict[str, str],
                     skipped: Column | None = None, error: Column | None = None,
                     progress: Progress | None = None) -> dict[str, Any]:
    """Write `details`, one row per study file, and `document`, one row, below `folder`.

    The totals come from the pass that writes the details. They are returned with the seconds taken.
    """
    base = folder.rstrip("/")
    figures = observed_write(
        file_details(checked, skipped, error), lambda df: write_json(df, f"{base}/details"),
        detail_figures(), "filter studies", progress)
    write_run_document(checked.sparkSession, figures, parameters, f"{base}/document")
    return figures


def write_extraction_run(extracted: DataFrame, folder: str, parameters: dict[str, str],
                         skipped: Column | None = None,
                         progress: Progress | None = None) -> dict[str, Any]:
    """Write the documents of `reports.extract_reports` as `results` and a one-row `document`.

    Totals, success rate and mean seconds per processed document come from the same pass.
    """
    base = folder.rstrip("/")
    figures = observed_write(
        extracted, lambda df: df.write.mode("overwrite").parquet(f"{base}/results"),
        reports.extraction_figures(skipped), "extract reports", progress)
    figures["mean_seconds"] = figures["seconds"] / max(figures["processed_documents"], 1)
    write_run_document(extracted.sparkSession, figures, parameters, f"{base}/document")
    return figures
