"""Incremental runs: new files as a stream, ledgers as append-only tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from studyloom.operators import progress
from studyloom.schemas import LEDGER_SCHEMA
from studyloom.session import durable
from studyloom.sinks.stores import overwrite_batch
from studyloom.sources.files import LISTING_SCHEMA, plain_path


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Ledger table, empty before the first run."""
    try:
        return spark.read.schema(LEDGER_SCHEMA).parquet(path)
    except Exception as problem:
        if "PATH_NOT_FOUND" not in str(problem):
            raise
        return spark.createDataFrame([], LEDGER_SCHEMA)


def ledger_entries(results: DataFrame, job: str, key: Column, ok: Column,
                   error: Column | None = None, before: DataFrame | None = None) -> DataFrame:
    """Ledger rows of `results`; with the ledger so far, `before`, attempts are counted on."""
    named = results.withColumn("_key", key.cast("string"))
    attempt = F.lit(1)
    if before is not None:
        tried = before.filter(F.col("job") == job).groupBy(F.col("key").alias("_key")).agg(
            F.max("attempt").alias("_tried"))
        named = named.join(tried, "_key", "left")
        attempt = F.coalesce("_tried", F.lit(0)) + 1
    return named.select(
        F.lit(job).alias("job"), F.col("_key").alias("key"),
        F.when(ok, "ok").otherwise("failed").alias("status"), attempt.alias("attempt"),
        F.current_timestamp().alias("ts"),
        (error if error is not None else F.lit(None)).cast("string").alias("error"))


def append_ledger(entries: DataFrame, path: str) -> None:
    entries.write.mode("append").parquet(path)


def run_pending(work: DataFrame, ledger_path: str, job: str, key: str,
                process: Callable[[DataFrame], DataFrame], output: str,
                retry_failed: bool = True) -> DataFrame:
    """Process what the ledger does not settle, store the results, then note the outcome.

    `process` returns one row per key with `ok` and `error`. Results are written before
    the ledger, under a run name of their own that sorts by time: two runs at once do not
    meet, and of a run that died in between `latest_results` takes the repeated keys from the
    later one. Returns the results of this run.
    """
    spark = work.sparkSession
    ledger = read_ledger(spark, ledger_path).filter(F.col("job") == job)
    run_name = f"{job}-{time.time_ns():020d}-{uuid.uuid4().hex[:8]}"
    todo = progress.pending(work, ledger, key, retry_failed)
    results = durable(process(todo))
    overwrite_batch(results, output, run_name)
    append_ledger(ledger_entries(results, job, F.col(key), F.col("ok"), F.col("error"), ledger),
                  ledger_path)
    return results


def latest_results(results: DataFrame, key: str | Sequence[str],
                   batch: str = "batch") -> DataFrame:
    """One row per key over all runs: that of the last run."""
    keys = [key] if isinstance(key, str) else list(key)
    rest = [c for c in results.columns if c not in (*keys, batch)]
    last = results.groupBy(*keys).agg(F.max_by(F.struct(*rest), batch).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def new_files(spark: SparkSession, root: str, glob: str | None = None,
              with_content: bool = False) -> DataFrame:
    """Stream of files that arrive below `root`."""
    reader = (spark.readStream.format("binaryFile").schema(LISTING_SCHEMA)
              .option("recursiveFileLookup", "true"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    columns = [plain_path(F.col("path")).alias("path"), F.col("length"),
               F.col("modificationTime").alias("modification_time")]
    return reader.load(root).select(*columns, *(["content"] if with_content else []))


def new_lines(spark: SparkSession, root: str, glob: str = "*.jsonl") -> DataFrame:
    """Stream of lines from record files that arrive below `root`."""
    return (spark.readStream.schema("value string").option("pathGlobFilter", glob)
            .option("recursiveFileLookup", "true").text(root)
            .select("value", F.col("_metadata.file_name").alias("source_file")))


def run_available(stream: DataFrame, output: str, checkpoint: str,
                  transform: Callable[[DataFrame], DataFrame] | None = None) -> StreamingQuery:
    """Process what has arrived since the last run and stop.

    Every micro-batch is its own partition of the output, replaced if it is repeated
    after a failure, so no row is written twice.
    """
    def write(batch: DataFrame, number: int) -> None:
        rows = transform(batch) if transform else batch
        overwrite_batch(rows, output, f"{number:012d}")

    query = (stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
             .trigger(availableNow=True).start())
    query.awaitTermination()
    return query


def disc_images_to_extract(images: DataFrame, ledger: DataFrame,
                           retry_failed: bool = True) -> DataFrame:
    """Disc images not yet extracted or skipped; failed ones are tried again by default."""
    return progress.pending(images, ledger, "path", retry_failed)
