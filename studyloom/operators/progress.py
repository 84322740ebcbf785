"""Progress ledger: what is still to do, and how far a run has come.

The ledger is append-only, `(job, key, status, attempt, ts, error)`; the last entry
of a key counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


DONE = ["ok", "completed", "success", "extracted", "skipped"]


def latest(ledger: DataFrame, keys: Sequence[str] = ("job", "key")) -> DataFrame:
    """Last entry of every key."""
    rest = [c for c in ledger.columns if c not in keys]
    order = [c for c in ("ts", "attempt") if c in rest]
    others = [c for c in rest if c not in order]
    last = ledger.groupBy(*keys).agg(F.max(F.struct(*order, *others)).alias("_last"))
    return last.select(*keys, *[F.col(f"_last.{c}").alias(c) for c in rest])


def pending(work: DataFrame, ledger: DataFrame, key: str, retry_failed: bool = True,
            ledger_key: str = "key") -> DataFrame:
    """Work whose last entry does not settle it; failures are tried again by default."""
    keys = [c for c in ("job", ledger_key) if c in ledger.columns]
    last = latest(ledger, keys)
    settled = last.filter(F.col("status").isin(DONE)) if retry_failed else last.filter(
        F.col("status") != "pending")
    return work.join(settled.select(F.col(ledger_key).alias(key)), key, "left_anti")


def track_series(tracker: DataFrame, ledger: DataFrame) -> DataFrame:
    """Put the outcome of processed series on the tracker, by hash.

    Failed series are in the ledger under `Er_<hash>`.
    """
    plain = F.regexp_replace("key", "^Er_", "")
    last = latest(ledger.withColumn("key", plain), ["key"]).filter(F.col("status") != "pending")
    outcome = last.select(
        F.col("key").alias("hash_id"), F.col("status").isin(DONE).alias("_success"),
        F.col("ts").alias("_ts"), F.col("error").alias("_error"))
    joined = tracker.join(outcome, "hash_id", "left")
    done = F.col("_success").isNotNull()
    return joined.withColumns({
        "processing_status": F.when(done, "completed").otherwise(F.col("processing_status")),
        "success": F.coalesce("_success", "success"),
        "processing_timestamp": F.coalesce(F.col("_ts").cast("timestamp"),
                                           "processing_timestamp"),
        "error_message": F.when(F.col("_success"), F.col("error_message"))
        .otherwise(F.coalesce("_error", "error_message")),
    }).drop("_success", "_ts", "_error")


def percent(part: Column, whole: Column) -> Column:
    """Share with one decimal and a percent sign, `0%` of nothing."""
    return F.when(whole > 0, F.format_string("%.1f%%", F.bround(part / whole * 100, 1))) \
        .otherwise(F.lit("0%"))


def tracker_summary(tracker: DataFrame) -> DataFrame:
    done = F.col("processing_status") == "completed"
    total, completed = F.count(F.lit(1)), F.count_if(done)
    good = F.count_if(done & F.col("success"))
    return tracker.agg(
        total.alias("total_series"), (total - completed).alias("pending"),
        good.alias("successful"), (completed - good).alias("failed"),
        percent(completed, total).alias("processing_rate"))


def run_summary(results: DataFrame, success: Column, skipped: Column) -> DataFrame:
    """Processed, successful, failed and already processed items with the success rate."""
    total, good = F.count(F.lit(1)), F.count_if(success)
    return results.agg(
        total.alias("processed"), good.alias("successful"),
        F.count_if(~success).alias("failed"), F.count_if(skipped).alias("already_processed"),
        percent(good, total).alias("success_rate"))


def location_progress(ledger: DataFrame, location: str = "location") -> DataFrame:
    """Completed, failed and pending items per location."""
    status = F.col("status")
    return ledger.groupBy(location).agg(
        F.count_if(status.isin(DONE)).alias("completed"),
        F.count_if(status == "failed").alias("failed"),
        F.count_if(status == "pending").alias("pending"))


def location_status(locations: DataFrame, ledger: DataFrame,
                    location: str = "location") -> DataFrame:
    """Last status of every location; one that never ran is pending."""
    last = latest(ledger, [location]).select(location, "status")
    return locations.join(last, location, "left").withColumn(
        "status", F.coalesce("status", F.lit("pending")))


def locations_to_run(locations: DataFrame, ledger: DataFrame,
                     location: str = "location") -> DataFrame:
    """Every location without a good last run, including one that failed before a good one."""
    return location_status(locations, ledger, location).filter(
        ~F.col("status").isin(DONE)).drop("status")


def latest_done(ledger: DataFrame, n: int = 10) -> DataFrame:
    return ledger.filter(F.col("status").isin(DONE)).orderBy(
        F.desc("ts"), F.desc("key")).limit(n)


def archive_decision(archives: DataFrame, ledger: DataFrame, listing: DataFrame,
                     check_integrity: bool = False, overwrite: bool = False,
                     sample: int = 5) -> DataFrame:
    """Add `decision` to an archive inventory: why each one is done or to be expanded.

    `archives(path, extract_path, mtime[, checksum])`; `ledger(path, mtime, checksum,
    ok, extracted_files)` has the last run of each; `listing(path, folder)` the files
    there are. A failed archive is tried again.
    """
    last = ledger.select(
        "path", F.col("mtime").alias("_mtime"), F.col("checksum").alias("_checksum"),
        F.col("ok").alias("_ok"), F.col("extracted_files").alias("_files"))
    targets = archives.select("extract_path").distinct()
    above = F.transform(F.sequence(F.lit(1), F.size(F.split("folder", "/"))),
                        lambda n: F.array_join(F.slice(F.split("folder", "/"), F.lit(1), n), "/"))
    filled = (
        listing.select(F.explode(above).alias("extract_path"))
        .join(targets, "extract_path", "left_semi").distinct().withColumn("_filled", F.lit(True))
    )
    entries = archives.join(last, "path").select(
        "path", F.explode(F.slice("_files", 1, sample)).alias("_entry"), "extract_path")
    files = listing.select(F.col("path").alias("_file"))
    gone = (
        entries.withColumn("_file", F.concat_ws("/", "extract_path", "_entry"))
        .join(files, "_file", "left_anti").select("path").distinct()
        .withColumn("_gone", F.lit(True))
    )
    joined = (archives.join(last, "path", "left").join(filled, "extract_path", "left")
              .join(gone, "path", "left"))
    changed = F.lit(False)
    if check_integrity:
        changed = F.coalesce((F.col("_checksum") != "") & (F.col("_checksum")
                                                          != F.col("checksum")), F.lit(False))
    decision = (
        F.when(F.lit(overwrite), "expand: overwrite")
        .when(F.col("_ok").isNull(),
              F.when(F.col("_filled"), "done: target has files").otherwise("expand: new"))
        .when(F.col("_filled").isNull(), "expand: target missing")
        .when(F.col("_mtime") < F.col("mtime"), "expand: archive changed")
        .when(~F.col("_ok"), "expand: last run failed")
        .when(changed, "expand: checksum differs")
        .when(F.col("_gone"), "expand: extracted file missing")
        .otherwise("done: recorded"))
    return joined.withColumn("decision", decision).drop(
        "_mtime", "_checksum", "_ok", "_files", "_filled", "_gone")


def studies_to_archive(studies: DataFrame, ledger: DataFrame, archives: DataFrame,
                       key: str = "study") -> DataFrame:
    """Studies whose archive is not done: completed in the ledger, present and readable.

    `archives(study, readable)` lists the archives there are, one row per part, and may name the
    number of parts a study should have in `parts`: one unreadable or missing part undoes the study.
    Failures are tried again.
    """
    completed = latest(ledger, ["key"]).filter(F.col("status").isin(DONE)).select(
        F.col("key").alias(key))
    whole = F.bool_and(F.coalesce("readable", F.lit(False)))
    if "parts" in archives.columns:
        whole = whole & (F.count(F.lit(1)) >= F.coalesce(F.max("parts"), F.lit(1)))
    present = archives.groupBy(key).agg(whole.alias("_whole")).filter("_whole").select(key)
    return studies.join(completed.join(present, key, "left_semi"), key, "left_anti")


def series_outputs(listing: DataFrame) -> DataFrame:
    """Hashes of series folders that hold an image, the public and the protected document.

    The folder is named by the hash, or `Er_` and the hash; `listing(path)` has the files.
    """
    folder = F.element_at(F.split("path", "/"), -2)
    name = F.element_at(F.split("path", "/"), -1)
    found = listing.select(folder.alias("_folder"), name.alias("_name")).groupBy("_folder").agg(
        F.bool_or(F.col("_name").rlike(r"\.nii(\.gz)?$")).alias("_image"),
        F.bool_or(F.col("_name") == F.concat("_folder", F.lit(".json"))).alias("_public"),
        F.bool_or(F.col("_name") == F.concat(F.lit("PATIENT_DATA_"), "_folder", F.lit(".zip")))
        .alias("_protected"))
    return found.filter("_image and _public and _protected").select(
        F.regexp_replace("_folder", "^Er_", "").alias("hash_id")).distinct()


def series_to_convert(tracker: DataFrame, ledger: DataFrame, listing: DataFrame) -> DataFrame:
    """Series neither in the ledger nor with all their output files.

    A failed series is in the ledger under `Er_<hash>`, so it is tried again.
    """
    noted = ledger.filter(F.col("status") != "pending").select(F.col("key").alias("hash_id"))
    return tracker.join(noted, "hash_id", "left_anti").join(
        series_outputs(listing), "hash_id", "left_anti")
