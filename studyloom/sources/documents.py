"""Document maps, site summaries, tables and text extraction jobs."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from studyloom.functions import text
from studyloom.operators import reports
from studyloom.schemas import require_columns
from studyloom.session import durable
from studyloom.sources.files import plain_path
from studyloom.sources.json_items import read_items

# Where a site keeps its results.
SUMMARY_FILE = "S2_concatenated_summaries/S2_patient_summary.json"
DOCUMENTS_FILE = "S1_indexed_metadata/S1_indexingFiles_allDocuments.json"

SUMMARY_SCHEMA = ("patient_id string, patient_name string, study_date string, "
                  "patient_age string, study_modality string, study_body_part string, "
                  "institution_name string, source_file string, ct_objects_count bigint, "
                  "dicom_folder_path string")
REPORT_SCHEMA = "array<struct<file_path:string,report_text:string>>"


def _parsed_items(items: DataFrame, value: Column) -> DataFrame:
    """Items of well-formed files with their parsed `value`, an array; null is malformed.

    A file with one malformed item, or a comma that nothing follows, has no items at all. The parsed
    items are written out, as the files are known only when all are parsed.
    """
    parsed = durable(items.select("file", "kind", "item", value.alias("rows"),
                                  (text.strip(F.col("value")) == "").alias("blank")))
    broken = parsed.groupBy("file").agg(
        F.bool_or(F.col("rows").isNull()).alias("_bad"), F.bool_or("blank").alias("_blank"),
        F.count(F.lit(1)).alias("_n")).where("_bad or (_blank and _n > 1)").select("file")
    return parsed.join(broken, "file", "left_anti")


def read_document_maps(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """(file_path, report_text, source_json_file) from JSON maps or lists of documents.

    A file is read in splits by many tasks, whatever its size. Any other shape and broken JSON give no
    rows. A path that a map names twice gives two rows.
    """
    items, _ = read_items(spark, paths)
    entries = F.transform(
        F.map_entries(F.from_json(F.concat(F.lit("{"), "value", F.lit("}")), "map<string,string>")),
        lambda e: F.struct(e["key"].alias("file_path"), e["value"].alias("report_text")))
    listed = F.from_json(F.concat(F.lit("["), "value", F.lit("]")), REPORT_SCHEMA)
    rows = _parsed_items(items, F.when(F.col("kind") == "{", entries).otherwise(listed))
    return rows.select(F.inline("rows"), F.col("file").alias("source_json_file"))


def read_site_documents(spark: SparkSession, root: str) -> DataFrame:
    """Flagged reports of all sites below `root`, with the site folder."""
    rows = read_document_maps(spark, f"{root.rstrip('/')}/*/{DOCUMENTS_FILE}")
    site = F.element_at(F.split("source_json_file", "/"), -3)
    return reports.flag_reports(rows.withColumn("source_processed_dir", site))


def read_site_summaries(spark: SparkSession, paths: str | Sequence[str]) -> DataFrame:
    """Study summaries of several sites with `source_folder` and `position` in the site.

    `paths` is a root holding site folders, or a list of site folders. A site's summary is one
    file with a JSON list, or a folder of JSON lines as `stores.write_site_summary` writes it; both
    are read in splits. `position` orders the rows of a site as they are written: by part, split and
    row in the split, or by place in the list. A file that is no list, or a line that is no object,
    gives a row with `load_error`.
    """
    targets = ([f"{paths.rstrip('/')}/*/{SUMMARY_FILE}"] if isinstance(paths, str)
               else [f"{p.rstrip('/')}/{SUMMARY_FILE}" for p in paths])

    def site(path: Column) -> Column:
        return F.regexp_extract(path, f"([^/]+)/{SUMMARY_FILE}", 1).alias("source_folder")

    def place(part: Column, block: Column, row: Column) -> Column:
        return F.struct(part.alias("part"), block.cast("long").alias("block"),
                        row.cast("long").alias("row")).alias("position")

    record = f"struct<{_inner(SUMMARY_SCHEMA)}>"
    items, no_lists = read_items(spark, targets, SUMMARY_FILE.rpartition("/")[2])
    listed = _parsed_items(items, F.when(F.col("kind") == "[", F.from_json(
        F.concat(F.lit("["), "value", F.lit("]")), f"array<{record}>")))
    from_lists = listed.select(
        site(F.col("file")), place(F.lit(""), F.lit(0), F.col("item")),
        F.explode("rows").alias("_r"))
    wrong = (items.select("file").distinct().join(listed.select("file").distinct(), "file",
                                                  "left_anti").unionByName(no_lists))
    lines = (spark.read.option("pathGlobFilter", "part-*").text(targets)
             .select("value", site(plain_path(F.col("_metadata.file_path"))),
                     place(F.col("_metadata.file_name"), F.col("_metadata.file_block_start"),
                           F.monotonically_increasing_id() % (1 << 33)))
             .filter(text.strip(F.col("value")) != ""))
    is_object = (F.try_parse_json("value").isNotNull()
                 & text.strip(F.col("value")).startswith("{"))
    from_lines = lines.filter(is_object).select(
        "source_folder", "position", F.from_json("value", record).alias("_r"))
    good = from_lists.unionByName(from_lines).select(
        "_r.*", "source_folder", "position", F.lit(None).cast("string").alias("load_error"))

    def bad(rows: DataFrame, message: str) -> DataFrame:
        return rows.select("source_folder", F.lit(message).alias("load_error"))

    return good.unionByName(
        bad(wrong.select(site(F.col("file"))), "not a JSON list").unionByName(
            bad(lines.filter(~is_object), "not a JSON object")), allowMissingColumns=True)


def _inner(ddl: str) -> str:
    return ",".join(":".join(part.split()) for part in ddl.split(", "))


def site_status(summaries: DataFrame) -> DataFrame:
    """Per site: number of studies, error flag and message."""
    return summaries.groupBy("source_folder").agg(
        F.count_if(F.col("load_error").isNull()).alias("patient_count"),
        F.bool_or(F.col("load_error").isNotNull()).alias("has_error"),
        F.coalesce(F.max("load_error"), F.lit("")).alias("error_message"))


def read_sheet(spark: SparkSession, path: str, required: Sequence[str],
               optional: Sequence[str] = ()) -> DataFrame:
    """CSV or Parquet table with required and optional columns; CSV values stay text."""
    if path.rstrip("/").endswith(".parquet"):
        table = spark.read.parquet(path)
    else:
        table = spark.read.option("header", "true").option("multiLine", "true").option(
            "escape", '"').csv(path)
    return require_columns(table, required, optional)


# An extractor takes file bytes and returns (native text, text read from images).
Extractor = Callable[[bytes], tuple[str | None, str | None]]
EXTRACT_SCHEMA = "path string, extracted string, recognised string, error string, pages int"


def plain_text(content: bytes) -> tuple[str | None, str | None]:
    return content.decode("utf-8", errors="replace"), None


def extract_texts(files: DataFrame, extractors: dict[str, Extractor]) -> DataFrame:
    """Text, status and method of every document file.

    `files(path, content)` as read by the `binaryFile` source; `extractors` maps a file
    type (pdf, docx, doc, image) to a function. A type without one is unsupported.
    """
    known = dict(extractors)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for path, kind, content in zip(batch["path"], batch["kind"], batch["content"]):
                native = recognised = error = None
                if kind in known:
                    try:
                        native, recognised = known[kind](content)
                    except Exception as problem:  # any reader failure is a row, not a lost job
                        error = f"{type(problem).__name__}: {problem}"
                rows.append({"path": path, "extracted": native, "recognised": recognised,
                             "error": error, "pages": None})
            yield pd.DataFrame(rows, columns=["path", "extracted", "recognised", "error",
                                              "pages"])

    kind = reports.file_type(F.col("path"))
    source = files.select(plain_path(F.col("path")).alias("path"), kind.alias("kind"), "content")
    supported = F.when(reports.file_type(F.col("path")).isin(list(known)),
                       reports.file_type(F.col("path")))
    done = source.mapInPandas(run, EXTRACT_SCHEMA)
    return done.withColumn("_r", reports.extraction_status(
        supported, F.col("extracted"), F.col("recognised"), F.col("error"))) \
        .select("path", text.base_name(F.col("path")).alias("filename"), "_r.*")


ANSWER_SCHEMA = "content string, reasoning string, call_error string"
Caller = Callable[[str], tuple[str | None, str | None]]


def call_model(documents: DataFrame, call: Callable[[], Caller], body: str = "text",
               delay: float = 0.0) -> DataFrame:
    """One request per document; `call()` makes a client once per task.

    Adds content, reasoning and call_error. Documents that are too short are not sent.
    """
    import time

    names = documents.columns

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        client = call()
        for batch in batches:
            answers = []
            for document in batch[body]:
                if document is None or len(document.strip()) < 10:
                    answers.append((None, None, "empty_document"))
                    continue
                try:
                    content, reasoning = client(document)
                    answers.append((content, reasoning, None))
                except Exception as problem:  # recorded per document, tried again next run
                    answers.append((None, None, f"api_exception: {problem}"))
                if delay:
                    time.sleep(delay)
            extra = pd.DataFrame(answers, columns=["content", "reasoning", "call_error"],
                                 index=batch.index)
            yield pd.concat([batch, extra], axis=1)

    fields = ", ".join(f"`{n}` {documents.schema[n].dataType.simpleString()}" for n in names)
    return documents.mapInPandas(run, f"{fields}, {ANSWER_SCHEMA}")
