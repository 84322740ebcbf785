import hashlib
import io
import json
import zipfile

import pandas as pd
import pytest
from pyspark.sql import functions as F

from studyloom.operators import files as file_ops, progress, studies
from studyloom.plans import stages
from studyloom.schemas import SLICE_FIELDS, require_columns
from studyloom.sinks import stores
from studyloom.sources import documents, files


def zipped(entries):
    buffer = io.BytesIO()
    with zipfile.ZipFile(buffer, "w") as archive:
        for name, content in entries.items():
            archive.writestr(name, content)
    return buffer.getvalue()


def record(**values):
    return {f: values.get(f, "Unknown") for f in SLICE_FIELDS}


@pytest.fixture
def site(tmp_path):
    """Record files of one location: good, with bad lines, empty, and one to skip."""
    folder = tmp_path / "records"
    folder.mkdir()
    good = [record(file_path=f"/a/{i}.dcm", patient_id="P1") for i in range(4)]
    lines = [json.dumps(r) for r in [*good, good[0]]]
    (folder / "good.jsonl").write_text("\n".join(lines) + "\n\n")
    (folder / "bad.jsonl").write_text(json.dumps(good[1]) + "\n{broken\n")
    (folder / "empty.jsonl").write_text("")
    (folder / "summary.jsonl").write_text(json.dumps(good[0]))
    return folder


def test_listing_reads_no_content_and_finds_kinds(spark, tmp_path):
    for name in ("a/x.dcm", "a/noext", "a/r.PDF", "b/p.jpg", "b/other.txt"):
        target = tmp_path / name
        target.parent.mkdir(exist_ok=True)
        target.write_text("12345")
    listing = files.list_files(spark, str(tmp_path))
    plan = listing._jdf.queryExecution().executedPlan().toString()
    assert "content" not in plan.split("ReadSchema")[-1]
    kinds = {r.path.rsplit("/", 1)[1]: r.kind for r in file_ops.classified(
        listing, str(tmp_path)).collect()}
    assert kinds == {"x.dcm": "dicom", "noext": "dicom", "r.PDF": "document", "p.jpg": "image"}
    index = {r.folder_key: r for r in file_ops.folder_index(listing, str(tmp_path)).collect()}
    assert index["a"].dicom_files == 2 and index["b"].files == 2
    contents = {r.folder.rsplit("/", 1)[1]: r for r in
                file_ops.folder_contents(listing).collect()}
    assert (contents["a"].dcm_files, contents["a"].no_extension_files) == (1, 1)


def test_walk_finds_empty_files_and_folders(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "zero.dcm").write_text("")
    (tmp_path / "top.pdf").write_text("x")
    walked = files.walk(spark, str(tmp_path))
    found = {r.path[len(str(tmp_path)):]: r.length for r in walked.filter("not is_folder").collect()}
    assert found == {"/a/zero.dcm": 0, "/top.pdf": 1}
    status = {r.folder_key: r.status for r in files.folder_status(walked, str(tmp_path)).collect()}
    assert status == {".": "files_done", "a": "files_done", "a_._b": "files_done"}
    gone = files.walk(spark, str(tmp_path / "gone")).first()
    assert gone.error


def test_records_keep_order_and_report_bad_lines(spark, site):
    records = files.read_records(spark, str(site))
    assert records.filter("source_file = 'summary.jsonl'").isEmpty()
    good = files.good_records(records)
    first = studies.study_summary(good.filter("source_file = 'good.jsonl'"), order=["line_no"])
    assert first.first().dicom_folder_path == "/a"
    assert tuple(files.bad_line_counts(records).first())[1:] == ("bad.jsonl", 1)
    counts = {r.source_file: r.ct_objects_count for r in
              files.line_counts(spark, str(site)).collect()}
    assert counts == {"good.jsonl": 6, "bad.jsonl": 2, "empty.jsonl": 0}


def test_records_to_consolidated_table_over_two_sites(spark, tmp_path):
    for site, patients in (("one", ["P0001", "P0002"]), ("two", ["P0001"])):
        folder = tmp_path / "records" / site
        folder.mkdir(parents=True)
        for patient in patients:
            (folder / f"{patient}.jsonl").write_text("".join(json.dumps({
                "file_path": f"/{site}/{patient}/{k}.dcm", "patient_id": patient,
                "study_date": "20200101", "study_modality": "CT"}) + "\n" for k in range(3)))
        done = stages.index_and_filter(spark, str(folder), min_files=2)
        stores.write_site_summary(done.summary, str(tmp_path / "processed" / site))
    broken = tmp_path / "processed" / "three" / documents.SUMMARY_FILE
    broken.parent.mkdir(parents=True)
    broken.write_text("{not json")
    table = stages.consolidate_sites(spark, str(tmp_path / "processed"))
    got = sorted((r.source_folder, r.patient_id, r.ct_objects_count, r.is_duplicate)
                 for r in table.collect())
    assert got == [("one", "P0001", 3, "first_occurrence"), ("one", "P0002", 3, "unique"),
                   ("two", "P0001", 3, "duplicate")]
    status = {r.source_folder: (r.patient_count, r.has_error) for r in documents.site_status(
        documents.read_site_summaries(spark, str(tmp_path / "processed"))).collect()}
    assert status == {"one": (2, False), "two": (1, False), "three": (0, True)}


def test_equal_file_names_are_different_studies(spark, tmp_path):
    for name, patient, n in (("a", "P1", 2), ("b", "P2", 3)):
        (tmp_path / name).mkdir()
        (tmp_path / name / "s.jsonl").write_text("".join(
            json.dumps({"file_path": f"/{name}/{k}.dcm", "patient_id": patient}) + "\n"
            for k in range(n)))
    for where in (str(tmp_path), [str(tmp_path / "a"), str(tmp_path / "b")]):
        done = stages.index_and_filter(spark, where, min_files=3)
        got = {(r.source_folder.rpartition("/")[2], r.source_file): (
            r.patient_id, r.ct_objects_count) for r in done.summary.collect()}
        assert got == {("a", "s.jsonl"): ("P1", 2), ("b", "s.jsonl"): ("P2", 3)}
        assert {(r.source_folder.rpartition("/")[2], r.passed)
                for r in done.filters.collect()} == {("a", False), ("b", True)}
        assert {r.patient_id for r in done.kept.collect()} == {"P2"}
    assert {r.project_name.rpartition("_._")[2] for r in done.summary.collect()} == {"a", "b"}


def test_index_and_filter_end_to_end(spark, site):
    done = stages.index_and_filter(spark, str(site), min_files=3)
    summary = {r.source_file: r for r in done.summary.collect()}
    assert summary["empty.jsonl"].ct_objects_count == 0 and summary["empty.jsonl"].patient_id is None
    assert summary["good.jsonl"].patient_id == "P1"
    checked = {r.source_file: r for r in done.filters.collect()}
    assert checked["good.jsonl"].passed and checked["good.jsonl"].after_dedup == 4
    assert checked["bad.jsonl"].filter_results == ["Filter 1: Failed: 1 files < 3 minimum"]
    assert done.kept.count() == 4
    again = studies.exact_dedup(done.kept, "source_file", SLICE_FIELDS)
    assert again.count() == 4
    totals = done.statistics.first()
    assert (totals.total_files_found, totals.files_passed_filters, totals.files_failed_filters,
            totals.total_records_original, totals.total_records_final) == (3, 1, 2, 6, 4)


def test_document_maps_of_all_shapes(spark, tmp_path):
    (tmp_path / "map.json").write_text(json.dumps({"/a.pdf": "x" * 60, "/b.doc":
                                                   "Extraction for .doc is not implemented."}))
    (tmp_path / "list.json").write_text(json.dumps([{"file_path": "/c.pdf", "report_text": ""}]))
    (tmp_path / "number.json").write_text("3")
    (tmp_path / "broken.json").write_text("{oops")
    rows = documents.read_document_maps(spark, str(tmp_path / "*.json"))
    assert {r.file_path for r in rows.collect() if r.file_path} == {"/a.pdf", "/b.doc", "/c.pdf"}


def test_site_documents_and_summaries(spark, tmp_path):
    for name, text in (("one", "short"), ("two", "PATIENT NAME: A\nCT chest " + "x" * 60)):
        target = tmp_path / name / "S1_indexed_metadata"
        target.mkdir(parents=True)
        (target / "S1_indexingFiles_allDocuments.json").write_text(json.dumps({f"/{name}.pdf": text}))
        target = tmp_path / name / "S2_concatenated_summaries"
        target.mkdir(parents=True)
        rows = [{"patient_id": "P0001", "study_date": "2020010" + str(i), "study_modality": "CT",
                 "ct_objects_count": 3} for i in (1, 2)]
        (target / "S2_patient_summary.json").write_text(json.dumps(rows))
    broken = tmp_path / "zzz" / "S2_concatenated_summaries"
    broken.mkdir(parents=True)
    (broken / "S2_patient_summary.json").write_text("[{")
    flagged = {r.source_processed_dir: r.need_manual_check for r in
               documents.read_site_documents(spark, str(tmp_path)).collect()}
    assert flagged == {"one": "too_short", "two": ""}
    summaries = documents.read_site_summaries(spark, str(tmp_path))
    status = {r.source_folder: (r.patient_count, r.has_error) for r in
              documents.site_status(summaries).collect()}
    assert status == {"one": (2, False), "two": (2, False), "zzz": (0, True)}
    table = stages.consolidate_sites(spark, str(tmp_path))
    got = {r.unique_number: (r.is_duplicate, r.has_other_studies) for r in table.collect()}
    assert got == {10001: ("first_occurrence", 1), 10002: ("first_occurrence", 1),
                   10003: ("duplicate", 0), 10004: ("duplicate", 0)}
    picked = documents.read_site_summaries(spark, [str(tmp_path / "two")])
    assert picked.count() == 2
    read = stages.extract_site_reports(spark, str(tmp_path)).filter("extraction_successful")
    assert read.first().extraction_data.imaging_modality == "CT"


def test_tags_to_record(spark):
    tags = [("/a.dcm", {"PatientID": ["P1"], "PixelSpacing": ["0.5", "0.6"], "StationName": [""],
                        "ImagePositionPatient": ["1", "2", "3"], "ImageType": ["A", "B"]})]
    df = spark.createDataFrame(tags, "file_path string, tags map<string,array<string>>")
    row = files.normalise_tags(df).first()
    assert row.pixel_spacing == "0.5\\0.6" and row.image_type == "A\\B"
    assert row.image_position_patient == "[1, 2, 3]" and row.station_name == ""
    assert row.patient_name == "Unknown" and files.normalise_tags(df).columns == SLICE_FIELDS


def test_archives_are_listed_expanded_and_decided(spark, tmp_path):
    (tmp_path / "ok.zip").write_bytes(zipped({"a.dcm": b"1", "../evil": b"2"}))
    (tmp_path / "evil.zip").write_bytes(zipped({"/etc/x": b"1"}))
    (tmp_path / "broken.zip").write_bytes(b"no archive")
    inventory = files.archive_inventory(spark, str(tmp_path), integrity=True)
    assert inventory.filter("length(checksum) = 32").count() == 3
    content = spark.read.format("binaryFile").option("pathGlobFilter", "*.zip").load(str(tmp_path))
    entries = files.expand_archives(content, with_content=True)
    got = {(r.entry, r.safe, bytes(r.content) if r.content else None) for r in entries.collect()
           if r.entry}
    assert got == {("a.dcm", True, b"1"), ("../evil", False, None), ("/etc/x", False, None)}
    result = {r.archive.rsplit("/", 1)[1]: (r.extraction_successful, r.error) for r in
              files.expansion_results(entries).collect()}
    assert result["ok.zip"] == (True, None)
    assert result["evil.zip"] == (False, "No safe files to extract")
    assert not result["broken.zip"][0]


def test_archive_decisions(spark):
    names = ["new", "manual", "good", "gone", "changed", "failed", "sum"]
    archives = spark.createDataFrame([(f"/z/{n}.zip", f"/z/{n}", 10, "c1") for n in names],
                                     "path string, extract_path string, mtime long, checksum string")
    ledger = spark.createDataFrame([
        ("/z/good.zip", 10, "c1", True, ["a"]), ("/z/gone.zip", 10, "c1", True, ["a", "b"]),
        ("/z/changed.zip", 9, "c1", True, ["a"]), ("/z/failed.zip", 10, "c1", False, []),
        ("/z/sum.zip", 10, "c0", True, ["a"])],
        "path string, mtime long, checksum string, ok boolean, extracted_files array<string>")
    listing = spark.createDataFrame([(f"/z/{n}/a", f"/z/{n}") for n in names if n != "new"],
                                    "path string, folder string")
    got = {r.path[3:-4]: r.decision for r in progress.archive_decision(
        archives, ledger, listing, check_integrity=True).collect()}
    assert got == {
        "new": "expand: new", "manual": "done: target has files", "good": "done: recorded",
        "gone": "expand: extracted file missing", "changed": "expand: archive changed",
        "failed": "expand: last run failed", "sum": "expand: checksum differs"}
    kept = file_ops.sample_present(
        ledger.withColumn("extract_path", F.regexp_replace("path", ".zip$", "")), listing)
    assert kept.filter("path = '/z/gone.zip'").isEmpty()


def test_text_extraction_job(spark, tmp_path):
    for name, body in (("a.docx", "some readable text"), ("b.docx", "x"), ("c.pdf", "p"),
                       ("d.txt", "no"), ("e.doc", "fail")):
        (tmp_path / name).write_text(body)

    def fail(_):
        raise ValueError("bad bytes")

    content = spark.read.format("binaryFile").load(str(tmp_path))
    got = {r.filename: (r.status, r.method) for r in documents.extract_texts(content, {
        "docx": documents.plain_text, "doc": fail,
        "pdf": lambda b: ("", "text read from an image")}).collect()}
    assert got == {"a.docx": ("success", "native"), "b.docx": ("empty_document", "native"),
                   "c.pdf": ("ocr_fallback", "ocr"), "d.txt": ("unsupported", "failed"),
                   "e.doc": ("corrupted", "failed")}


def test_model_calls_and_response_ladder(spark):
    from studyloom.functions.report_fields import parse_responses

    def make():
        def call(document):
            if "fail" in document:
                raise RuntimeError("down")
            return '{"number_of_studies": 2, "imaging_modality": "X-ray", "body_part": "Head"}', None
        return call

    docs = spark.createDataFrame([(1, "a report text"), (2, "will fail here"), (3, "short")],
                                 "id long, text string")
    answered = documents.call_model(docs, make)
    got = {r.id: r for r in parse_responses(answered).collect()}
    assert got[1].parsing_method == "structured"
    assert got[1].extraction_data.imaging_modality == "X-ray"
    assert got[2].call_error.startswith("api_exception") and got[2].extraction_data is None
    assert got[3].call_error == "empty_document"
    plain = spark.createDataFrame([("no fields at all", None)], "content string, reasoning string")
    last = parse_responses(plain, allow_minimal=True).first()
    assert last.parsing_method == "minimal_extraction"


def test_sheets_need_their_columns(spark, tmp_path):
    (tmp_path / "t.csv").write_text("hospital,dicom_folder_path\nH,0012\n")
    table = documents.read_sheet(spark, str(tmp_path / "t.csv"), ["hospital"], ["study_date"])
    assert table.first().dicom_folder_path == "0012" and table.first().study_date is None
    with pytest.raises(ValueError, match="missing required columns: x"):
        require_columns(table, ["x"])


def test_stores_documents_and_chunks(spark, tmp_path):
    df = spark.createDataFrame([("s1", "a"), ("s2", "b")], "source_file string, v string")
    stores.append_store(df, str(tmp_path / "store"), buckets=4)
    stores.append_store(df, str(tmp_path / "store"), buckets=4)
    assert spark.read.parquet(str(tmp_path / "store")).count() == 4
    for _ in range(2):
        stores.append_store(df, str(tmp_path / "batches"), buckets=4, batch="run1")
    stores.append_store(df, str(tmp_path / "batches"), buckets=4, batch="run2")
    assert spark.read.parquet(str(tmp_path / "batches")).count() == 4
    for _ in range(2):
        stores.write_filtered_store(df, str(tmp_path / "kept"), buckets=4)
    kept = spark.read.parquet(str(tmp_path / "kept"))
    assert kept.count() == 2 and kept.first().stored_file.startswith("S3_processForStore_")
    chunks = spark.createDataFrame([("k", "old", 1), ("k", "new", 2), ("j", "x", 1)],
                                   "key string, v string, chunk int")
    assert {tuple(r) for r in stores.last_wins(chunks, "key").collect()} == {("k", "new"), ("j", "x")}
    stores.write_json(df, str(tmp_path / "out"), records_per_file=1)
    assert spark.read.json(str(tmp_path / "out")).count() == 2
    summary = df.agg(F.count(F.lit(1)).alias("rows"))
    row = stores.run_document(summary, {"min_files": "10"}).first()
    assert row.summary.rows == 2 and row.parameters == {"min_files": "10"}
    stores.write_tables(stores.consolidation_report(df, spark.createDataFrame(
        [("a", 2)], "source_folder string, patient_count long")), str(tmp_path / "sheets"))
    assert spark.read.parquet(str(tmp_path / "sheets" / "Summary")).first().total_patients == 2


def test_study_archives_in_parts(spark, tmp_path):
    rows = []
    for i in range(6):
        path = tmp_path / f"f{i}.dcm"
        path.write_bytes(b"x" * 1000)
        rows.append(("one.jsonl" if i < 2 else "big.jsonl", str(path), "P1"))
    rows.append(("one.jsonl", "/missing.dcm", "P1"))
    slices = spark.createDataFrame(rows, "source_file string, file_path string, patient_id string")
    listing = files.list_files(spark, str(tmp_path), "*.dcm")
    done = stores.write_study_archives(slices, listing, str(tmp_path / "zips"), part_files=2).collect()
    assert sum(r.n_files for r in done) == 6 and all(r.error is None for r in done)
    assert sum(r.original_size for r in done) == 6000
    with zipfile.ZipFile(tmp_path / "zips" / "one.zip") as archive:
        assert sorted(archive.namelist()) == ["f0.dcm", "f0_metadata.json", "f1.dcm",
                                              "f1_metadata.json"]
        assert json.loads(archive.read("f0_metadata.json"))["patient_id"] == "P1"
    counts = file_ops.existence_counts(slices, listing, ["source_file"]).filter(
        "source_file = 'one.jsonl'").first()
    assert (counts.existing, counts.missing) == (2, 1)


def test_checksums_read_files_of_any_size_in_ranges(spark, tmp_path):
    big, small = tmp_path / "big.zip", tmp_path / "small.zip"
    with big.open("wb") as file:
        file.truncate(3 << 30)
    small.write_bytes(b"some bytes")
    inventory = files.archive_inventory(spark, str(tmp_path), integrity=True)
    got = {r.path.rsplit("/", 1)[1]: r for r in inventory.collect()}
    big.unlink()
    zeros = hashlib.md5()
    for _ in range(3 << 7):
        zeros.update(bytes(8 << 20))
    assert got["big.zip"].checksum == zeros.hexdigest() and got["big.zip"].size == 3 << 30
    assert got["small.zip"].checksum == hashlib.md5(b"some bytes").hexdigest()
    assert got["small.zip"].error is None and got["small.zip"].extract_path.endswith("/small")
    gone = pd.DataFrame([("/gone.zip", 1, None)], columns=["path", "size", "mtime"])
    (row,) = next(files._checksums(iter([gone]))).itertuples()
    assert row.checksum is None and "No such file" in row.error
