import json
from pathlib import Path

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st

from studyloom.sinks import stores
from studyloom.sources import documents
from studyloom.sources.json_items import read_items

TEXT = st.text(st.sampled_from(list('ab"\\{}[],: \n\té中𝄞')), max_size=60)
VALUE = st.recursive(st.none() | st.booleans() | st.integers() | TEXT,
                     lambda v: st.lists(v, max_size=3) | st.dictionaries(TEXT, v, max_size=3),
                     max_leaves=6)
FILES = st.lists(st.dictionaries(TEXT, VALUE, max_size=8) | st.lists(VALUE, max_size=8),
                 min_size=1, max_size=4)


@pytest.fixture
def small_splits(spark):
    """Splits of a few bytes, so that every item goes over some."""
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "64")
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    yield spark
    spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    spark.conf.unset("spark.sql.files.openCostInBytes")


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(files=FILES, indent=st.sampled_from([None, 0, 2]), plain=st.booleans())
def test_items_of_split_files_equal_the_whole_file(small_splits, tmp_path_factory, files, indent,
                                                   plain):
    folder = tmp_path_factory.mktemp("items")
    for k, content in enumerate(files):
        (folder / f"{k}.json").write_text(json.dumps(content, indent=indent, ensure_ascii=plain))
    items, broken = read_items(small_splits, str(folder))
    assert broken.count() == 0
    got = {}
    for r in items.collect():
        got.setdefault(Path(r.file).name, {})[r.item] = r.value
    for k, content in enumerate(files):
        parts = [got[f"{k}.json"][i] for i in range(max(1, len(content)))]
        assert len(got[f"{k}.json"]) == len(parts)
        body = ",".join(parts)
        assert json.loads(f"[{body}]" if isinstance(content, list) else "{" + body + "}") == content


def test_other_shapes_are_listed(small_splits, tmp_path):
    for name, body in {"number": "3", "open": '{"a": "b', "two": '{"a":1}{"b":2}', "text": '"x{}"',
                       "empty": "", "closed": "}{", "good": ' [1, {"a": "]"}] '}.items():
        (tmp_path / name).write_text(body)
    items, broken = read_items(small_splits, str(tmp_path))
    assert {Path(r.file).name for r in broken.collect()} == {
        "number", "open", "two", "text", "empty", "closed"}
    assert sorted((r.item, json.dumps(json.loads(r.value))) for r in items.collect()) == [
        (0, "1"), (1, '{"a": "]"}')]


def test_a_map_larger_than_its_splits_is_read_by_many_tasks(spark, tmp_path):
    content = {f"/r/{k}.pdf": f'line "{k}" of {{a}} [text], ' * 40 for k in range(3000)}
    (tmp_path / "map.json").write_text(json.dumps(content))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "200000")
    try:
        rows = documents.read_document_maps(spark, str(tmp_path))
        assert {r.file_path: r.report_text for r in rows.collect()} == content
        items, _ = read_items(spark, str(tmp_path))
        assert items.rdd.getNumPartitions() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_one_malformed_item_voids_its_file_only(small_splits, tmp_path):
    (tmp_path / "a.json").write_text('{"/a": "x", "/b": oops, "/c": "y"}')
    (tmp_path / "b.json").write_text('{"/a": "x",}')
    (tmp_path / "c.json").write_text('[{"file_path": "/d", "report_text": null}]')
    (tmp_path / "d.json").write_text("{}")
    rows = documents.read_document_maps(small_splits, str(tmp_path))
    assert [(r.file_path, r.report_text) for r in rows.collect()] == [("/d", None)]


def test_summary_positions_follow_the_files_not_the_splits(small_splits, tmp_path):
    folder = tmp_path / "one" / documents.SUMMARY_FILE
    folder.mkdir(parents=True)
    sizes, n = [3, 400, 1, 90], 0
    for part, size in enumerate(sizes):
        with open(folder / f"part-{part:05d}.json", "w") as out:
            for _ in range(size):
                out.write(json.dumps({"patient_id": f"P{n:04d}"}) + "\n")
                n += 1
    listed = tmp_path / "two" / documents.SUMMARY_FILE
    listed.parent.mkdir(parents=True)
    listed.write_text(json.dumps([{"patient_id": f"Q{k:04d}"} for k in range(50)], indent=1))
    rows = documents.read_site_summaries(small_splits, str(tmp_path)).collect()
    for site, letter, total in (("one", "P", n), ("two", "Q", 50)):
        found = [r.patient_id for r in sorted(
            (r for r in rows if r.source_folder == site), key=lambda r: tuple(r.position))]
        assert found == [f"{letter}{k:04d}" for k in range(total)]


def test_written_summary_is_read_in_its_order(spark, tmp_path):
    df = spark.range(0, 1000, 1, 7).selectExpr("concat('P', id) as patient_id", "id")
    stores.write_site_summary(df.drop("id"), str(tmp_path / "site"))
    rows = documents.read_site_summaries(spark, str(tmp_path)).orderBy("position").collect()
    assert [r.patient_id for r in rows] == [f"P{k}" for k in range(1000)]
