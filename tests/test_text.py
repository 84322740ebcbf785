import pytest
from pyspark.sql import functions as F

from studyloom.functions import jsontext, privacy, text


@pytest.mark.parametrize("name, expected", [
    ("a/b:c*.dcm", "a_b_c_.dcm"),
    ("x" * 300 + ".jsonl", "x" * 249 + ".jsonl"),
    ("y" * 300, "y" * 255),
    (" . ", "unnamed_file"),
    ("tab\there", "tab_here"),
])
def test_safe_file_name(one, name, expected):
    assert one(text.safe_file_name(F.col("n")), n=name) == expected


@pytest.mark.parametrize("station, institution, center", [
    ("ST1", "H", "ST1"), ("", "H", "H"), ("Unknown", "H", "Unknown"), ("", "", "Unknown"),
])
def test_study_key_uses_institution_only_for_empty_station(one, station, institution, center):
    key = text.study_key(F.lit("20200101"), F.lit("P1"), F.col("s"), F.col("i"))
    assert one(key, s=station, i=institution) == f"20200101_._P1_._{center}_._Study.jsonl"


@pytest.mark.parametrize("path, folder", [
    ("/a/b/c.dcm", "/a/b"), ("c.dcm", ""), ("/c.dcm", "/"), (r"E:\a\b.dcm", r"E:\a"), ("", None),
])
def test_parent_folder(one, path, folder):
    assert one(text.parent_folder(F.col("p")), p=path) == folder


@pytest.mark.parametrize("new, old, under", [
    (r"E:\Data\P1\x", "f:/data/p1/", True),
    ("/data/p1", "/data/p1", True),
    ("/data/p10", "/data/p1", False),
    ("/data/p1", "/data/p1/x", False),
    ("/", "/", False),
])
def test_path_is_under(one, new, old, under):
    assert one(text.path_is_under(F.col("n"), F.col("o")), n=new, o=old) is under


@pytest.mark.parametrize("a, b, expected", [
    ("DOE^JOHN", "john doe", 1.0), ("A B C D", "A B C D E", 0.8), ("Unknown", "Unknown", 0.0),
    ("", "A", 0.0), ("^", "^", 0.0),
])
def test_name_jaccard_and_symmetry(one, a, b, expected):
    assert one(text.name_jaccard(F.col("a"), F.col("b")), a=a, b=b) == expected
    assert one(text.name_jaccard(F.col("b"), F.col("a")), a=a, b=b) == expected


@pytest.mark.parametrize("size, expected", [
    (0, "0 B"), (1023, "1023.00 B"), (1024, "1.00 KB"), (1152, "1.12 KB"), (5 * 1024 ** 4, "5.00 TB"),
])
def test_human_size(one, size, expected):
    assert one(text.human_size(F.lit(size).cast("bigint"))) == expected


@pytest.mark.parametrize("value, expected", [
    ("12973355_EmamKh", "12973355"), ("a_b_c", "a_b"), ("abc", "abc"), (" x_1 ", "x"),
])
def test_id_without_suffix(one, value, expected):
    assert one(text.id_without_suffix(F.col("v")), v=value) == expected


def test_drive_and_package_names(one):
    assert one(text.swap_drive(F.col("p"), "D"), p="E:/x/y.pdf") == "D:/x/y.pdf"
    assert one(text.swap_drive(F.col("p"), "D"), p="/x/y.pdf") == "/x/y.pdf"
    assert one(text.package_file_name(F.lit(7), F.col("p")), p="/x/y.pdf") == "ROW_0007_y.pdf"
    assert one(text.study_name(F.col("p")), p="/o/S3_processForStore_a.b.jsonl") == "a.b"


@pytest.mark.parametrize("path, expected", [
    ("F:/12412/1.iso", "12412_._1"), ("/1.iso", "1"), ("/" + "a" * 120 + "/1.iso", "a" * 97 + "..."),
])
def test_flat_archive_name(one, path, expected):
    assert one(text.flat_archive_name(F.col("p")), p=path) == expected


def test_project_names(one):
    assert one(text.project_name(F.col("p"), F.lit(3)), p="/mnt/data x/site-1/") == "data_x_._site-1"
    assert one(text.project_name(F.col("p"), F.lit(3)), p="/") == "location_003"


def test_json_text(one):
    assert one(jsontext.strip_fence(F.col("c")), c='```json\n{"a": 1}\n```') == '{"a": 1}'
    assert one(jsontext.clean_json(F.col("c")), c='{"a": [1, ], }') == '{"a": [1]}'
    assert one(jsontext.first_valid_json(F.col("c")), c='x {bad} then {"b": 2} y') == '{"b": 2}'
    assert one(jsontext.salvage_pairs(F.col("c")), c='"a": "x", "a": 3, "l": [1,2]') == {
        "a": "3", "l": "1,2"}
    assert one(jsontext.salvage_pairs(F.col("c")), c="nothing") is None
    assert one(jsontext.clean_json(F.col("c")), c='{number: 2, "x": "a, b: c\\" , }", y : [1,]}') == (
        '{"number": 2, "x": "a, b: c\\" , }", "y" : [1]}')
    assert one(jsontext.salvage_pairs(F.col("c")), c='"a": null, "b": "null", "c": 1, "c": 2') == {
        "a": None, "b": "null", "c": "2"}
    assert one(jsontext.strip_fence(F.col("c")), c='```\n{"a": 1}') == '{"a": 1}'


def test_next_candidate_when_one_does_not_convert(one):
    from studyloom.functions.report_fields import converts

    def chosen(text):
        return one(jsontext.first_valid_json(F.col("c"), converts), c=text)

    assert chosen('{"number_of_studies": "two"} {"number_of_studies": "2"}') == (
        '{"number_of_studies": "2"}')
    assert chosen('{"current_disease_list": "x"} or {"current_disease_list": ["x"]}') == (
        '{"current_disease_list": ["x"]}')
    assert chosen('{"number_of_studies": null}') is None


def test_shift_is_constant_and_bounded(spark):
    ids = spark.range(5000).select(F.concat(F.lit("P"), F.col("id").cast("string")).alias("p"))
    shifts = ids.select(privacy.shift_days(F.col("p"), "s").alias("d"),
                        privacy.shift_years(F.col("p"), "s").alias("y"))
    low, high, years = shifts.agg(F.min("d"), F.max("d"), F.count_distinct("y")).first()
    assert -730 <= low < -700 and 700 < high <= 730 and years == 5
    again = ids.select(privacy.shift_days(F.col("p"), "s").alias("d"))
    assert again.exceptAll(shifts.select("d")).isEmpty()


@pytest.mark.parametrize("date, days, expected", [
    ("20200131", 1, "20200201"), ("Unknown", 1, "Unknown"), ("2020-01-31", 1, "2020-01-31"),
    ("20201399", 1, "20201399"), ("", 1, ""),
])
def test_shifted_date(one, date, days, expected):
    assert one(privacy.shifted_date(F.col("d"), F.lit(days)), d=date) == expected


@pytest.mark.parametrize("age, years, expected", [
    ("045Y", 2, "047Y"), ("001Y", -2, "001Y"), ("006M", 1, "006M"), ("Unknown", 1, "Unknown"),
])
def test_jittered_age(one, age, years, expected):
    assert one(privacy.jittered_age(F.col("a"), F.lit(years)), a=age) == expected
