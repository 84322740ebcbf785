import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from studyloom.operators import mapping as ops

NEW = ("new_id long, hospital string, dicom_folder_path string, patient_id string, "
       "study_date string, unique_number long, is_duplicate string, "
       "is_duplicate_first_occurrence_un string")
OLD = ("old_id long, hospital string, dir_to_root string, id_from_ct string, "
       "id_hospital string, old_date string")


def clean(path):
    path = (path or "").strip()
    if len(path) > 1 and path[1] == ":" and path[0].isalpha():
        path = path[2:]
    return path.replace("\\", "/").strip("/").lower()


def digits(date):
    return "".join(c for c in date if c not in "-/ ")


def dates_ok(a, b):
    return a is None or b is None or (digits(a) == digits(b) and digits(a) != "")


def plain_mapping(new, old):
    """Row by row, in the order the rules give."""
    matches = {}
    for n in new:
        for o in old:
            if n[1] is None or o[1] is None or n[1].strip() != o[1].strip() or not o[2]:
                continue
            a, b = clean(n[2]), clean(o[2])
            if a and b and (a == b or a.startswith(b + "/")) and dates_ok(n[4], o[5]):
                matches.setdefault(n[0], []).append(o[0])
    for o in old:
        if o[1] is None or (o[2] or "").strip():
            continue
        key = (o[3] or "").strip() or (o[4] or "").strip().rsplit("_", 1)[0]
        for n in new:
            if key and n[1] is not None and n[1].strip() == o[1].strip() \
                    and (n[3] or "").strip() == key and dates_ok(n[4], o[5]):
                matches.setdefault(n[0], []).append(o[0])
    groups = defaultdict(list)
    for n in new:
        if n[6] == "first_occurrence":
            groups[str(n[5])].append(n[0])
        elif n[6] == "duplicate":
            groups[n[7]].append(n[0])
    copied = set()
    for ids in groups.values():
        done = [i for i in ids if i in matches]
        todo = [i for i in ids if i not in matches]
        for i in todo if done else []:
            matches[i] = list(matches[done[0]])
            copied.add(i)
    back = defaultdict(list)
    for n, olds in matches.items():
        for o in olds:
            back[o].append(n)
    classes = set()
    for n, olds in matches.items():
        if len(olds) == 1 and len(back[olds[0]]) == 1:
            classes |= {("one_to_one", n, "old", olds[0]), ("one_to_one", n, "new", n)}
    for o, news in back.items():
        if len(news) > 1:
            classes |= {("one_to_many", o, "new", n) for n in news}
    seen = set()
    for n, olds in matches.items():
        if n in seen or len(olds) < 2:
            continue
        reach = {m for o in olds for m in back[o]}
        name = "many_to_one" if len(reach) == 1 else "many_to_many"
        classes |= {(name, n, "old", o) for o in olds} | {(name, n, "new", m) for m in reach}
        seen |= reach
    return matches, copied, classes


def random_databases(seed):
    rng = random.Random(seed)
    new, old = [], []
    for i in range(60):
        state = rng.choice(["unique", "first_occurrence", "duplicate"])
        path = rng.choice([None, "", "E:\\d\\p%d\\s%d" % (rng.randint(1, 6), rng.randint(1, 3)),
                           "e:/D/p%d" % rng.randint(1, 6)])
        new.append((i, rng.choice(["H1", "H2 ", None]), path, rng.choice(["A1", "A2", "", None]),
                    rng.choice(["20200101", "2020-01-02", None, ""]), 10001 + i, state,
                    str(10001 + rng.randint(0, 59)) if state == "duplicate" else ""))
    for i in range(25):
        path = rng.choice([None, " ", "/d/p%d/" % rng.randint(1, 6),
                           "f:\\d\\P%d\\s%d" % (rng.randint(1, 6), rng.randint(1, 3)), "/"])
        old.append((500 + i, rng.choice(["H1", "H2"]), path, rng.choice(["A1", "", None]),
                    rng.choice(["A2_x", "A1_y_z", None]), rng.choice(["2020/01/01", None, ""])))
    return new, old


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_classes_equal_the_row_by_row_rules(spark, seed):
    new, old = random_databases(seed)
    matches, copied, classes = plain_mapping(new, old)
    m = ops.match_databases(spark.createDataFrame(new, NEW), spark.createDataFrame(old, OLD))
    pairs = ops.expand_edges(m.edges, m.old).select("new_id", "old_id", "propagated").collect()
    assert {(r.new_id, r.old_id) for r in pairs} == {
        (n, o) for n, olds in matches.items() for o in olds}
    assert len(pairs) == sum(map(len, matches.values()))
    assert {r.new_id for r in pairs if r.propagated} == copied
    got = set(map(tuple, ops.conflict_members(m).collect()))
    assert got == classes
    merged = ops.merged_table(m).collect()
    assert {r.new_id for r in merged if r.section_no == 5} == {
        n[0] for n in new} - set(matches)
    many = [(r.new_id, r["backward_CT_No_Final"]) for r in merged if r.section_no == 2]
    assert sorted(many) == sorted((n, o) for c, o, _, n in classes if c == "one_to_many")
    red = {n for c, _, s, n in classes if s == "new" and c.startswith("many")}
    yellow = {n for c, _, _, n in classes if c == "one_to_many"} - red
    colour = {r.new_id: r.highlight for r in merged if r.new_id is not None}
    assert {n for n, c in colour.items() if c == "red"} == red
    assert {n for n, c in colour.items() if c == "yellow"} == yellow
    used = {o for c, _, s, o in classes if s == "old"} | {
        o for c, o, _, _ in classes if c == "one_to_many"}
    assert {r["backward_CT_No_Final"] for r in merged if r.section_no == 6} == {
        o[0] for o in old} - used


def test_hospital_map_gaps_and_template(spark):
    studies = spark.createDataFrame([("a",), ("b",), ("c",), (" ",), (None,), ("a",)],
                                    "source_folder string")
    hospitals = spark.createDataFrame([("a", "H"), ("b", " "), ("z", "")],
                                      "source_folder string, hospital string")
    gaps = {tuple(r) for r in ops.mapping_gaps(studies, hospitals).collect()}
    assert gaps == {("c", "missing"), ("b", "empty")}
    labelled = ops.apply_hospitals(studies, hospitals)
    assert sorted(r.Hospital for r in labelled.collect()) == ["", "", "", " ", "H", "H"]
    assert [r.source_folder for r in ops.mapping_template(studies).collect()] == ["a", "b", "c"]
    assert ops.hospital_distribution(labelled).first().rows == 2


@pytest.mark.parametrize("n", [3, 1100])
def test_conflict_log_has_one_shape_for_all_sizes(spark, n):
    new = [(i, "H", "/d/p", None, None, i, "unique", "") for i in range(n)]
    old = [(500, "H", "/d", None, None, None)]
    m = ops.match_databases(spark.createDataFrame(new, NEW), spark.createDataFrame(old, OLD))
    log = ops.conflict_log(m).collect()
    assert {r.side for r in log} == {"new", "old"} and len(log) == n + 1
    assert sorted(r.member for r in log if r.side == "new") == list(range(n))
    counts = {r.match_class: r.entries for r in ops.match_class_counts(m).collect()}
    assert counts == {"one_to_many": 1}
    assert ops.highlight_counts(ops.merged_table(m)).filter(F.col("highlight") == "yellow").first().rows == n


def test_optional_old_columns_may_be_absent(spark):
    new = [(1, "H", "/d/p", "P1", "20200101", 1, "unique", ""), (2, "H", None, "P2", None, 2, "unique", "")]
    old = spark.createDataFrame([(500, "H", "P1"), (501, "H", "P3")],
                                "old_id long, hospital string, id_from_ct string")
    m = ops.match_databases(spark.createDataFrame(new, NEW), old)
    got = sorted((r.section_no, r.new_id or 0, r.backward_CT_No_Final or 0)
                 for r in ops.merged_table(m).collect())
    assert got == [(1, 1, 500), (5, 2, 0), (6, 0, 501)]
    assert ops.merged_table(m).filter("backward_date is not null").isEmpty()
