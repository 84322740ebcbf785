"""Mapping between a new and an old study database, and hospital labels.

Old rows that agree on hospital, key and date have the same matches, so they are
folded into one group before matching, and the match classes are worked out on
groups. Old rows are only spread out again in the final table.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from studyloom.functions import text
from studyloom.operators.leaders import first_come_leaders
from studyloom.operators.skew import match_keys
from studyloom.session import durable

# Columns of the old database that may be absent.
OPTIONAL_OLD = ["dir_to_root", "id_from_ct", "id_hospital", "old_date"]
NEW_IDS = ["ID_fromCT", "DONOTPUBLISH_ID_fromCT", "patient_id"]


# Hospital labels

def apply_hospitals(studies: DataFrame, hospitals: DataFrame,
                    source: str = "source_folder") -> DataFrame:
    """Add `Hospital` from a (source_folder, hospital) map; '' where there is none.

    A source may be listed again with the same hospital; with another one the job fails.
    """
    named = hospitals.groupBy(F.col("source_folder").alias("_source")).agg(
        F.min("hospital").alias("_hospital"), F.max("hospital").alias("_other")).select(
        "_source", F.when(F.col("_hospital") == F.col("_other"), F.col("_hospital")).otherwise(
            F.when(F.col("_hospital").isNotNull(), F.raise_error(F.concat(
                F.lit("two hospitals for "), "_source")).cast("string"))).alias("_hospital"))
    return (studies.join(named, F.col(source) == F.col("_source"), "left")
            .withColumn("Hospital", F.coalesce("_hospital", F.lit("")))
            .drop("_source", "_hospital"))


def distinct_sources(studies: DataFrame, source: str = "source_folder") -> DataFrame:
    return (studies.filter(~text.blank(F.col(source)))
            .select(F.col(source).alias("source_folder")).distinct())


def mapping_template(studies: DataFrame, source: str = "source_folder") -> DataFrame:
    """Every source, in order, with an empty hospital to fill in."""
    return distinct_sources(studies, source).orderBy("source_folder").withColumn(
        "hospital", F.lit(""))


def mapping_gaps(studies: DataFrame, hospitals: DataFrame,
                 source: str = "source_folder") -> DataFrame:
    """Sources that block labelling: missing from the map, or mapped to a blank."""
    sources = distinct_sources(studies, source)
    missing = sources.join(hospitals, "source_folder", "left_anti").withColumn(
        "problem", F.lit("missing"))
    empty = sources.join(hospitals.filter(text.blank(F.col("hospital"))), "source_folder",
                         "left_semi").withColumn("problem", F.lit("empty"))
    return missing.unionByName(empty)


def hospital_distribution(labelled: DataFrame) -> DataFrame:
    return (labelled.filter(~text.blank(F.col("Hospital")))
            .groupBy("Hospital").agg(F.count(F.lit(1)).alias("rows")))


# Matching

def _day(date: Column) -> Column:
    """Date digits; null only for a null date, '' for a blank one."""
    return F.when(date.isNotNull(), F.coalesce(text.date_digits(date), F.lit("")))


def days_agree(new: Column, old: Column) -> Column:
    """Dates agree, or one of them is null; a blank date agrees with no date."""
    return new.isNull() | old.isNull() | ((new == old) & (old != ""))


def old_groups(old: DataFrame) -> DataFrame:
    """Old rows with `group_id`, the first old id with the same hospital, key and date.

    Rows with a path match by path; rows without one by id, else by hospital id
    without its suffix. Rows with no usable key have a null group.
    """
    folder, ct_id, hospital_id = (F.col(c) for c in ("dir_to_root", "id_from_ct", "id_hospital"))
    by_path = ~text.blank(folder)
    fallback = F.when(~text.blank(ct_id), text.strip(ct_id)).otherwise(
        F.when(~text.blank(hospital_id), text.id_without_suffix(hospital_id)))
    keyed = old.withColumns({
        "_kind": F.when(by_path, "path").otherwise("id"),
        "_place": text.strip(F.col("hospital")),
        "_key": F.nullif(F.when(by_path, text.normal_path(folder)).otherwise(fallback),
                         F.lit("")),
        "_day": _day(F.col("old_date")),
    })
    keys = ["_kind", "_place", "_key", "_day"]
    usable = F.col("_place").isNotNull() & F.col("_key").isNotNull()
    groups = keyed.filter(usable).groupBy(*keys).agg(
        F.min("old_id").alias("group_id"), F.count(F.lit(1)).alias("n_old"))
    return match_keys(keyed, groups, keys)


def _groups_of(keyed: DataFrame, kind: str) -> DataFrame:
    first = keyed.filter((F.col("_kind") == kind) & (F.col("group_id") == F.col("old_id")))
    return first.select("_place", "_key", F.col("_day").alias("old_day"), "group_id", "n_old",
                        F.col("_place").alias("place"))


# Columns of an edge between a new row and an old group.
EDGE = ["new_id", "group_id", "n_old", "old_day", "new_day", "place"]


def path_edges(new: DataFrame, keyed_old: DataFrame) -> DataFrame:
    """(new_id, group_id): the new folder is the old one or lies under it.

    Containment becomes an equality with one of the leading parts of the new path.
    Only parts as deep as old paths are looked up, so a common root costs nothing.
    """
    groups = _groups_of(keyed_old, "path")
    depth = F.size(F.split("_key", "/"))
    deep = groups.agg(F.min(depth).alias("low"), F.max(depth).alias("high")).first()
    low, high = deep.low or 1, deep.high or 0
    parts = text.path_ancestors(text.normal_path(F.col("dicom_folder_path")))
    prefixes = new.select(
        "new_id", text.strip(F.col("hospital")).alias("_place"),
        _day(F.col("study_date")).alias("new_day"),
        F.explode(F.slice(parts, low, max(high - low + 1, 0))).alias("_key"))
    return (prefixes.join(groups, ["_place", "_key"])
            .filter(days_agree(F.col("new_day"), F.col("old_day")))
            .select(*EDGE))


def id_edges(new: DataFrame, keyed_old: DataFrame) -> DataFrame:
    """(new_id, group_id): one of the new ids equals the id of an old row without a path."""
    present = [c for c in NEW_IDS if c in new.columns]
    ids = F.array_distinct(F.array_compact(F.array(*[text.strip(F.col(c)) for c in present])))
    candidates = new.select(
        "new_id", text.strip(F.col("hospital")).alias("_place"),
        _day(F.col("study_date")).alias("new_day"), F.explode(ids).alias("_key"))
    return (candidates.join(_groups_of(keyed_old, "id"), ["_place", "_key"])
            .filter(days_agree(F.col("new_day"), F.col("old_day")))
            .select(*EDGE)
            .distinct())


def match_edges(new: DataFrame, keyed_old: DataFrame) -> DataFrame:
    """All edges with their strategy and the visiting order of the new rows.

    `visit` orders new rows as they are first matched: by path in row order, then by
    id in the order of the old rows.
    """
    by_path = path_edges(new, keyed_old).withColumn("strategy", F.lit("path"))
    by_id = id_edges(new, keyed_old).withColumn("strategy", F.lit("id"))
    edges = durable(by_path.unionByName(by_id).select(*EDGE, "strategy"))
    phase = F.when(F.col("strategy") == "path", F.struct(
        F.lit(1).alias("phase"), F.lit(0).cast("bigint").alias("first_old"),
        F.col("new_id").cast("bigint").alias("new_id"))).otherwise(F.struct(
            F.lit(2).alias("phase"), F.col("group_id").cast("bigint").alias("first_old"),
            F.col("new_id").cast("bigint").alias("new_id")))
    order = edges.groupBy("new_id").agg(F.min(phase).alias("visit"))
    return edges.join(order, "new_id")


def expand_edges(edges: DataFrame, keyed_old: DataFrame) -> DataFrame:
    """(new_id, old_id) for edges to groups."""
    members = keyed_old.filter(F.col("group_id").isNotNull()).select("group_id", "old_id")
    return edges.drop("old_id").join(members, "group_id")


def propagate(edges: DataFrame, new: DataFrame) -> DataFrame:
    """Give unmatched rows of a duplicate group the matches of its first matched row."""
    state = F.lower(text.strip(F.col("is_duplicate")))
    group = F.when(state == "first_occurrence", F.col("unique_number").cast("string")).when(
        state == "duplicate", F.col("is_duplicate_first_occurrence_un"))
    matched = edges.select("new_id").distinct().withColumn("_matched", F.lit(True))
    rows = new.select("new_id", group.alias("_group"), _day(F.col("study_date")).alias("_day")).filter(
        F.col("_group").isNotNull()).join(matched, "new_id", "left")
    sources = rows.groupBy("_group").agg(
        F.min("new_id").alias("_first"),
        F.min(F.when(F.col("_matched"), F.col("new_id"))).alias("_source")).filter(
        F.col("_source").isNotNull())
    copies = (
        rows.filter(F.col("_matched").isNull()).join(sources, "_group")
        .select(F.col("new_id").alias("_copy"), F.col("_day").alias("_copy_day"), "_first",
                "_source")
        .join(edges.withColumnRenamed("new_id", "_source"), "_source")
        .withColumn("visit", F.struct(
            F.lit(3).alias("phase"), F.col("_first").cast("bigint").alias("first_old"),
            F.col("_copy").cast("bigint").alias("new_id")))
        .withColumns({"new_id": F.col("_copy"), "new_day": F.col("_copy_day")})
        .select(*EDGE, "strategy", "visit", F.lit(True).alias("propagated"))
    )
    return edges.select(*EDGE, "strategy", "visit", F.lit(False).alias("propagated")).unionByName(
        copies)


@dataclass
class Matches:
    """Matches of two databases with what the classes are derived from."""

    new: DataFrame
    old: DataFrame      # with group_id
    #: EDGE, strategy, visit, propagated, n_new and n_olds (degrees of group and new row), and the
    #: conflict entry that leads the group, if any: entry (a new_id) and its match_class
    edges: DataFrame


def match_databases(new: DataFrame, old: DataFrame) -> Matches:
    """Match, propagate and find the conflict entries.

    A new row with several old ones opens an entry, unless an earlier entry reached
    it; an entry takes all new rows its old rows lead to. Entries share no old group, so the entry
    is a property of the group. Optional old columns that are absent are null.
    """
    absent = {c: F.lit(None).cast("string") for c in OPTIONAL_OLD if c not in old.columns}
    keyed = durable(old_groups(old.withColumns(absent) if absent else old))
    edges = match_edges(new, keyed)
    if "is_duplicate" in new.columns:
        edges = propagate(edges, new)
    else:
        edges = edges.select(*EDGE, "strategy", "visit", F.lit(False).alias("propagated"))
    news = durable(edges)
    reach = news.groupBy("group_id").agg(F.count(F.lit(1)).alias("n_new"))
    degrees = news.groupBy("new_id").agg(F.sum("n_old").alias("n_olds"))
    edges = durable(news.join(reach, "group_id").join(degrees, "new_id"))
    crowded = edges.filter(F.col("n_olds") > 1)
    led = first_come_leaders(crowded.select(
        F.col("place").alias("block"), F.col("group_id").alias("clique"),
        F.col("visit").alias("node")))
    followers = led.filter(F.col("node") != F.col("leader")).select(
        F.col("node.new_id").alias("new_id"))
    leading = crowded.join(followers, "new_id", "left_anti")
    classes = leading.groupBy("new_id").agg(F.max("n_new").alias("_reach")).select(
        F.col("new_id"), F.when(F.col("_reach") == 1, "many_to_one").otherwise("many_to_many")
        .alias("match_class"))
    entries = leading.select("new_id", "group_id").join(classes, "new_id").select(
        "group_id", F.col("new_id").alias("entry"), "match_class")
    return Matches(new, keyed, durable(edges.join(entries, "group_id", "left")))


def conflict_members(m: Matches) -> DataFrame:
    """(match_class, entry, side, member): what belongs to each class entry.

    The entry is the old row for 1-to-many and the leading new row otherwise.
    """
    single = m.edges.filter((F.col("n_olds") == 1) & (F.col("n_new") == 1)).select(
        F.lit("one_to_one").alias("match_class"), F.col("new_id").alias("entry"), "new_id",
        "group_id")
    many = expand_edges(m.edges.filter(F.col("n_new") > 1), m.old)
    shared = many.select(F.lit("one_to_many").alias("match_class"),
                         F.col("old_id").alias("entry"), F.lit("new").alias("side"),
                         F.col("new_id").alias("member"))
    led = m.edges.filter(F.col("entry").isNotNull())
    led_old = expand_edges(
        led.filter(F.col("new_id") == F.col("entry")).select("match_class", "entry", "group_id"),
        m.old).select("match_class", "entry", F.lit("old").alias("side"),
                      F.col("old_id").alias("member"))
    led_new = led.select("match_class", "entry", F.lit("new").alias("side"),
                         F.col("new_id").alias("member")).distinct()
    pairs = expand_edges(single, m.old)
    single_old = pairs.select("match_class", "entry", F.lit("old").alias("side"),
                              F.col("old_id").alias("member"))
    single_new = pairs.select("match_class", "entry", F.lit("new").alias("side"),
                              F.col("new_id").alias("member"))
    return (single_old.unionByName(single_new).unionByName(shared)
            .unionByName(led_old).unionByName(led_new))


# Bits of what applies to a matched new row, strongest colour first.
RED, YELLOW, CYAN, GREEN = 1, 2, 4, 8
COLOURS = {RED: "red", YELLOW: "yellow", CYAN: "cyan", GREEN: "dark_green"}


def _edge_bits() -> Column:
    """Which colours an edge calls for: a led group, a shared old row, a propagated match, other dates."""
    other_day = (F.col("new_day").isNotNull() & (F.col("old_day") != "")
                 & (F.col("old_day") != F.col("new_day")))
    bits = {RED: F.col("entry").isNotNull(), YELLOW: F.col("n_new") > 1,
            CYAN: F.col("propagated"), GREEN: other_day}
    mask = F.lit(0)
    for bit, applies in bits.items():
        mask = mask.bitwiseOR(F.when(applies, bit).otherwise(0))
    return mask


def _colour(mask: Column) -> Column:
    named = F.lit(None).cast("string")
    for bit in sorted(COLOURS, reverse=True):
        named = F.when(mask.bitwiseAND(bit) > 0, COLOURS[bit]).otherwise(named)
    return named


def date_mismatches(m: Matches) -> DataFrame:
    """Matched new rows where the date of a matched old row differs."""
    return m.edges.filter(_edge_bits().bitwiseAND(GREEN) > 0).select("new_id").distinct()


def highlights(m: Matches) -> DataFrame:
    """(new_id, highlight) of matched new rows, the strongest colour that applies."""
    return m.edges.groupBy("new_id").agg(F.bit_or(_edge_bits()).alias("_mask")).select(
        "new_id", _colour(F.col("_mask")).alias("highlight"))


BACKWARD = {
    "dir_to_root": "backward_dir_to_root",
    "id_from_ct": "backward_DONOTPUBLISH_ID_fromCT",
    "old_id": "backward_CT_No_Final",
    "id_hospital": "backward_ID_HOSPITAL",
    "old_date": "backward_date",
}


def merged_table(m: Matches) -> DataFrame:
    """Outer merge of both databases in six sections, with the highlight of each row.

    Clean and 1-to-many matches carry the old columns; conflicting new rows stay
    unmerged; old rows in conflicts are only in the conflict members.
    """
    kinds = "struct<section_no:int,section:string,group_id:bigint>"

    def section(number: int | Column, name: str | Column, group: Column) -> Column:
        return F.struct(
            (number if isinstance(number, Column) else F.lit(number)).cast("int")
            .alias("section_no"), (name if isinstance(name, Column) else F.lit(name))
            .alias("section"), group.cast("bigint").alias("group_id")).cast(kinds)

    group, alone = F.col("group_id"), F.lit(None).cast("bigint")
    merged = F.when(F.col("n_new") > 1, section(2, "one_to_many", group)).when(
        F.col("n_olds") == 1, section(1, "one_to_one", group))
    led = F.when(F.col("entry").isNotNull(), F.struct(F.col("entry"), section(
        F.when(F.col("match_class") == "many_to_one", 3).otherwise(4), F.col("match_class"), alone)
        .alias("place")))
    # everything about a new row in one aggregate: colour, old groups to merge, conflict entries
    facts = m.edges.groupBy("new_id").agg(
        F.bit_or(_edge_bits()).alias("_mask"), F.collect_list(merged).alias("_merged"),
        F.collect_set(led).alias("_led"))
    facts = facts.select("new_id", _colour(F.col("_mask")).alias("highlight"), F.concat(
        F.col("_merged"), F.transform("_led", lambda x: x["place"])).alias("_places"))
    untouched = F.array(section(5, "unmatched_new", alone))
    placed = m.new.join(facts, "new_id", "left").withColumn(
        "_place", F.explode(F.coalesce("_places", untouched))).select(
        *m.new.columns, "highlight", "_place.*")
    back = m.old.select("group_id", *[F.col(c).alias(a) for c, a in BACKWARD.items()])
    new_rows = placed.join(back, "group_id", "left").drop("group_id")
    used = m.edges.filter((F.col("n_new") > 1) | (F.col("n_olds") == 1)
                          | F.col("entry").isNotNull()).select("group_id").distinct()
    only_old = m.old.join(used, "group_id", "left_anti").select(
        "hospital", *[F.col(c).alias(a) for c, a in BACKWARD.items()],
        F.lit(6).alias("section_no"), F.lit("unmatched_old").alias("section"))
    return new_rows.unionByName(only_old, allowMissingColumns=True)


def highlight_counts(merged: DataFrame) -> DataFrame:
    return (merged.filter(F.col("highlight").isNotNull())
            .groupBy("highlight").agg(F.count(F.lit(1)).alias("rows")))


def match_class_counts(m: Matches) -> DataFrame:
    """Number of entries per class."""
    return conflict_members(m).select("match_class", "entry").distinct().groupBy(
        "match_class").agg(F.count(F.lit(1)).alias("entries"))


def conflict_log(m: Matches) -> DataFrame:
    """Conflicts, one row per old or new row that takes part.

    The old row of a 1-to-many entry is listed as a member of its own entry.
    """
    crowded = m.edges.filter(F.col("n_new") > 1).select("group_id").distinct()
    shared_old = expand_edges(crowded, m.old).select(
        F.lit("one_to_many").alias("match_class"), F.col("old_id").alias("entry"),
        F.lit("old").alias("side"), F.col("old_id").alias("member"))
    return conflict_members(m).filter(F.col("match_class") != "one_to_one").select(
        "match_class", "entry", "side", "member").unionByName(shared_old)
