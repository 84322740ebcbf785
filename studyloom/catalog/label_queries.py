"""Queries over series labels."""

from __future__ import annotations


from pyspark.sql import DataFrame, functions as F

from studyloom.catalog.fixtures import Tables
from studyloom.catalog.registry import query
from studyloom.functions import label_rules as rules, labels
from studyloom.operators.top import top_per_group


def _any(column: str, words: list[str]) -> str:
    return "(" + " or ".join(f"contains({column}, '{w}')" for w in words) + ")"


def _find(column: str, patterns: list[str]) -> str:
    return "(" + " or ".join(f"regexp_matches({column}, '{p}')" for p in patterns) + ")"


def _case(rungs: list[tuple[str, str, float]]) -> tuple[str, str]:
    """SQL for label and confidence of a list of (condition, label, confidence)."""
    label = " ".join(f"when {c} then '{v}'" for c, v, _ in rungs)
    sure = " ".join(f"when {c} then {s}" for c, _, s in rungs)
    return f"(case {label} else 'UNKNOWN' end)", f"(case {sure} else 0.0 end)::double"


ORIGIN = _case([(_any("im", w), k, 1.0) for k, w in rules.ORIGIN.items()])
RECON = _case([
    ("im is null", "UNKNOWN", 0.0),
    *[(_any("im", w), k, 1.0) for k, w in rules.RECONSTRUCTION.items()],
    ("contains(se, 'MPR')", "MPR", 0.9), (_any("se", ["COR", "SAG"]), "MPR", 0.8),
    ("contains(se, 'MIP')", "MIP", 0.9), (_any("se", ["3D", "VOLUME"]), "VOLUME", 0.8),
    ("contains(im, 'AXIAL')", "AXIAL", 0.6)])
STUDY = _case([
    (_any("st", ["WOWITH", "WITHOUT_WITH", "WW"]), "YES", 0.98),
    (_any("st", rules.STUDY_CONTRAST_NO) + " and not contains(st, 'WITH')", "NO", 0.95),
    (_any("st", rules.STUDY_CONTRAST_YES), "YES", 0.95),
    (_any("pr", rules.STUDY_CONTRAST_NO), "NO", 0.9),
    (_any("pr", rules.STUDY_CONTRAST_YES), "YES", 0.9)])
SERIES = _case([
    ("study_label = 'NO'", "NO", 0.95),
    ("se is null and study_label = 'YES'", "YES", 0.5), ("se is null", "UNKNOWN", 0.0),
    (_any("se", ["W/O", "WITHOUT"]) + " or ends_with(se, ' WO')", "NO", 0.95),
    ("contains(se, 'CE') and " + _any("se", ["1.", "2.", "3.", "4.", "5.", "10."]), "YES", 0.95),
    (_any("se", ["CORONAL C", "COR C"]), "YES", 0.9), (_any("se", ["+C"]), "YES", 0.9),
    (_any("se", rules.SERIES_CONTRAST_NO), "NO", 0.9),
    (_any("se", rules.SERIES_CONTRAST_YES), "YES", 0.9),
    (_any("se", rules.PHASE["NON_CONTRAST"]), "NO", 0.85),
    (_any("se", rules.PHASE["ARTERIAL"] + rules.PHASE["VENOUS"] + rules.PHASE["PORTAL"]
          + rules.PHASE["DELAY"]), "YES", 0.85),
    ("contains(se, 'PHASE')", "YES", 0.7), ("study_label = 'YES'", "YES", 0.6)])
ORIENT = _case([("contains(im, 'AXIAL')", "AXIAL", 0.8),
                *[(_find("se", p), k, 0.9) for k, p in rules.ORIENTATION.items()]])
PHASE = _case([
    *[(_any("se", w), k, 0.9) for k, w in rules.PHASE.items()],
    ("try_cast(regexp_extract(se, '(\\d+)\\s*MIN', 1) as bigint) >= 3", "DELAY", 0.8),
    (_any("se", ["3M", "3 MM"]), "DELAY", 0.7), (_any("se", ["15 MIN", "7MIN"]), "DELAY", 0.8)])
BODY = _case([
    *[(f"bp = '{k}'", v, 1.0) for k, v in rules.BODY_PART_NAMES.items()],
    *[(_find("st", p), k, 0.85) for k, p in rules.BODY_PART.items()],
    *[(_find("pr", p), k, 0.85) for k, p in rules.BODY_PART.items()]])

UPPER_SQL = f"""uppered as (select *, upper(image_type) as im, upper(study_series_description) as se, upper(study_description) as st, upper(study_protocol) as pr, upper(study_body_part) as bp from label_text),
studied as (select *, {STUDY[0]} as study_label, {STUDY[1]} as study_sure, try_cast(parsed_slice_thickness as double) as th,
  try_cast(regexp_extract(study_series_description, '(\\d+\\.?\\d*)', 1) as double) as num from uppered),
rated as (select series_id, {ORIGIN[0]} as l1, {ORIGIN[1]} as c1, {RECON[0]} as l2, {RECON[1]} as c2,
  case when th > 0 then th else num end as l3, case when th > 0 then 1.0 when num is not null then 0.7 else 0.0 end::double as c3,
  study_label as l4, study_sure as c4, {SERIES[0]} as l5, {SERIES[1]} as c5, {ORIENT[0]} as l6, {ORIENT[1]} as c6,
  {PHASE[0]} as l7, {PHASE[1]} as c7, {BODY[0]} as l8, {BODY[1]} as c8 from studied)"""


def _register(number: int, name: str, label: str) -> None:
    @query(name, "label_text", f"with {UPPER_SQL} select series_id, l{number} as label, "
                               f"c{number} as confidence from rated")
    def build(t: Tables) -> DataFrame:
        found = F.col(f"_l_{label}")
        return labels.raw_labels(t.label_text).select(
            "series_id", found["label"].alias("label"),
            found["confidence"].alias("confidence"))


for _number, (_name, _label) in enumerate({
        "label_origin": "image_origin", "label_reconstruction": "reconstruction_type",
        "label_thickness": "slice_thickness_mm",
        "label_study_contrast": "study_contrast_enhanced",
        "label_series_contrast": "series_contrast_enhanced",
        "label_orientation": "image_orientation", "label_phase": "contrast_phase",
        "label_body_part": "standardized_body_part"}.items(), start=1):
    _register(_number, _name, _label)

GATED = ", ".join(
    (f"case when c{i} >= 0.7 then l{i} end as {label}" if i == 3 else
     f"case when c{i} >= 0.7 then l{i} else 'UNKNOWN' end as {label}") + f", c{i} as {sure}"
    for i, (label, sure) in enumerate(labels.LABEL_COLUMNS, start=1))


@query("label_all", "label_text", f"with {UPPER_SQL} select series_id, {GATED} from rated")
def label_all(t: Tables) -> DataFrame:
    labelled = labels.label_series(t.label_text)
    return labelled.select("series_id", *[c for pair in labels.LABEL_COLUMNS for c in pair])


COUNTS = " union all ".join(
    f"select '{label}' as label_column, cast({label} as varchar) as value from gated"
    for label, _ in labels.LABEL_COLUMNS)
COUNTS_SQL = f"""{UPPER_SQL}, gated as (select series_id, {GATED} from rated),
counts as (select label_column, value, count(*) as rows from ({COUNTS}) x where value is not null group by 1, 2)"""


@query("label_distribution", "label_text", f"with {COUNTS_SQL} select * from counts")
def label_distribution(t: Tables) -> DataFrame:
    return labels.label_counts(labels.label_series(t.label_text))


@query("label_top10", "label_text", f"""with {COUNTS_SQL}
select * from (select *, row_number() over (partition by label_column order by rows desc, value) as rank from counts) x where rank <= 10
""")
def label_top10(t: Tables) -> DataFrame:
    counts = labels.label_counts(labels.label_series(t.label_text))
    return top_per_group(counts, "label_column", "rows", "value")


