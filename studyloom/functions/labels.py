"""Series labels as columns: each labeller is a ladder of conditions, first hit wins.

A rung is one condition over an upper-cased text; the words of a rung are joined
into one pattern, so a ladder of hundreds of words stays a short expression. Every
labeller returns a struct of label and confidence.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

from studyloom.functions import label_rules as rules

UNKNOWN = "UNKNOWN"


def has_any(text: Column, words: Iterable[str]) -> Column:
    """Text contains one of the words."""
    return text.rlike("|".join(re.escape(w) for w in words))


def finds_any(text: Column, patterns: Iterable[str]) -> Column:
    """One of the regular expressions is found in the text."""
    return text.rlike("|".join(patterns))


def ladder(rungs: Sequence[tuple[Column, str | Column, float]],
           default: tuple[str | None, float] = (UNKNOWN, 0.0)) -> Column:
    """First rung whose condition holds, as a (label, confidence) struct."""
    def made(label: str | Column | None, confidence: float) -> Column:
        value = label if isinstance(label, Column) else F.lit(label)
        return F.struct(value.cast("string").alias("label"),
                        F.lit(confidence).alias("confidence"))

    chosen = None
    for condition, label, confidence in rungs:
        chosen = (F.when if chosen is None else chosen.when)(condition, made(label, confidence))
    return chosen.otherwise(made(*default))


def image_origin(image_type: Column) -> Column:
    image = F.upper(image_type)
    return ladder([(has_any(image, words), label, 1.0)
                   for label, words in rules.ORIGIN.items()])


def reconstruction_type(image_type: Column, series: Column) -> Column:
    image, text = F.upper(image_type), F.upper(series)
    return ladder([
        (image.isNull(), UNKNOWN, 0.0),
        *[(has_any(image, words), label, 1.0)
          for label, words in rules.RECONSTRUCTION.items()],
        (text.contains("MPR"), "MPR", 0.9),
        (has_any(text, ["COR", "CORONAL", "SAG", "SAGITTAL"]), "MPR", 0.8),
        (text.contains("MIP"), "MIP", 0.9),
        (has_any(text, ["3D", "VOLUME"]), "VOLUME", 0.8),
        (image.contains("AXIAL"), "AXIAL", 0.6),
    ])


def slice_thickness(parsed: Column, series: Column) -> Column:
    """Thickness in mm: the parsed value, else the first number in the series text."""
    value = parsed.try_cast("double")
    number = F.regexp_extract(series, r"(\d+\.?\d*)", 1).try_cast("double")

    def made(v: Column, confidence: float) -> Column:
        return F.struct(v.alias("label"), F.lit(confidence).alias("confidence"))

    return (F.when(value > 0, made(value, 1.0))
            .when(number.isNotNull(), made(number, 0.7))
            .otherwise(made(F.lit(None).cast("double"), 0.0)))


def study_contrast(study: Column, protocol: Column) -> Column:
    """`WITHOUT` contains `WITH`, so a plain "without" text counts as contrast."""
    text, steps = F.upper(study), F.upper(protocol)
    return ladder([
        (has_any(text, rules.STUDY_CONTRAST_BOTH), "YES", 0.98),
        (has_any(text, rules.STUDY_CONTRAST_NO) & ~text.contains("WITH"), "NO", 0.95),
        (has_any(text, rules.STUDY_CONTRAST_YES), "YES", 0.95),
        (has_any(steps, rules.STUDY_CONTRAST_NO), "NO", 0.9),
        (has_any(steps, rules.STUDY_CONTRAST_YES), "YES", 0.9),
    ])


def _timing(text: Column, fixed_timing: bool) -> Column:
    """Seconds or minutes number; off by default, as it is never found in upper-case text."""
    if not fixed_timing:
        return F.lit(None).cast("bigint")
    return F.regexp_extract(text, r"(\d+)\s*[SM]", 1).try_cast("bigint")


def series_contrast(series: Column, study_label: Column, fixed_timing: bool = False) -> Column:
    text = F.upper(series)
    enhanced = [w for phase in rules.ENHANCED_PHASES for w in rules.PHASE[phase]]
    return ladder([
        (study_label == "NO", "NO", 0.95),
        (text.isNull() & (study_label == "YES"), "YES", 0.5),
        (text.isNull(), UNKNOWN, 0.0),
        (has_any(text, ["W/O", "WITHOUT"]) | text.endswith(" WO"), "NO", 0.95),
        (text.contains("CE") & has_any(text, rules.ENHANCED_DOSES), "YES", 0.95),
        (has_any(text, ["CORONAL C", "COR C"]), "YES", 0.9),
        (has_any(text, ["+C", "+CM"]), "YES", 0.9),
        (has_any(text, rules.SERIES_CONTRAST_NO), "NO", 0.9),
        (has_any(text, rules.SERIES_CONTRAST_YES), "YES", 0.9),
        (has_any(text, rules.PHASE["NON_CONTRAST"]), "NO", 0.85),
        (has_any(text, enhanced), "YES", 0.85),
        (_timing(text, fixed_timing).isNotNull() | text.contains("PHASE"), "YES", 0.7),
        (study_label == "YES", "YES", 0.6),
    ])


def image_orientation(image_type: Column, series: Column) -> Column:
    text = F.upper(series)
    return ladder([
        (F.upper(image_type).contains("AXIAL"), "AXIAL", 0.8),
        *[(finds_any(text, patterns), label, 0.9)
          for label, patterns in rules.ORIENTATION.items()],
    ])


def contrast_phase(series: Column, fixed_timing: bool = False) -> Column:
    text = F.upper(series)
    timing = _timing(text, fixed_timing)
    minutes = F.regexp_extract(text, r"(\d+)\s*MIN", 1).try_cast("bigint")
    return ladder([
        *[(has_any(text, words), label, 0.9) for label, words in rules.PHASE.items()],
        (timing <= 30, "ARTERIAL", 0.8),
        (timing.between(60, 90), "PORTAL", 0.8),
        (timing > 120, "DELAY", 0.8),
        (minutes >= 3, "DELAY", 0.8),
        (has_any(text, ["3M", "3 MM"]), "DELAY", 0.7),
        (has_any(text, ["15 MIN", "7MIN"]), "DELAY", 0.8),
    ])


def body_part(part: Column, study: Column, protocol: Column) -> Column:
    name = F.upper(part)
    named = [(name == source, label, 1.0) for source, label in rules.BODY_PART_NAMES.items()]
    found = [(finds_any(F.upper(text), patterns), label, 0.85)
             for text in (study, protocol) for label, patterns in rules.BODY_PART.items()]
    return ladder([*named, *found])


# Label column, confidence column.
LABEL_COLUMNS = [
    ("image_origin", "image_origin_confidence"),
    ("reconstruction_type", "reconstruction_confidence"),
    ("slice_thickness_mm", "thickness_confidence"),
    ("study_contrast_enhanced", "study_contrast_confidence"),
    ("series_contrast_enhanced", "series_contrast_confidence"),
    ("image_orientation", "orientation_confidence"),
    ("contrast_phase", "phase_confidence"),
    ("standardized_body_part", "body_part_confidence"),
]


def raw_labels(df: DataFrame, fixed_timing: bool = False) -> DataFrame:
    """Add one (label, confidence) struct `_l_<label column>` per labeller."""
    image, series = F.col("image_type"), F.col("study_series_description")
    study, protocol = F.col("study_description"), F.col("study_protocol")
    with_study = df.withColumn("_l_study_contrast_enhanced", study_contrast(study, protocol))
    return with_study.withColumns({
        "_l_image_origin": image_origin(image),
        "_l_reconstruction_type": reconstruction_type(image, series),
        "_l_slice_thickness_mm": slice_thickness(F.col("parsed_slice_thickness"), series),
        "_l_series_contrast_enhanced": series_contrast(
            series, F.col("_l_study_contrast_enhanced.label"), fixed_timing),
        "_l_image_orientation": image_orientation(image, series),
        "_l_contrast_phase": contrast_phase(series, fixed_timing),
        "_l_standardized_body_part": body_part(F.col("study_body_part"), study, protocol),
    })


def label_series(df: DataFrame, fixed_timing: bool = False,
                 keep_from: float = rules.KEEP_FROM) -> DataFrame:
    """Add the eight labels and their confidences; weak labels become UNKNOWN or null."""
    labelled = raw_labels(df, fixed_timing)
    columns: list[Column] = []
    for label, confidence in LABEL_COLUMNS:
        found = F.col(f"_l_{label}")
        weak = F.lit(None) if label == "slice_thickness_mm" else F.lit(UNKNOWN)
        columns.append(F.when(found["confidence"] >= keep_from, found["label"])
                       .otherwise(weak).alias(label))
        columns.append(found["confidence"].alias(confidence))
    return labelled.select(*df.columns, *columns)


def label_counts(labelled: DataFrame) -> DataFrame:
    """Rows per value of every label column, in one pass."""
    pairs = F.array(*[F.struct(F.lit(label).alias("label_column"),
                               F.col(label).cast("string").alias("value"))
                      for label, _ in LABEL_COLUMNS])
    return (labelled.select(F.explode(pairs).alias("_p"))
            .select("_p.label_column", "_p.value").filter(F.col("value").isNotNull())
            .groupBy("label_column", "value").agg(F.count(F.lit(1)).alias("rows")))
