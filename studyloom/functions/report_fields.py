"""Fields of a report read by ordered patterns, and the checks on an extraction result."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from studyloom.functions import jsontext
from studyloom.functions.staging import computed_once
from studyloom.functions.text import strip
from studyloom.schemas import EXTRACTION_SCHEMA

# Patterns per field, tried in order, ignoring case.
STUDY_COUNT = [
    r'"number_of_studies"[:\s]*(\d+)',
    r"number_of_studies[:\s]*(\d+)",
    r"(\d+)\s*stud(?:y|ies)",
]
MODALITY_QUOTED = [
    r'"imaging_modality"[:\s]*"([^"]+)"',
    r'imaging_modality[:\s]*"([^"]+)"',
]
MODALITY_WORD = [r"\b(CT|MRI|X-ray|Ultrasound|PET|SPECT|Mammography)\b"]
MODALITY_NAMES = ["CT", "MRI", "X-RAY", "ULTRASOUND", "PET", "SPECT", "MAMMOGRAPHY"]
BODY = [
    r'"body_part"[:\s]*"([^"]+)"',
    r'body_part[:\s]*"([^"]+)"',
    r"\b(Head|Neck|Chest|Abdomen|Pelvis|Spine|Extremities)\b",
]
NAME = [
    r'"name"[:\s]*"([^"]+)"',
    r'patient[:\s]*name[:\s]*"([^"]+)"',
    r"PATIENT\s+NAME[:\s]*([^\n,]+)",
]
AGE = [
    r'"age"[:\s]*"([^"]+)"',
    r'age[:\s]*"([^"]+)"',
    r"AGE[:\s]*([^\n,]+)",
    r"(\d+)\s*years?\s*old",
    r"(\d+)y",
]
GENDER = [
    r'"gender"[:\s]*"([^"]+)"',
    r'gender[:\s]*"([^"]+)"',
    r"GENDER[:\s]*([^\n,]+)",
    r"\b(Male|Female|M|F)\b",
]
CONTRAST = [
    r'("contrast_used"[:\s]*(?:true|false))',
    r"(contrast[:\s]*(?:true|false))",
    r"(with\s+contrast)",
    r"(contrast\s+material)",
]

# Members of the two result enumerations.
MODALITIES = ["CT", "MRI", "X-ray", "Ultrasound", "PET", "SPECT", "Mammography", "Fluoroscopy",
              "Nuclear Medicine", "Other", "Unknown"]
BODY_PARTS = ["Head", "Neck", "Chest", "Abdomen", "Pelvis", "Spine", "Extremities",
              "Whole Body", "Abdomen and Pelvis", "Chest, Abdomen and Pelvis", "Other",
              "Unknown"]

# Documents shorter than this after trimming are not read.
SHORTEST_DOCUMENT = 10
SHORT_MESSAGE = "Document is empty or too short (less than 10 characters)"


def first_match(text: Column, patterns: Sequence[str]) -> Column:
    """Group 1 of the first pattern that is found; null if none is."""
    found = [F.nullif(F.regexp_extract(text, "(?iU)" + p, 1), F.lit("")) for p in patterns]
    return F.coalesce(*found)


def read_fields(text: Column) -> dict[str, Column]:
    """Raw field values of a report text."""
    quoted = [F.upper(first_match(text, [p])) for p in MODALITY_QUOTED]
    named = [F.when(q.isin(MODALITY_NAMES), q) for q in quoted]
    gender = F.lower(strip(first_match(text, GENDER)))
    contrast = F.lower(first_match(text, CONTRAST))
    return {
        "number_of_studies": F.coalesce(
            first_match(text, STUDY_COUNT).try_cast("int"), F.lit(0)),
        "modality": F.coalesce(*named, F.upper(first_match(text, MODALITY_WORD)),
                               F.lit("Unknown")),
        "body_part": F.coalesce(F.initcap(first_match(text, BODY)), F.lit("Unknown")),
        "name": strip(first_match(text, NAME)),
        "age": strip(first_match(text, AGE)),
        "gender": F.when(gender.isin("male", "m"), "Male")
        .when(gender.isin("female", "f"), "Female"),
        "contrast_used": F.when(contrast.contains("true") | contrast.contains("with contrast"),
                                True).when(contrast.contains("false"), False),
    }


def has_fields(count: Column, modality: Column, name: Column, age: Column) -> Column:
    """A reading counts if one of study count, modality, name and age was found."""
    return ((count > 0) | (modality != "Unknown")
            | F.coalesce(name != "", F.lit(False)) | F.coalesce(age != "", F.lit(False)))


def checked_modality(c: Column) -> Column:
    """Upper-cased modality where that is a member, else Unknown."""
    name = F.upper(c)
    return F.when(name.isin(MODALITIES), name).otherwise(F.lit("Unknown"))


def checked_body_part(c: Column) -> Column:
    """Title-cased body part where that is a member, else Unknown."""
    name = F.initcap(c)
    return F.when(name.isin(BODY_PARTS), name).otherwise(F.lit("Unknown"))


def extraction(**fields: Column) -> Column:
    """Extraction struct with checked modality and body part and empty lists by default."""
    no_list = F.array().cast("array<string>")
    text = F.lit(None).cast("string")
    ids = fields.get("ids", F.array().cast("array<struct<id_value:string,id_type:string>>"))
    return F.struct(
        F.coalesce(fields.get("number_of_studies", F.lit(0)), F.lit(0)).cast("int")
        .alias("number_of_studies"),
        fields.get("imaging_indication", text).alias("imaging_indication"),
        checked_modality(fields.get("modality", text)).alias("imaging_modality"),
        checked_body_part(fields.get("body_part", text)).alias("body_part"),
        F.coalesce(fields.get("current_disease_list", no_list), no_list)
        .alias("current_disease_list"),
        F.coalesce(fields.get("previous_disease_list", no_list), no_list)
        .alias("previous_disease_list"),
        F.coalesce(fields.get("previous_interventions", no_list), no_list)
        .alias("previous_interventions"),
        F.struct(
            fields.get("name", text).alias("name"),
            F.coalesce(ids, F.array().cast("array<struct<id_value:string,id_type:string>>"))
            .alias("ids"),
            text.alias("patient_number"),
            fields.get("age", text).alias("age"),
            fields.get("gender", text).alias("gender"),
        ).alias("patient_info"),
        fields.get("contrast_used", F.lit(None).cast("boolean")).alias("contrast_used"),
        fields.get("findings_summary", text).alias("findings_summary"),
        fields.get("impression", text).alias("impression"),
    )


def from_fields(f: Column) -> Column:
    """Extraction from the struct of `read_fields`; null if nothing was found."""
    return F.when(has_fields(f["number_of_studies"], f["modality"], f["name"], f["age"]),
                  extraction(**{k: f[k] for k in FIELD_NAMES}))


def with_text_extraction(df: DataFrame, text: Column, alias: str,
                         when: Column | None = None) -> DataFrame:
    """Add the extraction read by patterns, where `when` holds."""
    raw = F.struct(*[c.alias(k) for k, c in read_fields(text).items()])
    staged = computed_once(df, _fields=raw if when is None else F.when(when, raw))
    return computed_once(staged, **{alias: F.when(
        F.col("_fields").isNotNull(), from_fields(F.col("_fields")))}).drop("_fields")


def from_parsed(parsed: Column) -> Column:
    """Extraction from a parsed JSON object of the result layout."""
    info = parsed["patient_info"]
    return F.when(parsed.isNotNull(), extraction(
        number_of_studies=parsed["number_of_studies"],
        imaging_indication=parsed["imaging_indication"], modality=parsed["imaging_modality"],
        body_part=parsed["body_part"], current_disease_list=parsed["current_disease_list"],
        previous_disease_list=parsed["previous_disease_list"],
        previous_interventions=parsed["previous_interventions"],
        name=info["name"], age=info["age"], gender=info["gender"],
        ids=F.transform(info["ids"], lambda i: F.struct(
            F.coalesce(i["id_value"], F.lit("")).alias("id_value"),
            F.coalesce(i["id_type"], F.lit("Unknown")).alias("id_type"))),
        contrast_used=parsed["contrast_used"], findings_summary=parsed["findings_summary"],
        impression=parsed["impression"]))


FIELD_NAMES = ["number_of_studies", "modality", "body_part", "name", "age", "gender",
               "contrast_used"]
LIST_FIELDS = ["current_disease_list", "previous_disease_list", "previous_interventions",
               "patient_info"]


def from_pairs(pairs: Column, keep_modality_hint: bool = True) -> Column:
    """Extraction from salvaged pairs; null if there are none or a list field was cut open.

    A salvaged modality is written under another key than the one read later; with
    `keep_modality_hint` it is used, without it is lost as in the original layout.
    """
    def value(key: str) -> Column:
        return F.try_element_at(pairs, F.lit(key))

    modality = value("imaging_modality")
    if keep_modality_hint:
        modality = F.coalesce(modality, value("modality"))
    count = value("number_of_studies")
    broken = F.lit(False)
    for key in LIST_FIELDS:
        broken = broken | F.map_contains_key(pairs, key)
    flag = value("contrast_used")
    usable = pairs.isNotNull() & ~broken & (count.isNull() | count.try_cast("int").isNotNull())
    return F.when(usable, extraction(
        number_of_studies=count.try_cast("int"), imaging_indication=value("imaging_indication"),
        modality=modality, body_part=value("body_part"),
        contrast_used=F.when(flag == "true", True).when(flag == "false", False),
        findings_summary=value("findings_summary"), impression=value("impression")))


def from_structured(body: Column, parsed: Column) -> Column:
    """Extraction from a response that is one valid JSON object with known enum values."""
    valid = (
        body.startswith("{") & F.try_parse_json(body).isNotNull()
        & (parsed["imaging_modality"].isNull() | parsed["imaging_modality"].isin(MODALITIES))
        & (parsed["body_part"].isNull() | parsed["body_part"].isin(BODY_PARTS))
    )
    # Members are taken as they are, without changing their case.
    exact = from_parsed(parsed).withField("imaging_modality", F.coalesce(
        parsed["imaging_modality"], F.lit("Unknown"))).withField(
        "body_part", F.coalesce(parsed["body_part"], F.lit("Unknown")))
    return F.when(valid, exact)


def minimal(text: Column) -> Column:
    """The made-up default of last resort; only for callers that ask for it."""
    return F.when(text.isNotNull(), extraction(
        number_of_studies=F.lit(1), modality=F.lit("CT"), body_part=F.lit("Chest"),
        findings_summary=F.lit(
            "Unable to extract detailed findings - model returned empty response")))


def converts(candidate: Column) -> Column:
    """Whether a JSON object has a countable number of studies and lists where lists belong."""
    keys = F.json_object_keys(candidate)

    def member(key: str, good: Column) -> Column:
        return ~F.array_contains(keys, key) | F.coalesce(good, F.lit(False))

    count = F.get_json_object(candidate, "$.number_of_studies").try_cast("double")
    fits = member("number_of_studies", count.isNotNull())
    for key in LIST_FIELDS:
        opening = "{" if key == "patient_info" else "["
        fits = fits & member(key, F.get_json_object(candidate, f"$.{key}").startswith(opening))
    return fits


def _with_json_extraction(df: DataFrame, text: Column, alias: str, when: Column) -> DataFrame:
    """Add the extraction from salvaged pairs, else from the first JSON object that parses."""
    paired = computed_once(df, _pairs=F.when(when, jsontext.salvage_pairs(text)))
    hinted = computed_once(paired, _hinted=F.when(
        F.col("_pairs").isNotNull(), jsontext.add_hints(F.col("_pairs"), text)))
    salvaged = computed_once(hinted, _salvaged=from_pairs(F.col("_hinted")))
    parsed = computed_once(salvaged, _parsed=F.when(
        when & F.col("_salvaged").isNull(),
        F.from_json(jsontext.first_valid_json(text, converts), EXTRACTION_SCHEMA)))
    return computed_once(parsed, **{alias: F.coalesce(
        "_salvaged", from_parsed(F.col("_parsed")))}).drop(
        "_pairs", "_hinted", "_salvaged", "_parsed")


def parse_responses(df: DataFrame, content: str = "content", reasoning: str = "reasoning",
                    allow_minimal: bool = False) -> DataFrame:
    """Add `extraction_data` and `parsing_method` by the first strategy that succeeds.

    Each strategy is only evaluated for the rows that reach it.
    """
    first, second = F.col(content), F.col(reasoning)
    body = computed_once(df, _body=jsontext.strip_fence(first))
    parsed = computed_once(body, _json=F.when(
        F.col("_body").startswith("{"), F.from_json("_body", EXTRACTION_SCHEMA)))
    step = computed_once(parsed, _s1=from_structured(F.col("_body"), F.col("_json")))
    step = _with_json_extraction(step, first, "_s2", F.col("_s1").isNull())
    step = _with_json_extraction(step, second, "_s3",
                                 F.col("_s1").isNull() & F.col("_s2").isNull())
    open_row = F.col("_s1").isNull() & F.col("_s2").isNull() & F.col("_s3").isNull()
    step = with_text_extraction(step, F.concat_ws(" ", first, second), "_s4", open_row)
    last = minimal(F.coalesce(first, F.lit(""))) if allow_minimal else F.lit(None)
    step = step.withColumn("_s5", last)
    found = [F.col(f"_s{i}").isNotNull() for i in range(1, 6)]
    # Names of the strategies, in order.
    names = ["structured", "content_json", "reasoning_json", "intelligent_parsing",
             "minimal_extraction"]
    method = F.when(found[0], names[0])
    for hit, name in zip(found[1:], names[1:]):
        method = method.when(hit, name)
    chosen = [F.col(f"_s{i}") for i in range(1, 6 if allow_minimal else 5)]
    return step.withColumns({"extraction_data": F.coalesce(*chosen), "parsing_method": method}) \
        .drop("_body", "_json", "_s1", "_s2", "_s3", "_s4", "_s5")
