"""Series of a study: order, spacing, analysis table, readiness, tracker, affine, volumes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from studyloom.functions import geometry as geo, privacy
from studyloom.functions.staging import computed_once
from studyloom.operators.skew import (
    large_groups, match_keys, number_rows, previous_value, spread_groups)
from studyloom.session import durable

ORDER = ("line_no", "file_path")
# Spread of the gaps up to which a series is evenly spaced, as a share of the mean.
EVEN_GAPS = 0.05
EVEN_LOCATIONS = 0.1
# A series of at most this many slices is not converted.
FEW_SLICES = 10


def selected_studies(studies: DataFrame) -> DataFrame:
    return studies.filter(F.col("final_selection") == 1)


def study_slices(studies: DataFrame, slices: DataFrame,
                 keys: Sequence[str] = ("source_folder", "source_file")) -> DataFrame:
    """Slices of the given studies."""
    return slices.join(studies, list(keys))


def series_key(c: Column) -> Column:
    return F.coalesce(c, F.lit("unknown"))


def slice_positions(slices: DataFrame) -> DataFrame:
    """Add `slice_position` and `has_orientation`; null where the position is unreadable."""
    parsed = computed_once(
        slices, _iop=geo.parse_orientation(F.col("image_orientation_patient")),
        _ipp=geo.parse_position(F.col("image_position_patient")))
    directed = computed_once(parsed, _direction=geo.slice_direction(F.col("_iop")))
    placed = computed_once(
        directed, slice_position=geo.slice_position(F.col("_ipp"), F.col("_direction")),
        has_orientation=F.col("_iop").isNotNull(), has_position=F.col("_ipp").isNotNull())
    return placed.drop("_iop", "_ipp", "_direction")


def gap_cells(slices: DataFrame, keys: Sequence[str],
              position: str = "slice_position") -> DataFrame:
    """Distinct positions of a series with their slices and the gap to the one before.

    Slices at one position are counted first, so copies never reach the ordered step.
    The counts are written out, as the split of large series reads them again.
    """
    cells = durable(
        slices.filter(F.col(position).isNotNull())
        .groupBy(*keys, position).agg(F.count(F.lit(1)).alias("n_slices"))
    )
    return previous_value(cells, keys, position, "previous_position").withColumn(
        "gap", F.abs(F.col(position) - F.col("previous_position")))


def _cell_figures(cells: DataFrame, keys: Sequence[str], name: str) -> DataFrame:
    """As `_gap_figures`, from distinct positions.

    A position held by k slices adds k - 1 gaps of zero; their effect on mean and
    variance is added in closed form.
    """
    grouped = cells.groupBy(*keys).agg(
        F.count("gap").alias("_n"), F.coalesce(F.avg("gap"), F.lit(0.0)).alias("_mean"),
        F.coalesce(F.var_pop("gap"), F.lit(0.0)).alias("_var"),
        F.min("gap").alias("_min"), F.coalesce(F.max("gap"), F.lit(0.0)).alias("_max"),
        F.sum(F.col("n_slices") - 1).alias("_zeros"))
    n, zeros, mean = F.col("_n"), F.col("_zeros"), F.col("_mean")
    total = n + zeros
    values = {
        "n": total, "mean": mean * n / total,
        "var": (n * F.col("_var") + mean * mean * n * zeros / total) / total,
        "min": F.when(zeros > 0, F.lit(0.0)).otherwise(F.col("_min")), "max": F.col("_max")}
    return grouped.filter(total > 0).select(
        *keys, *[v.alias(f"{name}_{k}") for k, v in values.items()])


def _gap_figures(gap: str, name: str) -> list[Column]:
    """Number, mean, population variance and range of the gaps between neighbours."""
    return [f.alias(f"{name}_{k}") for k, f in (
        ("n", F.count(gap)), ("mean", F.avg(gap)), ("var", F.var_pop(gap)),
        ("min", F.min(gap)), ("max", F.max(gap)))]


def series_facts(slices: DataFrame, keys: Sequence[str],
                 more: Sequence[str | Column] = ()) -> DataFrame:
    """Narrow, typed facts of the slices, parsed and written once for all later figures."""
    return durable(slice_positions(slices).select(
        *keys, "slice_position", "has_orientation", *more))


def series_figures(facts: DataFrame, keys: Sequence[str], positions: dict[str, str],
                   *figures: Column) -> DataFrame:
    """One row per series: `figures` and, for each name and column of `positions`, its gaps
    (`<name>_n`, `_mean`, `_var`, `_min`, `_max`; null or 0 without a gap).

    One exchange by the series key serves the ordering by every position and the figures. Series
    above a row limit are counted out first: their figures are combined before the exchange, and
    their ordered step sees distinct positions only, in stretches.
    """
    large = large_groups(facts, keys)
    ordinary = facts if large is None else _matching(facts, large, keys, "left_anti")
    gaps, found = spread_groups(ordinary, keys), []
    for name, position in positions.items():
        before = F.lag(position).over(Window.partitionBy(*keys).orderBy(position))
        gaps = gaps.withColumn(f"_gap_{name}", F.abs(F.col(position) - before))
        found += _gap_figures(f"_gap_{name}", name)
    wide = gaps.groupBy(*keys).agg(*figures, *found)
    if large is None:
        return wide
    hot = _matching(facts, large, keys, "left_semi")
    combined = hot.groupBy(*keys).agg(*figures)
    for name, position in positions.items():
        combined = match_keys(
            combined, _cell_figures(gap_cells(hot, keys, position), keys, name), keys)
    return wide.unionByName(combined.select(*wide.columns))


def _matching(df: DataFrame, groups: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Rows of groups that are listed (semi) or not (anti), null equal to null."""
    listed = groups.select(*[F.col(k).alias(f"_l_{k}") for k in keys])
    condition = F.lit(True)
    for k in keys:
        condition = condition & F.col(k).eqNullSafe(F.col(f"_l_{k}"))
    return df.join(listed, condition, how)


def _spacing_figures() -> list[Column]:
    """What `spacing_columns` needs besides the gaps of `slice_position`, named `_pos`."""
    return [
        F.count(F.lit(1)).alias("_slices"), F.count("slice_position").alias("_placed"),
        F.count_if(F.col("slice_position").isNotNull() & ~F.col("has_orientation"))
        .alias("z_fallbacks")]


def spacing_columns(figures: DataFrame, repeat_note: bool = False) -> DataFrame:
    """Spacing of every series from its figures; their helper columns are dropped."""
    some = F.col("_pos_n") > 0
    stats = figures.withColumns({
        "num_intervals": F.when(some, F.col("_pos_n")),
        "slice_spacing": F.when(some, F.col("_pos_mean")),
        "std_deviation": F.when(some, F.sqrt("_pos_var")),
        "min_spacing": F.when(some, F.col("_pos_min")),
        "max_spacing": F.when(some, F.col("_pos_max"))})
    success = F.coalesce(F.col("_placed") >= 2, F.lit(False))
    even = F.col("std_deviation") <= EVEN_GAPS * F.col("slice_spacing")
    # Message texts of the spacing check.
    note = F.lit("Using Z-coordinate fallback (no orientation info)")
    times = F.col("z_fallbacks").cast("int") if repeat_note else F.lit(1)
    notes = F.when((F.col("_slices") >= 2) & (F.col("z_fallbacks") > 0),
                   F.array_repeat(note, times)).otherwise(F.array().cast("array<string>"))
    return stats.withColumns({
        "spacing_success": success,
        "spacing_consistent": F.coalesce(success & even, F.lit(False)),
        "spacing_method": F.when(success, "image_position_patient").otherwise("fallback"),
    }).withColumn("spacing_warnings", F.concat(notes, geo.messages(
        F.when(F.col("_slices") < 2, "Need at least 2 slices for spacing calculation"),
        F.when((F.col("_slices") >= 2) & ~success, "Insufficient valid spatial information"),
        F.when(success & ~F.col("spacing_consistent"), F.concat(
            F.lit("Inconsistent spacing detected: std="),
            geo.decimals(F.col("std_deviation")), F.lit("mm, avg="),
            geo.decimals(F.col("slice_spacing")), F.lit("mm"))),
    ))).drop("_slices", "_placed", *[c for c in figures.columns if c.startswith("_pos_")])


def spacing_statistics(slices: DataFrame, keys: Sequence[str],
                       repeat_note: bool = False) -> DataFrame:
    """Spacing of every series from its slice positions.

    `spacing_success` needs two readable positions. The note about a slice without
    orientation is listed once, with the number of such slices in `z_fallbacks`;
    `repeat_note` lists it once per slice, as long as the series.
    """
    figures = series_figures(series_facts(slices, keys), keys, {"_pos": "slice_position"},
                             *_spacing_figures())
    return spacing_columns(figures, repeat_note)


def _fallback_columns(figures: DataFrame) -> DataFrame:
    """Fallback spacing from `_located` and the gaps named `_loc`, else from `_first._thick`."""
    known, std = F.col("_located") >= 2, F.sqrt("_loc_var")
    return figures.withColumns({
        "fallback_spacing": F.when(known, F.col("_loc_mean")).otherwise(
            F.coalesce("_first._thick", F.lit(1.0))),
        "fallback_method": F.when(known, "slice_location").otherwise("slice_thickness"),
        "fallback_irregular": F.when(known, std > EVEN_LOCATIONS * F.col("_loc_mean"))
        .otherwise(F.col("_many"))})


def _thickness(thickness: str) -> Column:
    return geo.repair_thickness(geo.parse_number(F.col(thickness)))


def location_spacing(slices: DataFrame, keys: Sequence[str], location: str = "slice_location",
                     thickness: str = "slice_thickness") -> DataFrame:
    """Spacing from slice locations, else the first thickness, else 1.0, with the method used."""
    facts = durable(slices.select(
        *keys, *ORDER, geo.parse_number(F.col(location)).alias("_at"),
        _thickness(thickness).alias("_thick")))
    figures = series_figures(
        facts, keys, {"_loc": "_at"}, (F.count(F.lit(1)) > 1).alias("_many"),
        F.count("_at").alias("_located"), F.min(F.struct(*ORDER, "_thick")).alias("_first"))
    return _fallback_columns(figures).select(
        *keys, "fallback_spacing", "fallback_method", "fallback_irregular")


def sorted_slices(slices: DataFrame, keys: Sequence[str],
                  location: str | None = "slice_location") -> DataFrame:
    """Slices in spatial order inside their series, by one range sort over all of them.

    Series without usable positions go by slice location (missing counts as 0).
    """
    placed = slice_positions(slices)
    usable = placed.groupBy(*keys).agg(
        (F.count("slice_position") >= 2).alias("_usable"))
    at = F.coalesce(geo.parse_number(F.col(location)), F.lit(0.0)) if location else F.lit(0.0)
    ordered = match_keys(placed, usable, keys).withColumn(
        "sort_position", F.when(F.col("_usable"), F.col("slice_position")).otherwise(at))
    # A successfully placed series keeps only the slices with a position.
    kept = ordered.filter(~F.col("_usable") | F.col("slice_position").isNotNull())
    return kept.orderBy(*keys, "sort_position", *ORDER).drop("_usable")


ANALYSIS_TEXT = ["study_description", "study_body_part", "study_series_description",
                 "study_protocol", "image_type"]
ANALYSIS_RAW = ["image_orientation_patient", "image_position_patient", "pixel_spacing",
                "slice_thickness", "slice_location"]


def series_analysis(slices: DataFrame, keys: Sequence[str],
                    study_fields: Sequence[str] = (), strict: bool = False) -> DataFrame:
    """One row per series: first slice's geometry, readiness and spacing.

    An unreadable pixel spacing is replaced by 1.0, so `has_pixel_spacing` is always
    true unless `strict` asks for the real value.
    """
    head = [*study_fields, *ANALYSIS_TEXT, *ANALYSIS_RAW]
    absent = [c for c in [*ANALYSIS_TEXT, *ANALYSIS_RAW] if c not in slices.columns]
    empty = {c: F.lit("") for c in absent}
    # what a series takes from its first slice travels as one value, without columns known to be empty
    carried = [c for c in head if c not in keys and c not in absent]
    facts = series_facts(slices.withColumns(empty) if absent else slices, keys,
                         [F.struct(*ORDER, *carried).alias("_head")])
    figures = spacing_columns(series_figures(
        facts, keys, {"_pos": "slice_position"}, *_spacing_figures(),
        F.min("_head").alias("_head"), F.count(F.lit(1)).alias("total_slices")))
    spacing = [c for c in figures.columns if c not in keys and c not in ("_head", "total_slices")]
    wide = geo.with_geometry(figures.select(
        *keys, "total_slices", *[F.col(f"_head.{c}").alias(c) for c in carried],
        *[c.alias(name) for name, c in empty.items()], *spacing), joined=True)
    spacing_found = F.col("spacing").isNotNull() if strict else F.lit(True)
    flags = wide.withColumns({
        "has_orientation": F.col("orientation").isNotNull(),
        "has_position": F.col("position").isNotNull(),
        "has_pixel_spacing": spacing_found,
        "has_slice_thickness": F.col("thickness").isNotNull(),
        "has_enough_slices": F.col("total_slices") > FEW_SLICES,
    })
    ready = (F.col("has_orientation") & F.col("has_position") & F.col("has_pixel_spacing")
             & F.col("has_slice_thickness") & F.col("has_enough_slices"))
    return flags.select(
        *keys, *study_fields, "total_slices", *ANALYSIS_TEXT,
        *[F.col(c).alias(f"raw_{c}") for c in ANALYSIS_RAW],
        "has_orientation", "has_position", "has_pixel_spacing", "has_slice_thickness",
        "has_enough_slices", ready.alias("is_ready_for_nifti"),
        F.coalesce(geo.decimals(F.col("thickness")), F.lit("")).alias("parsed_slice_thickness"),
        F.when(F.col("has_pixel_spacing"), F.concat(
            geo.decimals(F.col("row_spacing")), F.lit("x"), geo.decimals(F.col("col_spacing"))))
        .otherwise(F.lit("")).alias("parsed_pixel_spacing"),
        "geometry_valid",
        "geometry_errors", "geometry_warnings",
        F.col("spacing_success").alias("ipp_spacing_success"),
        F.when(F.col("spacing_success"), geo.decimals(F.col("slice_spacing")))
        .otherwise(F.lit("")).alias("ipp_calculated_spacing"),
        F.col("spacing_consistent").alias("ipp_spacing_consistent"),
        F.col("spacing_method").alias("ipp_spacing_method"),
        F.array_join("spacing_warnings", "; ").alias("ipp_spacing_warnings"))


# Names of the analysis metrics, in report order.
METRICS = {
    "Ready for NIfTI Conversion": "is_ready_for_nifti",
    "Series with Valid Orientation": "has_orientation",
    "Series with Valid Position": "has_position",
    "Series with Valid Pixel Spacing": "has_pixel_spacing",
    "Series with Valid Slice Thickness": "has_slice_thickness",
    "Series with Enough Slices (>10)": "has_enough_slices",
    "IPP Spacing Calculation Success": "ipp_spacing_success",
    "IPP Spacing Consistent": "ipp_spacing_consistent",
}


def analysis_metrics(analysis: DataFrame, study: Sequence[str]) -> DataFrame:
    """The counts of the analysis as (metric, count) rows, in one pass.

    Studies are counted from the analysis; studies without slices are not in it.
    """
    counts = {"Total Studies": F.count_distinct(*study), "Total Series": F.count(F.lit(1))}
    counts |= {name: F.count_if(F.col(flag)) for name, flag in METRICS.items()}
    counts["Geometry Validation Errors"] = F.count_if(~F.col("geometry_valid"))
    counts["Geometry Validation Warnings"] = F.count_if(F.col("geometry_warnings") != "")
    if "final_selection" in analysis.columns:
        counts["Final Selection = 1 & NIfTI Ready"] = F.count_if(
            (F.col("final_selection") == 1) & F.col("is_ready_for_nifti"))
    wide = analysis.agg(*[c.alias(f"m{i}") for i, c in enumerate(counts.values())])
    pairs = F.array(*[F.struct(F.lit(name).alias("metric"), F.col(f"m{i}").alias("count"))
                      for i, name in enumerate(counts)])
    return wide.select(F.explode(pairs).alias("_pair")).select("_pair.metric", "_pair.count")


def ready_series(slices: DataFrame, analysis: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Slices of selected series that are ready; series numbers compare as text."""
    ready = analysis.filter(F.col("is_ready_for_nifti"))
    if "final_selection" in analysis.columns:
        ready = ready.filter(F.col("final_selection") == 1)
    return slices.join(ready.select(*[F.col(k).cast("string").alias(k) for k in keys]),
                       list(keys), "left_semi")


def geometry_flags(slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Per series: whether any slice has each geometry field, and message totals."""
    return geo.with_geometry(slices).groupBy(*keys).agg(*geometry_figures())


def geometry_figures() -> list[Column]:
    """The columns of `geometry_flags` as aggregates of slices with parsed geometry."""
    return [
        F.bool_or(F.col("orientation").isNotNull()).alias("has_orientation"),
        F.bool_or(F.col("position").isNotNull()).alias("has_position"),
        F.lit(True).alias("has_pixel_spacing"),
        F.bool_or(F.col("thickness").isNotNull()).alias("has_slice_thickness"),
        F.sum(F.size("geometry_warnings")).alias("validation_warnings_count"),
        F.sum(F.size("geometry_errors")).alias("validation_errors_count"),
        F.count(F.lit(1)).alias("total_slices")]


def geometry_messages(slices: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Every distinct geometry message of a series with the number of slices that have it."""
    parsed = geo.with_geometry(slices)
    kinds = F.concat(
        F.transform("geometry_warnings", lambda m: F.struct(
            F.lit("warning").alias("kind"), m.alias("message"))),
        F.transform("geometry_errors", lambda m: F.struct(
            F.lit("error").alias("kind"), m.alias("message"))))
    return (parsed.select(*keys, F.explode(kinds).alias("_m"))
            .groupBy(*keys, F.col("_m.kind").alias("kind"), F.col("_m.message").alias("message"))
            .agg(F.count(F.lit(1)).alias("slices")))


def series_affine(slices: DataFrame, keys: Sequence[str],
                  location: str = "slice_location") -> DataFrame:
    """Affine matrix per series from its first slice in spatial order.

    Slice spacing comes from positions, else locations, else thickness.
    """
    head = ["image_orientation_patient", "image_position_patient", "pixel_spacing",
            "slice_thickness"]
    figures = [*_spacing_figures(), (F.count(F.lit(1)) > 1).alias("_many"),
               F.min("_head").alias("_earliest"),
               F.min(F.when(F.col("slice_position").isNotNull(),
                            F.struct("slice_position", "_head"))).alias("_by_position")]
    more, positions = [F.struct(*ORDER, *head).alias("_head")], {"_pos": "slice_position"}
    if location in slices.columns:
        more.append(geo.parse_number(F.col(location)).alias("_at"))
        positions["_loc"] = "_at"
        figures += [F.count("_at").alias("_located"),
                    F.min(F.struct(F.coalesce("_at", F.lit(0.0)).alias("_place"), "_head"))
                    .alias("_by_location")]
    facts = series_facts(slices, keys, more)
    wide = series_figures(facts, keys, positions, *figures)
    if location not in slices.columns:  # all slices are at one place, so the earliest comes first
        wide = wide.withColumns({
            "_located": F.lit(0), "_loc_mean": F.lit(None).cast("double"),
            "_loc_var": F.lit(None).cast("double"), "_by_location": F.struct(
                F.col("_earliest").alias("_head"))})
    wide = _fallback_columns(spacing_columns(wide.withColumn("_first", F.struct(
        _thickness("_earliest.slice_thickness").alias("_thick")))))
    chosen = F.when(F.col("spacing_success"), F.col("_by_position._head")).otherwise(
        F.col("_by_location._head"))
    flat = wide.withColumn("_head", chosen).select(
        *keys, "spacing_success", "spacing_consistent", "slice_spacing", "fallback_spacing",
        "fallback_irregular", "fallback_method", *[f"_head.{c}" for c in head])
    parsed = geo.with_geometry(flat)
    used = F.when(F.col("spacing_success"), F.col("slice_spacing")).otherwise(
        F.col("fallback_spacing"))
    return parsed.select(
        *keys, used.alias("used_spacing"),
        F.when(F.col("spacing_success"), "image_position_patient")
        .otherwise(F.col("fallback_method")).alias("spacing_source"),
        geo.affine_matrix(F.col("orientation"), F.col("position"), F.col("row_spacing"),
                          F.col("col_spacing"), used).alias("affine"),
        F.when(~F.col("geometry_valid"), True)
        .when(F.col("spacing_success"), ~F.col("spacing_consistent"))
        .otherwise(F.col("fallback_irregular")).alias("has_warnings"))


def series_tracker(studies: DataFrame, slices: DataFrame, study_keys: Sequence[str]) -> DataFrame:
    """One pending row per series of the selected studies, keyed by the series hash."""
    counts = (
        slices.withColumn("series_number", series_key(F.col("series_number")))
        .groupBy(*study_keys, "series_number").agg(F.count(F.lit(1)).alias("slice_count"))
    )
    return counts.join(studies, list(study_keys)).select(
        privacy.series_hash(F.col("patient_id"), F.col("study_date"), F.col("series_number"),
                            F.col("institution_name")).alias("hash_id"),
        "patient_id", "study_date", "series_number", "slice_count", "institution_name",
        *[k for k in study_keys],
        F.lit("pending").alias("processing_status"),
        F.lit(None).cast("boolean").alias("success"),
        F.lit(None).cast("string").alias("error_message"),
        F.lit(None).cast("timestamp").alias("processing_timestamp"))


def stack_volumes(pixels: DataFrame, keys: Sequence[str], position: str, image: str = "pixels",
                  slope: str | float = 1.0, intercept: str | float = 0.0) -> DataFrame:
    """Rescaled slices of each volume in order: keys, place (from 1), position, image.

    A volume is as large as its series, so it stays one row per slice, numbered by position. Only
    keys and positions go through the numbering, not the images.
    """
    def value(v: str | float) -> Column:
        return F.col(v) if isinstance(v, str) else F.lit(float(v))

    placed = number_rows(pixels, [*keys, position], "place", within=keys)
    return placed.select(
        *keys, F.col("place"), F.col(position).alias("position"),
        geo.rescale(F.col(image), value(slope), value(intercept)).alias("image"))
