"""Queries over series geometry, spacing and the series analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from studyloom.catalog.fixtures import Tables
from studyloom.catalog.registry import query
from studyloom.functions import geometry as geo
from studyloom.operators import series as ops

KEYS = ["study_no", "series_number"]

ODD_SQL = r"""odd as (select * replace (
  case when study_no % 13 = 0 then '0.05/0.05' when study_no % 17 = 0 then '20.5' else pixel_spacing end as pixel_spacing,
  case when study_no % 11 = 0 then '506' when study_no % 19 = 0 then '60.5' else slice_thickness end as slice_thickness,
  case when study_no % 7 = 0 then '[1, 0, 0, 0.5, 0.5, 0]' when study_no % 23 = 0 then '[1, 0, x, 0, 1, 0]' else image_orientation_patient end as image_orientation_patient,
  case when study_no % 29 = 0 then '[0, 0]' else image_position_patient end as image_position_patient) from slices)"""

PARSED_SQL = ODD_SQL + r""",
lists as (select *, string_split(replace(trim(image_orientation_patient, '[]'), ' ', ''), ',') as io,
  string_split(replace(trim(image_position_patient, '[]'), ' ', ''), ',') as ip,
  case when contains(pixel_spacing, chr(92)) then string_split(pixel_spacing, chr(92)) when contains(pixel_spacing, '/') then string_split(pixel_spacing, '/') else [pixel_spacing, pixel_spacing] end as sp from odd),
parsed as (select *, case when len(io) >= 6 and len(list_filter(io, lambda x: try_cast(x as double) is null)) = 0 then list_transform(io, lambda x: try_cast(x as double)) end as o,
  case when len(ip) >= 3 and len(list_filter(ip, lambda x: try_cast(x as double) is null)) = 0 then list_transform(ip, lambda x: try_cast(x as double)) end as p,
  case when try_cast(sp[1] as double) is not null and try_cast(sp[2] as double) is not null then [try_cast(sp[1] as double), try_cast(sp[2] as double)] end as s,
  try_cast(slice_thickness as double) as t0 from lists),
geom as (select *, case when t0 > 100 then t0 / 1000 else t0 end as t, o[1]*o[5] - o[2]*o[4] as nz, o[2]*o[6] - o[3]*o[5] as nx, o[3]*o[4] - o[1]*o[6] as ny from parsed),
placed as (select *, case when p is null then null when o is null then p[3] else (p[1]*nx + p[2]*ny + p[3]*nz) / sqrt(nx*nx + ny*ny + nz*nz) end as pos from geom)"""

WARN_SQL = """concat_ws('; ',
  case when abs(sqrt(o[1]*o[1]+o[2]*o[2]+o[3]*o[3]) - 1) > 0.1 or abs(sqrt(o[4]*o[4]+o[5]*o[5]+o[6]*o[6]) - 1) > 0.1 then 'Direction cosines are not unit vectors' end,
  case when abs(o[1]*o[4]+o[2]*o[5]+o[3]*o[6]) > 0.1 then 'Row and column vectors are not orthogonal' end,
  case when not (s[1] between 0.1 and 10) or not (s[2] between 0.1 and 10) then concat('Unusual pixel spacing: ', s[1]::varchar, 'x', s[2]::varchar, ' mm') end,
  case when s is null then 'Failed to parse PixelSpacing' end,
  case when t0 > 100 then concat('Converted slice thickness: ', t0::varchar, ' -> ', printf('%.3f', t), 'mm (divided by 1000)') end,
  case when not (t between 0.1 and 50) then concat('Unusual slice thickness: ', printf('%.3f', t), 'mm') end)"""
ERR_SQL = """concat_ws('; ', case when o is null then 'Failed to parse ImageOrientationPatient' end, case when p is null then 'Failed to parse ImagePositionPatient' end)"""


def odd(t: Tables) -> DataFrame:
    """Slices with some unusual, broken and mis-scaled geometry texts."""
    n = F.col("study_no")
    return t.slices.withColumns({
        "pixel_spacing": F.when(n % 13 == 0, "0.05/0.05").when(n % 17 == 0, "20.5")
        .otherwise(F.col("pixel_spacing")),
        "slice_thickness": F.when(n % 11 == 0, "506").when(n % 19 == 0, "60.5")
        .otherwise(F.col("slice_thickness")),
        "image_orientation_patient": F.when(n % 7 == 0, "[1, 0, 0, 0.5, 0.5, 0]")
        .when(n % 23 == 0, "[1, 0, x, 0, 1, 0]").otherwise(F.col("image_orientation_patient")),
        "image_position_patient": F.when(n % 29 == 0, "[0, 0]")
        .otherwise(F.col("image_position_patient")),
    })


@query("parse_geometry", "slices", f"""with {PARSED_SQL}
select file_path, line_no, o[1] as row_x, o[4] as col_x, o[5] as col_y, p[3] as z, coalesce(s[1], 1.0) as row_spacing, coalesce(s[2], 1.0) as col_spacing,
 round(t, 6) as thickness, round(nz, 6) as normal_z, round(pos, 6) as slice_position from placed
""")
def parse_geometry(t: Tables) -> DataFrame:
    parsed = geo.with_geometry(odd(t))
    return parsed.select(
        "file_path", "line_no", F.get("orientation", 0).alias("row_x"),
        F.get("orientation", 3).alias("col_x"), F.get("orientation", 4).alias("col_y"),
        F.get("position", 2).alias("z"), "row_spacing", "col_spacing",
        F.round("thickness", 6).alias("thickness"),
        F.round(F.get("direction", 2), 6).alias("normal_z"),
        F.round(geo.slice_position(F.col("position"), F.col("direction")), 6)
        .alias("slice_position"))


@query("geometry_validation", "slices", f"""with {PARSED_SQL}
select file_path, line_no, {WARN_SQL} as warnings, {ERR_SQL} as errors, o is not null and p is not null as geometry_valid from placed
""")
def geometry_validation(t: Tables) -> DataFrame:
    return geo.with_geometry(odd(t)).select(
        "file_path", "line_no", F.array_join("geometry_warnings", "; ").alias("warnings"),
        F.array_join("geometry_errors", "; ").alias("errors"), "geometry_valid")


@query("geometry_flags", "slices", f"""with {PARSED_SQL}
select study_no, series_number, bool_or(o is not null) as has_orientation, bool_or(p is not null) as has_position, true as has_pixel_spacing,
 bool_or(t is not null) as has_slice_thickness, sum(case when {WARN_SQL} = '' then 0 else len(string_split({WARN_SQL}, '; ')) end)::bigint as validation_warnings_count,
 sum((o is null)::int + (p is null)::int)::bigint as validation_errors_count, count(*) as total_slices from placed group by 1, 2
""")
def geometry_flags(t: Tables) -> DataFrame:
    return ops.geometry_flags(odd(t), KEYS)


@query("geometry_messages", "slices", f"""with {PARSED_SQL}
select study_no, series_number, kind, message, count(*) as slices from (
 select study_no, series_number, 'warning' as kind, unnest(string_split({WARN_SQL}, '; ')) as message from placed
 union all select study_no, series_number, 'error', unnest(string_split({ERR_SQL}, '; ')) from placed) x where message <> '' group by all
""")
def geometry_messages(t: Tables) -> DataFrame:
    return ops.geometry_messages(odd(t), KEYS)


@query("slice_gaps", "slices", f"""with {PARSED_SQL},
cells as (select study_no, series_number, pos, count(*) as n_slices from placed where pos is not null group by 1, 2, 3)
select study_no, series_number, round(pos, 6) as slice_position, n_slices,
 round(abs(pos - lag(pos) over (partition by study_no, series_number order by pos)), 6) as gap from cells
""")
def slice_gaps(t: Tables) -> DataFrame:
    cells = ops.gap_cells(ops.slice_positions(odd(t)), KEYS)
    return cells.select(*KEYS, F.round("slice_position", 6).alias("slice_position"), "n_slices",
                        F.round("gap", 6).alias("gap"))


STATS_SQL = f"""{PARSED_SQL},
gaps as (select study_no, series_number, abs(pos - lag(pos) over (partition by study_no, series_number order by pos, line_no, file_path)) as gap from placed where pos is not null),
gap_stats as (select study_no, series_number, count(gap) as num_intervals, avg(gap) as slice_spacing, stddev_pop(gap) as std_deviation, min(gap) as min_spacing, max(gap) as max_spacing
  from gaps where gap is not null group by 1, 2),
totals as (select study_no, series_number, count(*) as n, count(pos) as n_placed, count(*) filter (where pos is not null and o is null) as z_fallbacks from placed group by 1, 2),
spacing as (select t.*, g.* exclude (study_no, series_number), n_placed >= 2 as spacing_success, n_placed >= 2 and coalesce(std_deviation <= 0.05 * slice_spacing, false) as spacing_consistent,
  case when n_placed >= 2 then 'image_position_patient' else 'fallback' end as spacing_method,
  concat_ws('; ', case when n >= 2 and z_fallbacks > 0 then 'Using Z-coordinate fallback (no orientation info)' end,
   case when n < 2 then 'Need at least 2 slices for spacing calculation' end,
   case when n >= 2 and n_placed < 2 then 'Insufficient valid spatial information' end,
   case when n_placed >= 2 and std_deviation > 0.05 * slice_spacing then 'Inconsistent spacing detected' end) as notes
  from totals t left join gap_stats g using (study_no, series_number))"""


@query("spacing_stats", "slices", f"""with {STATS_SQL}
select study_no, series_number, num_intervals, round(slice_spacing, 4) as slice_spacing, round(std_deviation, 4) as std_deviation,
 round(min_spacing, 4) as min_spacing, round(max_spacing, 4) as max_spacing, z_fallbacks, spacing_success, spacing_consistent, spacing_method, notes from spacing
""")
def spacing_stats(t: Tables) -> DataFrame:
    stats = ops.spacing_statistics(odd(t), KEYS)
    return stats.select(
        *KEYS, "num_intervals", *[F.round(c, 4).alias(c) for c in (
            "slice_spacing", "std_deviation", "min_spacing", "max_spacing")],
        "z_fallbacks", "spacing_success", "spacing_consistent", "spacing_method",
        F.regexp_replace(F.array_join("spacing_warnings", "; "), ": std=.*$", "").alias("notes"))


@query("location_spacing", "slices", """
with located as (select *, case when study_no % 5 = 0 then 'Unknown' else cast(line_no * 2 + line_no % 3 as varchar) end as slice_location from slices),
first as (select study_no, series_number, count(*) as n, count(try_cast(slice_location as double)) as located,
  first(slice_thickness order by line_no, file_path, try_cast(slice_thickness as double) nulls first) as raw from located group by 1, 2),
gaps as (select study_no, series_number, abs(x - lag(x) over (partition by study_no, series_number order by x)) as gap from (select *, try_cast(slice_location as double) as x from located) y where x is not null),
stats as (select study_no, series_number, avg(gap) as mean, stddev_pop(gap) as std from gaps group by 1, 2)
select study_no, series_number, round(case when located >= 2 then mean else coalesce(try_cast(raw as double), 1.0) end, 4) as fallback_spacing,
 case when located >= 2 then 'slice_location' else 'slice_thickness' end as fallback_method,
 case when located >= 2 then std > 0.1 * mean else n > 1 end as fallback_irregular
from first left join stats using (study_no, series_number)
""")
def location_spacing(t: Tables) -> DataFrame:
    place = (F.col("line_no") * 2 + F.col("line_no") % 3).cast("string")
    located = t.slices.withColumn("slice_location", F.when(F.col("study_no") % 5 == 0, "Unknown")
                                  .otherwise(place))
    return ops.location_spacing(located, KEYS).withColumn(
        "fallback_spacing", F.round("fallback_spacing", 4))


ANALYSIS_SQL = f"""{STATS_SQL},
ranked as (select *, row_number() over (partition by study_no, series_number order by line_no, file_path, patient_id, study_date, image_type, image_orientation_patient, image_position_patient, pixel_spacing, slice_thickness) as rn, count(*) over (partition by study_no, series_number) as total_slices from placed),
analysis as (select r.*, o is not null as has_orientation, p is not null as has_position, true as has_pixel_spacing, t is not null as has_slice_thickness, total_slices > 10 as has_enough_slices,
  o is not null and p is not null and t is not null and total_slices > 10 as is_ready_for_nifti, {WARN_SQL} as geometry_warnings, {ERR_SQL} as geometry_errors,
  spacing_success, spacing_consistent, slice_spacing, spacing_method
  from ranked r join spacing using (study_no, series_number) where rn = 1)"""


@query("series_analysis", "slices", f"""with {ANALYSIS_SQL}
select study_no, series_number, total_slices, patient_id, study_date, image_type, has_orientation, has_position, has_pixel_spacing, has_slice_thickness, has_enough_slices, is_ready_for_nifti,
 coalesce(printf('%.3f', t), '') as parsed_slice_thickness, printf('%.3fx%.3f', coalesce(s[1], 1.0), coalesce(s[2], 1.0)) as parsed_pixel_spacing, has_orientation and has_position as geometry_valid,
 geometry_errors, geometry_warnings, spacing_success as ipp_spacing_success, spacing_consistent as ipp_spacing_consistent, spacing_method as ipp_spacing_method from analysis
""")
def series_analysis(t: Tables) -> DataFrame:
    rows = ops.series_analysis(odd(t), KEYS, ["patient_id", "study_date"])
    return rows.select(
        *KEYS, "total_slices", "patient_id", "study_date", "image_type", "has_orientation",
        "has_position", "has_pixel_spacing", "has_slice_thickness", "has_enough_slices",
        "is_ready_for_nifti", "parsed_slice_thickness", "parsed_pixel_spacing",
        "geometry_valid", "geometry_errors", "geometry_warnings", "ipp_spacing_success",
        "ipp_spacing_consistent", "ipp_spacing_method")


@query("analysis_metrics", "slices", f"""with {ANALYSIS_SQL},
m as (select *, study_no % 2 as final_selection from analysis)
select unnest(['Total Studies','Total Series','Ready for NIfTI Conversion','Series with Valid Orientation','Series with Valid Position','Series with Valid Pixel Spacing','Series with Valid Slice Thickness',
 'Series with Enough Slices (>10)','IPP Spacing Calculation Success','IPP Spacing Consistent','Geometry Validation Errors','Geometry Validation Warnings','Final Selection = 1 & NIfTI Ready']) as metric,
 unnest([count(distinct study_no), count(*), count(*) filter (where is_ready_for_nifti), count(*) filter (where has_orientation), count(*) filter (where has_position), count(*), count(*) filter (where has_slice_thickness),
 count(*) filter (where has_enough_slices), count(*) filter (where spacing_success), count(*) filter (where spacing_consistent), count(*) filter (where not (has_orientation and has_position)),
 count(*) filter (where geometry_warnings <> ''), count(*) filter (where final_selection = 1 and is_ready_for_nifti)]) as count from m
""")
def analysis_metrics(t: Tables) -> DataFrame:
    rows = ops.series_analysis(odd(t), KEYS).withColumn(
        "final_selection", F.col("study_no") % 2)
    return ops.analysis_metrics(rows, ["study_no"])


@query("ready_series", "slices", """
with first as (select study_no, count(*) as n, bool_or(image_orientation_patient <> 'Unknown') as any_o,
  first(image_orientation_patient <> 'Unknown' and slice_thickness <> 'Unknown' order by line_no, file_path, image_type, image_orientation_patient, image_position_patient, pixel_spacing, slice_thickness) as ok from slices group by 1)
select s.file_path, s.line_no, s.study_no from slices s join first using (study_no) where n > 10 and ok and study_no % 3 <> 0
""")
def ready_series(t: Tables) -> DataFrame:
    analysis = ops.series_analysis(t.slices, ["study_no"]).withColumn(
        "final_selection", (F.col("study_no") % 3 != 0).cast("int"))
    slices = t.slices.withColumn("study_no", F.col("study_no").cast("string"))
    return ops.ready_series(slices, analysis, ["study_no"]).select(
        "file_path", "line_no", F.col("study_no").cast("bigint").alias("study_no"))


@query("selected_studies_slices", "slices studies", """
select study_no, patient_id, ct_objects_count, file_path, line_no from studies join slices using (study_no, patient_id) where ct_objects_count > 4
""")
def selected_studies_slices(t: Tables) -> DataFrame:
    chosen = ops.selected_studies(t.studies.withColumn(
        "final_selection", (F.col("ct_objects_count") > 4).cast("int")))
    slices = t.slices.select("study_no", "patient_id", "file_path", "line_no")
    return ops.study_slices(chosen.select("study_no", "patient_id", "ct_objects_count"), slices,
                            ["study_no", "patient_id"])


@query("affine_matrix", "slices", f"""with {STATS_SQL},
firsts as (select study_no, series_number, row_number() over (partition by study_no, series_number order by pos, line_no, file_path, image_orientation_patient, image_position_patient, pixel_spacing, slice_thickness) as rp, row_number() over (partition by study_no, series_number order by line_no, file_path, image_orientation_patient, image_position_patient, pixel_spacing, slice_thickness) as rl, pos, o, p, s, t from placed),
chosen as (select f.*, sp.slice_spacing, sp.spacing_success, sp.spacing_consistent, sp.n from firsts f join spacing sp using (study_no, series_number)
  where (spacing_success and rp = 1) or (not spacing_success and rl = 1)),
used as (select *, case when spacing_success then slice_spacing else coalesce(t, 1.0) end as sz, o is not null and p is not null as good, o[1]*o[5]-o[2]*o[4] as nz from chosen)
select study_no, series_number, round(sz, 4) as used_spacing, case when spacing_success then 'image_position_patient' else 'slice_thickness' end as spacing_source,
 round(case when good then -o[1] * coalesce(s[1], 1.0) else 1.0 end, 4) as a00, round(case when good then -o[5] * coalesce(s[2], 1.0) else 1.0 end, 4) as a11,
 round(case when good then nz * sz else 1.0 end, 4) as a22, round(case when good then p[3] else 0.0 end, 4) as a23, 1.0 as a33,
 case when not good then true when spacing_success then not spacing_consistent else n > 1 end as has_warnings
from used
""")
def affine_matrix(t: Tables) -> DataFrame:
    rows = ops.series_affine(odd(t), KEYS)

    def at(i: int, j: int):
        return F.round(F.get(F.get("affine", i), j), 4).alias(f"a{i}{j}")

    return rows.select(*KEYS, F.round("used_spacing", 4).alias("used_spacing"), "spacing_source",
                       at(0, 0), at(1, 1), at(2, 2), at(2, 3), at(3, 3), "has_warnings")


@query("rescale_stack", "", """
with scaled as (select label, vec_id, list_transform(embedding, lambda x: x::double * 2.0 - 1024.0) as image from embeddings)
select label, row_number() over (partition by label order by vec_id) as place, vec_id as position, round(list_sum(image), 3) as total, round(image[1], 4) as first_pixel from scaled
""")
def rescale_stack(t: Tables) -> DataFrame:
    volumes = ops.stack_volumes(t.pixel_rows(), ["label"], "vec_id", slope=2.0, intercept=-1024.0)
    total = F.aggregate("image", F.lit(0.0), lambda s, x: s + x)
    return volumes.select("label", "place", "position", F.round(total, 3).alias("total"),
                          F.round(F.get("image", 0), 4).alias("first_pixel"))


@query("slice_sort", "slices", """
select file_path, line_no, study_no, series_number, substr(image_position_patient, 8, length(image_position_patient) - 8)::double as slice_position
from slices order by study_no, series_number, slice_position
""")
def slice_sort(t: Tables) -> DataFrame:
    placed = ops.slice_positions(t.slices).select(
        "file_path", "line_no", "study_no", "series_number", "slice_position")
    return placed.orderBy("study_no", "series_number", "slice_position", "line_no",
                          "file_path")


@query("series_order", "slices", f"""with {STATS_SQL}
select p.study_no, p.series_number, file_path, line_no, round(case when spacing_success then pos else 0.0 end, 6) as sort_position
from placed p join spacing using (study_no, series_number) where not spacing_success or pos is not null
""")
def series_order(t: Tables) -> DataFrame:
    return ops.sorted_slices(odd(t), KEYS, location=None).select(
        *KEYS, "file_path", "line_no", F.round("sort_position", 6).alias("sort_position"))


@query("series_tracker", "slices studies", """
with counts as (select study_no, coalesce(series_number, 'unknown') as series_number, count(*) as slice_count from slices group by 1, 2)
select substr(sha256(concat(patient_id, '_', study_date, '_', series_number, '_', institution_name)), 1, 16) as hash_id, patient_id, study_date, series_number, slice_count, institution_name, study_no, 'pending' as processing_status
from counts join studies using (study_no)
""")
def series_tracker(t: Tables) -> DataFrame:
    slices = t.slices.select("study_no", "series_number")
    studies = t.studies.select("study_no", "patient_id", "study_date", "institution_name")
    return ops.series_tracker(studies, slices, ["study_no"]).drop(
        "success", "error_message", "processing_timestamp")
