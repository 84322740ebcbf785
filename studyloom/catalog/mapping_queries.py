"""Queries over the mapping of two study databases and over hospital labels."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from studyloom.catalog.consolidate_queries import STARS_SQL
from studyloom.catalog.fixtures import Tables
from studyloom.catalog.registry import query
from studyloom.operators import consolidate, mapping as ops
from studyloom.session import durable

NORM = ("lower(trim(replace(regexp_replace(trim({c}), '^[A-Za-z]:', ''), chr(92), '/'), '/'))")

EDGES_SQL = f"""news as (select *, {NORM.format(c='dicom_folder_path')} as np, replace(study_date, '-', '') as nd from {{new}}),
olds as (select *, {NORM.format(c='dir_to_root')} as op, replace(old_date, '-', '') as od from old_db),
path_pairs as (select n.new_id, o.old_id from news n join olds o on trim(n.hospital) = trim(o.hospital)
  and (n.np = o.op or starts_with(n.np, concat(o.op, '/'))) where n.np <> '' and o.op <> '' and (n.nd is null or o.od is null or n.nd = o.od)),
id_keys as (select *, case when trim(coalesce(id_from_ct, '')) <> '' then trim(id_from_ct) else regexp_replace(trim(id_hospital), '_[^_]*$', '') end as k from olds where trim(coalesce(dir_to_root, '')) = ''),
id_pairs as (select n.new_id, o.old_id from news n join id_keys o on trim(n.hospital) = trim(o.hospital) and trim(n.patient_id) = o.k
  where o.k <> '' and (n.nd is null or o.od is null or n.nd = o.od)),
pairs as (select *, 1 as phase from path_pairs union all select *, 2 as phase from id_pairs)"""
PLAIN_SQL = EDGES_SQL.format(new="new_db")


@query("path_prefix_join", "new_db old_db", f"with {PLAIN_SQL} select new_id, old_id from path_pairs")
def path_prefix_join(t: Tables) -> DataFrame:
    keyed = ops.old_groups(t.old_db)
    return ops.expand_edges(ops.path_edges(t.new_db, keyed), keyed).select("new_id", "old_id")


@query("id_fallback_join", "new_db old_db", f"with {PLAIN_SQL} select new_id, old_id from id_pairs")
def id_fallback_join(t: Tables) -> DataFrame:
    keyed = ops.old_groups(t.old_db)
    return ops.expand_edges(ops.id_edges(t.new_db, keyed), keyed).select("new_id", "old_id")


# The stars of the consolidated studies give the duplicate groups of the new database.
DUP_SQL = f"""{STARS_SQL.strip()},
new_dup as (select n.*, m.unique_number, m.is_duplicate, m.is_duplicate_first_occurrence_un from new_db n join marked m on m.unique_number = n.new_id),
{EDGES_SQL.format(new='new_dup')},
groups as (select new_id, case is_duplicate when 'first_occurrence' then unique_number::varchar when 'duplicate' then is_duplicate_first_occurrence_un end as g from new_dup),
sources as (select g, min(new_id) as first_id, min(new_id) filter (where new_id in (select new_id from pairs)) as source from groups where g is not null group by g),
copies as (select groups.new_id, p.old_id, first_id from groups join sources using (g) join pairs p on p.new_id = source where groups.new_id not in (select new_id from pairs)),
edges as (select new_id, old_id, phase, false as propagated, 0 as first_id from pairs union all select new_id, old_id, 3, true, first_id from copies),
visits as (select new_id, min(row(phase, case phase when 1 then 0 when 2 then old_id else first_id end, new_id)) as visit from edges group by 1),
reach as (select old_id, count(*) as n_new from edges group by 1),
degree as (select new_id, count(*) as n_olds from edges group by 1),
wide as (select * from edges join reach using (old_id) join degree using (new_id) join visits using (new_id)),
crowded as (select * from wide where n_olds > 1),
leaders as (select new_id, case when max(n_new) = 1 then 'many_to_one' else 'many_to_many' end as match_class from crowded
  where new_id not in (select b.new_id from crowded a join crowded b on a.old_id = b.old_id and a.visit < b.visit) group by 1),
led as (select l.new_id as entry, match_class, old_id from leaders l join edges using (new_id)),
members as (
  select 'one_to_one' as match_class, new_id as entry, 'old' as side, old_id as member from wide where n_olds = 1 and n_new = 1
  union all select 'one_to_one', new_id, 'new', new_id from wide where n_olds = 1 and n_new = 1
  union all select 'one_to_many', old_id, 'new', new_id from wide where n_new > 1
  union all select match_class, entry, 'old', old_id from led
  union all select distinct match_class, entry, 'new', e.new_id from led join edges e using (old_id)),
mismatch as (select distinct e.new_id from edges e join new_dup n using (new_id) join old_db o using (old_id) where n.study_date is not null and trim(o.old_date) <> '' and replace(o.old_date, '-', '') <> replace(n.study_date, '-', '')),
colours as (select w.new_id, case when w.new_id in (select member from members where match_class in ('many_to_one', 'many_to_many') and side = 'new') then 'red'
  when bool_or(n_new > 1) then 'yellow' when bool_or(propagated) then 'cyan' when w.new_id in (select new_id from mismatch) then 'dark_green' end as highlight from wide w group by 1),
used as (select old_id from wide where n_new > 1 or n_olds = 1 union select old_id from led),
merged as (
  select 1 as section_no, new_id, old_id from wide where n_olds = 1 and n_new = 1
  union all select 2, new_id, old_id from wide where n_new > 1
  union all select case match_class when 'many_to_one' then 3 else 4 end, new_id, null from (select distinct match_class, entry, e.new_id from led join edges e using (old_id)) x
  union all select 5, new_id, null from new_dup where new_id not in (select new_id from edges)
  union all select 6, null, old_id from old_db where old_id not in (select old_id from used))"""


def matched(t: Tables) -> ops.Matches:
    # written once: the matching and what is made from it read the new rows several times
    marked = durable(t.new_db_of(consolidate.mark_duplicates(t.consolidated, direct=True)))
    return ops.match_databases(marked, t.old_db)


@query("propagated_matches", "consolidated new_db old_db", f"""with {DUP_SQL}
select new_id, old_id, propagated from edges
""")
def propagated_matches(t: Tables) -> DataFrame:
    m = matched(t)
    return ops.expand_edges(m.edges, m.old).select("new_id", "old_id", "propagated")


@query("match_classes", "consolidated new_db old_db", f"""with {DUP_SQL}
select match_class, entry, side, member from members
""")
def match_classes(t: Tables) -> DataFrame:
    return ops.conflict_members(matched(t))


@query("match_class_counts", "consolidated new_db old_db", f"""with {DUP_SQL}
select match_class, count(distinct entry) as entries from members group by 1
""")
def match_class_counts(t: Tables) -> DataFrame:
    return ops.match_class_counts(matched(t))


@query("conflict_log", "consolidated new_db old_db", f"""with {DUP_SQL}
select match_class, entry, side, member from members where match_class <> 'one_to_one'
union all select distinct 'one_to_many', old_id, 'old', old_id from wide where n_new > 1
""")
def conflict_log(t: Tables) -> DataFrame:
    return ops.conflict_log(matched(t))


@query("merged_outer", "consolidated new_db old_db", f"""with {DUP_SQL}
select section_no, m.new_id, coalesce(n.hospital, o.hospital) as hospital, n.patient_id, case when section_no in (1, 2, 6) then o.old_id end as "backward_CT_No_Final",
 case when section_no in (1, 2, 6) then o.dir_to_root end as backward_dir_to_root, case when section_no in (1, 2, 6) then o.old_date end as backward_date, c.highlight
from merged m left join new_dup n on n.new_id = m.new_id left join old_db o on o.old_id = m.old_id left join colours c on c.new_id = m.new_id
""")
def merged_outer(t: Tables) -> DataFrame:
    return ops.merged_table(matched(t)).select(
        "section_no", "new_id", "hospital", "patient_id", "backward_CT_No_Final",
        "backward_dir_to_root", "backward_date", "highlight")


@query("highlight_counts", "consolidated new_db old_db", f"""with {DUP_SQL}
select highlight, count(*) as rows from merged join colours using (new_id) where highlight is not null group by 1
""")
def highlight_counts(t: Tables) -> DataFrame:
    return ops.highlight_counts(ops.merged_table(matched(t)))


@query("date_mismatch", "consolidated new_db old_db", f"with {DUP_SQL} select new_id from mismatch")
def date_mismatch(t: Tables) -> DataFrame:
    return ops.date_mismatches(matched(t))


LABELLED_SQL = "labelled as (select s.*, coalesce(h.hospital, '') as \"Hospital\" from studies s left join hospital_map h on s.institution_name = h.source_folder)"


@query("hospital_apply", "studies hospital_map", f"""with {LABELLED_SQL}
select study_no, institution_name, "Hospital" from labelled
""")
def hospital_apply(t: Tables) -> DataFrame:
    return ops.apply_hospitals(t.studies, t.hospital_map, "institution_name").select(
        "study_no", "institution_name", "Hospital")


@query("hospital_missing", "studies hospital_map", """
with sources as (select distinct institution_name as source_folder from studies where trim(institution_name) <> '')
select source_folder, 'missing' as problem from sources where source_folder not in (select source_folder from hospital_map)
union all select source_folder, 'empty' from sources join hospital_map using (source_folder) where trim(hospital) = ''
""")
def hospital_missing(t: Tables) -> DataFrame:
    return ops.mapping_gaps(t.studies, t.hospital_map, "institution_name")


@query("hospital_distribution", "studies hospital_map", f"""with {LABELLED_SQL}
select "Hospital", count(*) as rows from labelled where trim("Hospital") <> '' group by 1
""")
def hospital_distribution(t: Tables) -> DataFrame:
    return ops.hospital_distribution(
        ops.apply_hospitals(t.studies, t.hospital_map, "institution_name"))


@query("mapping_template", "studies", """
select distinct institution_name as source_folder, '' as hospital from studies where trim(institution_name) <> '' order by 1
""")
def mapping_template(t: Tables) -> DataFrame:
    return ops.mapping_template(t.studies, "institution_name")
