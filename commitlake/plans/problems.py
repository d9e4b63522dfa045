"""Queries of the general data-pipeline operators (history, hierarchy, wide table, failing rows, incremental runs) and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.operators import graph, hierarchy, history, incremental, records, wide
from commitlake.session import read


def _events(spark: SparkSession, d: str) -> DataFrame:
    return history.project_events(read(spark, d, "project_updates"), read(spark, d, "project_heads"), read(spark, d, "project_metadata"), read(spark, d, "metadata_keys"))


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """Each version of a status, branch or metadata value, by the ``_seq`` of its first record."""
    return history.versions_started(_events(spark, d))


def p3_history(spark: SparkSession, d: str) -> DataFrame:
    """Each version with the period it was valid, as ``_seq`` numbers; an open period ends with null."""
    return history.versions(_events(spark, d)).select("attr", "project_id", "item", "from_seq", "to_seq", "op", "state")


def p4_found(spark: SparkSession, d: str) -> DataFrame:
    """Each commit on circular links with the smallest commit of its class."""
    return hierarchy.circular_nodes(hierarchy.latest_links(read(spark, d, "commits_info"))).select("cycle_min", F.col("id").alias("commit_id"))


def p4_tree(spark: SparkSession, d: str) -> DataFrame:
    """Every commit in the forest of first parents: root, depth, exact path (as text) and number of descendants."""
    trees = hierarchy.hierarchy(hierarchy.first_parents(hierarchy.latest_links(read(spark, d, "commits_info"))))
    return trees.select(F.col("id").alias("commit_id"), "root", "depth", F.array_join("path", "/").alias("path"), "n_descendants")


def p4_descendants(spark: SparkSession, d: str) -> DataFrame:
    """Each commit with each other commit from which following ``parents`` (any of them) leads to it."""
    links = hierarchy.latest_links(read(spark, d, "commits_info"))
    roots = links.select(F.col("id").alias("key"), "id")
    return graph.reachable(roots, hierarchy.edges_of(links)).filter("key <> id").select(F.col("id").alias("commit_id"), F.col("key").alias("descendant"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """Each cell whose latest value is of no use."""
    return wide.useless_cells(wide.wide_table(read(spark, d, "project_metadata"), read(spark, d, "metadata_keys")))


def p5_wide(spark: SparkSession, d: str) -> DataFrame:
    """One row per project with a typed column per proper key."""
    return wide.wide_table(read(spark, d, "project_metadata"), read(spark, d, "metadata_keys")).drop("useless")


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """Each failing line with the first reason that applies."""
    return records.failed_records(records.parse_records(read(spark, d, "raw_projects"), read(spark, d, "language_names")))


def p6_valid(spark: SparkSession, d: str) -> DataFrame:
    """The valid rows, typed."""
    return records.valid_records(records.parse_records(read(spark, d, "raw_projects"), read(spark, d, "language_names")))


def p7_found(spark: SparkSession, d: str) -> DataFrame:
    """Each new or changed record that no successful run has processed."""
    return incremental.project_deltas(spark, d).select("log_name", "rec_seq").distinct()


QUERIES = {f.__name__: f for f in (p3_found, p3_history, p4_found, p4_tree, p4_descendants, p5_found, p5_wide, p6_found, p6_valid, p7_found)}

_OBSERVED = """
with s as (select distinct _seq, project_id, time, kind, new_kind, error from project_updates),
m as (select distinct x._seq, x.project_id, k.metakey, x.value from project_metadata x
      join metadata_keys k on regexp_replace(lower(x.key), '[^a-z0-9]', '', 'g') = regexp_replace(lower(k.metakey), '[^a-z0-9]', '', 'g')),
h as (select distinct _seq, project_id, heads from project_heads where heads is not null),
snap as (select _seq, project_id, heads, lag(_seq) over (partition by project_id order by _seq) before from h),
hb as (select _seq, project_id, before, unnest(map_keys(heads)) item, unnest(map_values(heads)).commit_id c from snap),
v as (
  select 'status' attr, project_id, '' item, _seq from (
    select *, row_number() over w rn, lag(kind) over w pk, lag(new_kind) over w pn, lag(error) over w pe from s window w as (partition by project_id order by time nulls first, _seq)) q
  where rn = 1 or kind is distinct from pk or new_kind is distinct from pn or error is distinct from pe
  union all
  select 'metadata', project_id, metakey, _seq from (
    select *, row_number() over w rn, lag(value) over w pv from m window w as (partition by project_id, metakey order by _seq)) q
  where rn = 1 or value is distinct from pv
  union all
  select 'heads', a.project_id, a.item, a._seq from hb a left join hb b on b.project_id = a.project_id and b.item = a.item and b._seq = a.before
  where b.item is null or a.c is distinct from b.c)
"""

_PERIODS = """
with s as (select distinct _seq, project_id, time, kind, new_kind, error from project_updates),
m as (select distinct x._seq, x.project_id, k.metakey, x.value from project_metadata x
      join metadata_keys k on regexp_replace(lower(x.key), '[^a-z0-9]', '', 'g') = regexp_replace(lower(k.metakey), '[^a-z0-9]', '', 'g')),
snap as (select _seq, project_id, heads, lag(_seq) over w before, lead(_seq) over w after from (select distinct _seq, project_id, heads from project_heads where heads is not null) q window w as (partition by project_id order by _seq)),
hb as (select _seq, project_id, before, after, unnest(map_keys(heads)) item, unnest(map_values(heads)).commit_id c from snap),
ev as (
  select 'status' attr, project_id, '' item, time t, _seq, case when rn = 1 then 'inserted' else 'changed' end op, cast(to_json({'kind': kind, 'new_kind': new_kind, 'error': error}) as varchar) state from (
    select *, row_number() over w rn, lag(kind) over w pk, lag(new_kind) over w pn, lag(error) over w pe from s window w as (partition by project_id order by time nulls first, _seq)) q
  where rn = 1 or kind is distinct from pk or new_kind is distinct from pn or error is distinct from pe
  union all
  select 'metadata', project_id, metakey, 0, _seq, case when rn = 1 then 'inserted' else 'changed' end, value from (
    select *, row_number() over w rn, lag(value) over w pv from m window w as (partition by project_id, metakey order by _seq)) q
  where rn = 1 or value is distinct from pv
  union all
  select 'heads', a.project_id, a.item, 0, a._seq, case when b.item is null then 'inserted' else 'changed' end, cast(a.c as varchar) from hb a left join hb b on b.project_id = a.project_id and b.item = a.item and b._seq = a.before
  where b.item is null or a.c is distinct from b.c
  union all
  select 'heads', a.project_id, a.item, 0, a.after, 'deleted', null from hb a left join hb b on b.project_id = a.project_id and b.item = a.item and b._seq = a.after where a.after is not null and b.item is null)
select attr, project_id, item, from_seq, to_seq, op, state from (
  select attr, project_id, item, _seq from_seq, lead(_seq) over (partition by attr, project_id, item order by t nulls first, _seq) to_seq, op, state from ev) q where op <> 'deleted'
"""

_LATEST = "select commit_id, parents from (select *, row_number() over (partition by commit_id order by _seq desc) rn from commits_info) q where rn = 1"

_EDGES = f"""
l as materialized ({_LATEST}),
e as materialized (select distinct commit_id a, p b from (select commit_id, unnest(parents) p from l) q where p in (select commit_id from l))
"""

_METADATA_TYPES = {
    "archived": "bool", "bus_factor": "int", "created": "timestamp", "default_branch": "string", "disabled": "bool", "fork": "bool", "forks": "int", "github_metadata": "json",
    "has_wiki": "bool", "health_score": "double", "homepage": "string", "language": "string", "last_release": "timestamp", "license": "string", "open_issues": "int",
    "pushed_at": "timestamp", "size_kb": "int", "stars": "int", "subscribers": "int", "test_coverage": "double",
}
_TYPED = {
    "string": "value",
    "int": r"case when regexp_full_match(trim(value), '[+-]?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)(\.0*)?') then try_cast(regexp_replace(replace(trim(value), ',', ''), '\..*$', '') as bigint) end",
    "double": r"case when regexp_full_match(trim(value), '[+-]?(([0-9]+|[0-9]{1,3}(,[0-9]{3})+)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?') then try_cast(replace(trim(value), ',', '') as double) end",
    "bool": "case when lower(trim(value)) in ('true', 't', 'yes', 'y', '1', 'on') then true when lower(trim(value)) in ('false', 'f', 'no', 'n', '0', 'off') then false end",
    "timestamp": r"case when regexp_full_match(trim(value), '[+-]?[0-9]{1,12}(\.0*)?') then make_timestamp(cast(regexp_replace(trim(value), '\..*$', '') as bigint) * 1000000) else try_cast(replace(replace(trim(value), '/', '-'), 'Z', '') as timestamp) end",
    "json": "case when json_valid(value) and lower(trim(value)) <> 'null' then value end",
}
_CELLS = """
with m as (select x.project_id, k.metakey, k.value_type, x.value, x._seq from project_metadata x
      join metadata_keys k on regexp_replace(lower(x.key), '[^a-z0-9]', '', 'g') = regexp_replace(lower(k.metakey), '[^a-z0-9]', '', 'g')),
c as (select project_id, metakey, value_type, value from (select *, row_number() over (partition by project_id, metakey order by _seq desc) rn from m) q where rn = 1)
"""

_LINES = r"""
with r as (select raw_id, coalesce(raw_line, '') l from raw_projects),
f as (select raw_id, l, regexp_full_match(l, '(?s)[ \t\r]*("([^"\\]|\\.)*"[ \t\r]*|[^",]*)(,[ \t\r]*("([^"\\]|\\.)*"[ \t\r]*|[^",]*))*') ok,
  list_transform(regexp_extract_all(',' || l, '(?s),[ \t\r]*("(?:[^"\\]|\\.)*"|[^",]*)', 1), lambda x:
    case when starts_with(x, '"') then regexp_replace(substr(x, 2, length(x) - 2), '(?s)\\(.)', '\1', 'g') else regexp_replace(x, '[ \t\r]+$', '') end) v from r),
c as (select raw_id, v, case when not ok then 'quoting' when l = '' or len(v) <> 12 then 'column_count'
  when not (regexp_full_match(v[2], '[A-Za-z0-9._-]+/[A-Za-z0-9._-]+') and (v[3] = '' or lower(v[3]) in (select lower(language_name) from language_names))
    and v[5] in ('0', '1') and v[6] in ('0', '1') and v[7] in ('0', '1') and regexp_full_match(v[1] || ',' || v[4] || ',' || array_to_string(v[8:12], ','), '([0-9]+,){6}[0-9]+')) then 'value' end reason from f)
"""

SQL = {
    "p3_found": _OBSERVED + "select attr, project_id, item, _seq as from_seq from v",
    "p3_history": _PERIODS,
    "p4_found": f"""
with recursive {_EDGES},
r(a, b) as (select a, b from e union select r.a, e.b from r join e on e.a = r.b),
c as (select a from r where a = b),
m as (select x.a, y.b from r x join r y on y.a = x.b and y.b = x.a where x.a in (select a from c)),
mutual as (select x.a, x.b from r x join r y on y.a = x.b and y.b = x.a)
select min(b) as cycle_min, a as commit_id from mutual group by a
""",
    "p4_tree": f"""
with recursive l as materialized ({_LATEST}),
g as (select commit_id id, unnest(parents) p, generate_subscripts(parents, 1) k from l),
k as (select id, arg_min(p, k) parent from g where p in (select commit_id from l) group by id),
f as materialized (select l.commit_id id, k.parent from l left join k on k.id = l.commit_id),
t(id, root, depth, path) as (
  select id, id, cast(0 as bigint), cast(id as varchar) from f where parent is null
  union all select f.id, t.root, t.depth + 1, t.path || '/' || f.id from t join f on f.parent = t.id),
u(anc, id) as (select parent, id from f where parent is not null union select f.parent, u.id from u join f on f.id = u.anc where f.parent is not null),
n as (select anc, count(*) k from u group by anc)
select f.id as commit_id, t.root, t.depth, t.path, case when t.root is not null then coalesce(n.k, 0) end as n_descendants
from f left join t on t.id = f.id left join n on n.anc = f.id
""",
    "p5_found": r"""
with m as (select x.project_id, k.metakey, k.value_type, x.value, x._seq from project_metadata x
      join metadata_keys k on regexp_replace(lower(x.key), '[^a-z0-9]', '', 'g') = regexp_replace(lower(k.metakey), '[^a-z0-9]', '', 'g')),
c as (select project_id, metakey, value_type, value from (select *, row_number() over (partition by project_id, metakey order by _seq desc) rn from m) q where rn = 1)
select project_id, metakey from c where trim(value) <> '' and not case value_type
  when 'string' then true
  when 'int' then regexp_full_match(trim(value), '[+-]?([0-9]+|[0-9]{1,3}(,[0-9]{3})+)(\.0*)?')
  when 'double' then regexp_full_match(trim(value), '[+-]?(([0-9]+|[0-9]{1,3}(,[0-9]{3})+)(\.[0-9]*)?|\.[0-9]+)([eE][+-]?[0-9]+)?')
  when 'bool' then lower(trim(value)) in ('true', 't', 'yes', 'y', '1', 'on', 'false', 'f', 'no', 'n', '0', 'off')
  when 'timestamp' then regexp_full_match(trim(value), '[+-]?[0-9]{1,12}(\.0*)?') or try_cast(replace(replace(trim(value), '/', '-'), 'Z', '') as timestamp) is not null
  else json_valid(value) and lower(trim(value)) <> 'null' end
""",
    "p5_wide": _CELLS + "select project_id, " + ", ".join(f"max(case when metakey = '{k}' and trim(value) <> '' then {_TYPED[t]} end) as {k}" for k, t in _METADATA_TYPES.items()) + " from c group by project_id",
    "p6_found": _LINES + "select raw_id, reason from c where reason is not null",
    "p6_valid": _LINES + """
select raw_id, try_cast(v[1] as bigint) as id, v[2] as name, nullif(v[3], '') as language, try_cast(v[4] as bigint) as created, v[5] = '1' as fork, v[6] = '1' as disabled, v[7] = '1' as archived,
  try_cast(v[8] as bigint) as stars, try_cast(v[9] as bigint) as forks, try_cast(v[10] as bigint) as network_count, try_cast(v[11] as bigint) as subscribers, try_cast(v[12] as bigint) as size
from c where reason is null""",
    "p7_found": """
with runs as (select run_id, log_name, arg_max(struct_pack(o := outcome, a := from_seq, b := to_seq), struct_pack(t := reported_at, n := outcome <> 'ok')) r from ingest_runs group by 1, 2),
ok as (select log_name, r.a a, r.b b from runs where r.o = 'ok'),
s as (select distinct 'project_updates' log_name, _seq, project_id, cast(to_json({'k': kind, 'n': new_kind, 'e': error}) as varchar) st from project_updates),
h as (select 'project_heads' log_name, _seq, project_id, cast(list_sort(list_transform(map_entries(heads), lambda e: e.key || '=' || e.value.commit_id)) as varchar) st
      from (select distinct _seq, project_id, heads from project_heads where heads is not null) q),
x as (select *, row_number() over w rn, lag(st) over w ps from (select * from s union all select * from h) q window w as (partition by log_name, project_id order by _seq))
select log_name, _seq as rec_seq from x where (rn = 1 or st is distinct from ps)
  and not exists (select 1 from ok where ok.log_name = x.log_name and x._seq between ok.a and ok.b)
""",
}
