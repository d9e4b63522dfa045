"""Queries of filters, joins, aggregations, graph walks, sampling, set operations and merges, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.functions import scalars as S
from commitlake.functions import tables
from commitlake.operators import aggregate, assemble, graph, hierarchy, log, merge, sampling
from commitlake.operators.history import heads_state, normal_key
from commitlake.operators.ordering import with_previous
from commitlake.session import cut, read

DAYS = 90


def _commits(spark: SparkSession, d: str) -> DataFrame:
    """The last record of every commit."""
    return log.latest(read(spark, d, "commits_info"), ["commit_id"], ["committer", "committer_time", "author", "author_time", "parents", "changes", "message"])


def _heads(spark: SparkSession, d: str) -> DataFrame:
    """Branches of the last head map of every project."""
    return graph.head_commits(log.latest(read(spark, d, "project_heads").filter("heads is not null"), ["project_id"], ["heads"]))


def _languages(spark: SparkSession, d: str) -> DataFrame:
    """``project_id, language``: the last language of every project, in lower case."""
    rows = read(spark, d, "project_metadata").filter(normal_key("key") == "language")
    return log.latest(rows, ["project_id"], ["value"]).filter("trim(value) <> ''").select("project_id", F.lower(F.trim("value")).alias("language"))


def _member(spark: SparkSession, d: str) -> DataFrame:
    """``project_id, commit_id``: the commits reachable from the heads of every project."""
    links = hierarchy.latest_links(read(spark, d, "commits_info"))
    roots = _heads(spark, d).select(F.col("project_id").alias("key"), F.col("commit_id").alias("id")).join(links.select("id"), "id", "left_semi")
    return graph.reachable(roots, hierarchy.edges_of(links)).select(F.col("key").alias("project_id"), F.col("id").alias("commit_id"))


def _export(spark: SparkSession, d: str) -> DataFrame:
    commits = _commits(spark, d)
    return cut(aggregate.export_rows(_member(spark, d), commits, aggregate.files_per_language(graph.changes(commits), read(spark, d, "path_strings"))))


# --- filters --------------------------------------------------------------------------------------------------------------


def f01_last_of_id(spark, d):
    """Last head map of one project."""
    rows = read(spark, d, "project_heads").filter("project_id = 5 and heads is not null")
    return log.latest(rows, ["project_id"], ["heads"]).select("project_id", "_seq", F.size("heads").cast("bigint").alias("n_heads"))


def f03_first_match(spark, d):
    """First record under each way of writing a url, by host."""
    rows = log.history(read(spark, d, "project_metadata")).filter(normal_key("key") == "homepage")
    host = F.regexp_extract("value", "^https?://([^/]+)/", 1)
    return rows.withColumn("host", host).filter("host <> ''").groupBy("host").agg(F.min_by("project_id", "_seq").alias("project_id"), F.min("_seq").alias("first_seq"))


def f04_status_tests(spark, d):
    """Errors and valid updates per project."""
    rows = log.history(read(spark, d, "project_updates"))
    return rows.groupBy("project_id").agg(aggregate.count_if(F.col("kind") == "Error").alias("errors"), aggregate.count_if(F.col("kind").isin("NoChange", "Ok")).alias("valid"))


def f06_url_column(spark, d):
    """Columns of a CSV-like table with the number of their values that parse as project urls."""
    rows = log.history(read(spark, d, "project_metadata")).filter("value is not null").select(F.col("key").alias("column"), F.concat("value", F.lit(".git")).alias("v"))
    return rows.groupBy("column").agg(F.count("*").alias("values"), aggregate.count_if(S.url_kind(F.col("v")).isNotNull()).alias("urls")).filter("urls > 0")


def f07_project_filter(spark, d):
    """Projects of some languages first updated within a span, both ends included."""
    first = read(spark, d, "project_updates").groupBy("project_id").agg(F.min("time").alias("created"))
    return _languages(spark, d).filter(F.col("language").isin("python", "java", "go")).join(first, "project_id").filter("created between 1325376000 and 1577836800")


def f12_not_deleted(spark, d):
    """Files of every substore's last commits that were not deleted."""
    commits = log.latest(read(spark, d, "commits_info"), ["commit_id"], ["substore", "changes"])
    return commits.select("substore", F.explode("changes").alias("path_id", "hash_id")).filter("hash_id <> 0").groupBy("substore").agg(F.count("*").alias("files"))


def f15_heads_difference(spark, d):
    """Branches that changed between the middle of the log of heads and now."""
    heads = read(spark, d, "project_heads").filter("heads is not null")
    half = (heads.agg(F.max("_seq").alias("m")).first()["m"] or 0) // 2
    old = graph.head_commits(log.latest(log.as_of(heads, half), ["project_id"], ["heads"]))
    return graph.heads_difference(old, _heads(spark, d))


def f16_main_branch(spark, d):
    """The head of each project's main branch: the one named in its metadata, else master."""
    rows = read(spark, d, "project_metadata").filter(normal_key("key") == "githubmetadata")
    named = log.latest(rows, ["project_id"], ["value"]).select("project_id", S.json_value(F.col("value"), "$.default_branch", "string").alias("named"))
    heads = _heads(spark, d)
    branch = F.concat(F.lit("refs/heads/"), F.coalesce("named", F.lit("master")))
    return heads.join(named, "project_id", "left").filter(F.col("branch") == branch).select("project_id", "branch", "commit_id")


def f17_head_errors(spark, d):
    """Heads whose commit was never recorded."""
    from commitlake.operators.verify import head_errors

    return head_errors(_heads(spark, d), read(spark, d, "commits_info"))


# --- joins ----------------------------------------------------------------------------------------------------------------


def j01_projects(spark, d):
    """Assembled projects."""
    return assemble.projects(read(spark, d, "project_updates"), read(spark, d, "project_heads"))


def j02_commit_users(spark, d):
    """Commits with the mail addresses of committer and author."""
    return assemble.with_users(_commits(spark, d).select("commit_id", "committer", "author"), read(spark, d, "users"))


def j03_change_paths(spark, d):
    """Changes with path and whether the content is stored."""
    return assemble.with_contents(graph.changes(_commits(spark, d)), read(spark, d, "path_strings"), read(spark, d, "contents")).select("commit_id", "path", "hash_id", "has_contents")


def j05_head_times(spark, d):
    """Commit time of every head."""
    times = _commits(spark, d).select("commit_id", "committer_time")
    return _heads(spark, d).join(times, "commit_id").select("project_id", "branch", "committer_time")


def j06_sha_to_id(spark, d):
    """Commit ids of all hashes that ever were a head, and how many projects had them."""
    rows = graph.head_commits(read(spark, d, "project_heads").filter("heads is not null"))
    return rows.groupBy("sha").agg(F.min("commit_id").alias("commit_id"), F.count_distinct("project_id").alias("projects"))


def j07_cascade(spark, d):
    """Size of the dataset cut down to projects of one language."""
    chosen = _languages(spark, d).filter("language = 'python'").select("project_id")
    users = read(spark, d, "users").filter("user_id <> 0").select("user_id").distinct()
    parts = assemble.cascade(chosen, _heads(spark, d), _commits(spark, d).drop("_seq", "changes"), users)
    return aggregate.summary(parts)


def j09_unfinished(spark, d):
    """Heads' commits whose contents are all missing: changes left to fetch."""
    changed = graph.changes(_commits(spark, d)).filter("hash_id <> 0")
    return changed.join(read(spark, d, "contents").select("hash_id").distinct(), "hash_id", "left_anti").groupBy("commit_id").agg(F.count("*").alias("missing"))


def j10_by_id_list(spark, d):
    """Last status of the projects that have a head map."""
    listed = read(spark, d, "project_heads").filter("heads is not null").select("project_id").distinct()
    return log.latest(read(spark, d, "project_updates"), ["project_id"], ["kind"]).join(listed, "project_id", "left_semi").select("project_id", "kind")


# --- aggregations ---------------------------------------------------------------------------------------------------------


def a02_project_languages(spark, d):
    """Commits, bug fixes and changed files per project and language."""
    return aggregate.project_languages(_export(spark, d))


def a03_projects(spark, d):
    """Totals per project."""
    return aggregate.project_totals(_export(spark, d))


def a04_ratios(spark, d):
    """Percentages per project and language."""
    rows = _export(spark, d)
    return aggregate.ratios(aggregate.project_languages(rows), aggregate.project_totals(rows))


def a05_files_per_language(spark, d):
    """Changed files per commit and language."""
    return aggregate.files_per_language(graph.changes(_commits(spark, d)), read(spark, d, "path_strings"))


def a06_active_projects(spark, d):
    """Projects, valid and active ones per substore and in total; now is the newest commit time."""
    commits = _commits(spark, d).select("commit_id", "committer_time")
    now = commits.agg(F.max("committer_time").alias("m")).first()["m"] or 0
    times = _heads(spark, d).join(commits, "commit_id")
    return aggregate.active_projects(assemble.projects(read(spark, d, "project_updates"), read(spark, d, "project_heads")), times, now, DAYS)


def a07_error_projects(spark, d):
    """Projects, the highest id and those whose last status is an error."""
    last = log.latest(read(spark, d, "project_updates"), ["project_id"], ["kind"])
    return last.agg(F.count("*").alias("projects"), F.max("project_id").alias("max_id"), aggregate.count_if(F.col("kind") == "Error").alias("errors"))


def a10_min_commits(spark, d):
    """Projects with at least ten commits."""
    return aggregate.at_least(_member(spark, d), "project_id", "commit_id", tables.SMALL_PROJECT)


def a12_people(spark, d):
    """Distinct authors, committers and their union, per substore."""
    rows = log.history(read(spark, d, "commits_info")).select("substore", "author", "committer")
    both = rows.select("substore", F.explode(F.array("author", "committer")).alias("u"))
    return rows.groupBy("substore").agg(F.count_distinct("author").alias("authors"), F.count_distinct("committer").alias("committers")).join(both.groupBy("substore").agg(F.count_distinct("u").alias("people")), "substore")


def a14_summary(spark, d):
    """Records of every table."""
    names = ["commits_info", "contents", "path_strings", "project_heads", "project_metadata", "project_updates", "users", "users_metadata"]
    return aggregate.summary({t: read(spark, d, t).distinct() if t == "users" else log.history(read(spark, d, t)) for t in names})


def r23_contents_size(spark, d):
    """Stored contents and bytes per substore and in total."""
    return aggregate.contents_size(log.history(read(spark, d, "contents")))


# --- graph ----------------------------------------------------------------------------------------------------------------


def x01_reachable(spark, d):
    """Commits reachable from the heads of every project."""
    return _member(spark, d)


def x03_trees(spark, d):
    """Files of every project at its heads: the newest change of each path by commit time."""
    commits = _commits(spark, d)
    changed = graph.changes(commits).join(commits.select("commit_id", "committer_time"), "commit_id").join(_member(spark, d), "commit_id")
    return graph.tree(changed, ["project_id"], ["committer_time", "commit_id"])


def x04_bounded_count(spark, d):
    """Commits of every project, counted up to ten."""
    return _member(spark, d).groupBy("project_id").agg(F.least(F.count("*"), F.lit(tables.SMALL_PROJECT)).alias("commits"))


def x05_new_commits(spark, d):
    """Commits reachable from heads that were not recorded before the middle of the log."""
    raw = read(spark, d, "commits_info")
    half = (raw.agg(F.max("_seq").alias("m")).first()["m"] or 0) // 2
    links = hierarchy.latest_links(raw)
    known = log.as_of(raw, half).select(F.col("commit_id").alias("id")).distinct()
    heads = _heads(spark, d).select(F.col("commit_id").alias("id")).join(links.select("id"), "id", "left_semi")
    return graph.unknown_commits(heads, hierarchy.edges_of(links), known).select(F.col("id").alias("commit_id"))


def x07_tree_difference(spark, d):
    """Changes between the tree of every substore at the middle of its commit times and now."""
    commits = log.latest(read(spark, d, "commits_info"), ["commit_id"], ["substore", "committer_time", "changes"])
    middle = commits.agg(((F.min("committer_time") + F.max("committer_time")) / 2).cast("bigint").alias("m")).first()["m"]
    changed = commits.select("substore", "commit_id", "committer_time", F.explode("changes").alias("path_id", "hash_id"))
    order = ["committer_time", "commit_id"]
    return graph.tree_difference(graph.tree(changed.filter(F.col("committer_time") < (middle or 0)), ["substore"], order), graph.tree(changed, ["substore"], order), ["substore"])


def x08_edges(spark, d):
    """Links of the commit graph with the position of the parent."""
    return graph.edges(_commits(spark, d)).withColumn("pos", F.col("pos").cast("bigint"))


# --- sorting, sampling, sets ----------------------------------------------------------------------------------------------


def s01_update_queue(spark, d):
    """The hundred projects to update next: those updated longest ago."""
    return sampling.first(read(spark, d, "project_updates").groupBy("project_id").agg(F.max("time").alias("last_time")), ["last_time", "project_id"], 100)


def s03_first_projects(spark, d):
    """The fifty projects that were recorded first."""
    return sampling.first(read(spark, d, "project_updates").groupBy("project_id").agg(F.min("_seq").alias("first_seq")), ["first_seq"], 50)


def s05_sample(spark, d):
    """Fifty projects by the order of their hash."""
    return sampling.uniform(read(spark, d, "project_updates").select("project_id").distinct(), "project_id", 50)


def s06_stratified(spark, d):
    """Up to three projects of every language by the order of their hash."""
    return sampling.stratified(_languages(spark, d), "language", "project_id", 3)


def u01_people(spark, d):
    """Union of author and committer ids."""
    c = _commits(spark, d)
    return c.select(F.col("author").alias("user_id")).union(c.select("committer")).filter("user_id is not null").distinct()


def u02_difference(spark, d):
    """Users who never wrote nor committed."""
    c = read(spark, d, "commits_info")
    active = c.select(F.col("author").alias("user_id")).union(c.select("committer"))
    return read(spark, d, "users").select("user_id").distinct().subtract(active)


def u03_intersection(spark, d):
    """Users who both wrote and committed in several substores' records."""
    c = read(spark, d, "commits_info")
    return c.select(F.col("author").alias("user_id")).intersect(c.select(F.col("committer").alias("user_id"))).filter("user_id is not null")


def u05_retain(spark, d):
    """Branches of the last head maps that are no feature branches."""
    maps = log.latest(read(spark, d, "project_heads").filter("heads is not null"), ["project_id"], ["heads"])
    kept = maps.select("project_id", F.map_filter("heads", lambda k, v: ~k.startswith("refs/heads/fix")).alias("heads"))
    return graph.head_commits(kept).select("project_id", "branch", "commit_id")


def u06_changed_maps(spark, d):
    """Head maps that differ from the project's map before."""
    rows = log.history(read(spark, d, "project_heads")).filter("heads is not null").select("project_id", "_seq", heads_state().alias("state"))
    return with_previous(rows, ["project_id"], ["_seq"], ["state"]).filter("not has_prev or not (state <=> prev_state)").select("project_id", "_seq")


# --- merging --------------------------------------------------------------------------------------------------------------

TARGET, SOURCE = "Python", "JavaScript"


def _sides(spark, d, table):
    rows = read(spark, d, table)
    return rows.filter(F.col("substore") == TARGET), rows.filter(F.col("substore") == SOURCE)


def _path_dictionary(spark, d):
    target, source = _sides(spark, d, "path_strings")
    return merge.dictionary(target, source, "path_id", "path")


def _user_dictionary(spark, d):
    target, source = _sides(spark, d, "users")
    return merge.dictionary(target, source, "user_id", "email")


def _hash_dictionary(spark, d):
    target, source = (log.latest(x, ["hash_id"], ["contents"]).select("hash_id", S.sha1_of(F.col("contents")).alias("sha")) for x in _sides(spark, d, "contents"))
    return merge.dictionary(target, source, "hash_id", "sha")


def _commit_dictionary(spark, d):
    target, source = (x.select("commit_id", F.sha1(F.col("commit_id").cast("string")).alias("sha")) for x in _sides(spark, d, "commits_info"))
    return merge.dictionary(target, source, "commit_id", "sha")


def m01_merge_users(spark, d):
    """Translation of user ids when one substore is merged into another."""
    return _user_dictionary(spark, d)


def m02_merge_paths(spark, d):
    """Translation of path ids."""
    return _path_dictionary(spark, d)


def m03_merge_hashes(spark, d):
    """Translation of content hashes, by the hash of the bytes."""
    return _hash_dictionary(spark, d)


def m04_merge_contents(spark, d):
    """Contents to append."""
    target, source = _sides(spark, d, "contents")
    return merge.contents(target, log.latest(source, ["hash_id"], ["kind", "contents"]), _hash_dictionary(spark, d)).groupBy("hash_id", "kind").agg(F.max(F.length("contents")).cast("bigint").alias("bytes"))


def m05_merge_commits(spark, d):
    """Records of new commits with all ids translated, in long form."""
    source = _commits_of(spark, d, SOURCE)
    out = merge.commits(source, _commit_dictionary(spark, d), _user_dictionary(spark, d), _path_dictionary(spark, d), _hash_dictionary(spark, d))
    return out.select("commit_id", "new_commit", "new_author", F.array_join(F.col("new_parents").cast("array<string>"), ",", "-").alias("new_parents"), F.size("new_changes").cast("bigint").alias("changes"))


def _commits_of(spark, d, substore):
    return log.latest(read(spark, d, "commits_info").filter(F.col("substore") == substore), ["commit_id"], ["committer", "committer_time", "author", "author_time", "parents", "changes", "message"])


def m06_merge_projects(spark, d):
    """Projects of one substore whose homepages, current or former, no project of the other has."""
    rows = log.history(read(spark, d, "project_metadata")).filter((normal_key("key") == "homepage") & (F.trim("value") != "")).select("project_id", F.col("value").alias("url"))
    placed = rows.join(assemble.substores(read(spark, d, "project_updates")), "project_id")
    return merge.new_projects(placed.filter(F.col("substore") == TARGET), placed.filter(F.col("substore") == SOURCE))


def a08_merge_counters(spark, d):
    """Total, existing and added values of the merged dictionaries."""
    out = merge.counters(_user_dictionary(spark, d), "users").unionByName(merge.counters(_path_dictionary(spark, d), "paths"))
    return out.unionByName(merge.counters(_hash_dictionary(spark, d), "hashes"))


QUERIES = {
    f.__name__: f
    for f in (
        f01_last_of_id, f03_first_match, f04_status_tests, f06_url_column, f07_project_filter, f12_not_deleted, f15_heads_difference, f16_main_branch, f17_head_errors,
        j01_projects, j02_commit_users, j03_change_paths, j05_head_times, j06_sha_to_id, j07_cascade, j09_unfinished, j10_by_id_list,
        a02_project_languages, a03_projects, a04_ratios, a05_files_per_language, a06_active_projects, a07_error_projects, a08_merge_counters, a10_min_commits, a12_people, a14_summary, r23_contents_size,
        x01_reachable, x03_trees, x04_bounded_count, x05_new_commits, x07_tree_difference, x08_edges,
        s01_update_queue, s03_first_projects, s05_sample, s06_stratified, u01_people, u02_difference, u03_intersection, u05_retain, u06_changed_maps,
        m01_merge_users, m02_merge_paths, m03_merge_hashes, m04_merge_contents, m05_merge_commits, m06_merge_projects,
    )
}

# --- SQL ------------------------------------------------------------------------------------------------------------------

_NORM = "regexp_replace(lower(key), '[^a-z0-9]', '', 'g')"
_EXT = "regexp_extract(path, '[^/]\\.([^./]*)$', 1)"
_LANG = "case " + _EXT + " " + " ".join(f"when '{e}' then '{k}'" for e, k in tables.LANGUAGE_OF_EXTENSION.items()) + " else '' end"
_BUG = "(" + " or ".join(f"contains(message, '{w}')" for w in tables.BUG_WORDS) + ")"
_LAST = "select * from (select *, row_number() over (partition by {k} order by _seq desc) rn from {t}) q where rn = 1"
_CI = "ci as materialized (" + _LAST.format(k="commit_id", t="commits_info") + ")"
_E = "e as materialized (select distinct a, b from (select commit_id a, unnest(parents) b from ci) q where b in (select commit_id from ci))"
_H0 = "h0 as materialized (" + _LAST.format(k="project_id", t="(select * from project_heads where heads is not null)") + ")"
_HD = _H0 + ", hd as materialized (select project_id, branch, v.commit_id commit_id, v.sha sha from (select project_id, unnest(map_keys(heads)) branch, unnest(map_values(heads)) v from h0) q)"
_MEM = f"{_CI}, {_E}, {_HD}, m(project_id, commit_id) as (select project_id, commit_id from hd where commit_id in (select commit_id from ci) union select m.project_id, e.b from m join e on e.a = m.commit_id)"
_P = f"p as materialized (select path_id, {_LANG} as language from ({_LAST.format(k='path_id', t='path_strings')}) q)"
_CH = "ch as materialized (select commit_id, unnest(map_keys(changes)) path_id, unnest(map_values(changes)) hash_id from ci)"
_FL = f"{_P}, {_CH}, fl as materialized (select commit_id, language, count(*) files from ch join p on p.path_id = ch.path_id where language <> '' group by 1, 2)"
_X = f"{_MEM}, {_FL}, x as materialized (select m.project_id, fl.language, m.commit_id, fl.files, ci.committer, ci.committer_time, cast(coalesce({_BUG}, false) as int) is_bug from m join fl on fl.commit_id = m.commit_id join ci on ci.commit_id = m.commit_id)"
_PL = "pl as (select project_id, language, count(*) commits, cast(sum(is_bug) as bigint) bugs, cast(sum(files) as bigint) changes from x group by 1, 2)"
_PT = """pc as (select project_id, commit_id, max(is_bug) b, max(committer) c, max(committer_time) t, sum(files) f from x group by 1, 2),
pt as (select project_id, count(*) commits, cast(sum(b) as bigint) bugs, cast(sum(f) as bigint) changes, count(distinct c) authors, max(t) - min(t) age,
  (select count(distinct language) from x where x.project_id = pc.project_id) languages from pc group by project_id)"""
_LG = f"lg as materialized (select project_id, lower(trim(value)) as language from ({_LAST.format(k='project_id', t=f'''(select * from project_metadata where {_NORM} = 'language')''')}) q where trim(value) <> '')"
_ASM = f"""ids as (select project_id from project_updates union select project_id from project_heads),
lu as ({_LAST.format(k='project_id', t='project_updates')}), ls as ({_LAST.format(k='project_id', t="(select * from project_updates where kind = 'ChangeStore')")}),
lv as (select project_id, max(time) t from project_updates where kind in ('Ok', 'NoChange') group by 1),
asm as (select i.project_id, coalesce(ls.new_kind, 'Unspecified') as substore, coalesce(lu.kind, 'Error') as kind, coalesce(lu.time, 0) as time,
  case when lu.kind is null then 'no_data' else lu.error end as error, lv.t as latest_valid_time, coalesce(cast(cardinality(h0.heads) as bigint), 0) as n_heads
  from ids i left join lu on lu.project_id = i.project_id left join ls on ls.project_id = i.project_id left join lv on lv.project_id = i.project_id left join h0 on h0.project_id = i.project_id
  where i.project_id is not null)"""


def _dictionary(name: str, target: str, source: str) -> str:
    """CTEs ``name(source, target, is_new)``; the inner tables have ``id, v``."""
    return f"""{name}_t as materialized (select distinct id, v from ({target}) q where v is not null), {name}_s as materialized (select distinct id, v from ({source}) q where v is not null and id is not null),
{name}_k as (select v, min(id) id from {name}_t group by 1), {name}_n as (select v, min(id) f from {name}_s where v not in (select v from {name}_k) group by 1),
{name}_i as (select v, id, false is_new from {name}_k union all select v, (select max(id) from {name}_t) + row_number() over (order by f, v), true from {name}_n),
{name} as materialized (select s.id as source, i.id as target, i.is_new from {name}_s s join {name}_i i on i.v = s.v)"""


def _of(table: str, id_: str, value: str) -> list[str]:
    return [f"select {id_} id, {value} v from {table} where substore = '{s}'" for s in (TARGET, SOURCE)]


_DU = _dictionary("du", *_of("users", "user_id", "email"))
_DP = _dictionary("dp", *_of("path_strings", "path_id", "path"))
_DH = _dictionary("dh", *_of("contents", "hash_id", "sha1(contents)"))
_DC = _dictionary("dc", *_of("commits_info", "commit_id", "sha1(cast(commit_id as varchar))"))

SQL = {
    "f01_last_of_id": "select project_id, _seq, cast(cardinality(heads) as bigint) as n_heads from project_heads where project_id = 5 and heads is not null order by _seq desc limit 1",
    "f03_first_match": f"select host, arg_min(project_id, _seq) as project_id, min(_seq) as first_seq from (select *, regexp_extract(value, '^https?://([^/]+)/', 1) host from project_metadata where {_NORM} = 'homepage') q where host <> '' group by 1",
    "f04_status_tests": "select project_id, count(*) filter (where kind = 'Error') as errors, count(*) filter (where kind in ('NoChange', 'Ok')) as valid from (select distinct * from project_updates) q group by 1",
    "f06_url_column": "select key as \"column\", count(*) as \"values\", count(*) filter (where value like 'https://%') as urls from (select distinct * from project_metadata where value is not null) q group by 1 having count(*) filter (where value like 'https://%') > 0",
    "f07_project_filter": f"with {_LG} select lg.project_id, lg.language, f.created from lg join (select project_id, min(time) created from project_updates group by 1) f on f.project_id = lg.project_id where language in ('python', 'java', 'go') and created between 1325376000 and 1577836800",
    "f12_not_deleted": f"with {_CI} select substore, count(*) as files from (select substore, unnest(map_values(changes)) h from ci) q where h <> 0 group by 1",
    "f15_heads_difference": f"""
with {_HD}, o0 as ({_LAST.format(k='project_id', t="(select * from project_heads where heads is not null and _seq < (select max(_seq) // 2 from project_heads where heads is not null))")}),
od as (select project_id, branch, v.commit_id commit_id from (select project_id, unnest(map_keys(heads)) branch, unnest(map_values(heads)) v from o0) q)
select coalesce(o.project_id, n.project_id) as project_id, coalesce(o.branch, n.branch) as branch, case when o.branch is null then 'added' when n.branch is null then 'removed' else 'moved' end as change
from od o full join hd n on n.project_id = o.project_id and n.branch = o.branch where o.branch is null or n.branch is null or o.commit_id is distinct from n.commit_id""",
    "f16_main_branch": f"""
with {_HD}, g as (select project_id, case when json_valid(value) and json_type(value, '$.default_branch') = 'VARCHAR' then json_extract_string(value, '$.default_branch') end named
  from ({_LAST.format(k='project_id', t=f"(select * from project_metadata where {_NORM} = 'githubmetadata')")}) q)
select hd.project_id, branch, commit_id from hd left join g on g.project_id = hd.project_id where branch = 'refs/heads/' || coalesce(named, 'master')""",
    "f17_head_errors": f"with {_HD} select project_id, branch, commit_id from hd where commit_id not in (select commit_id from commits_info)",
    "j01_projects": f"with {_H0}, {_ASM} select * from asm",
    "j02_commit_users": f"with {_CI}, u as (select distinct user_id, email from users where user_id <> 0) select commit_id, committer, author, a.email as committer_email, b.email as author_email from ci left join u a on a.user_id = ci.committer left join u b on b.user_id = ci.author",
    "j03_change_paths": f"with {_CI}, {_CH}, n as ({_LAST.format(k='path_id', t='path_strings')}) select commit_id, n.path, hash_id, hash_id in (select hash_id from contents) as has_contents from ch join n on n.path_id = ch.path_id",
    "j05_head_times": f"with {_CI}, {_HD} select project_id, branch, committer_time from hd join ci on ci.commit_id = hd.commit_id",
    "j06_sha_to_id": "select v.sha as sha, min(v.commit_id) as commit_id, count(distinct project_id) as projects from (select project_id, unnest(map_values(heads)) v from project_heads where heads is not null) q group by 1",
    "j07_cascade": f"""
with {_CI}, {_HD}, {_LG}, h as (select * from hd where project_id in (select project_id from lg where language = 'python')), c as (select * from ci where commit_id in (select commit_id from h)),
u as (select author u from c union select committer from c)
select 'heads' as table_name, count(*) as records from h union all select 'commits', count(*) from c union all select 'links', count(*) from (select unnest(parents) p from c) q
union all select 'users', count(distinct user_id) from users where user_id <> 0 and user_id in (select u from u where u is not null)""",
    "j09_unfinished": f"with {_CI}, {_CH} select commit_id, count(*) as missing from ch where hash_id <> 0 and hash_id not in (select hash_id from contents) group by 1",
    "j10_by_id_list": f"select project_id, kind from ({_LAST.format(k='project_id', t='project_updates')}) q where project_id in (select project_id from project_heads where heads is not null)",
    "a02_project_languages": f"with recursive {_X}, {_PL} select * from pl",
    "a03_projects": f"with recursive {_X}, {_PT} select project_id, commits, bugs, changes, authors, age, languages from pt",
    "a04_ratios": f"""with recursive {_X}, {_PL}, {_PT} select pl.project_id, pl.language, pl.commits, pl.bugs, pl.changes, coalesce(pl.commits * 100 // nullif(pt.commits, 0), 0) as pct_commits,
 coalesce(pl.bugs * 100 // nullif(pt.bugs, 0), 0) as pct_bugs, coalesce(pl.changes * 100 // nullif(pt.changes, 0), 0) as pct_changes, 100 // nullif(pt.languages, 0) as pct_languages from pl join pt on pt.project_id = pl.project_id""",
    "a05_files_per_language": f"with {_CI}, {_FL} select * from fl",
    "a06_active_projects": f"""with {_CI}, {_HD}, {_ASM}, n as (select hd.project_id, max(committer_time) t from hd join ci on ci.commit_id = hd.commit_id group by 1)
select substore, count(*) as projects, count(latest_valid_time) as valid, count(*) filter (where n.t >= (select max(committer_time) from ci) - {DAYS * 86400}) as active from asm left join n on n.project_id = asm.project_id group by rollup(substore)""",
    "a07_error_projects": f"select count(*) as projects, max(project_id) as max_id, count(*) filter (where kind = 'Error') as errors from ({_LAST.format(k='project_id', t='project_updates')}) q",
    "a08_merge_counters": f"with {_DU}, {_DP}, {_DH} " + " union all ".join(f"select '{n}' as table_name, count(*) as total, count(*) filter (where not is_new) as existing, count(*) filter (where is_new) as added from {t}" for n, t in (("users", "du"), ("paths", "dp"), ("hashes", "dh"))),
    "a10_min_commits": f"with recursive {_MEM} select project_id, count(distinct commit_id) as n from m group by 1 having count(distinct commit_id) >= {tables.SMALL_PROJECT}",
    "a12_people": "select substore, count(distinct author) as authors, count(distinct committer) as committers, (select count(distinct u) from (select unnest([author, committer]) u from commits_info b where b.substore = a.substore) q) as people from commits_info a group by substore",
    "a14_summary": " union all ".join(f"select '{t}' as table_name, count(distinct _seq) as records from {t}" for t in ("commits_info", "contents", "path_strings", "project_heads", "project_metadata", "project_updates", "users_metadata")) + " union all select 'users', count(*) from (select distinct * from users) q",
    "r23_contents_size": "select substore, count(*) as records, cast(sum(octet_length(contents)) as bigint) as bytes from (select distinct * from contents) q group by rollup(substore)",
    "x01_reachable": f"with recursive {_MEM} select project_id, commit_id from m",
    "x03_trees": f"with recursive {_MEM}, {_CH} select project_id, path_id, hash_id from (select m.project_id, ch.path_id, ch.hash_id, row_number() over (partition by m.project_id, ch.path_id order by ci.committer_time desc, ci.commit_id desc) rn from m join ch on ch.commit_id = m.commit_id join ci on ci.commit_id = m.commit_id) q where rn = 1 and hash_id <> 0",
    "x04_bounded_count": f"with recursive {_MEM} select project_id, least(count(*), {tables.SMALL_PROJECT}) as commits from m group by 1",
    "x05_new_commits": f"""with recursive {_CI}, {_E}, {_HD}, k as materialized (select distinct commit_id from commits_info where _seq < (select max(_seq) // 2 from commits_info)),
r(c) as (select commit_id from hd where commit_id in (select commit_id from ci) union select e.b from r join e on e.a = r.c where r.c not in (select commit_id from k)) select c as commit_id from r where c not in (select commit_id from k)""",
    "x07_tree_difference": f"""with {_CI}, c as (select substore, commit_id, committer_time, unnest(map_keys(changes)) path_id, unnest(map_values(changes)) hash_id from ci), mid as (select (min(committer_time) + max(committer_time)) // 2 t from ci),
o as (select * from (select *, row_number() over (partition by substore, path_id order by committer_time desc, commit_id desc) rn from c where committer_time < (select t from mid)) q where rn = 1 and hash_id <> 0),
n as (select * from (select *, row_number() over (partition by substore, path_id order by committer_time desc, commit_id desc) rn from c) q where rn = 1 and hash_id <> 0)
select coalesce(o.substore, n.substore) as substore, coalesce(o.path_id, n.path_id) as path_id, coalesce(n.hash_id, 0) as hash_id from o full join n on n.substore = o.substore and n.path_id = o.path_id where o.hash_id is distinct from n.hash_id""",
    "x08_edges": f"with {_CI} select commit_id, parent_id, pos from (select commit_id, unnest(parents) parent_id, generate_subscripts(parents, 1) - 1 pos from ci) q where parent_id is not null",
    "s01_update_queue": "select project_id, max(time) as last_time from project_updates group by 1 order by 2, 1 limit 100",
    "s03_first_projects": "select project_id, min(_seq) as first_seq from project_updates group by 1 order by 2 limit 50",
    "s05_sample": "select project_id from (select distinct project_id from project_updates) q order by md5(cast(project_id as varchar)), project_id limit 50",
    "s06_stratified": f"with {_LG} select project_id, language from (select *, row_number() over (partition by language order by md5(cast(project_id as varchar)), project_id) rn from lg) q where rn <= 3",
    "u01_people": f"with {_CI} select user_id from (select author user_id from ci union select committer from ci) q where user_id is not null",
    "u02_difference": "select user_id from users except select u from (select author u from commits_info union all select committer from commits_info) q",
    "u03_intersection": "select user_id from (select author as user_id from commits_info intersect select committer from commits_info) q where user_id is not null",
    "u05_retain": f"with {_HD} select project_id, branch, commit_id from hd where not starts_with(branch, 'refs/heads/fix')",
    "u06_changed_maps": "select project_id, _seq from (select *, row_number() over w rn, lag(st) over w ps from (select distinct project_id, _seq, cast(list_sort(list_transform(map_entries(heads), lambda e: e.key || '=' || e.value.commit_id)) as varchar) st from project_heads where heads is not null) q window w as (partition by project_id order by _seq)) z where rn = 1 or st is distinct from ps",
    "m01_merge_users": f"with {_DU} select * from du",
    "m02_merge_paths": f"with {_DP} select * from dp",
    "m03_merge_hashes": f"with {_DH} select * from dh",
    "m04_merge_contents": f"""with {_DH}, s as ({_LAST.format(k='hash_id', t=f"(select * from contents where substore = '{SOURCE}')")})
select dh.target as hash_id, s.kind, max(octet_length(s.contents)) as bytes from s join dh on dh.source = s.hash_id where dh.target not in (select hash_id from contents where substore = '{TARGET}') group by 1, 2""",
    "m05_merge_commits": f"""with {_DU}, {_DP}, {_DH}, {_DC}, s as materialized ({_LAST.format(k='commit_id', t=f"(select * from commits_info where substore = '{SOURCE}')")}),
pa as (select commit_id, string_agg(coalesce(cast(dc.target as varchar), '-'), ',' order by pos) p from (select commit_id, unnest(parents) parent, generate_subscripts(parents, 1) pos from s) q left join dc on dc.source = q.parent group by 1),
cg as (select commit_id, count(distinct dp.target) n from (select commit_id, unnest(map_keys(changes)) path_id from s) q join dp on dp.source = q.path_id group by 1)
select s.commit_id, dc.target as new_commit, du.target as new_author, coalesce(pa.p, '') as new_parents, coalesce(cg.n, 0) as changes
from s join dc on dc.source = s.commit_id and dc.is_new left join du on du.source = s.author left join pa on pa.commit_id = s.commit_id left join cg on cg.commit_id = s.commit_id""",
    "m06_merge_projects": f"""with ls as ({_LAST.format(k='project_id', t="(select * from project_updates where kind = 'ChangeStore')")}),
u as (select distinct m.project_id, value url, coalesce(ls.new_kind, 'Unspecified') s from project_metadata m join ls on ls.project_id = m.project_id where {_NORM} = 'homepage' and trim(value) <> '')
select distinct project_id from u where s = '{SOURCE}' and project_id not in (select project_id from u where s = '{SOURCE}' and url in (select url from u where s = '{TARGET}'))""",
}
