"""Queries on logs, dictionaries, savepoints and integrity, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.functions import scalars as S
from commitlake.functions import tables
from commitlake.operators import log, savepoint, verify
from commitlake.operators.history import status_state
from commitlake.session import checkpoint_dir, read, small

LOGS = ["commits_info", "contents", "path_strings", "project_heads", "project_metadata", "project_updates", "users_metadata"]
KEY_OF = dict(zip(LOGS, ["commit_id", "hash_id", "path_id", "project_id", "project_id", "project_id", "id"]))
STATUS = ["_seq", "project_id", "kind", "time", "version", "old_offset", "new_kind", "error"]


def _logs(spark: SparkSession, d: str) -> dict[str, DataFrame]:
    return {t: read(spark, d, t) for t in LOGS}


def _half(df: DataFrame) -> int:
    """A position in the middle of a log: the savepoint of the time-travel queries."""
    return (df.agg(F.max("_seq").alias("m")).first()["m"] or 0) // 2


def r01_history(spark, d):
    """All status records in append order, each once."""
    return log.history(read(spark, d, "project_updates")).select(*STATUS)


def r02_latest(spark, d):
    """Latest status record of every project."""
    return log.latest(read(spark, d, "project_updates"), ["project_id"], ["kind", "time", "error"])


def r03_lookup(spark, d):
    """Latest status of one project."""
    return log.lookup(read(spark, d, "project_updates"), "project_id", 7).select("project_id", "_seq", "kind")


def r04_exists(spark, d):
    """Every content hash that was ever committed, with whether its content is stored."""
    hashes = read(spark, d, "commits_info").select(F.explode(F.map_values("changes")).alias("hash_id")).filter("hash_id <> 0").distinct()
    return log.exists(hashes, read(spark, d, "contents"), ["hash_id"], "stored")


def r05_metadata_history(spark, d):
    """All metadata records, each once."""
    return log.history(read(spark, d, "project_metadata")).select("_seq", "project_id", "key", "value")


def r08_history_rank(spark, d):
    """Age of every status record within its project, 1 for the newest."""
    return log.newest_first(read(spark, d, "project_updates"), ["project_id"]).select("project_id", "_seq", F.col("age").cast("bigint").alias("age"))


def r09_previous_link(spark, d):
    """Position of the record before, per project."""
    return log.previous_link(read(spark, d, "project_updates"), ["project_id"]).select("project_id", "_seq", F.col("prev__seq").alias("prev_seq"))


def r10_dictionary(spark, d):
    """The dictionary of users."""
    return read(spark, d, "users").select("substore", "user_id", "email").distinct()


def r11_decode(spark, d):
    """Paths of all committed path ids."""
    ids = read(spark, d, "commits_info").select(F.explode(F.map_keys("changes")).alias("path_id")).distinct()
    names = log.latest(read(spark, d, "path_strings"), ["path_id"], ["path"]).select("path_id", "path")
    return ids.join(names, "path_id")


def r12_encode(spark, d):
    """User ids of all mail addresses, in any letter case."""
    users = read(spark, d, "users").filter("user_id <> 0").select(F.lower("email").alias("email"), "user_id").distinct()
    return users.groupBy("email").agg(F.min("user_id").alias("first_id"), F.count("*").alias("ids"))


def r15_split_scan(spark, d):
    """All contents in order of kind, then of appending."""
    rows = log.history(read(spark, d, "contents"))
    return rows.select(S.contents_number(F.col("kind")).alias("kind_number"), "kind", "_seq", "hash_id", F.length("contents").cast("bigint").alias("bytes"))


def r16_single_kind(spark, d):
    """Contents of one kind."""
    return log.history(log.split(read(spark, d, "contents"), "Python")).select("hash_id", "_seq", F.length("contents").cast("bigint").alias("bytes"))


def r17_split_lookup(spark, d):
    """Kind and size of one content."""
    return log.lookup(read(spark, d, "contents"), "hash_id", 42).select("hash_id", "kind", F.length("contents").cast("bigint").alias("bytes"))


def r19_savepoint_latest(spark, d):
    """Latest status of every project as of a savepoint in the middle of the log."""
    updates = read(spark, d, "project_updates")
    return log.latest(log.as_of(updates, _half(updates)), ["project_id"], ["kind", "time"])


def r21_cardinality(spark, d):
    """Slots, ids in use and records of every log."""
    out = None
    for t in LOGS:
        one = log.cardinality(read(spark, d, t), KEY_OF[t]).select(F.lit(t).alias("table_name"), "slots", "ids", "records")
        out = one if out is None else out.unionByName(one)
    return out


def r24_savepoints(spark, d):
    """Savepoints: two of them share a name, of which the first counts."""
    logs = _logs(spark, d)
    manifest = savepoint.create(spark, logs, "first", 1, 1)
    manifest = manifest.unionByName(savepoint.create(spark, {t: logs[t] for t in LOGS[:3]}, "first", 2, 2)).unionByName(savepoint.create(spark, {}, "empty", 3, 3))
    return savepoint.find(manifest, "first").select("name", "time", "table_name", "seq_limit")


def r30_kinds_by_store(spark, d):
    """Highest kind number of each substore and whether its sentinel path is there."""
    kinds = read(spark, d, "contents").groupBy("substore").agg(F.max(S.contents_number(F.col("kind"))).alias("max_kind"))
    sentinels = read(spark, d, "path_strings").filter("path_id = 0").select("substore").distinct().withColumn("has_sentinel", F.lit(True))
    return kinds.join(sentinels, "substore", "full_outer").select("substore", "max_kind", F.coalesce("has_sentinel", F.lit(False)).alias("has_sentinel"))


def w03_dictionary_ids(spark, d):
    """Dense path ids in order of first appearance."""
    return log.dense_ids(read(spark, d, "path_strings"), "path", "_seq", "dense_id")


def w05_get_or_create(spark, d):
    """Ids of all mail addresses for a dictionary that holds those of one substore."""
    users = read(spark, d, "users").filter("user_id <> 0")
    return log.get_or_create(users.filter("substore = 'Python'"), users, "email", "user_id", "user_id").select("email", "user_id", "is_new")


def w06_replace_value(spark, d):
    """The user dictionary with mail addresses overwritten by their lower-case form."""
    users = read(spark, d, "users").select("user_id", "email").filter("user_id <> 0").groupBy("user_id").agg(F.min("email").alias("email"))
    changed = users.filter(F.lower("email") != F.col("email")).select("user_id", F.lower("email").alias("email"))
    return log.replace_value(users, changed, "user_id", "email")


def w09_insert_if_absent(spark, d):
    """Commits recorded after a savepoint that were not recorded before it."""
    commits = read(spark, d, "commits_info")
    half = _half(commits)
    later = commits.filter(F.col("_seq") >= half).select("commit_id").distinct()
    return log.insert_if_absent(log.as_of(commits, half), later, ["commit_id"])


def w10_write_if_changed(spark, d):
    """Metadata records that change the value under their project and key as written."""
    return log.write_if_changed(read(spark, d, "project_metadata").select("_seq", "project_id", "key", "value"), ["project_id", "key"], ["value"])


def w11_latest_metadata(spark, d):
    """Latest value of every project and key as written."""
    return log.latest(read(spark, d, "project_metadata"), ["project_id", "key"], ["value"])


def w16_create_savepoint(spark, d):
    """Limits of all tables in a new savepoint."""
    return savepoint.create(spark, _logs(spark, d), "now", 0, 1).select("table_name", "seq_limit")


def w17_revert(spark, d):
    """Records per project left after reverting the status log to a savepoint at its middle."""
    updates = read(spark, d, "project_updates")
    manifest = savepoint.create(spark, {"project_updates": log.as_of(updates, _half(updates))}, "middle", 0, 1)
    paths = savepoint.revert(spark, {"project_updates": updates}, manifest, "middle", f"{checkpoint_dir(spark)}/reverted")
    return log.history(spark.read.parquet(paths["project_updates"])).groupBy("project_id").agg(F.count("*").alias("records"))


def w18_savepoint_size(spark, d):
    """Tables and spanned records of savepoints."""
    logs = _logs(spark, d)
    manifest = savepoint.create(spark, logs, "all", 10, 1).unionByName(savepoint.create(spark, {"contents": logs["contents"]}, "one", 20, 2))
    return savepoint.listing(manifest).select("name", "time", "tables", F.col("size").cast("bigint").alias("size"))


def w19_gzip(spark, d):
    """Compressed size of every content, and whether unpacking gives it back."""
    rows = read(spark, d, "contents").select("hash_id", "contents").withColumn("packed", S.gzip(F.col("contents")))
    return rows.select("hash_id", F.length("packed").cast("bigint").alias("packed_bytes"), (S.gunzip(F.col("packed")) == F.col("contents")).alias("same"))


def v01_index(spark, d):
    """Projects whose index entry is wrong, for an index taken at a savepoint."""
    updates = read(spark, d, "project_updates")
    index = log.latest(log.as_of(updates, _half(updates)), ["project_id"], [])
    return verify.index_errors(updates, index, "project_id")


def v02_back_links(spark, d):
    """Status records whose back link is wrong, for links that skip repeats of a status."""
    updates = log.history(read(spark, d, "project_updates")).withColumn("state", status_state())
    kept = log.write_if_changed(updates.select("_seq", "project_id", "state"), ["project_id"], ["state"])
    links = log.previous_link(kept, ["project_id"]).select("_seq", F.col("prev__seq").alias("back"))
    return verify.link_errors(updates.select("_seq", "project_id"), links, ["project_id"])


def v03_kinds(spark, d):
    """Contents stored under several kinds."""
    return verify.kind_errors(read(spark, d, "contents"), "hash_id").select("hash_id", "kinds")


def v04_mapping(spark, d):
    """Paths with several ids and ids with several paths."""
    return verify.mapping_errors(read(spark, d, "path_strings"), "path_id", "path")


def v05_values(spark, d):
    """Failed value checks of three tables."""
    out = None
    for t, checks in verify.record_checks().items():
        one = verify.value_errors(read(spark, d, t), checks).select(F.lit(t).alias("table_name"), "check_name", "failed")
        out = one if out is None else out.unionByName(one)
    return out


def v06_report(spark, d):
    """Items, repeated deliveries and records without key of every log."""
    return verify.report({t: (read(spark, d, t), KEY_OF[t]) for t in LOGS})


def n06_segments(spark, d):
    """Status records since the last move between substores, per project."""
    from commitlake.operators.graph import segments

    rows = log.history(read(spark, d, "project_updates"))
    return segments(rows, ["project_id"], "_seq", F.col("kind") == "ChangeStore", F.col("kind") != "ChangeStore").select("project_id", "_seq", "kind")


def r14_cached_dictionary(spark, d):
    """Commits per substore of the path dictionary, which is small enough to be held or is shuffled."""
    names = log.latest(read(spark, d, "path_strings"), ["path_id"], ["substore"]).select("path_id", F.col("substore").alias("path_store"))
    changed = read(spark, d, "commits_info").select("commit_id", F.explode(F.map_keys("changes")).alias("path_id")).distinct()
    return changed.join(small(names), "path_id").groupBy("path_store").agg(F.count_distinct("commit_id").alias("commits"))


QUERIES = {
    f.__name__: f
    for f in (
        r01_history, r02_latest, r03_lookup, r04_exists, r05_metadata_history, r08_history_rank, r09_previous_link, r10_dictionary, r11_decode, r12_encode, r14_cached_dictionary,
        r15_split_scan, r16_single_kind, r17_split_lookup, r19_savepoint_latest, r21_cardinality, r24_savepoints, r30_kinds_by_store, w03_dictionary_ids, w05_get_or_create,
        w06_replace_value, w09_insert_if_absent, w10_write_if_changed, w11_latest_metadata, w16_create_savepoint, w17_revert, w18_savepoint_size, w19_gzip, v01_index,
        v02_back_links, v03_kinds, v04_mapping, v05_values, v06_report, n06_segments,
    )
}

_U = "(select distinct * from project_updates)"
_HALF = "(select max(_seq) // 2 from project_updates)"
_LATEST = "select {k}, _seq, {v} from (select *, row_number() over (partition by {k} order by _seq desc) rn from {t}) q where rn = 1"
_KIND_NUMBER = "case kind " + " ".join(f"when '{k}' then {n}" for k, n in tables.CONTENTS_NUMBERS.items()) + " end"
_KINDS = ", ".join(f"'{k}'" for k in tables.CONTENTS_KINDS)
_LIMITS = " union all ".join(f"select '{t}' table_name, max(_seq) + 1 seq_limit from {t}" for t in LOGS)

SQL = {
    "r01_history": f"select {', '.join(STATUS)} from {_U}",
    "r02_latest": _LATEST.format(k="project_id", v="kind, time, error", t="project_updates"),
    "r03_lookup": "select project_id, _seq, kind from project_updates where project_id = 7 order by _seq desc limit 1",
    "r04_exists": "select hash_id, hash_id in (select hash_id from contents) as stored from (select distinct unnest(map_values(changes)) hash_id from commits_info) q where hash_id <> 0",
    "r05_metadata_history": "select distinct _seq, project_id, key, value from project_metadata",
    "r08_history_rank": f"select project_id, _seq, row_number() over (partition by project_id order by _seq desc) as age from {_U}",
    "r09_previous_link": f"select project_id, _seq, lag(_seq) over (partition by project_id order by _seq) as prev_seq from {_U}",
    "r10_dictionary": "select distinct substore, user_id, email from users",
    "r11_decode": f"select i.path_id, p.path from (select distinct unnest(map_keys(changes)) path_id from commits_info) i join ({_LATEST.format(k='path_id', v='path', t='path_strings')}) p on p.path_id = i.path_id",
    "r12_encode": "select email, min(user_id) as first_id, count(*) as ids from (select distinct lower(email) email, user_id from users where user_id <> 0) q group by email",
    "r14_cached_dictionary": f"select p.substore as path_store, count(distinct c.commit_id) as commits from (select commit_id, unnest(map_keys(changes)) path_id from commits_info) c join ({_LATEST.format(k='path_id', v='substore', t='path_strings')}) p on p.path_id = c.path_id group by 1",
    "r15_split_scan": f"select cast({_KIND_NUMBER} as bigint) as kind_number, kind, _seq, hash_id, octet_length(contents) as bytes from (select distinct * from contents) q",
    "r16_single_kind": "select hash_id, _seq, octet_length(contents) as bytes from (select distinct * from contents where kind = 'Python') q",
    "r17_split_lookup": "select hash_id, kind, octet_length(contents) as bytes from contents where hash_id = 42 order by _seq desc limit 1",
    "r19_savepoint_latest": _LATEST.format(k="project_id", v="kind, time", t=f"(select * from project_updates where _seq < {_HALF})"),
    "r21_cardinality": " union all ".join(f"select '{t}' as table_name, max({KEY_OF[t]}) + 1 as slots, count(distinct {KEY_OF[t]}) as ids, count(distinct _seq) as records from {t}" for t in LOGS),
    "r24_savepoints": f"select 'first' as name, cast(1 as bigint) as time, table_name, seq_limit from ({_LIMITS}) q",
    "r30_kinds_by_store": f"select coalesce(k.substore, s.substore) as substore, cast(k.m as bigint) as max_kind, s.substore is not null as has_sentinel from (select substore, max({_KIND_NUMBER}) m from contents group by 1) k full join (select distinct substore from path_strings where path_id = 0) s on s.substore = k.substore",
    "w03_dictionary_ids": "select path, row_number() over (order by f, path) - 1 as dense_id from (select path, min(_seq) f from path_strings group by path) q",
    "w05_get_or_create": """
with u as (select distinct email, user_id, substore from users where user_id <> 0),
k as (select email, min(user_id) user_id from u where substore = 'Python' group by 1),
n as (select email, min(user_id) f from u where email not in (select email from k) group by 1)
select email, user_id, false as is_new from k
union all select email, (select max(user_id) from u where substore = 'Python') + row_number() over (order by f, email), true from n""",
    "w06_replace_value": "select user_id, lower(min(email)) as email from users where user_id <> 0 group by user_id",
    "w09_insert_if_absent": "with h as (select max(_seq) // 2 m from commits_info) select distinct commit_id from commits_info where _seq >= (select m from h) and commit_id not in (select commit_id from commits_info where _seq < (select m from h))",
    "w10_write_if_changed": "select _seq, project_id, key, value from (select *, row_number() over w rn, lag(value) over w p from (select distinct * from project_metadata) s window w as (partition by project_id, key order by _seq)) q where rn = 1 or value is distinct from p",
    "w11_latest_metadata": _LATEST.format(k="project_id, key", v="value", t="project_metadata"),
    "w16_create_savepoint": _LIMITS,
    "w17_revert": f"select project_id, count(distinct _seq) as records from project_updates where _seq < {_HALF} group by 1",
    "w18_savepoint_size": f"select 'all' as name, cast(10 as bigint) as time, count(*) as tables, cast(sum(seq_limit) as bigint) as size from ({_LIMITS}) q union all select 'one', 20, 1, max(_seq) + 1 from contents",
    "v01_index": f"""
with l as (select project_id, max(_seq) m from project_updates group by 1), i as (select project_id, max(_seq) m from project_updates where _seq < {_HALF} group by 1)
select l.project_id, case when i.m is null then 'missing' else 'stale' end as problem from l left join i on i.project_id = l.project_id where i.m is distinct from l.m""",
    "v02_back_links": f"""
with s as (select *, row_number() over w rn, lag(kind) over w pk, lag(new_kind) over w pn, lag(error) over w pe, lag(_seq) over w ps from {_U} q window w as (partition by project_id order by _seq)),
k as (select _seq, lag(_seq) over (partition by project_id order by _seq) back from s where rn = 1 or kind is distinct from pk or new_kind is distinct from pn or error is distinct from pe)
select s._seq from s left join k on k._seq = s._seq where s.ps is distinct from k.back""",
    "v03_kinds": "select hash_id, count(distinct kind) as kinds from contents group by 1 having count(distinct kind) > 1",
    "v04_mapping": "with r as (select distinct path_id, path from path_strings) select path_id as id, 'several values' as problem from r group by path_id having count(*) > 1 union all select min(path_id), 'several ids' from r group by path having count(*) > 1",
    "v05_values": f"""
select 'contents' as table_name, 'kind_known' as check_name, count(*) filter (where (kind in ({_KINDS})) is not true) as failed from contents
union all select 'contents', 'size', count(*) filter (where (octet_length(contents) <= {tables.LARGEST_VALUE}) is not true) from contents
union all select 'contents', 'small_kind', count(*) filter (where ((octet_length(contents) < {tables.SMALL_FILE}) = (kind = 'SmallFiles')) is not true) from contents
union all select 'project_updates', 'kind_known', count(*) filter (where (kind in ('NoChange', 'Ok', 'Rename', 'ChangeStore', 'Error')) is not true) from project_updates
union all select 'project_updates', 'error_only_of_errors', count(*) filter (where (kind = 'Error' or error is null) is not true) from project_updates
union all select 'project_updates', 'time', count(*) filter (where (time >= 0) is not true) from project_updates
union all select 'commits_info', 'committer_time', count(*) filter (where (committer_time > 0) is not true) from commits_info
union all select 'commits_info', 'has_changes', count(*) filter (where changes is null) from commits_info
union all select 'commits_info', 'has_parents', count(*) filter (where parents is null) from commits_info""",
    "v06_report": " union all ".join(f"select '{t}' as table_name, count(distinct _seq) as items, count(*) - count(distinct _seq) as repeated, count(*) filter (where {KEY_OF[t]} is null) as without_key from {t}" for t in LOGS),
    "n06_segments": f"""
with u as (select * from {_U} q),
l as (select project_id, max(_seq) m from u where kind <> 'ChangeStore' group by 1),
b as (select u.project_id, max(u._seq) s from u join l on l.project_id = u.project_id where u.kind = 'ChangeStore' and u._seq <= l.m group by 1)
select u.project_id, u._seq, u.kind from u left join b on b.project_id = u.project_id where u.kind <> 'ChangeStore' and (b.s is null or u._seq >= b.s)""",
}
