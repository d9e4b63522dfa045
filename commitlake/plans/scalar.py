"""Queries of scalar functions, sources and streams, with their SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from commitlake.functions import scalars as S
from commitlake.functions import tables
from commitlake.operators import log
from commitlake.operators.history import normal_key
from commitlake.session import checkpoint_dir, read
from commitlake.sources import files
from commitlake.streaming import ingest


def _urls(spark, d):
    """Urls of several forms made of homepages and names of repositories."""
    meta = log.history(read(spark, d, "project_metadata")).filter("value is not null")
    home = meta.filter(normal_key("key") == "homepage").select(F.col("value").alias("url"))
    name = F.get_json_object("value", "$.full_name")
    hub = meta.filter((normal_key("key") == "githubmetadata") & F.col("value").startswith("{") & F.col("value").endswith("}}")).select(name.alias("n")).filter("n is not null")
    made = [home, home.select(F.concat("url", F.lit(".git"))), hub.select(F.concat(F.lit(S.HUB), "n", F.lit(".git"))), hub.select(F.concat(F.lit(S.HUB), "n")), hub.select(F.concat(F.lit(S.HUB_API), "n"))]
    out = made[0]
    for m in made[1:]:
        out = out.union(m)
    return out.filter("url <> ''").distinct()


def c01_parse_url(spark, d):
    """Kind, name and clone url of project urls."""
    rows = _urls(spark, d).withColumns({"url_kind": S.url_kind(F.col("url")), "url_name": S.url_name(F.col("url"))})
    return rows.withColumn("clone_url", S.clone_url(F.col("url_kind"), F.col("url_name")))


def c04_match_url(spark, d):
    """Whether a project's url matches itself in its other forms."""
    rows = _urls(spark, d).select("url", S.url_kind(F.col("url")).alias("k"), S.url_name(F.col("url")).alias("n")).filter("k is not null")
    return rows.select("url", S.matches_url(F.col("k"), F.col("n"), F.col("url")).alias("itself"), S.matches_url(F.col("k"), F.col("n"), F.col("n")).alias("bare"), S.matches_url(F.col("k"), F.col("n"), F.concat(F.lit("http://"), "n")).alias("http"))


def c05_links(spark, d):
    """Terminal links to head commits and files."""
    rows = read(spark, d, "project_heads").filter("heads is not null").select(F.explode(F.map_values("heads")).alias("h")).select("h.sha").distinct()
    return rows.select("sha", S.commit_link(F.lit("GitHub"), F.lit("a/b"), F.col("sha")).alias("link"), S.change_link(F.lit("GitHub"), F.lit("a/b"), F.col("sha"), F.lit("x/y.c"), F.lit(1)).alias("file_link"))


def _paths(spark, d):
    return read(spark, d, "path_strings").select("path").distinct()


def c06_contents_kind(spark, d):
    """Kind of contents by path."""
    return _paths(spark, d).select("path", S.contents_kind(F.col("path")).alias("kind"))


def c07_stored_kind(spark, d):
    """Kind under which each content is stored."""
    rows = read(spark, d, "contents").select("hash_id", F.length("contents").alias("n"), S.stored_kind(F.col("contents"), F.col("kind")).alias("kind")).distinct()
    return rows.select("hash_id", F.col("n").cast("bigint").alias("bytes"), "kind")


def c08_language(spark, d):
    """Language by file name."""
    return _paths(spark, d).select("path", S.file_language(F.col("path")).alias("language"))


def c09_store_kinds(spark, d):
    """Stores named by the languages of projects, with display name and number."""
    rows = read(spark, d, "language_names").select("language_name", S.store_kind(F.col("language_name")).alias("kind"))
    return rows.select("language_name", "kind", S.store_display(F.col("kind")).alias("display"), S.store_number(F.col("kind")).alias("number"))


def c12_bug_fixes(spark, d):
    """Commits that fix a fault, with and without regard to letter case."""
    rows = log.history(read(spark, d, "commits_info"))
    return rows.select("_seq", S.is_bug_fix(F.col("message")).alias("is_bug"), S.is_bug_fix(F.col("message"), True).alias("is_bug_any_case"))


def c13_escape(spark, d):
    """Contents as escaped text, by its hash."""
    return read(spark, d, "contents").select("hash_id", F.md5(S.escaped_text(F.col("contents"))).alias("md5")).distinct()


def c14_times(spark, d):
    """Commit times as text and parsed back."""
    rows = log.history(read(spark, d, "commits_info")).select("_seq", "committer_time", S.pretty_timestamp(F.col("committer_time")).alias("shown"))
    return rows.withColumn("parsed", S.parse_time(F.col("shown")))


def c15_durations(spark, d):
    """Time between writing and committing."""
    rows = log.history(read(spark, d, "commits_info")).select("_seq", F.abs(F.col("committer_time") - F.col("author_time")).alias("seconds")).filter("seconds is not null")
    return rows.select("_seq", S.pretty_duration(F.col("seconds")).alias("shown"))


def c16_sizes(spark, d):
    """Sequence numbers as values, sizes and percentages."""
    rows = log.history(read(spark, d, "contents")).select("_seq", F.length("contents").alias("n"))
    return rows.select("_seq", S.pretty_value(F.col("_seq")).alias("value"), S.pretty_size(F.col("_seq") * 1000).alias("size"), S.percent(F.col("n"), F.col("_seq")).alias("percent"))


def c19_escape_quotes(spark, d):
    """Commit messages in escaped quotes."""
    return log.history(read(spark, d, "commits_info")).filter("message is not null").select("_seq", S.escape_quotes(F.col("message")).alias("quoted"))


def c20_texts(spark, d):
    """Parts of paths."""
    return _paths(spark, d).filter("path <> ''").select("path", F.element_at(S.split_limit(F.col("path"), "/", 2), 1).alias("head"), F.size(F.split("path", "/")).cast("bigint").alias("parts"), F.col("path").endswith(".js").alias("is_js"))


def c22_sha1(spark, d):
    """Hash of every content."""
    return read(spark, d, "contents").select("hash_id", S.sha1_of(F.col("contents")).alias("sha")).distinct()


def c23_json_fields(spark, d):
    """Typed fields of repository documents; a field of another type is null."""
    rows = log.history(read(spark, d, "project_metadata")).filter((normal_key("key") == "githubmetadata") & F.col("value").isNotNull())
    v = F.col("value")
    return rows.select("_seq", S.json_value(v, "$.id", "bigint").alias("id"), S.json_value(v, "$.full_name", "string").alias("name"), S.json_value(v, "$.fork", "boolean").alias("fork"), S.json_value(v, "$.full_name", "bigint").alias("not_a_number"))


def c24_drop_urls(spark, d):
    """Documents without their url fields."""
    rows = log.history(read(spark, d, "project_metadata")).filter((normal_key("key") == "githubmetadata") & F.col("value").isNotNull())
    return rows.select("_seq", S.drop_url_fields(F.col("value")).alias("document"))


def c25_json_build(spark, d):
    """Counts per project as JSON."""
    rows = log.history(read(spark, d, "project_updates")).groupBy("project_id").agg(F.count("*").alias("updates"), F.sum(F.when(F.col("kind") == "Error", 1).otherwise(0)).cast("bigint").alias("errors"))
    return rows.select("project_id", F.to_json(F.struct("updates", "errors")).alias("document"))


def c26_csv_rows(spark, d):
    """Repository documents as typed rows, as they are written to CSV."""
    rows = log.history(read(spark, d, "project_metadata")).filter((normal_key("key") == "githubmetadata") & F.col("value").isNotNull())
    return files.repository_rows(rows).select("id", "name", "fork", "stars")


def c27_status_text(spark, d):
    """Status records as text."""
    rows = log.history(read(spark, d, "project_updates"))
    more = F.when(F.col("kind") == "ChangeStore", F.concat(F.lit(" to "), F.coalesce("new_kind", F.lit("")))).when(F.col("kind") == "Error", F.concat(F.lit(": "), F.coalesce("error", F.lit("")))).otherwise("")
    return rows.select("_seq", F.concat(S.pretty_timestamp(F.col("time")), F.lit(" "), "kind", more).alias("shown"))


def c28_try_int(spark, d):
    """Metadata values as whole numbers where they are written as such, else -1."""
    return log.history(read(spark, d, "project_metadata")).filter(F.col("value").isNotNull()).select("_seq", F.coalesce(F.when(F.col("value").rlike("^[0-9]{1,18}$"), S.try_int(F.col("value"))), F.lit(-1)).alias("number"))


def c30_collections(spark, d):
    """Numbers of parents, changes and deletions of each commit."""
    rows = log.history(read(spark, d, "commits_info"))
    return rows.select("_seq", F.size("parents").cast("bigint").alias("parents"), F.size(F.map_filter("changes", lambda k, v: v == 0)).cast("bigint").alias("deleted"), F.size("changes").cast("bigint").alias("changed"))


def w22_add_projects(spark, d):
    """Outcome of adding all urls to a store that knows those of other hosts."""
    rows = _urls(spark, d).withColumn("pos", F.xxhash64("url"))
    known = rows.filter(F.col("url").startswith(S.HUB) & ~F.col("url").endswith(".git")).select(S.url_kind(F.col("url")).alias("url_kind"), S.url_name(F.col("url")).alias("url_name"))
    return files.add_projects(known, rows, 0)[1]


def r33_resume(spark, d):
    """Scraped lines above the highest id of the first file."""
    raw = read(spark, d, "raw_projects").select("raw_id", "file_name")
    first = raw.agg(F.min("file_name").alias("f")).first()["f"]
    return files.resume_after(raw.filter(F.col("file_name") == first), raw, "raw_id")


def t04_stream_first_seen(spark, d):
    """Projects in the status log, each once, found by a stream."""
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    ingest.run(ingest.stream_log(spark, f"{d}/project_updates.parquet"), ingest.append_new_keys(["project_id"], f"{base}/out"), f"{base}/state")
    return spark.read.parquet(f"{base}/out").select("project_id").distinct()


def t05_stream_changes(spark, d):
    """Changed metadata values, found by a stream that reads file by file."""
    base = f"{checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    ingest.run(ingest.stream_log(spark, f"{d}/project_metadata.parquet"), ingest.append_changes(["project_id", "key"], ["value"], f"{base}/out"), f"{base}/state")
    return spark.read.parquet(f"{base}/out").select("_seq", "project_id", "key", "value")


QUERIES = {
    f.__name__: f
    for f in (
        c01_parse_url, c04_match_url, c05_links, c06_contents_kind, c07_stored_kind, c08_language, c09_store_kinds, c12_bug_fixes, c13_escape, c14_times, c15_durations, c16_sizes,
        c19_escape_quotes, c20_texts, c22_sha1, c23_json_fields, c24_drop_urls, c25_json_build, c26_csv_rows, c27_status_text, c28_try_int, c30_collections,
        w22_add_projects, r33_resume, t04_stream_first_seen, t05_stream_changes,
    )
}

_N = "regexp_replace(lower(key), '[^a-z0-9]', '', 'g')"
_URLS = f"""h as (select value url from project_metadata where {_N} = 'homepage' and value is not null),
g as (select json_extract_string(value, '$.full_name') n from project_metadata where {_N} = 'githubmetadata' and json_valid(value) and value like '{{%' and value like '%}}}}' and json_extract_string(value, '$.full_name') is not null),
urls as (select distinct url from (select url from h union all select url || '.git' from h union all select 'https://github.com/' || n || '.git' from g union all select 'https://github.com/' || n from g union all select 'https://api.github.com/repos/' || n from g) q where url <> ''),
parsed as (select url,
  case when starts_with(url, 'https://github.com/') or starts_with(url, 'https://api.github.com/repos/') then 'GitHub' when starts_with(url, 'https://') and suffix(url, '.git') then 'Git' end url_kind,
  case when starts_with(url, 'https://github.com/') then regexp_replace(substr(url, 20), '\\.git$', '') when starts_with(url, 'https://api.github.com/repos/') then substr(url, 30)
    when starts_with(url, 'https://') and suffix(url, '.git') then regexp_replace(substr(url, 9), '\\.git$', '') end url_name from urls)"""
_EXT = "regexp_extract(path, '[^/]\\.([^./]*)$', 1)"
_LANG = f"case {_EXT} " + " ".join(f"when '{e}' then '{k}'" for e, k in tables.LANGUAGE_OF_EXTENSION.items()) + " else '' end"
_KIND = "case string_split(path, '.')[-1] " + " ".join(f"when '{e}' then '{k}'" for e, k in tables.KIND_OF_ENDING.items()) + " end"
_ALIAS = "case lower(language_name) " + " ".join(f"when '{e}' then '{k}'" for e, k in tables.STORE_ALIASES.items()) + " end"
_BUG = lambda m: "coalesce(" + " or ".join(f"contains({m}, '{w}')" for w in tables.BUG_WORDS) + ", false)"
_TIME = "strftime(make_timestamp({c} * 1000000), '%Y-%m-%d %H:%M:%S')"
_SCALE = lambda v, u: f"case when {v} < 1000 then cast({v} as varchar) when {v} < 1000000 then cast({v} // 1000 as varchar) || '{u[0]}' when {v} < 1000000000 then cast({v} // 1000000 as varchar) || '{u[1]}' else cast({v} // 1000000000 as varchar) || '{u[2]}' end"
_CI = "(select distinct _seq, committer_time, author_time, message, parents, changes from commits_info)"

SQL = {
    "c01_parse_url": f"with {_URLS} select url, url_kind, url_name, case when url_kind = 'GitHub' then 'https://github.com/' || url_name || '.git' when url_kind = 'Git' then 'https://' || url_name || '.git' end as clone_url from parsed",
    "c04_match_url": f"""with {_URLS} select url, case when url_kind = 'GitHub' then regexp_replace(regexp_replace(url, '\\.git$', ''), '^(https?://github\\.com/|https://api\\.github\\.com/repos/)', '') = url_name
  else regexp_replace(regexp_replace(url, '\\.git$', ''), '^https?://', '') = url_name end as itself, regexp_replace(url_name, '\\.git$', '') = url_name as bare, url_kind = 'Git' as http from parsed where url_kind is not null""",
    "c05_links": """select distinct v.sha as sha, chr(27) || ']8;;https://github.com/a/b/commit/' || v.sha || chr(7) || v.sha || chr(27) || ']8;;' || chr(7) as link,
  chr(27) || ']8;;https://github.com/a/b/blob/' || v.sha || '/x/y.c' || chr(7) || 'x/y.c' || chr(27) || ']8;;' || chr(7) as file_link from (select unnest(map_values(heads)) v from project_heads where heads is not null) q""",
    "c06_contents_kind": f"select distinct path, {_KIND} as kind from path_strings",
    "c07_stored_kind": f"select distinct hash_id, octet_length(contents) as bytes, case when octet_length(contents) < {tables.SMALL_FILE} then 'SmallFiles' else kind end as kind from contents",
    "c08_language": f"select distinct path, {_LANG} as language from path_strings",
    "c09_store_kinds": f"select language_name, kind, case kind {' '.join(f'''when '{k}' then '{v[0]}' ''' for k, v in tables.STORE_KINDS.items())} else 'Unspecified' end as display, cast(case kind {' '.join(f'''when '{k}' then {v} ''' for k, v in tables.STORE_NUMBERS.items())} end as bigint) as number from (select language_name, {_ALIAS} kind from language_names) q",
    "c12_bug_fixes": f"select _seq, {_BUG('message')} as is_bug, {_BUG('lower(message)')} as is_bug_any_case from {_CI} q",
    "c14_times": f"select _seq, committer_time, {_TIME.format(c='committer_time')} as shown, committer_time as parsed from {_CI} q",
    "c15_durations": """select _seq, case when s >= 86400 then format('{}d {}h {}m {}s', s // 86400, s % 86400 // 3600, s % 3600 // 60, s % 60) when s >= 3600 then format('{}h {}m {}s', s // 3600, s % 3600 // 60, s % 60)
  when s >= 60 then format('{}m {}s', s // 60, s % 60) else format('{}s', s) end as shown from (select distinct _seq, abs(committer_time - author_time) s from commits_info) q where s is not null""",
    "c16_sizes": f"select _seq, {_SCALE('_seq', ['k', 'm', 'b'])} as value, {_SCALE('(_seq * 1000)', ['kb', 'mb', 'gb'])} as size, case when _seq = 0 then '??' else cast(n * 100 // _seq as varchar) end as percent from (select distinct _seq, octet_length(contents) n from contents) q",
    "c19_escape_quotes": "select distinct _seq, '\"' || regexp_replace(message, '([''\"\\\\])', '\\\\\\1', 'g') || '\"' as quoted from commits_info where message is not null",
    "c20_texts": "select distinct path, string_split(path, '/')[1] as head, len(string_split(path, '/')) as parts, suffix(path, '.js') as is_js from path_strings where path <> ''",
    "c22_sha1": "select distinct hash_id, sha1(contents) as sha from contents",
    "c23_json_fields": f"""select distinct _seq, case when json_type(v, '$.id') in ('UBIGINT', 'BIGINT') then cast(json_extract_string(v, '$.id') as bigint) end as id, case when json_type(v, '$.full_name') = 'VARCHAR' then json_extract_string(v, '$.full_name') end as name,
  case when json_type(v, '$.fork') = 'BOOLEAN' then cast(json_extract_string(v, '$.fork') as boolean) end as fork, cast(null as bigint) as not_a_number from (select _seq, case when json_valid(value) then value end v from project_metadata where {_N} = 'githubmetadata' and value is not null) q""",
    "c25_json_build": "select project_id, '{\"updates\":' || count(distinct _seq) || ',\"errors\":' || count(distinct _seq) filter (where kind = 'Error') || '}' as document from project_updates group by 1",
    "c27_status_text": f"select distinct _seq, {_TIME.format(c='time')} || ' ' || kind || case when kind = 'ChangeStore' then ' to ' || coalesce(new_kind, '') when kind = 'Error' then ': ' || coalesce(error, '') else '' end as shown from project_updates",
    "c28_try_int": "select distinct _seq, case when regexp_full_match(value, '[0-9]{1,18}') then cast(value as bigint) else -1 end as number from project_metadata where value is not null",
    "c30_collections": f"select _seq, len(parents) as parents, len(list_filter(map_values(changes), lambda x: x = 0)) as deleted, cast(cardinality(changes) as bigint) as changed from {_CI} q",
    "w22_add_projects": f"""with {_URLS}, k as (select distinct url_kind, url_name from parsed where starts_with(url, 'https://github.com/') and not suffix(url, '.git')),
n as (select count(*) total, count(url_kind) valid, (select count(*) from (select distinct url_kind, url_name from parsed where url_kind is not null except select url_kind, url_name from k) q) added from parsed)
select 'added' as outcome, added as projects from n union all select 'existing', valid - added from n union all select 'invalid', total - valid from n""",
    "r33_resume": "select raw_id, file_name from raw_projects where raw_id > (select max(raw_id) from raw_projects where file_name = (select min(file_name) from raw_projects))",
    "t04_stream_first_seen": "select distinct project_id from project_updates",
    "t05_stream_changes": "select _seq, project_id, key, value from (select *, row_number() over w rn, lag(value) over w p from (select distinct * from project_metadata) s window w as (partition by project_id, key order by _seq)) q where rn = 1 or value is distinct from p",
}
