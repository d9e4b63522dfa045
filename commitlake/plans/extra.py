"""Queries of project filters, work lists, dictionaries' sizes, forced refreshes and merges of all substores, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.functions import tables
from commitlake.operators import log, merge, records, sampling
from commitlake.operators.ordering import positions
from commitlake.plans.analysis import SOURCE, TARGET
from commitlake.plans.problems import _LINES
from commitlake.session import read

WORKERS, WORK_LIMIT = 4, 50
CUTOFF = 1_420_070_400
VERSION = 2


def _scraped(spark: SparkSession, d: str) -> DataFrame:
    return records.valid_records(records.parse_records(read(spark, d, "raw_projects"), read(spark, d, "language_names")))


def own_projects(rows: DataFrame, language) -> DataFrame:
    """Rows of the languages a condition names that are neither gone (``disabled``) nor forks."""
    return rows.filter(language & ~F.col("disabled") & ~F.col("fork"))


def f08_one_language(spark, d):
    """Scraped projects of one language, as written, neither gone nor forks."""
    return own_projects(_scraped(spark, d), F.col("language") == "Python").select("raw_id", "name")


def f09_language_set(spark, d):
    """The same for a fixed set of languages in any letter case."""
    return own_projects(_scraped(spark, d), F.lower("language").isin(*tables.SAMPLED_LANGUAGES)).select("raw_id", F.lower("language").alias("language"))


def f11_before(spark, d):
    """Commits per substore committed up to a time."""
    rows = log.history(read(spark, d, "commits_info")).filter(F.col("committer_time") <= CUTOFF)
    return rows.groupBy("substore").agg(F.count("*").alias("records"))


def a15_dictionary_sizes(spark, d):
    """Entries and bytes of the dictionaries of every substore."""
    users = read(spark, d, "users").select("substore", F.lit("users").alias("dictionary"), F.col("email").alias("value")).distinct()
    paths = read(spark, d, "path_strings").select("substore", F.lit("path_strings").alias("dictionary"), F.col("path").alias("value")).distinct()
    both = users.unionByName(paths).filter("value is not null")
    return both.groupBy("substore", "dictionary").agg(F.count("*").alias("entries"), F.sum(F.octet_length("value")).cast("bigint").alias("bytes"))


def s02_by_start(spark, d):
    """Projects by the start of their last update, oldest first, with their place."""
    last = log.latest(read(spark, d, "project_updates"), ["project_id"], ["time"]).filter("time is not null")
    return positions(last.select("project_id", "time"), [], ["time", "project_id"], "place").select("project_id", F.col("time").alias("started"), F.col("place").cast("bigint").alias("place"))


def _work(spark: SparkSession, d: str) -> DataFrame:
    """Every project once in the order of its hash, dealt to the workers in turn: no two pick the same and none is left out."""
    projects = read(spark, d, "project_updates").select("project_id").distinct().withColumn("hash", sampling.hashed("project_id"))
    placed = positions(projects, [], ["hash", "project_id"], "place")
    return placed.select("project_id", F.pmod(F.col("place") - 1, F.lit(WORKERS)).cast("bigint").alias("worker"), F.floor((F.col("place") - 1) / WORKERS).cast("bigint").alias("turn"))


def s07_picks(spark, d):
    """Which worker picks which project, and when."""
    return _work(spark, d)


def s08_work_limit(spark, d):
    """The projects the workers get to within their limit (the limit is the feature)."""
    return _work(spark, d).filter(F.col("turn") < WORK_LIMIT)


def t09_forced(spark, d):
    """Projects whose last update was made by an older version: they are refreshed whatever their heads."""
    last = log.latest(read(spark, d, "project_updates"), ["project_id"], ["version"])
    return last.filter(F.coalesce("version", F.lit(0)) < VERSION).select("project_id", F.col("version").cast("bigint").alias("version"))


def m07_merge_all_users(spark, d):
    """Translation of user ids when all other substores are merged into one, in the order of their names."""
    users = read(spark, d, "users")
    return merge.dictionary_of_all(users.filter(F.col("substore") == TARGET), users.filter(F.col("substore") != TARGET), "user_id", "email")


def m08_valid_users(spark, d):
    """The translation of one substore's users if only those with a mail address are valid."""
    users, valid = read(spark, d, "users"), merge.Validator(user=lambda: F.col("email").contains("@"))
    return merge.dictionary(users.filter(F.col("substore") == TARGET), users.filter(F.col("substore") == SOURCE), "user_id", "email", valid.user())


QUERIES = {
    f.__name__: f
    for f in (f08_one_language, f09_language_set, f11_before, a15_dictionary_sizes, s02_by_start, s07_picks, s08_work_limit, t09_forced, m07_merge_all_users, m08_valid_users)
}

_SAMPLED = ", ".join(f"'{x}'" for x in tables.SAMPLED_LANGUAGES)
_PLACES = "(select project_id, row_number() over (order by md5(cast(project_id as varchar)), project_id) - 1 p from (select distinct project_id from project_updates) q)"
_NEW_USERS = """
with t as (select email, min(user_id) id from users where substore = '{target}' and email is not null group by 1),
s as (select distinct substore, user_id source, email from users where {sources} and user_id is not null and email is not null),
n as (select email, (select max(user_id) from users where substore = '{target}') + row_number() over (order by substore, source) id from (
  select *, row_number() over (partition by email order by substore, source) rn from s where email not in (select email from t)) q where rn = 1)
"""

SQL = {
    "f08_one_language": _LINES + "select raw_id, v[2] as name from c where reason is null and v[3] = 'Python' and v[5] = '0' and v[6] = '0'",
    "f09_language_set": _LINES + f"select raw_id, lower(v[3]) as language from c where reason is null and lower(v[3]) in ({_SAMPLED}) and v[5] = '0' and v[6] = '0'",
    "f11_before": f"select substore, count(distinct _seq) as records from commits_info where committer_time <= {CUTOFF} group by 1",
    "a15_dictionary_sizes": """
select substore, dictionary, count(*) as entries, cast(sum(strlen(value)) as bigint) as bytes from (
  select distinct substore, 'users' dictionary, email as value from users union all select distinct substore, 'path_strings', path from path_strings) q where value is not null group by 1, 2""",
    "s02_by_start": """
select project_id, time as started, row_number() over (order by time, project_id) as place from (
  select *, row_number() over (partition by project_id order by _seq desc) rn from project_updates) q where rn = 1 and time is not null""",
    "s07_picks": f"select project_id, cast(p % {WORKERS} as bigint) as worker, cast(p // {WORKERS} as bigint) as turn from {_PLACES} q",
    "s08_work_limit": f"select project_id, cast(p % {WORKERS} as bigint) as worker, cast(p // {WORKERS} as bigint) as turn from {_PLACES} q where p // {WORKERS} < {WORK_LIMIT}",
    "t09_forced": f"select project_id, cast(version as bigint) as version from (select *, row_number() over (partition by project_id order by _seq desc) rn from project_updates) q where rn = 1 and coalesce(version, 0) < {VERSION}",
    "m07_merge_all_users": _NEW_USERS.format(target=TARGET, sources=f"substore <> '{TARGET}'")
    + "select s.substore, s.source, coalesce(t.id, n.id) as target, t.id is null as is_new from s left join t on t.email = s.email left join n on n.email = s.email",
    "m08_valid_users": _NEW_USERS.format(target=TARGET, sources=f"substore = '{SOURCE}' and contains(email, '@')")
    + "select s.source, coalesce(t.id, n.id) as target, t.id is null as is_new from s left join t on t.email = s.email left join n on n.email = s.email",
}
