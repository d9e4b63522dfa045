"""Grouped statistics of projects, languages and stores. All are partial aggregations before any shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.functions.scalars import file_language, is_bug_fix


def count_if(cond):
    return F.sum(F.when(cond, 1).otherwise(0)).cast("bigint")


def files_per_language(changed: DataFrame, paths: DataFrame) -> DataFrame:
    """``commit_id, language, files``: changed files of each commit by language; files of no language do not count."""
    languages = paths.filter("path_id is not null").groupBy("path_id").agg(F.max_by("path", "_seq").alias("path")).select("path_id", file_language(F.col("path")).alias("language")).filter("language <> ''")
    return changed.join(languages, "path_id").groupBy("commit_id", "language").agg(F.count("*").alias("files"))


def export_rows(member: DataFrame, commits: DataFrame, per_language: DataFrame) -> DataFrame:
    """``project_id, language, commit_id, files, committer, committer_time, is_bug``: one row per project, commit and language."""
    facts = commits.select("commit_id", "committer", "committer_time", is_bug_fix(F.col("message")).cast("int").alias("is_bug"))
    return member.join(per_language, "commit_id").join(facts, "commit_id")


def project_languages(rows: DataFrame) -> DataFrame:
    return rows.groupBy("project_id", "language").agg(F.count("*").alias("commits"), F.sum("is_bug").cast("bigint").alias("bugs"), F.sum("files").cast("bigint").alias("changes"))


def project_totals(rows: DataFrame) -> DataFrame:
    """Per project: languages, commits, bugs, changes, authors and age; commit facts count once per commit, not per language."""
    commits = rows.groupBy("project_id", "commit_id").agg(F.max("is_bug").alias("is_bug"), F.max("committer").alias("committer"), F.max("committer_time").alias("at"), F.sum("files").alias("files"))
    per = commits.groupBy("project_id").agg(
        F.count("*").alias("commits"), F.sum("is_bug").cast("bigint").alias("bugs"), F.sum("files").cast("bigint").alias("changes"),
        F.count_distinct("committer").alias("authors"), (F.max("at") - F.min("at")).alias("age"),
    )
    return per.join(rows.groupBy("project_id").agg(F.count_distinct("language").alias("languages")), "project_id")


def ratios(languages: DataFrame, totals: DataFrame) -> DataFrame:
    """Whole percentages of a project's commits, bugs, changes and languages; nothing of nothing is 0."""
    share = lambda a, b: F.coalesce(F.expr(f"(l.{a} * 100) div nullif(t.{b}, 0)"), F.lit(0)).cast("bigint")
    joined = languages.alias("l").join(totals.alias("t"), "project_id")
    return joined.select(
        "project_id", "l.language", F.col("l.commits").alias("commits"), F.col("l.bugs").alias("bugs"), F.col("l.changes").alias("changes"),
        share("commits", "commits").alias("pct_commits"), share("bugs", "bugs").alias("pct_bugs"), share("changes", "changes").alias("pct_changes"),
        F.expr("100 div nullif(t.languages, 0)").cast("bigint").alias("pct_languages"),
    )


def active_projects(assembled: DataFrame, head_times: DataFrame, now: int, days: int = 90) -> DataFrame:
    """Per substore and in total (null): projects, those with a valid update and those with a head commit in the last days."""
    recent = head_times.groupBy("project_id").agg(F.max("committer_time").alias("newest"))
    rows = assembled.join(recent, "project_id", "left")
    return rows.rollup("substore").agg(
        F.count("*").alias("projects"), count_if(F.col("latest_valid_time").isNotNull()).alias("valid"), count_if(F.col("newest") >= now - days * 86400).alias("active")
    )


def contents_size(contents: DataFrame) -> DataFrame:
    """Per substore and in total (null): stored contents and their bytes."""
    return contents.rollup("substore").agg(F.count("*").alias("records"), F.sum(F.length("contents")).cast("bigint").alias("bytes"))


def summary(tables: dict[str, DataFrame]) -> DataFrame:
    """Records per table."""
    rows = [df.agg(F.count("*").alias("records")).select(F.lit(t).alias("table_name"), "records") for t, df in tables.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def at_least(member: DataFrame, key: str, value: str, cutoff: int) -> DataFrame:
    """Keys with at least ``cutoff`` distinct values."""
    return member.groupBy(key).agg(F.count_distinct(value).alias("n")).filter(F.col("n") >= cutoff)
