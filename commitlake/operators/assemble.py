"""Assembling projects and commits from their logs, dataset cascades and translation of ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.operators.log import latest


def substores(updates: DataFrame) -> DataFrame:
    """``project_id, substore``: the datastore each project was last moved to."""
    return latest(updates.filter("kind = 'ChangeStore'"), ["project_id"], ["new_kind"]).select("project_id", F.coalesce("new_kind", F.lit("Unspecified")).alias("substore"))


def projects(updates: DataFrame, heads: DataFrame) -> DataFrame:
    """One row per known project: substore, last log and number of heads, with defaults where a log has no record of it."""
    ids = updates.select("project_id").unionByName(heads.select("project_id")).filter("project_id is not null").distinct()
    last = latest(updates, ["project_id"], ["kind", "time", "error"]).select("project_id", "kind", "time", "error")
    valid = updates.filter("kind in ('Ok', 'NoChange')").groupBy("project_id").agg(F.max("time").alias("latest_valid_time"))
    head = latest(heads.filter("heads is not null"), ["project_id"], ["heads"]).select("project_id", F.size("heads").cast("bigint").alias("n_heads"))
    out = ids.join(substores(updates), "project_id", "left").join(last, "project_id", "left").join(valid, "project_id", "left").join(head, "project_id", "left")
    return out.select(
        "project_id", F.coalesce("substore", F.lit("Unspecified")).alias("substore"), F.coalesce("kind", F.lit("Error")).alias("kind"),
        F.coalesce("time", F.lit(0)).alias("time"), F.when(F.col("kind").isNull(), "no_data").otherwise(F.col("error")).alias("error"),
        "latest_valid_time", F.coalesce("n_heads", F.lit(0)).alias("n_heads"),
    )


def with_users(commits: DataFrame, users: DataFrame) -> DataFrame:
    """Commits with the mail addresses of committer and author (two lookups in one dictionary; unknown users give null)."""
    book = users.filter("user_id <> 0").dropDuplicates(["user_id"]).select("user_id", "email")
    by = lambda role: book.select(F.col("user_id").alias(role), F.col("email").alias(f"{role}_email"))
    return commits.join(by("committer"), "committer", "left").join(by("author"), "author", "left")


def with_contents(changed: DataFrame, paths: DataFrame, contents: DataFrame) -> DataFrame:
    """Changes with their path and whether the content is stored."""
    names = latest(paths.filter("path_id is not null"), ["path_id"], ["path"]).select("path_id", "path")
    stored = contents.select("hash_id").distinct().withColumn("has_contents", F.lit(True))
    return changed.join(names, "path_id").join(stored, "hash_id", "left").withColumn("has_contents", F.coalesce("has_contents", F.lit(False)))


def cascade(chosen: DataFrame, head_rows: DataFrame, commits: DataFrame, users: DataFrame) -> dict[str, DataFrame]:
    """A dataset cut down to chosen projects: their head commits, the links from those commits, the users of those commits."""
    heads = head_rows.join(chosen, "project_id", "left_semi")
    kept = commits.join(heads.select("commit_id").distinct(), "commit_id", "left_semi")
    links = kept.select("commit_id", F.explode("parents").alias("parent_id"))  # a parent need not be kept itself
    people = kept.select(F.col("author").alias("user_id")).unionByName(kept.select(F.col("committer").alias("user_id"))).filter("user_id is not null").distinct()
    return {"heads": heads, "commits": kept, "links": links, "users": users.join(people, "user_id", "left_semi")}


def blank(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: F.lit("") for c in columns})


def translate(commits: DataFrame, users: DataFrame, nodes: DataFrame, paths: DataFrame, hashes: DataFrame) -> DataFrame:
    """Commits with every id replaced by its translation (tables ``source, target``); an id without one becomes null.

    Parents keep their order. Two changes whose paths translate alike collapse to one (the highest target hash).
    """
    one = lambda table, name, new: table.select(F.col("source").alias(name), F.col("target").alias(new))
    base = commits.join(one(nodes, "commit_id", "new_commit"), "commit_id", "left").join(one(users, "committer", "new_committer"), "committer", "left").join(one(users, "author", "new_author"), "author", "left")
    parents = (
        commits.select("commit_id", F.posexplode("parents").alias("pos", "parent"))
        .join(one(nodes, "parent", "new_parent"), "parent", "left")
        .groupBy("commit_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "new_parent"))), lambda x: x["new_parent"]).alias("new_parents"))
    )
    changed = (
        commits.select("commit_id", F.explode("changes").alias("path", "hash"))
        .join(one(paths, "path", "new_path"), "path", "left").join(one(hashes, "hash", "new_hash"), "hash", "left")
        .groupBy("commit_id", "new_path").agg(F.max("new_hash").alias("new_hash"))
        .filter("new_path is not null")
        .groupBy("commit_id").agg(F.map_from_entries(F.collect_list(F.struct("new_path", "new_hash"))).alias("new_changes"))
    )
    out = base.join(parents, "commit_id", "left").join(changed, "commit_id", "left")
    return out.select(
        "commit_id", "new_commit", "new_committer", "committer_time", "new_author", "author_time",
        F.coalesce("new_parents", F.array().cast("array<bigint>")).alias("new_parents"), F.coalesce("new_changes", F.create_map().cast("map<bigint,bigint>")).alias("new_changes"), "message",
    )
