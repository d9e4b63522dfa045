"""Conversion of the older exchange folder: CSV tables of ids, records and parents, binary files of messages and changes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.operators.graph import segments
from commitlake.sources.files import read_changes, read_csv, read_messages

EVENT = "time bigint, source string, kind string, key string, value string"


def commits(spark: SparkSession, folder: str) -> DataFrame:
    """``commit_id, sha, committer, committer_time, author, author_time, parents, changes, message`` of the commits that survive.

    A commit survives with a hash, a record, and a message or changes; parents that do not are dropped, the others keep their order.
    """
    ids = read_csv(spark, f"{folder}/commit_ids.csv", "sha string, id bigint").select(F.col("id").alias("commit_id"), "sha")
    records = read_csv(spark, f"{folder}/commit_records.csv", "unused string, commit_id bigint, committer bigint, committer_time bigint, author bigint, author_time bigint").drop("unused")
    messages = read_messages(spark, f"{folder}/commit_messages.dat").groupBy("commit_id").agg(F.first("message").cast("string").alias("message"))
    changed = read_changes(spark, f"{folder}/commit_changes.dat").groupBy("commit_id", "path_id").agg(F.max("hash_id").alias("hash_id"))
    maps = changed.groupBy("commit_id").agg(F.map_from_entries(F.collect_list(F.struct("path_id", "hash_id"))).alias("changes"))
    kept = ids.join(records, "commit_id").join(messages, "commit_id", "left").join(maps, "commit_id", "left").filter("message is not null or changes is not null")
    links = read_csv(spark, f"{folder}/commit_parents.csv", "unused string, commit_id bigint, parent_id bigint").withColumn("pos", F.monotonically_increasing_id())
    links = links.join(kept.select(F.col("commit_id").alias("parent_id")), "parent_id", "left_semi")
    parents = links.groupBy("commit_id").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "parent_id"))), lambda x: x["parent_id"]).alias("parents"))
    out = kept.join(parents, "commit_id", "left")
    return out.select(
        "commit_id", "sha", "committer", "committer_time", "author", "author_time", F.coalesce("parents", F.array().cast("array<bigint>")).alias("parents"),
        F.coalesce("changes", F.create_map().cast("map<bigint,bigint>")).alias("changes"), F.coalesce("message", F.lit("")).alias("message"),
    )


def project_heads(events: DataFrame) -> DataFrame:
    """``project_id, branch, sha``: heads of the last run of every project's event log (``project_id, pos`` and the event columns).

    Projects with an error, or without any event of the hub source, have none.
    """
    bad = events.filter("kind = 'error'").select("project_id").distinct()
    good = events.filter("source = 'GH'").select("project_id").distinct().join(bad, "project_id", "left_anti")
    last = segments(events.join(good, "project_id", "left_semi"), ["project_id"], "pos", F.col("kind") == "start", F.col("kind") == "head")
    return last.groupBy("project_id", F.col("key").alias("branch")).agg(F.max_by("value", "pos").alias("sha"))


def project_counts(events: DataFrame) -> DataFrame:
    """``project_id, stars, issues, buggy_issues``: the last counts in every project's event log, 0 where there is none."""
    last = events.filter("kind = 'meta'").groupBy("project_id", "key").agg(F.max_by("value", "pos").try_cast("bigint").alias("n"))
    pick = lambda k, name: F.coalesce(F.max(F.when(F.col("key") == k, F.col("n"))), F.lit(0)).alias(name)
    return events.select("project_id").distinct().join(last, "project_id", "left").groupBy("project_id").agg(pick("stars", "stars"), pick("ght_issue", "issues"), pick("ght_issue_bug", "buggy_issues"))
