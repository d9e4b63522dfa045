"""Integrity checks of logs and dictionaries. Each returns the offending rows; ``report`` counts them over all checks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.functions import tables
from commitlake.operators.log import history, previous_link
from commitlake.session import join_null_safe


def index_errors(log: DataFrame, index: DataFrame, key: str) -> DataFrame:
    """``key, problem``: an index (``key, _seq``) that does not point at the last record of each key of the log."""
    last = log.groupBy(key).agg(F.max("_seq").alias("last"))
    both = last.join(index.select(key, F.col("_seq").alias("points_at")), key, "full_outer")
    problem = F.when(F.col("points_at").isNull(), "missing").when(F.col("last").isNull(), "dangling").when(F.col("last") != F.col("points_at"), "stale")
    return both.select(key, problem.alias("problem")).filter("problem is not null")


def link_errors(log: DataFrame, links: DataFrame, keys: list[str]) -> DataFrame:
    """``_seq``: records whose back link (``_seq, back``) is not the position of the record of their key before."""
    truth = previous_link(log, keys).select("_seq", "prev__seq")
    return join_null_safe(truth, links.select("_seq", "back"), ["_seq"], "left").filter(~F.col("prev__seq").eqNullSafe(F.col("back"))).select("_seq")


def kind_errors(log: DataFrame, key: str) -> DataFrame:
    """Keys stored under several kinds."""
    return log.groupBy(key).agg(F.count_distinct("kind").alias("kinds")).filter("kinds > 1")


def mapping_errors(dictionary: DataFrame, id_: str, value: str) -> DataFrame:
    """``id, problem``: ids with several values and values with several ids."""
    rows = dictionary.select(id_, value).distinct()
    many_values = rows.groupBy(id_).agg(F.count("*").alias("n")).filter("n > 1").select(F.col(id_).alias("id"), F.lit("several values").alias("problem"))
    many_ids = rows.groupBy(value).agg(F.count("*").alias("n"), F.min(id_).alias("id")).filter("n > 1").select("id", F.lit("several ids").alias("problem"))
    return many_values.unionByName(many_ids)


def value_errors(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """``check_name, failed``: rows that do not meet each check; an unknown outcome counts as failed."""
    sums = df.agg(*[F.sum(F.when(c, 0).otherwise(1)).cast("bigint").alias(n) for n, c in checks.items()])
    return sums.select(F.explode(F.map_from_arrays(F.array(*[F.lit(n) for n in checks]), F.array(*[F.coalesce(n, F.lit(0)) for n in checks]))).alias("check_name", "failed"))


def record_checks() -> dict[str, dict[str, Column]]:
    """The value checks of each table."""
    return {
        "contents": {"kind_known": F.col("kind").isin(list(tables.CONTENTS_KINDS)), "size": F.length("contents") <= tables.LARGEST_VALUE, "small_kind": (F.length("contents") < tables.SMALL_FILE) == (F.col("kind") == "SmallFiles")},
        "project_updates": {"kind_known": F.col("kind").isin("NoChange", "Ok", "Rename", "ChangeStore", "Error"), "error_only_of_errors": (F.col("kind") == "Error") | F.col("error").isNull(), "time": F.col("time") >= 0},
        "commits_info": {"committer_time": F.col("committer_time") > 0, "has_changes": F.col("changes").isNotNull(), "has_parents": F.col("parents").isNotNull()},
    }


def report(logs: dict[str, tuple[DataFrame, str]]) -> DataFrame:
    """``table_name, items, repeated, without_key``: records, repeated deliveries and records without key of every log."""
    out = None
    for name, (log, key) in sorted(logs.items()):
        one = log.agg(F.count("*").alias("n"), F.count_distinct("_seq").alias("items"), F.sum(F.when(F.col(key).isNull(), 1).otherwise(0)).cast("bigint").alias("without_key"))
        one = one.select(F.lit(name).alias("table_name"), "items", (F.col("n") - F.col("items")).alias("repeated"), F.coalesce("without_key", F.lit(0)).alias("without_key"))
        out = one if out is None else out.unionByName(one)
    return out


def head_errors(heads: DataFrame, commits: DataFrame) -> DataFrame:
    """``project_id, branch, commit_id``: heads whose commit was never recorded."""
    return heads.join(commits.select("commit_id").distinct(), "commit_id", "left_anti").select("project_id", "branch", "commit_id")


def repeated(log: DataFrame) -> DataFrame:
    return log.groupBy("_seq").agg(F.count("*").alias("n")).filter("n > 1")


def clean(log: DataFrame) -> DataFrame:
    return history(log)
