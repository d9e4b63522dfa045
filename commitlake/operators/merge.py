"""Merging one datastore into another: users, paths, hashes, contents, commits and projects, each with its id translation."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.operators.assemble import translate
from commitlake.operators.log import get_or_create, latest


@dataclass
class Validator:
    """Conditions a row must meet to be merged; override any with a function that returns a boolean column."""

    user: Callable[[], Column] = lambda: F.lit(True)
    path: Callable[[], Column] = lambda: F.lit(True)
    hash: Callable[[], Column] = lambda: F.lit(True)
    contents: Callable[[], Column] = lambda: F.lit(True)
    commit: Callable[[], Column] = lambda: F.lit(True)
    project: Callable[[], Column] = lambda: F.lit(True)


def dictionary(target: DataFrame, source: DataFrame, id_: str, value: str, valid: Column | None = None) -> DataFrame:
    """``source, target, is_new``: the id in the target of every source id; new values get the next dense ids in order of source ids.

    Ids and values may repeat in either table; a value known under several ids keeps the smallest.
    """
    rows = source.filter(valid) if valid is not None else source
    rows = rows.filter(F.col(id_).isNotNull() & F.col(value).isNotNull()).select(F.col(id_).alias("source"), value).distinct()
    ids = get_or_create(target, rows.select(value, "source"), value, id_, "source")
    return rows.join(ids, value).select("source", F.col(id_).alias("target"), "is_new")


def dictionary_of_all(target: DataFrame, sources: DataFrame, id_: str, value: str, valid: Column | None = None) -> DataFrame:
    """``substore, source, target, is_new``: every source substore merged into one target at once.

    New values get the next dense ids in the order of substores, then of ids, as if one substore were merged after the other.
    """
    rows = sources.filter(valid) if valid is not None else sources
    rows = rows.filter(F.col(id_).isNotNull() & F.col(value).isNotNull() & F.col("substore").isNotNull()).select("substore", F.col(id_).alias("source"), value).distinct()
    ids = get_or_create(target, rows.select(value, F.struct("substore", "source").alias("__first")), value, id_, "__first")
    return rows.join(ids, value).select("substore", "source", F.col(id_).alias("target"), "is_new")


def contents(target: DataFrame, source: DataFrame, hashes: DataFrame, valid: Column | None = None) -> DataFrame:
    """``hash_id, kind, contents`` to append, bytes copied as they are: new hashes, and known ones whose content the target lacks."""
    rows = source.filter(valid) if valid is not None else source
    moved = rows.join(hashes.select(F.col("source").alias("hash_id"), F.col("target").alias("new_hash")), "hash_id")
    return moved.join(target.select(F.col("hash_id").alias("new_hash")).distinct(), "new_hash", "left_anti").select(F.col("new_hash").alias("hash_id"), "kind", "contents")


def commits(source: DataFrame, nodes: DataFrame, users: DataFrame, paths: DataFrame, hashes: DataFrame, valid: Column | None = None) -> DataFrame:
    """Records of the new commits, with all ids translated."""
    rows = source.filter(valid) if valid is not None else source
    fresh = rows.join(nodes.filter("is_new").select(F.col("source").alias("commit_id")), "commit_id", "left_semi")
    return translate(fresh, users, nodes, paths, hashes)


def new_projects(target_urls: DataFrame, source_urls: DataFrame, valid: Column | None = None) -> DataFrame:
    """``project_id`` of the source projects none of whose urls, current or former, the target knows."""
    rows = source_urls.filter(valid) if valid is not None else source_urls
    known = rows.join(target_urls.select("url").distinct(), "url", "left_semi").select("project_id").distinct()
    return rows.select("project_id").distinct().join(known, "project_id", "left_anti")


def project_records(fresh: DataFrame, updates: DataFrame, heads: DataFrame, metadata: DataFrame, nodes: DataFrame) -> dict[str, DataFrame]:
    """What comes with new projects: their latest log, their latest heads with commit ids translated, all of their metadata."""
    last = latest(updates, ["project_id"]).join(fresh, "project_id", "left_semi")
    head = latest(heads.filter("heads is not null"), ["project_id"], ["heads"]).join(fresh, "project_id", "left_semi")
    rows = head.select("project_id", F.explode("heads").alias("branch", "h")).select("project_id", "branch", F.col("h.commit_id").alias("source"), F.col("h.sha").alias("sha"))
    moved = rows.join(nodes.select("source", "target"), "source", "left").select("project_id", "branch", F.col("target").alias("commit_id"), "sha")
    return {"updates": last, "heads": moved, "metadata": metadata.join(fresh, "project_id", "left_semi")}


def counters(translation: DataFrame, name: str) -> DataFrame:
    """``table_name, total, existing, added`` of one merged table."""
    return translation.agg(
        F.count("*").alias("total"), F.sum(F.when(F.col("is_new"), 0).otherwise(1)).cast("bigint").alias("existing"), F.sum(F.when(F.col("is_new"), 1).otherwise(0)).cast("bigint").alias("added")
    ).select(F.lit(name).alias("table_name"), "total", F.coalesce("existing", F.lit(0)).alias("existing"), F.coalesce("added", F.lit(0)).alias("added"))
