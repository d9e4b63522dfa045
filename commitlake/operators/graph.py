"""Commit graph: reachable commits, trees at a commit, differences of trees and heads."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.operators.hierarchy import _walks, splitter
from commitlake.session import keep

#: One node in so many is a splitter: where branches merge, walks between splitters multiply with their length.
SPARSE = 4


def reachable(roots: DataFrame, edges: DataFrame, level: int = 0, split: int = SPARSE) -> DataFrame:
    """``key, id``: all nodes reachable from the roots (``key, id``) along ``a, b``, roots included.

    The number of rounds grows with the logarithm of the depth: nodes walk to splitters by doubling, what the roots reach among the
    splitters is found on the reduced graph by the same function, and the walks of those splitters give the nodes between.
    """
    roots = roots.select("key", "id").distinct()
    pairs = _walks(edges.select("a", "b"), level, split)
    first = keep(roots.unionByName(roots.join(pairs.withColumnRenamed("a", "id"), "id").select("key", F.col("b").alias("id"))).distinct())
    stops = first.filter(splitter("id", level, split))
    if not stops.limit(1).count():
        return first
    reduced = keep(pairs.filter(splitter("a", level, split) & splitter("b", level, split) & (F.col("a") != F.col("b"))))
    through = reachable(stops, reduced, level + 1, split) if reduced.limit(1).count() else stops
    between = through.join(pairs.withColumnRenamed("a", "id"), "id").select("key", F.col("b").alias("id"))
    return keep(first.unionByName(through).unionByName(between).distinct())


def edges(commits: DataFrame) -> DataFrame:
    """``commit_id, parent_id, pos``: the parents of each commit in order."""
    return commits.select("commit_id", F.posexplode("parents").alias("pos", "parent_id")).filter("parent_id is not null").select("commit_id", "parent_id", "pos")


def head_commits(heads: DataFrame) -> DataFrame:
    """``project_id, branch, commit_id, sha``: one row per branch of each head map."""
    return heads.select("project_id", F.explode("heads").alias("branch", "h")).select("project_id", "branch", F.col("h.commit_id").alias("commit_id"), F.col("h.sha").alias("sha"))


def changes(commits: DataFrame) -> DataFrame:
    """``commit_id, path_id, hash_id``: one row per changed path."""
    return commits.select("commit_id", F.explode("changes").alias("path_id", "hash_id"))


def tree(changed: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Tree of each key: the newest change of every path by ``order``, deletions (hash 0) left out.

    Equals walking a linear history from its head; where branches merge, the newest change by commit time wins.
    """
    newest = changed.groupBy(*keys, "path_id").agg(F.max_by("hash_id", F.struct(*order)).alias("hash_id"))
    return newest.filter("hash_id <> 0")


def tree_difference(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, path_id, hash_id``: changes that turn the old tree into the new one; a removed path has hash 0."""
    on = [*keys, "path_id"]
    both = old.select(*on, F.col("hash_id").alias("was")).join(new.select(*on, F.col("hash_id").alias("now")), on, "full_outer")
    return both.filter(~F.col("was").eqNullSafe(F.col("now"))).select(*on, F.coalesce("now", F.lit(0).cast("bigint")).alias("hash_id"))


def merged_changes(differences: DataFrame) -> DataFrame:
    """Changes of a merge commit from its differences to each parent (``commit_id, pos, path_id, hash_id``): the last parent's wins."""
    return differences.groupBy("commit_id", "path_id").agg(F.max_by("hash_id", "pos").alias("hash_id"))


def heads_difference(old: DataFrame, new: DataFrame, force: bool = False) -> DataFrame:
    """``project_id, branch, change``: branches ``added``, ``moved`` or ``removed`` between two head tables (``changed`` all if forced)."""
    on = ["project_id", "branch"]
    both = old.select(*on, F.col("commit_id").alias("was"), F.lit(1).alias("o")).join(new.select(*on, F.col("commit_id").alias("now"), F.lit(1).alias("n")), on, "full_outer")
    change = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").when(~F.col("was").eqNullSafe(F.col("now")) | F.lit(force), "moved")
    return both.select(*on, change.alias("change")).filter("change is not null")


def unknown_commits(heads: DataFrame, graph: DataFrame, known: DataFrame) -> DataFrame:
    """``id``: commits reachable from heads that are not known yet; the walk stops at known ones."""
    fresh = graph.join(known.select(F.col("id").alias("a")), "a", "left_anti")
    roots = heads.select(F.lit(0).alias("key"), F.col("id"))
    return reachable(roots, fresh).select("id").join(known, "id", "left_anti").distinct()


def segments(log: DataFrame, keys: list[str], order: str, starts: Column, member: Column) -> DataFrame:
    """The ``member`` rows of the last segment of each key that has any; a ``starts`` row begins a new segment.

    Three aggregations: the last member, the last start before it, and the members from there on.
    """
    last = log.filter(member).groupBy(*keys).agg(F.max(order).alias("__last"))
    begun = log.filter(starts).join(last, keys).filter(F.col(order) <= F.col("__last")).groupBy(*keys).agg(F.max(order).alias("__start"))
    return log.filter(member).join(begun, keys, "left").filter(F.col("__start").isNull() | (F.col(order) >= F.col("__start"))).drop("__start")
