"""Appends that change the state of projects, and the batch pipeline of an update."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.operators.graph import heads_difference
from commitlake.operators.log import latest
from commitlake.operators.ordering import positions

STATUS = "_seq bigint, project_id bigint, kind string, time bigint, version int, old_offset bigint, new_kind string, error string"


def numbered(rows: DataFrame, order: str, start: int) -> DataFrame:
    """Rows with ``_seq`` from ``start`` on in the given order, numbered without one global sort."""
    return positions(rows.withColumn("__all", F.lit(0)), ["__all"], [order], "__n").withColumn("_seq", F.col("__n") - 1 + start).drop("__n", "__all")


def rename(urls: DataFrame, renames: DataFrame, time: int, start: int) -> tuple[DataFrame, DataFrame]:
    """``(urls, status)`` to append when projects get new urls (``project_id, url_kind, url_name``).

    A status record points back at the url record it replaces; a project that has this url already is left alone.
    """
    last = latest(urls, ["project_id"], ["url_kind", "url_name"]).select("project_id", F.col("_seq").alias("old_offset"), F.col("url_kind").alias("k"), F.col("url_name").alias("n"))
    moved = renames.join(last, "project_id", "left").filter(~(F.col("url_kind").eqNullSafe(F.col("k")) & F.col("url_name").eqNullSafe(F.col("n"))))
    placed = numbered(moved, "project_id", start)
    status = placed.select("_seq", "project_id", F.lit("Rename").alias("kind"), F.lit(time).cast("bigint").alias("time"), F.lit(0).alias("version"), "old_offset", F.lit(None).cast("string").alias("new_kind"), F.lit(None).cast("string").alias("error"))
    return placed.select("_seq", "project_id", "url_kind", "url_name"), status


def change_substore(moves: DataFrame, time: int, start: int) -> tuple[DataFrame, DataFrame]:
    """``(heads, status)`` to append when projects move to another substore (``project_id, substore``): empty heads are the tombstone."""
    placed = numbered(moves, "project_id", start)
    heads = placed.select("_seq", "project_id", F.create_map().cast("map<string, struct<commit_id: bigint, sha: string>>").alias("heads"))
    status = placed.select("_seq", "project_id", F.lit("ChangeStore").alias("kind"), F.lit(time).cast("bigint").alias("time"), F.lit(0).alias("version"), F.lit(None).cast("bigint").alias("old_offset"), F.col("substore").alias("new_kind"), F.lit(None).cast("string").alias("error"))
    return heads, status


def update_status(projects: DataFrame, old_heads: DataFrame, new_heads: DataFrame, time: int, start: int, changed: DataFrame | None = None) -> DataFrame:
    """Status records of an update run over ``project_id, error``: ``Error`` with its text, ``Ok`` if any head or anything in ``changed`` differs, else ``NoChange``."""
    moved = heads_difference(old_heads, new_heads).select("project_id")
    moved = (moved if changed is None else moved.unionByName(changed.select("project_id"))).distinct().withColumn("moved", F.lit(True))
    rows = numbered(projects.join(moved, "project_id", "left"), "project_id", start)
    kind = F.when(F.col("error").isNotNull(), "Error").when(F.col("moved"), "Ok").otherwise("NoChange")
    return rows.select("_seq", "project_id", kind.alias("kind"), F.lit(time).cast("bigint").alias("time"), F.lit(0).alias("version"), F.lit(None).cast("bigint").alias("old_offset"), F.lit(None).cast("string").alias("new_kind"), "error")


def file_sizes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """``table_name, files, bytes`` of stored tables, from the file system alone."""
    rows = []
    for name, path in sorted(paths.items()):
        p = spark._jvm.org.apache.hadoop.fs.Path(path)
        s = p.getFileSystem(spark._jsc.hadoopConfiguration()).getContentSummary(p)
        rows.append((name, int(s.getFileCount()), int(s.getLength())))
    return spark.createDataFrame(rows, "table_name string, files bigint, bytes bigint")
