"""Savepoints: named positions in all logs, time travel to them, and reverting without touching what is being read."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MANIFEST = "name string, time bigint, _seq bigint, table_name string, seq_limit bigint"


def create(spark: SparkSession, logs: dict[str, DataFrame], name: str, time: int, seq: int) -> DataFrame:
    """Manifest rows of a savepoint: the first ``_seq`` of every table that does not belong to it."""
    limits = [(name, time, seq, t, (log.agg(F.max("_seq").alias("m")).first()["m"] or 0) + 1) for t, log in sorted(logs.items())]
    return spark.createDataFrame(limits, MANIFEST)


def find(manifest: DataFrame, name: str) -> DataFrame:
    """The rows of the first savepoint of that name; later ones of the same name are hidden."""
    first = manifest.filter(F.col("name") == name).agg(F.min("_seq").alias("_seq"))
    return manifest.filter(F.col("name") == name).join(F.broadcast(first), "_seq", "left_semi")  # one row


def limit_for(manifest: DataFrame, name: str, table: str) -> int:
    """Limit of a table in a savepoint; 0 if the savepoint does not know it."""
    row = find(manifest, name).filter(F.col("table_name") == table).agg(F.max("seq_limit").alias("l")).first()
    return row["l"] or 0


def travel(logs: dict[str, DataFrame], manifest: DataFrame, name: str) -> dict[str, DataFrame]:
    """All tables as they were at a savepoint; rows without ``_seq`` were never appended."""
    return {t: log.filter(F.col("_seq") < limit_for(manifest, name, t)) for t, log in logs.items()}


def listing(manifest: DataFrame) -> DataFrame:
    """``name, time, tables, size``: the savepoints with the number of records they span over all tables."""
    return manifest.groupBy("name", "time", "_seq").agg(F.count("*").alias("tables"), F.sum("seq_limit").alias("size"))


def revert(spark: SparkSession, logs: dict[str, DataFrame], manifest: DataFrame, name: str, base: str) -> dict[str, str]:
    """Write every table as of the savepoint into a new version folder and return the new paths; the old files stay readable."""
    version = f"{base}/v-{uuid.uuid4().hex}"
    paths = {}
    for t, log in travel(logs, manifest, name).items():
        paths[t] = f"{version}/{t}"
        log.write.parquet(paths[t])
    return paths
