"""Entry to a datastore folder: one parquet table per log, as history, as latest view or as of a savepoint."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from commitlake.operators import log, savepoint
from commitlake.session import read

#: Key columns of the tables that have a latest view.
KEYS = {
    "commits_info": ["commit_id"], "contents": ["hash_id"], "path_strings": ["path_id"], "project_heads": ["project_id"], "project_updates": ["project_id"],
    "project_metadata": ["project_id", "key"], "users_metadata": ["substore", "id", "key"],
}


class Catalog:
    """``Catalog(spark, folder)``; every method returns a lazy DataFrame."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def log(self, table: str) -> DataFrame:
        """All records of a table, each once."""
        return log.history(read(self.spark, self.folder, table))

    def latest(self, table: str) -> DataFrame:
        """The last record of every key."""
        return log.latest(read(self.spark, self.folder, table), KEYS[table])

    def at(self, table: str, manifest: DataFrame, name: str) -> DataFrame:
        """The records of a table as of a savepoint."""
        return log.as_of(self.log(table), savepoint.limit_for(manifest, name, table))

    def get(self, table: str, key) -> DataFrame:
        """The last record of one key."""
        return log.lookup(read(self.spark, self.folder, table), KEYS[table][0], key)

    def create_savepoint(self, name: str, time: int, seq: int) -> DataFrame:
        return savepoint.create(self.spark, {t: read(self.spark, self.folder, t) for t in KEYS}, name, time, seq)
