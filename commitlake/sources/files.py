"""Readers and writers of the exchange formats: CSV with backslash escapes, binary record files, JSON documents."""

from __future__ import annotations

import struct
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CSV = {"header": "true", "quote": '"', "escape": "\\", "multiLine": "true", "encoding": "UTF-8"}


def read_csv(spark: SparkSession, path: str, schema: str, strict: bool = True, header: bool = True) -> DataFrame:
    """Rows of CSV files. ``strict``: a row of another length is an error; else such rows come with ``_corrupt_record`` set."""
    options = CSV | {"header": str(header).lower(), "mode": "FAILFAST" if strict else "PERMISSIVE"}
    if strict:
        return spark.read.options(**options).schema(schema).csv(path)
    return spark.read.options(**options, columnNameOfCorruptRecord="_corrupt_record").schema(f"{schema}, _corrupt_record string").csv(path)


def read_csv_folder(spark: SparkSession, glob: str, schema: str) -> DataFrame:
    """Rows of many CSV files with the name of the file each came from."""
    return read_csv(spark, glob, schema).withColumn("file_name", F.element_at(F.split(F.input_file_name(), "/"), -1))


def write_csv(df: DataFrame, path: str, append: bool = False, header: bool = True) -> None:
    df.write.mode("append" if append else "errorifexists").options(header=str(header).lower(), quoteAll="true", escape="\\").csv(path)


def url_column(rows: DataFrame) -> str | None:
    """The one column whose values in the first row parse as project urls; none if it is none or several."""
    from commitlake.functions.scalars import url_kind

    first = rows.limit(1).select(*[url_kind(F.col(c)).isNotNull().alias(c) for c in rows.columns]).collect()
    hits = [c for c in rows.columns if first and first[0][c]]
    return hits[0] if len(hits) == 1 else None


def add_projects(known_urls: DataFrame, candidates: DataFrame, start: int) -> tuple[DataFrame, DataFrame]:
    """``(added, counts)``: new projects (``project_id, url_kind, url_name``) with ids from ``start`` on, and how many were added, existing, invalid.

    ``known_urls``: every current or former ``url_kind, url_name``. ``candidates``: ``url, pos``.
    """
    from commitlake.functions.scalars import url_kind, url_name
    from commitlake.operators.log import dense_ids

    parsed = candidates.select("pos", url_kind(F.col("url")).alias("url_kind"), url_name(F.col("url")).alias("url_name"))
    valid = parsed.filter("url_kind is not null")
    fresh = valid.join(known_urls.select("url_kind", "url_name").distinct(), ["url_kind", "url_name"], "left_anti")
    keyed = fresh.withColumn("key", F.struct("url_kind", "url_name"))
    added = dense_ids(keyed, "key", "pos", "project_id", start).select("project_id", "key.url_kind", "key.url_name")
    n = [candidates.count(), valid.count(), added.count()]
    counts = candidates.sparkSession.createDataFrame([("added", n[2]), ("existing", n[1] - n[2]), ("invalid", n[0] - n[1])], "outcome string, projects bigint")
    return added, counts


def message_records(raw: bytes) -> Iterator[tuple[int, bytes]]:
    """Records ``u64 id, u32 length, bytes``, little endian; a cut-off record at the end is an error."""
    at = 0
    while at < len(raw):
        id_, n = struct.unpack_from("<QI", raw, at)
        at += 12
        if at + n > len(raw):
            raise ValueError("record cut off")
        yield id_, raw[at : at + n]
        at += n


def change_records(raw: bytes) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """Records ``u64 id, u32 n, u64 x2 (ignored), n times (u64 path, u64 hash)``, little endian."""
    at = 0
    while at < len(raw):
        id_, n = struct.unpack_from("<QI", raw, at)
        at += 28
        if at + 16 * n > len(raw):
            raise ValueError("record cut off")
        yield id_, [struct.unpack_from("<QQ", raw, at + 16 * k) for k in range(n)]
        at += 16 * n


def read_messages(spark: SparkSession, path: str) -> DataFrame:
    """``commit_id, message`` of binary message files, one file a task."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for raw in b["content"]:
                found = list(message_records(bytes(raw)))
                yield pd.DataFrame({"commit_id": [i for i, _ in found], "message": [m for _, m in found]})

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, "commit_id bigint, message binary")


def read_changes(spark: SparkSession, path: str) -> DataFrame:
    """``commit_id, path_id, hash_id`` of binary change files, one file a task."""

    def rows(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            for raw in b["content"]:
                found = [(i, p, h) for i, pairs in change_records(bytes(raw)) for p, h in pairs]
                yield pd.DataFrame(found, columns=["commit_id", "path_id", "hash_id"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, "commit_id bigint, path_id bigint, hash_id bigint")


REPOSITORY = "id bigint, full_name string, language string, created_at string, fork boolean, disabled boolean, archived boolean, stargazers_count bigint, forks_count bigint, network_count bigint, subscribers_count bigint, size bigint"


def repository_rows(documents: DataFrame, column: str = "value") -> DataFrame:
    """Typed rows of scraped repository documents; a document without an id gives no row, missing counts are 0."""
    from commitlake.functions.scalars import parse_time

    r = documents.select(F.from_json(column, REPOSITORY, {"mode": "PERMISSIVE"}).alias("r")).filter("r.id is not null")
    zero = lambda c: F.coalesce(f"r.{c}", F.lit(0))
    return r.select(
        "r.id", F.col("r.full_name").alias("name"), F.coalesce("r.language", F.lit("")).alias("language"), parse_time(F.col("r.created_at"), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("created"),
        *[F.coalesce(f"r.{c}", F.lit(False)).cast("int").alias(c) for c in ("fork", "disabled", "archived")],
        zero("stargazers_count").alias("stars"), zero("forks_count").alias("forks"), zero("network_count").alias("network_count"), zero("subscribers_count").alias("subscribers"), zero("size").alias("size"),
    )


def resume_after(output: DataFrame, source: DataFrame, id_: str) -> DataFrame:
    """The source rows above the highest id of the output: where an incremental scrape goes on."""
    top = output.agg(F.max(id_).alias("m")).first()["m"]
    return source if top is None else source.filter(F.col(id_) > top)


def export_files(files: DataFrame, folder: str) -> None:
    """Write ``project_id, path, contents`` to ``folder/<project_id>/<path>`` from the executors; the folder must be shared."""

    def write(rows) -> None:
        import os

        for r in rows:
            target = os.path.normpath(os.path.join(folder, str(r["project_id"]), r["path"].lstrip("/")))
            if not target.startswith(os.path.normpath(folder) + os.sep):
                raise ValueError(f"path leaves the folder: {r['path']}")
            os.makedirs(os.path.dirname(target), exist_ok=True)
            with open(target, "wb") as f:
                f.write(bytes(r["contents"]))

    files.select("project_id", "path", "contents").foreachPartition(write)
