"""Processing only new or changed records, by diffing immutable table-version manifests.

A version of a log is a manifest: the data files it consists of and, per file, a deletion vector of record positions that do not
belong to it. The *current* version holds every file, its vectors marking repeated deliveries. The *processed* version holds the
files a successful run has read; where a run read a file only in part, the vector marks the rest. Diffing the two gives the record
deltas: all records of added files, the restored positions of files in both, and the removed ones. An output commit stores the
processed version next to the output in one rename, so a failed run leaves no trace and a repeated one does nothing.

Defined results: records without ``_seq`` or project are no records; runs without range or with an empty one cover nothing; a run's
last report is the one with the latest ``reported_at`` (at equal times any report other than ``ok`` wins, so nothing is skipped);
an empty log or no runs at all give no or all records; other columns are ignored.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.operators.history import heads_state, status_state
from commitlake.operators.ordering import with_previous
from commitlake.session import cut, read

#: Width, in files of the sequence axis, of the buckets on which ranges and records meet.
BUCKETS = 4096


def log_records(log: DataFrame, state) -> DataFrame:
    """``file, pos, rec_seq, project_id, state`` of every stored record; ``pos`` is its row within its data file."""
    return log.select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("pos"), F.col("_seq").cast("long").alias("rec_seq"),
        F.col("project_id").cast("long").alias("project_id"), state.alias("state"),
    ).filter("rec_seq is not null and project_id is not null")


def covered_ranges(runs: DataFrame, log_name: str) -> DataFrame:
    """``from_seq, to_seq`` of the runs of a log whose last report is ``ok``."""
    last = F.max(F.struct(F.col("reported_at"), (F.coalesce(F.col("outcome"), F.lit("")) != "ok").alias("not_ok"), "outcome", "from_seq", "to_seq"))
    return (
        runs.filter((F.col("log_name") == log_name) & F.col("run_id").isNotNull())
        .groupBy("run_id").agg(last.alias("r"))
        .filter("r.outcome = 'ok' and r.from_seq <= r.to_seq")
        .select("r.from_seq", "r.to_seq")
    )


def mark_covered(records: DataFrame, ranges: DataFrame) -> DataFrame:
    """Add ``covered``: the record lies in one of the ranges. Both sides meet on buckets of the sequence axis (an equi-join)."""
    span = records.agg(F.min("rec_seq").alias("lo"), F.max("rec_seq").alias("hi")).first()
    lo, hi = span["lo"] or 0, span["hi"] or 0
    width = max(1, (hi - lo) // BUCKETS + 1)
    bucket = lambda c: F.floor((F.col(c) - F.lit(lo)) / F.lit(width)).cast("long")
    clipped = ranges.filter((F.col("to_seq") >= lo) & (F.col("from_seq") <= hi)).select(
        F.greatest("from_seq", F.lit(lo)).alias("a"), F.least("to_seq", F.lit(hi)).alias("b")
    ).distinct()
    pieces = (
        clipped.withColumn("bucket", F.explode(F.sequence(bucket("a"), bucket("b"))))
        .groupBy("bucket").agg(F.collect_list(F.struct("a", "b")).alias("in_bucket"))
    )
    return (
        records.withColumn("bucket", bucket("rec_seq")).join(pieces, "bucket", "left")
        .withColumn("covered", F.coalesce(F.exists("in_bucket", lambda r: (F.col("rec_seq") >= r["a"]) & (F.col("rec_seq") <= r["b"])), F.lit(False)))
        .drop("bucket", "in_bucket")
    )


def manifests(marked: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Files and deletion vectors of the processed and the current version: ``(old_files, old_deleted, new_files, new_deleted)``.

    A repeated delivery is deleted in the current version; only its first position counts.
    """
    first = marked.groupBy("rec_seq").agg(F.min(F.struct("file", "pos")).alias("at")).select("rec_seq", F.col("at.file").alias("file"), F.col("at.pos").alias("pos"))
    repeated = marked.join(first, ["rec_seq", "file", "pos"], "left_anti").select("file", "pos")
    files = marked.groupBy("file").agg(F.count("*").alias("n_rows"), F.sum(F.col("covered").cast("long")).alias("n_covered"))
    old_files = files.filter("n_covered > 0").select("file")
    old_deleted = marked.filter("not covered").join(old_files, "file", "left_semi").select("file", "pos")
    return old_files, old_deleted, files.select("file"), repeated


def diff_versions(records: DataFrame, old_files: DataFrame, old_deleted: DataFrame, new_files: DataFrame, new_deleted: DataFrame) -> DataFrame:
    """Record deltas between two versions: ``records`` with ``delta`` = ``added`` or ``removed``. Files are compared first, then positions."""
    flags = (
        new_files.select("file", F.lit(1).alias("in_new"), F.lit(0).alias("in_old"))
        .unionByName(old_files.select("file", F.lit(0).alias("in_new"), F.lit(1).alias("in_old")))
        .groupBy("file").agg(F.max("in_new").alias("in_new"), F.max("in_old").alias("in_old"))
    )
    positions = (
        old_deleted.select("file", "pos", F.lit(1).alias("del_old"), F.lit(0).alias("del_new"))
        .unionByName(new_deleted.select("file", "pos", F.lit(0).alias("del_old"), F.lit(1).alias("del_new")))
        .groupBy("file", "pos").agg(F.max("del_old").alias("del_old"), F.max("del_new").alias("del_new"))
    )
    was = (F.col("in_old") == 1) & (F.coalesce("del_old", F.lit(0)) == 0)
    now = (F.col("in_new") == 1) & (F.coalesce("del_new", F.lit(0)) == 0)
    return (
        records.join(flags, "file").join(positions, ["file", "pos"], "left")
        .withColumn("delta", F.when(now & ~was, "added").when(was & ~now, "removed"))
        .filter("delta is not null")
        .drop("in_new", "in_old", "del_old", "del_new")
    )


def unprocessed(log: DataFrame, state, runs: DataFrame, log_name: str, observed: str = "true") -> DataFrame:
    """``log_name, rec_seq, project_id, state``: new or changed records that no successful run has processed.

    ``observed``: a condition; rows for which it is false are neither records nor predecessors (a null head map).
    """
    records = cut(mark_covered(log_records(log.filter(observed), state), covered_ranges(runs, log_name)))
    added = diff_versions(records.drop("covered", "state", "project_id"), *manifests(records)).filter("delta = 'added'").select("rec_seq").distinct()
    once = records.select("rec_seq", "project_id", "state").dropDuplicates(["rec_seq"])
    changed = with_previous(once, ["project_id"], ["rec_seq"], ["state"]).filter(~F.col("has_prev") | ~F.col("state").eqNullSafe(F.col("prev_state")))
    return changed.join(added, "rec_seq", "left_semi").select(F.lit(log_name).alias("log_name"), "rec_seq", "project_id", "state")


def project_deltas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The unprocessed records of both project logs."""
    runs = read(spark, sf_dir, "ingest_runs")
    updates = unprocessed(read(spark, sf_dir, "project_updates"), status_state(), runs, "project_updates")
    heads = unprocessed(read(spark, sf_dir, "project_heads"), heads_state(), runs, "project_heads", "heads is not null")
    return updates.unionByName(heads)


# --- output commits -------------------------------------------------------------------------------------------------------


def _fs(spark: SparkSession, path: str):
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def processed_version(spark: SparkSession, output: str) -> dict | None:
    """The newest committed version of an output table: ``{"version", "data", "processed"}``, or ``None`` before the first commit."""
    fs, base = _fs(spark, f"{output}/_commits")
    if not fs.exists(base):
        return None
    names = sorted(s.getPath().getName() for s in fs.listStatus(base) if s.getPath().getName().endswith(".json"))
    if not names:
        return None
    return json.loads("\n".join(r[0] for r in spark.read.text(f"{output}/_commits/{names[-1]}").collect()))


def commit_output(spark: SparkSession, output: str, deltas: DataFrame, processed: dict) -> bool:
    """Write ``deltas`` as the next version of ``output`` together with the input version it processed.

    The data are written first under a fresh name; the commit file is created last, by one rename that fails if another run made
    that version. Returns False, leaving nothing visible, if ``processed`` is the version committed last (a repeated run).
    """
    last = processed_version(spark, output)
    if last and last["processed"] == processed:
        return False
    version = last["version"] + 1 if last else 1
    data = f"data/{uuid.uuid4().hex}"
    deltas.write.parquet(f"{output}/{data}")
    fs, base = _fs(spark, f"{output}/_commits")
    fs.mkdirs(base)
    text = json.dumps({"version": version, "data": [*(last["data"] if last else []), data], "processed": processed})
    jvm = spark._jvm
    staged = jvm.org.apache.hadoop.fs.Path(f"{output}/_commits/.{uuid.uuid4().hex}.tmp")
    out = fs.create(staged)
    out.write(bytearray(text, "utf-8"))
    out.close()
    final = jvm.org.apache.hadoop.fs.Path(f"{output}/_commits/{version:012d}.json")
    kinds = jvm.org.apache.hadoop.fs.Options.Rename
    options = spark.sparkContext._gateway.new_array(kinds, 1)
    options[0] = kinds.NONE  # a rename that fails if the version is there, so of two runs one wins
    try:
        jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri()).rename(fs.makeQualified(staged), fs.makeQualified(final), options)
    except Exception:
        if not fs.exists(final):
            raise
        fs.delete(staged, False)
        return False
    return True


def committed(spark: SparkSession, output: str) -> DataFrame | None:
    """The committed rows of an output table; data of runs that never committed are not part of it."""
    last = processed_version(spark, output)
    return spark.read.parquet(*[f"{output}/{d}" for d in last["data"]]) if last else None
