"""Continuous ingestion with Structured Streaming: first-seen keys, changed values and latest state, each exactly once per batch."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from commitlake.operators.log import latest, write_if_changed
from commitlake.session import join_null_safe


def stream_log(spark: SparkSession, path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A log folder or file as a stream, with the schema of what is there."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    if p.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(p).isDirectory():
        return reader.parquet(path)
    return reader.option("pathGlobFilter", p.getName()).parquet(p.getParent().toString())  # a file source reads folders


def run(stream: DataFrame, each: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True, interval: str = "10 seconds"):
    """Feed every micro-batch to ``each``; ``once`` processes what is there and stops, else it goes on for ever."""
    writer = stream.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint)
    query = (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=interval)).start()
    if once:
        query.awaitTermination()
    return query


def _versions(spark: SparkSession, path: str) -> DataFrame | None:
    jvm = spark._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return spark.read.parquet(path) if p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p) else None


def append_new_keys(keys: list[str], target: str) -> Callable[[DataFrame, int], None]:
    """Append the rows whose key was never seen. Each batch writes its own folder, so a repeated batch replaces itself."""

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        seen = _versions(spark, target)
        rows = latest(batch, keys)
        if seen is not None:
            rows = join_null_safe(rows, seen.filter(F.col("batch") != number).select(*keys).distinct(), keys, "left_anti")
        rows.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return each


def append_changes(keys: list[str], values: list[str], target: str) -> Callable[[DataFrame, int], None]:
    """Append the records that change the value of their key, compared with the last one kept in earlier batches."""

    def each(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        columns = [*keys, *values, "_seq"]
        seen = _versions(spark, target)
        rows = batch.select(*columns)
        if seen is not None:
            before = latest(seen.filter(F.col("batch") != number).select(*columns), keys)
            changed = write_if_changed(before.select(*columns).unionByName(rows), keys, values)
            rows = join_null_safe(changed, before.select("_seq"), ["_seq"], "left_anti")
        else:
            rows = write_if_changed(rows, keys, values)
        rows.write.mode("overwrite").parquet(f"{target}/batch={number}")

    return each


def windowed_counts(stream: DataFrame, time: str, key: str, width: str = "1 day", late: str = "2 days") -> DataFrame:
    """Records per window and key; windows close once the watermark has passed them, later records are left out."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width), key).agg(F.count("*").alias("records")).select(F.col("window.start").alias("start"), key, "records")
