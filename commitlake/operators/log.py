"""Append-only logs: history, latest and previous records, time travel, dictionaries and conditional appends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.operators.ordering import positions, with_previous
from commitlake.session import join_null_safe

SEQ = "_seq"


def history(log: DataFrame) -> DataFrame:
    """Every record once, however often it was delivered. A record is told by its ``_seq``."""
    return log.dropDuplicates([SEQ])


def latest(log: DataFrame, keys: list[str], values: list[str] | None = None) -> DataFrame:
    """The record with the highest ``_seq`` of each key: one partial aggregation, so a hot key shrinks before the shuffle."""
    values = [c for c in log.columns if c not in keys and c != SEQ] if values is None else values
    best = F.max_by(F.struct(*values), SEQ) if values else F.lit(None)
    out = log.groupBy(*keys).agg(F.max(SEQ).alias(SEQ), best.alias("__v"))
    return out.select(*keys, SEQ, *[F.col("__v")[v].alias(v) for v in values])


def lookup(log: DataFrame, key: str, value) -> DataFrame:
    """The latest record of one key; the condition reaches the scan."""
    return latest(log.filter(F.col(key) == value), [key])


def newest_first(log: DataFrame, keys: list[str], age: str = "age") -> DataFrame:
    """Each record with its age: 1 for the newest of its key."""
    placed = positions(history(log), keys, [SEQ], "__pos")
    total = placed.groupBy(*keys).agg(F.count("*").alias("__n"))
    return join_null_safe(placed, total, keys).withColumn(age, F.col("__n") - F.col("__pos") + 1).drop("__n", "__pos")


def previous_link(log: DataFrame, keys: list[str]) -> DataFrame:
    """Each record with the ``_seq`` of the record of its key before it (``prev__seq``, null for the first)."""
    return with_previous(history(log), keys, [SEQ], [SEQ]).drop("has_prev")


def as_of(log: DataFrame, limit: int | None) -> DataFrame:
    """The records appended before ``limit``; an unknown table (null limit) has none."""
    return log.filter(F.lit(False)) if limit is None else log.filter(F.col(SEQ) < limit)


def exists(left: DataFrame, right: DataFrame, on: list[str], flag: str = "present") -> DataFrame:
    """``left`` with a flag whether its key occurs in ``right``."""
    return left.join(right.select(*on).distinct().withColumn(flag, F.lit(True)), on, "left").withColumn(flag, F.coalesce(flag, F.lit(False)))


def dense_ids(values: DataFrame, value: str, first: str, out: str = "id", start: int = 0) -> DataFrame:
    """Dense ids in order of first appearance. Values are numbered within quantile blocks of the order, not in one sorted task."""
    seen = values.filter(F.col(value).isNotNull()).groupBy(value).agg(F.min(first).alias("__first"))
    return positions(seen.withColumn("__all", F.lit(0)), ["__all"], ["__first", value], "__n").select(value, (F.col("__n") - 1 + start).alias(out))


def get_or_create(dictionary: DataFrame, values: DataFrame, value: str, id_: str, first: str) -> DataFrame:
    """``value, id, is_new`` for every value: its id in the dictionary, or the next dense id in order of first appearance."""
    known = dictionary.select(value, id_).filter(F.col(value).isNotNull()).groupBy(value).agg(F.min(id_).alias(id_))
    highest = dictionary.agg(F.max(id_).alias("m")).first()["m"]  # may be 0, the sentinel alone
    start = 0 if highest is None else highest + 1
    fresh = dense_ids(values.join(known.select(value), value, "left_anti"), value, first, id_, start)
    found = values.select(value).filter(F.col(value).isNotNull()).distinct().join(known, value)
    return found.withColumn("is_new", F.lit(False)).unionByName(fresh.withColumn("is_new", F.lit(True)))


def insert_if_absent(target: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """The rows to append: those whose key the target lacks."""
    return join_null_safe(rows, target.select(*keys).distinct(), keys, "left_anti")


def write_if_changed(log: DataFrame, keys: list[str], values: list[str]) -> DataFrame:
    """The records of a log that change the value of their key; repeats of the value before are left out."""
    rows = with_previous(history(log), keys, [SEQ], values)
    same = F.lit(True)
    for v in values:
        same = same & F.col(v).eqNullSafe(F.col(f"prev_{v}"))
    return rows.filter(~F.col("has_prev") | ~same).drop("has_prev", *[f"prev_{v}" for v in values])


def replace_value(dictionary: DataFrame, changes: DataFrame, id_: str, value: str) -> DataFrame:
    """The dictionary with the values of changed ids overwritten."""
    new = changes.select(id_, F.col(value).alias("__new"), F.lit(True).alias("__hit"))
    return dictionary.join(new, id_, "left").withColumn(value, F.when(F.col("__hit"), F.col("__new")).otherwise(F.col(value))).drop("__new", "__hit")


def cardinality(log: DataFrame, id_: str) -> DataFrame:
    """``slots`` (highest id and one), ``ids`` in use and ``records``."""
    return history(log).agg((F.coalesce(F.max(id_), F.lit(-1)) + 1).alias("slots"), F.count_distinct(id_).alias("ids"), F.count("*").alias("records"))


def split(log: DataFrame, kind: str) -> DataFrame:
    """One kind of a table split by kind; on a partitioned table only its files are read."""
    return log.filter(F.col("kind") == kind)

