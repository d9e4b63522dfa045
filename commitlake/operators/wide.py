"""Attribute-value rows into one wide row per entity with typed columns.

The latest value per entity and attribute is found first (partial aggregation, so a hot entity shrinks to its attributes before
the shuffle). Entities are hash-bucketed; each bucket's rows are dictionary-encoded, their values scattered into one numpy array
per attribute by row and column index, and emitted as Arrow tables.

Defined results: rows without entity, key or ``_seq`` and keys that are not proper are left out; a null or blank latest value is an
empty cell; a value that states none of its type is an empty cell named in ``useless``; an entity whose cells are all empty has a
row of nulls; integers beyond 64 bits are whole numbers but an empty cell; other columns of the input are ignored.
"""

from __future__ import annotations

import json
import math
import re
from collections.abc import Iterator
from datetime import datetime, timezone

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlake.operators.history import normal_key, proper_keys
from commitlake.session import bounded_collect, small

#: Widest table that is built; a wider dictionary of attributes is an error, not a silent cut.
MAX_ATTRIBUTES = 5_000

# The words that stand for a truth value.
TRUE_WORDS = frozenset({"true", "t", "yes", "y", "1", "on"})
FALSE_WORDS = frozenset({"false", "f", "no", "n", "0", "off"})

SPARK_TYPES = {"int": T.LongType(), "double": T.DoubleType(), "bool": T.BooleanType(), "timestamp": T.TimestampNTZType(), "string": T.StringType(), "json": T.StringType()}
NUMPY_TYPES = {"int": np.int64, "double": np.float64, "bool": np.bool_, "timestamp": np.int64, "string": object, "json": object}
ARROW_TYPES = {"int": pa.int64(), "double": pa.float64(), "bool": pa.bool_(), "timestamp": pa.timestamp("us"), "string": pa.string(), "json": pa.string()}

WHOLE = re.compile(r"[+-]?(?:\d+|\d{1,3}(?:,\d{3})+)(?:\.0*)?", re.ASCII)
REAL = re.compile(r"[+-]?(?:(?:\d+|\d{1,3}(?:,\d{3})+)(?:\.\d*)?|\.\d+)(?:[eE][+-]?\d+)?", re.ASCII)
MOMENT = re.compile(
    r"(\d{4})([-/.])(\d{1,2})\2(\d{1,2})(?:[T ](\d{1,2}):(\d{2})(?::(\d{2})(?:[.,](\d{1,9}))?)?\s*(Z|z|UTC|[+-]\d{2}:?\d{2})?)?", re.ASCII
)
EPOCH = re.compile(r"[+-]?\d{1,12}(?:\.0*)?", re.ASCII)


def _strict_constant(word: str):
    raise ValueError(word)


def _json_document(text: str) -> str:
    if json.loads(text, parse_constant=_strict_constant) is None:
        raise ValueError("null states no value")
    return text


def _moment(text: str) -> int:
    if EPOCH.fullmatch(text):
        return int(float(text)) * 1_000_000
    m = MOMENT.fullmatch(text)
    if not m:
        raise ValueError(text)
    year, _, month, day, hour, minute, second, fraction, zone = m.groups()
    at = datetime(int(year), int(month), int(day), int(hour or 0), int(minute or 0), int(second or 0), tzinfo=timezone.utc)
    micros = int((at - datetime(1970, 1, 1, tzinfo=timezone.utc)).total_seconds()) * 1_000_000 + int((fraction or "0").ljust(6, "0")[:6])
    if zone and zone[0] in "+-":
        digits = zone[1:].replace(":", "")
        micros -= (1 if zone[0] == "+" else -1) * (int(digits[:2]) * 60 + int(digits[2:])) * 60_000_000
    return micros


def cell(value_type: str, text: str):
    """The typed value of a non-blank text; raises ValueError if it states none. ``None``: a valid value that has no 64-bit form."""
    if value_type == "string":
        return text
    if value_type == "json":
        return _json_document(text)
    t = text.strip()
    if value_type == "int":
        if not WHOLE.fullmatch(t):
            raise ValueError(text)
        number = int(t.partition(".")[0].replace(",", ""))
        return number if -(2**63) <= number < 2**63 else None
    if value_type == "double":
        if not REAL.fullmatch(t):
            raise ValueError(text)
        number = float(t.replace(",", ""))
        return number if math.isfinite(number) else None
    if value_type == "bool":
        word = t.lower()
        if word in TRUE_WORDS:
            return True
        if word in FALSE_WORDS:
            return False
        raise ValueError(text)
    if value_type == "timestamp":
        return _moment(t)
    raise ValueError(f"unknown type {value_type}")


def latest_cells(metadata: DataFrame, metadata_keys: DataFrame) -> DataFrame:
    """``project_id, metakey, value``: the value of the highest ``_seq`` over all ways of writing the key."""
    return (
        metadata.filter("project_id is not null and _seq is not null and key is not null")
        .select(F.col("project_id").cast("long").alias("project_id"), F.col("_seq").cast("long").alias("seq"), "value", normal_key("key").alias("norm"))
        .join(small(proper_keys(metadata_keys).select("norm", "metakey")), "norm")
        .groupBy("project_id", "metakey").agg(F.max_by("value", "seq").alias("value"))
    )


def widen(cells: DataFrame, attributes: list[tuple[str, str]]) -> DataFrame:
    """One row per ``project_id`` from ``project_id, metakey, value``: a typed column per attribute and the array ``useless``."""
    names = [a for a, _ in attributes]
    types = [t if t in SPARK_TYPES else "string" for _, t in attributes]
    column_of = {a: i for i, a in enumerate(names)}
    schema = T.StructType([T.StructField("project_id", T.LongType()), *[T.StructField(a, SPARK_TYPES[t]) for a, t in zip(names, types)], T.StructField("useless", T.ArrayType(T.StringType()))])
    arrow = pa.schema([("project_id", pa.int64()), *[(a, ARROW_TYPES[t]) for a, t in zip(names, types)], ("useless", pa.list_(pa.string()))])

    def table(rows: pa.Table) -> pa.RecordBatch:
        entity = rows["project_id"].combine_chunks().dictionary_encode()
        attribute = rows["metakey"].combine_chunks().dictionary_encode()
        row_index = entity.indices.to_numpy(zero_copy_only=False)
        columns = np.array([column_of[a] for a in attribute.dictionary.to_pylist()], dtype=np.int64)[attribute.indices.to_numpy(zero_copy_only=False)]
        values = np.array(rows["value"].to_pylist(), dtype=object)
        n = len(entity.dictionary)
        useless: list[list[str]] = [[] for _ in range(n)]
        out: list[pa.Array] = [entity.dictionary]
        for c, value_type in enumerate(types):
            at = np.flatnonzero(columns == c)
            data, empty = np.zeros(n, dtype=NUMPY_TYPES[value_type]), np.ones(n, dtype=bool)
            kept, typed = [], []
            for i in at:
                text = values[i]
                if text is None or not text.strip():
                    continue
                try:
                    value = cell(value_type, text)
                except (ValueError, OverflowError, RecursionError):
                    useless[row_index[i]].append(names[c])
                    continue
                if value is not None:
                    kept.append(row_index[i])
                    typed.append(value)
            if kept:
                data[kept] = np.array(typed, dtype=NUMPY_TYPES[value_type])
                empty[kept] = False
            out.append(pa.array(data, mask=empty, type=ARROW_TYPES[value_type]) if value_type != "timestamp" else pa.array(data, mask=empty).cast(ARROW_TYPES[value_type]))
        out.append(pa.array(useless, type=pa.list_(pa.string())))
        return pa.record_batch(out, schema=arrow)

    def buckets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: pa.Table | None = None  # rows of the entity that the next batch may continue: at most one row per attribute
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch]) if held is None else pa.concat_tables([held, pa.Table.from_batches([batch])])
            ids = rows["project_id"].to_numpy()
            start = int(np.searchsorted(ids, ids[-1], side="left"))
            if start:
                yield table(rows.slice(0, start))
            held = rows.slice(start)
        if held is not None and held.num_rows:
            yield table(held)

    return cells.select("project_id", "metakey", "value").repartition("project_id").sortWithinPartitions("project_id").mapInArrow(buckets, schema)


def wide_table(metadata: DataFrame, metadata_keys: DataFrame) -> DataFrame:
    """The wide table of all projects that ever had a record under a proper key."""
    found = bounded_collect(proper_keys(metadata_keys).select("metakey", "value_type").orderBy("metakey"), MAX_ATTRIBUTES)
    return widen(latest_cells(metadata, metadata_keys), [(r.metakey, r.value_type) for r in found])


def useless_cells(wide: DataFrame) -> DataFrame:
    """``project_id, metakey`` of the cells whose latest value is of no use."""
    return wide.select("project_id", F.explode("useless").alias("metakey"))
