"""Loading delimited records while separating the rows that fail, with the reason of failure.

Each line is assembled into a record with its quotes in view (blanks and carriage returns around a field are dropped, line ends and
commas inside quotes are data), parsed by Python's strict ``csv`` reader whose structural exceptions are captured, and then goes
through the typed constructors of its fields. The first reason that applies is reported: ``quoting``, ``column_count``, ``value``.

Defined results: a null or empty line has no fields (``column_count``); digits beyond 64 bits are valid but have no number (null);
an empty table gives empty results; repeated lines are reported under each of their ids; other columns of the input are ignored.
"""

from __future__ import annotations

import csv
import re
import sys
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from commitlake.session import bounded_collect

#: Names a dictionary of languages may hold; it is sent to every task.
MAX_NAMES = 20_000

BLANK = " \t\r"
PIECE = re.compile(r'[ \t\r]*(?:"(?P<quoted>(?:[^"\\]|\\.)*)"(?P<after>[^,]*)|(?P<plain>[^,]*))(?:,|\Z)', re.DOTALL)
NAME = re.compile(r"[A-Za-z0-9._-]+/[A-Za-z0-9._-]+")
DIGITS = re.compile(r"[0-9]+")

COLUMNS = ["id", "name", "language", "created", "fork", "disabled", "archived", "stars", "forks", "network_count", "subscribers", "size"]


def assemble(line: str) -> str:
    """The record with every field trimmed outside its quotes and re-quoted; broken quoting stays visible to the strict reader."""
    fields, at, end = [], 0, len(line)
    while True:
        m = PIECE.match(line, at)
        if m["quoted"] is not None:
            after = m["after"].strip(BLANK)
            if after[:1] in ('"', "\n"):  # the reader would take these for a doubled quote, which this format has not, and a new record
                raise csv.Error("text after a closing quote")
            fields.append(f'"{m["quoted"]}"{after}')
        else:
            plain = m["plain"].strip(BLANK)
            if plain.startswith('"'):  # a quote that is never closed: all that follows belongs to it
                fields.append(line[m.start("plain") :].lstrip(BLANK))
                break
            if '"' in plain:
                raise csv.Error("quote inside an unquoted field")
            fields.append('"' + plain.replace("\\", "\\\\") + '"')
        at = m.end()
        if at >= end and not line.endswith(",", 0, at) or at > end:
            break
        if at == end:  # the line ends with a separator: one more, empty, field
            fields.append('""')
            break
    return ",".join(fields)


def split_record(line: str) -> list[str]:
    """The fields of one line; raises ``csv.Error`` where its quoting is broken."""
    rows = list(csv.reader(assemble(line).splitlines(keepends=True), strict=True, doublequote=True, escapechar="\\"))
    return rows[0] if rows else []


def _digits(text: str) -> int | None:
    if not DIGITS.fullmatch(text):
        raise ValueError(text)
    number = int(text) if len(text) < 20 else 2**63
    return number if number < 2**63 else None


def _flag(text: str) -> bool:
    if text not in ("0", "1"):
        raise ValueError(text)
    return text == "1"


def _name(text: str) -> str:
    if not NAME.fullmatch(text):
        raise ValueError(text)
    return text


def constructors(languages: frozenset[str]) -> list[Callable[[str], object]]:
    def language(text: str) -> str | None:
        if text and text.lower() not in languages:
            raise ValueError(text)
        return text or None

    return [_digits, _name, language, _digits, _flag, _flag, _flag, _digits, _digits, _digits, _digits, _digits]


SCHEMA = T.StructType(
    [T.StructField("raw_id", T.LongType()), T.StructField("reason", T.StringType())]
    + [
        T.StructField(c, T.StringType() if c in ("name", "language") else T.BooleanType() if c in ("fork", "disabled", "archived") else T.LongType())
        for c in COLUMNS
    ]
)


def parse_records(raw: DataFrame, language_names: DataFrame) -> DataFrame:
    """``raw_id, reason`` and the typed columns: valid rows have a null reason, failed rows null columns."""
    languages = frozenset(r[0].lower() for r in bounded_collect(language_names.filter("language_name is not null").select("language_name").distinct(), MAX_NAMES))
    arrow = pa.schema([("raw_id", pa.int64()), ("reason", pa.string())] + [(f.name, pa.string() if isinstance(f.dataType, T.StringType) else pa.bool_() if isinstance(f.dataType, T.BooleanType) else pa.int64()) for f in SCHEMA.fields[2:]])
    build = constructors(languages)

    def parse(line: str | None) -> list:
        try:
            fields = split_record(line or "")
        except csv.Error:
            return ["quoting", *[None] * len(build)]
        if not line or len(fields) != len(build):
            return ["column_count", *[None] * len(build)]
        try:
            return [None, *[make(text) for make, text in zip(build, fields)]]
        except ValueError:
            return ["value", *[None] * len(build)]

    def partition(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        csv.field_size_limit(sys.maxsize)
        for batch in batches:
            rows = [parse(line) for line in batch.column(1).to_pylist()]
            columns = list(zip(*rows)) if rows else [()] * (len(build) + 1)
            yield pa.record_batch([batch.column(0), *[pa.array(list(c), type=f.type) for c, f in zip(columns, list(arrow)[1:])]], schema=arrow)

    return raw.select(F.col("raw_id").cast("long").alias("raw_id"), F.col("raw_line").cast("string").alias("raw_line")).mapInArrow(partition, SCHEMA)


def valid_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reason is null").drop("reason")


def failed_records(parsed: DataFrame) -> DataFrame:
    return parsed.filter("reason is not null").select("raw_id", "reason")
