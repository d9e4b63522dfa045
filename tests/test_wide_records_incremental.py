import csv
import json

import pytest
from conftest import rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from commitlake.operators import incremental, records, wide
from commitlake.operators.history import status_state


@pytest.mark.parametrize(
    "kind, text, value",
    [
        ("int", " 1,407 ", 1407), ("int", "+40", 40), ("int", "15.0", 15), ("int", "-3", -3), ("double", "4.85e-01", 0.485), ("double", ".5", 0.5), ("bool", "Yes", True), ("bool", "F", False),
        ("timestamp", "1970-01-02", 86_400_000_000), ("timestamp", "1970/01/01 00:00:01", 1_000_000), ("timestamp", "1970-01-01T00:00:01.5Z", 1_500_000), ("timestamp", "1970-01-01T01:00:00+01:00", 0), ("timestamp", "60", 60_000_000), ("string", "none", "none"), ("json", '{"a": [1]}', '{"a": [1]}'),
    ],
)
def test_cells(kind, text, value):
    assert wide.cell(kind, text) == value


@pytest.mark.parametrize("kind, text", [("int", "1,2,"), ("int", "12e"), ("int", "--7"), ("int", "1.5"), ("int", "n/a"), ("double", "nan"), ("double", "0,5,1"), ("double", "1/2"), ("bool", "tru"), ("bool", "-1"), ("timestamp", "2020-13-01"), ("timestamp", "yesterday"), ("json", "null"), ("json", "{'a': 1}"), ("json", "NaN"), ("json", '{"a"')])
def test_useless(kind, text):
    with pytest.raises((ValueError, OverflowError)):
        wide.cell(kind, text)


def test_wide_table(spark):
    m = [(1, 1, "stars", "3"), (2, 1, "Stars ", "x"), (3, 1, "has wiki", "yes"), (4, 2, "stars", " "), (5, 2, "hasWiki", None), (6, 3, "unknown", "1"), (7, 4, "stars", "99999999999999999999"), (7, 4, "stars", "99999999999999999999"), (None, 5, "stars", "1"), (9, None, "stars", "1")]
    df = spark.createDataFrame([(*x, "clash") for x in m], "_seq bigint, project_id bigint, key string, value string, useless string")
    keys = spark.createDataFrame([("stars", "int"), ("has_wiki", "bool"), (None, "int")], "metakey string, value_type string")
    got = wide.wide_table(df, keys)
    assert rows(got.select("project_id", "stars", "has_wiki", "useless")) == [(1, None, True, ["stars"]), (2, None, None, []), (4, None, None, [])]
    assert rows(wide.useless_cells(got)) == [(1, "stars")]
    assert wide.wide_table(df.limit(0), keys).count() == 0
    many = spark.range(5000).select(F.col("id").alias("_seq"), (F.col("id") % 2500).alias("project_id"), F.lit("stars").alias("key"), F.col("id").cast("string").alias("value"))
    assert wide.wide_table(many, keys).agg(F.count("*"), F.sum("stars")).first()[:] == (2500, sum(range(2500, 5000)))


def _brute(line):
    """Character by character: the fields of a line, or the word ``quoting``."""
    fields, i, n = [], 0, len(line)
    while True:
        while i < n and line[i] in " \t\r":
            i += 1
        if i < n and line[i] == '"':
            i, out = i + 1, ""
            while i < n and line[i] != '"':
                if line[i] == "\\":
                    i += 1
                    if i == n:
                        return "quoting"
                out, i = out + line[i], i + 1
            if i >= n:
                return "quoting"
            i += 1
            while i < n and line[i] in " \t\r":
                i += 1
            if i < n and line[i] != ",":
                return "quoting"
        else:
            j = i
            while j < n and line[j] != ",":
                j += 1
            out, i = line[i:j].strip(" \t\r"), j
            if '"' in out:
                return "quoting"
        fields.append(out)
        if i >= n:
            return fields
        i += 1


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet='ab",\\ \r\n\t1', max_size=14))
def test_lines_split_like_brute_force(line):
    try:
        got = records.split_record(line) if line else [""]
    except csv.Error:
        got = "quoting"
    assert got == _brute(line)


def test_reasons(spark):
    ok = '1,"a/b","C",3,0,1,0,4,5,6,7,8'
    lines = [ok, ok, '2 , "a\\/b.c" , "c" ,3,0,1,0,4,5,6,7,99999999999999999999\r', ok + ",", "", None, '1,"a/b', ok.replace("a/b", "ab"), ok.replace('"C"', '"Klingon"'), ok.replace(",0,", ",2,", 1), ok.replace('"C"', ""), '1,"a/b"x,"C",3,0,1,0,4,5,6,7', "x" * 200_000]
    raw = spark.createDataFrame([(i, x, "r") for i, x in enumerate(lines)], "raw_id bigint, raw_line string, reason string")
    parsed = records.parse_records(raw, spark.createDataFrame([("C",), (None,)], "language_name string"))
    assert rows(records.failed_records(parsed)) == [(11, "quoting"), (12, "column_count"), (3, "column_count"), (4, "column_count"), (5, "column_count"), (6, "quoting"), (7, "value"), (8, "value"), (9, "value")]
    valid = {r.raw_id: r for r in records.valid_records(parsed).collect()}
    assert set(valid) == {0, 1, 2, 10} and valid[2].name == "a/b.c" and valid[2].language == "c" and valid[2]["size"] is None and valid[10].language is None
    assert records.parse_records(raw.limit(0), spark.createDataFrame([], "language_name string")).count() == 0


UPDATES = "_seq bigint, project_id bigint, kind string, time bigint, version int, old_offset bigint, new_kind string, error string, covered boolean"
RUNS = "run_id bigint, log_name string, reported_at timestamp_ntz, outcome string, from_seq bigint, to_seq bigint"


def _log(spark, path, data):
    spark.createDataFrame([(s, p, k, 0, 0, None, None, None, None) for s, p, k in data], UPDATES).repartition(3).write.parquet(path)
    return spark.read.parquet(path)


def _runs(spark, data):
    return spark.createDataFrame(data, "run_id bigint, log_name string, at bigint, outcome string, from_seq bigint, to_seq bigint").selectExpr("run_id", "log_name", "cast(timestamp_seconds(at) as timestamp_ntz) reported_at", "outcome", "from_seq", "to_seq")


def test_unprocessed(spark, tmp_path):
    log = _log(spark, str(tmp_path / "log"), [(1, 1, "Ok"), (2, 1, "Ok"), (3, 1, "Error"), (3, 1, "Error"), (4, 2, None), (5, 2, "Ok"), (6, 1, "Error"), (7, 1, "Ok"), (None, 1, "Ok"), (8, None, "Ok")])
    runs = _runs(spark, [(1, "l", 1, "started", 1, 3), (1, "l", 2, "ok", 1, 3), (2, "l", 1, "ok", 4, 4), (2, "l", 3, "rolled_back", 4, 4), (3, "l", 1, "ok", 7, 7), (3, "l", 1, "failed", 7, 7), (4, "other", 1, "ok", 1, 9), (5, "l", 1, "ok", None, 9), (6, "l", 1, None, 1, 9), (7, "l", 1, "ok", 9, 5)])
    got = incremental.unprocessed(log, status_state(), runs, "l")
    assert rows(got.select("rec_seq")) == [(4,), (5,), (7,)]
    assert incremental.unprocessed(log, status_state(), runs.limit(0), "l").count() == 5
    assert incremental.unprocessed(log.filter("false"), status_state(), runs, "l").count() == 0


def test_manifests_differ_by_files_and_positions(spark):
    rec = spark.createDataFrame([("a", 0), ("a", 1), ("b", 0), ("c", 0)], "file string, pos bigint")
    f = lambda *x: spark.createDataFrame([(v,) for v in x], "file string")
    p = lambda *x: spark.createDataFrame(list(x), "file string, pos bigint")
    got = incremental.diff_versions(rec, f("a", "b"), p(("a", 1)), f("a", "c"), p(("a", 0)))
    assert rows(got.select("delta", "file", "pos")) == [("added", "a", 1), ("added", "c", 0), ("removed", "a", 0), ("removed", "b", 0)]


def test_output_commits_survive_failures(spark, tmp_path):
    out = str(tmp_path / "out")
    one = spark.createDataFrame([(1,)], "x int")
    assert incremental.committed(spark, out) is None
    assert incremental.commit_output(spark, out, one, {"v": 1})
    assert not incremental.commit_output(spark, out, one, {"v": 1})  # a repeated run adds nothing
    one.write.parquet(f"{out}/data/lost")  # a run that died before its commit
    assert incremental.commit_output(spark, out, one, {"v": 2})
    assert incremental.committed(spark, out).count() == 2
    assert incremental.processed_version(spark, out)["processed"] == {"v": 2}
    json.dumps(incremental.processed_version(spark, out))
