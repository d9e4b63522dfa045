import json
import struct

import pytest
from conftest import rows
from pyspark.sql import functions as F

from commitlake.catalog import Catalog
from commitlake.functions import scalars as S
from commitlake.operators import aggregate, assemble, graph, log, merge, sampling, savepoint, verify
from commitlake.session import join_null_safe, small
from commitlake.sources import files
from commitlake.streaming import ingest


def one(spark, *columns, **values):
    df = spark.createDataFrame([tuple(values.values())], list(values)) if values else spark.range(1)
    return df.select(*columns).first()[0]


@pytest.mark.parametrize(
    "url, kind, name",
    [
        ("https://github.com/a/b.git", "GitHub", "a/b"), ("https://github.com/a/b", "GitHub", "a/b"), ("https://api.github.com/repos/a/b", "GitHub", "a/b"), ("https://api.github.com/repos/a/b.git", "GitHub", "a/b.git"),
        ("https://x.org/r.git", "Git", "x.org/r"), ("http://github.com/a/b", None, None), ("https://x.org/r", None, None), ("", None, None),
    ],
)
def test_urls(spark, url, kind, name):
    r = spark.createDataFrame([(url,)], "u string").select(S.url_kind(F.col("u")), S.url_name(F.col("u"))).first()
    assert tuple(r) == (kind, name)


@pytest.mark.parametrize("path, kind, language", [("README", "Readme", ""), ("docs/README", None, ""), ("a.h", "C", ""), ("a.hpp", "Cpp", ""), ("A.JS", None, ""), ("c", "C", ""), ("a.c++", None, "C++"), (".js", "JavaScript", ""), ("x/y.ts", "TypeScript", "Typescript"), ("a.json", "JSON", ""), ("d.x/a.js", "JavaScript", "Javascript"), ("", None, "")])
def test_kinds_and_languages(spark, path, kind, language):
    r = spark.createDataFrame([(path,)], "p string").select(S.contents_kind(F.col("p")), S.file_language(F.col("p"))).first()
    assert tuple(r) == (kind, language)


def test_small_scalars(spark):
    lit = lambda f, *v: spark.range(1).select(f(*[F.lit(x) for x in v])).first()[0]
    assert [lit(S.pretty_duration, x) for x in (0, 59, 60, 3600, 90061)] == ["0s", "59s", "1m 0s", "1h 0m 0s", "1d 1h 1m 1s"]
    assert [lit(S.pretty_value, x) for x in (999, 1999, 2_500_000, 3 * 10**9)] == ["999", "1k", "2m", "3b"]
    assert [lit(S.pretty_size, x) for x in (999, 1999, 2_500_000, 3 * 10**9)] == ["999", "1kb", "2mb", "3gb"]
    assert [lit(S.percent, 1, 3), lit(S.percent, 5, 0)] == ["33", "??"]
    assert lit(S.percent_bar, 1, 2) == "=" * 10 + " " * 10
    assert [lit(S.is_bug_fix, x) for x in ("Fix crash", "fix crash", "prefix", None)] == [False, True, True, False]
    assert lit(S.escape_quotes, "it's \"x\"\\") == '"it\\\'s \\"x\\"\\\\"'
    assert [lit(S.store_kind, x) for x in ("C++", "JS", "rust")] == ["Cpp", "JavaScript", None]
    assert lit(S.pretty_timestamp, 0) == "1970-01-01 00:00:00" and lit(S.rfc1123, 0) == "Thu, 01 Jan 1970 00:00:00 GMT"
    assert [lit(S.parse_time, x) for x in ("1970-01-01 00:01:00", "soon")] == [60, None]
    assert [lit(S.hex_digit, x) for x in ("a", "F", "g", "")] == [10, 15, None, None]
    assert spark.range(1).select(S.split_limit(F.lit("a/b/c"), "/", 2)).first()[0] == ["a", "b/c"]
    assert lit(S.stored_kind, bytearray(99), "C") == "SmallFiles" and lit(S.stored_kind, bytearray(100), "C") == "C"


def test_bytes_and_json(spark):
    df = spark.createDataFrame([(bytearray(b"50%"),), (bytearray(b"a\xffb"),), (bytearray("ä".encode()),), (None,)], "b binary")
    assert [r[0] for r in df.select(S.escaped_text(F.col("b"))).collect()] == ["50%%", "a%ffb", "ä", None]
    assert all(r[0] == r[1] for r in df.select("b", S.gunzip(S.gzip(F.col("b")))).collect())
    doc = json.dumps({"html_url": "h", "url": "u", "x_url": "v", "o": {"html_url": "w", "k": 1}, "l": [{"url": 1}]})
    got = spark.createDataFrame([(doc,), ("no json",), (None,)], "d string").select(S.drop_url_fields(F.col("d"))).collect()
    assert json.loads(got[0][0]) == {"html_url": "h", "o": {"k": 1}, "l": [{"url": 1}]} and [got[1][0], got[2][0]] == ["no json", None]
    v = spark.createDataFrame([('{"a": 5, "b": "x", "c": true, "d": 1.5}',), ("{",), (None,)], "d string")
    got = [tuple(r) for r in v.select(S.json_value(F.col("d"), "$.a", "string"), S.json_value(F.col("d"), "$.a", "bigint"), S.json_value(F.col("d"), "$.b", "string"), S.json_value(F.col("d"), "$.c", "boolean"), S.json_value(F.col("d"), "$.d", "double")).collect()]
    assert got == [(None, 5, "x", True, 1.5), (None,) * 5, (None,) * 5]


LOG = [(1, 1, "a"), (2, 2, "x"), (3, 1, "a"), (4, 1, None), (4, 1, None), (5, 1, "a"), (6, None, "n")]


def test_logs(spark):
    df = spark.createDataFrame(LOG, "_seq bigint, id bigint, v string")
    assert rows(log.latest(df, ["id"])) == [(None, 6, "n"), (1, 5, "a"), (2, 2, "x")]
    assert rows(log.newest_first(df, ["id"]).filter("id = 1").select("_seq", "age")) == [(1, 4), (3, 3), (4, 2), (5, 1)]
    assert rows(log.previous_link(df, ["id"]).filter("id = 1").select("_seq", "prev__seq")) == [(1, None), (3, 1), (4, 3), (5, 4)]
    assert rows(log.write_if_changed(df, ["id"], ["v"]).select("_seq")) == [(1,), (2,), (4,), (5,), (6,)]
    assert log.as_of(df, None).count() == 0 and log.as_of(df, 3).count() == 2
    assert rows(log.lookup(df, "id", 1).select("v")) == [("a",)] and log.lookup(df, "id", 77).count() == 0
    assert rows(log.cardinality(df, "id")) == [(3, 2, 6)]
    empty = df.limit(0)
    assert log.latest(empty, ["id"]).count() == log.newest_first(empty, ["id"]).count() == log.write_if_changed(empty, ["id"], ["v"]).count() == 0


def test_dictionaries(spark):
    known = spark.createDataFrame([("b", 4), ("b", 6), (None, 9)], "v string, id bigint")
    seen = spark.createDataFrame([("z", 5), ("b", 1), ("a", 7), ("z", 2), (None, 1), ("a", 7)], "v string, at bigint")
    assert rows(log.get_or_create(known, seen, "v", "id", "at")) == [("a", 11, True), ("b", 4, False), ("z", 10, True)]
    assert rows(log.dense_ids(seen, "v", "at")) == [("a", 2), ("b", 0), ("z", 1)]
    assert rows(log.get_or_create(known.limit(0), seen, "v", "id", "at").select("v", "id")) == [("a", 2), ("b", 0), ("z", 1)]
    assert rows(log.insert_if_absent(known.select("id"), spark.createDataFrame([(4,), (5,), (None,)], "id bigint"), ["id"])) == [(None,), (5,)]
    assert rows(log.replace_value(known, spark.createDataFrame([(4, "q")], "id bigint, v string"), "id", "v").select("v", "id")) == [(None, 9), ("b", 6), ("q", 4)]


def test_savepoints(spark, tmp_path):
    a = spark.createDataFrame(LOG, "_seq bigint, id bigint, v string")
    manifest = savepoint.create(spark, {"a": a.filter("_seq <= 3")}, "s", 1, 1).unionByName(savepoint.create(spark, {"a": a}, "s", 2, 2))
    assert savepoint.limit_for(manifest, "s", "a") == 4 and savepoint.limit_for(manifest, "s", "b") == 0 and savepoint.limit_for(manifest, "t", "a") == 0
    paths = savepoint.revert(spark, {"a": a, "b": a}, manifest, "s", str(tmp_path))
    back = {t: spark.read.parquet(p) for t, p in paths.items()}
    assert back["a"].count() == 3 and back["b"].count() == 0
    assert rows(log.latest(back["a"], ["id"])) == rows(log.latest(log.as_of(a, 4), ["id"]))
    a.write.parquet(str(tmp_path / "project_updates.parquet").replace("project_updates", "contents"))


def test_catalog(spark, tmp_path):
    spark.createDataFrame([(1, 7, "C"), (2, 7, "Go")], "_seq bigint, hash_id bigint, kind string").write.parquet(str(tmp_path / "contents.parquet"))
    c = Catalog(spark, str(tmp_path))
    assert c.log("contents").count() == 2 and c.latest("contents").first()["kind"] == "Go" and c.get("contents", 7).first()["_seq"] == 2
    assert c.at("contents", savepoint.create(spark, {"contents": c.log("contents").limit(0)}, "e", 0, 1), "e").count() == 0


def test_graph_helpers(spark):
    heads = lambda *r: spark.createDataFrame(list(r), "project_id bigint, branch string, commit_id bigint")
    assert rows(graph.heads_difference(heads((1, "a", 1), (1, "b", 2), (1, "d", None)), heads((1, "a", 1), (1, "b", 3), (1, "c", 1), (1, "d", None)))) == [(1, "b", "moved"), (1, "c", "added")]
    t = lambda *r: spark.createDataFrame(list(r), "path_id bigint, hash_id bigint")
    assert rows(graph.tree_difference(t((1, 1), (2, 2), (3, 3)), t((1, 1), (2, 5), (4, 4)), [])) == [(2, 5), (3, 0), (4, 4)]
    changed = spark.createDataFrame([(1, 1, 10), (2, 1, 0), (3, 2, 5), (4, 1, 7)], "at bigint, path_id bigint, hash_id bigint").withColumn("k", F.lit(0))
    assert rows(graph.tree(changed, ["k"], ["at"])) == [(0, 1, 7), (0, 2, 5)] and rows(graph.tree(changed.filter("at < 4"), ["k"], ["at"])) == [(0, 2, 5)]
    d = spark.createDataFrame([(1, 0, 5, 1), (1, 1, 5, 2), (1, 0, 6, 3)], "commit_id bigint, pos int, path_id bigint, hash_id bigint")
    assert rows(graph.merged_changes(d)) == [(1, 5, 2), (1, 6, 3)]
    s = spark.createDataFrame([(1, 1, "head"), (1, 2, "start"), (1, 3, "head"), (1, 4, "head"), (1, 5, "start"), (2, 1, "head"), (3, 1, "start")], "k int, at int, kind string")
    assert rows(graph.segments(s, ["k"], "at", F.col("kind") == "start", F.col("kind") == "head").select("k", "at")) == [(1, 3), (1, 4), (2, 1)]


def test_ratios_of_nothing(spark):
    r = spark.createDataFrame([(1, "C", 10, 0, 1, 5, 0), (1, "C", 11, 0, 1, 9, 1), (1, "Go", 10, 0, 1, 5, 0)], "project_id bigint, language string, commit_id bigint, files bigint, committer bigint, committer_time bigint, is_bug int")
    totals = aggregate.project_totals(r)
    assert rows(totals.select("commits", "bugs", "changes", "authors", "age", "languages")) == [(2, 1, 0, 1, 4, 2)]
    assert rows(aggregate.ratios(aggregate.project_languages(r), totals).select("language", "pct_commits", "pct_bugs", "pct_changes", "pct_languages")) == [("C", 100, 100, 0, 50), ("Go", 50, 0, 0, 50)]


def test_translation(spark):
    t = lambda *r: spark.createDataFrame(list(r), "source bigint, target bigint")
    c = spark.createDataFrame([(1, 5, 10, 6, 11, [3, 2, 3], {7: 70, 8: 80, 9: 90}, "m"), (2, None, 0, None, 0, [], {}, None)], "commit_id bigint, committer bigint, committer_time bigint, author bigint, author_time bigint, parents array<bigint>, changes map<bigint,bigint>, message string")
    got = {r.commit_id: r for r in assemble.translate(c, t((5, 50)), t((1, 100), (3, 300)), t((7, 1), (8, 1)), t((70, 700), (80, 800))).collect()}
    assert got[1].new_parents == [300, None, 300] and got[1].new_changes == {1: 800} and (got[1].new_committer, got[1].new_author, got[1].new_commit) == (50, None, 100)
    assert got[2].new_parents == [] and got[2].new_changes == {} and got[2].new_commit is None


def test_merge_twice_adds_nothing(spark):
    target, source = (spark.createDataFrame(r, "id bigint, v string") for r in ([(1, "a"), (2, "b")], [(7, "b"), (8, "c"), (9, None), (8, "c")]))
    first = merge.dictionary(target, source, "id", "v")
    assert rows(first) == [(7, 2, False), (8, 3, True)]
    merged = target.unionByName(source.join(first.filter("is_new").withColumnRenamed("source", "id"), "id").select(F.col("target").alias("id"), "v"))
    assert merge.dictionary(merged, source, "id", "v").filter("is_new").count() == 0
    assert rows(merge.dictionary(target, source, "id", "v", F.col("v") != "c")) == [(7, 2, False)]
    assert rows(merge.counters(first, "t")) == [("t", 2, 1, 1)]


def test_verification(spark):
    df = spark.createDataFrame([(1, 1), (3, 1), (2, 2)], "_seq bigint, id bigint")
    assert rows(verify.index_errors(df, spark.createDataFrame([(1, 1), (9, 5)], "id bigint, _seq bigint"), "id")) == [(1, "stale"), (2, "missing"), (9, "dangling")]
    links = spark.createDataFrame([(1, None), (3, 2), (2, None)], "_seq bigint, back bigint")
    assert rows(verify.link_errors(df, links, ["id"])) == [(3,)]
    m = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "c"), (3, "c")], "id bigint, v string")
    assert rows(verify.mapping_errors(m, "id", "v")) == [(1, "several ids"), (1, "several values")]


def test_samples(spark):
    df = spark.range(100).withColumn("g", F.when(F.col("id") < 3, "s").otherwise("l"))
    assert sampling.uniform(df, "id", 10).count() == 10 and sampling.uniform(df, "id", 1000).count() == 100
    assert set(rows(sampling.uniform(df, "id", 5))) <= set(rows(sampling.uniform(df, "id", 10)))
    assert rows(sampling.stratified(df, "g", "id", 5).groupBy("g").count()) == [("l", 5), ("s", 3)]


def test_sources(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('x,y\n1,"a\\"b\nc"\n2,"\\\\N"\n')
    assert rows(files.read_csv(spark, str(p), "x int, y string")) == [(1, 'a"b\nc'), (2, "\\N")]
    p.write_text("x,y\n1,2\n1,2,3\n")
    got = files.read_csv(spark, str(p), "x int, y int", strict=False).collect()
    assert [r["_corrupt_record"] is not None for r in got] == [False, True]
    with pytest.raises(Exception):  # noqa: B017
        files.read_csv(spark, str(p), "x int, y int").collect()
    (tmp_path / "m.dat").write_bytes(struct.pack("<QI", 5, 2) + b"hi" + struct.pack("<QI", 6, 0))
    assert [(r[0], bytes(r[1])) for r in files.read_messages(spark, str(tmp_path / "m.dat")).collect()] == [(5, b"hi"), (6, b"")]
    (tmp_path / "c.dat").write_bytes(struct.pack("<QIQQQQQQ", 5, 2, 0, 0, 1, 10, 2, 20))
    assert rows(files.read_changes(spark, str(tmp_path / "c.dat"))) == [(5, 1, 10), (5, 2, 20)]
    with pytest.raises(ValueError):
        list(files.message_records(struct.pack("<QI", 5, 9) + b"hi"))
    assert files.url_column(spark.createDataFrame([("x", "https://github.com/a/b")], "n string, u string")) == "u"
    assert files.url_column(spark.createDataFrame([("https://a.b/c.git", "https://github.com/a/b")], "n string, u string")) is None
    docs = spark.createDataFrame([('{"id": 1, "full_name": "a/b", "created_at": "1970-01-01T00:01:00Z", "fork": true}',), ("{}",), (None,), ("{",)], "value string")
    assert rows(files.repository_rows(docs).select("id", "name", "language", "created", "fork", "stars")) == [(1, "a/b", "", 60, 1, 0)]
    files.export_files(spark.createDataFrame([(1, "d/a.txt", bytearray(b"x"))], "project_id bigint, path string, contents binary"), str(tmp_path / "out"))
    assert (tmp_path / "out/1/d/a.txt").read_bytes() == b"x"
    files.write_csv(spark.createDataFrame([(1, 'q"')], "a int, b string"), str(tmp_path / "w"))
    assert rows(files.read_csv_folder(spark, str(tmp_path / "w"), "a int, b string").select("a", "b")) == [(1, 'q"')]


def test_streams(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    schema = "_seq bigint, id bigint, v string, at timestamp"
    write = lambda r: spark.createDataFrame([(*x, None) for x in r], schema).coalesce(1).write.mode("append").parquet(src)
    write([(1, 1, "a"), (2, 1, "a"), (3, 2, "b")])
    for target, each in ((f"{out}/k", ingest.append_new_keys(["id"], f"{out}/k")), (f"{out}/c", ingest.append_changes(["id"], ["v"], f"{out}/c"))):
        ingest.run(ingest.stream_log(spark, src), each, f"{target}-state")
    write([(4, 1, "a"), (5, 1, "c"), (6, 3, "d")])
    for target, each in ((f"{out}/k", ingest.append_new_keys(["id"], f"{out}/k")), (f"{out}/c", ingest.append_changes(["id"], ["v"], f"{out}/c"))):
        ingest.run(ingest.stream_log(spark, src), each, f"{target}-state")
        ingest.run(ingest.stream_log(spark, src), each, f"{target}-state")  # nothing new
    assert rows(spark.read.parquet(f"{out}/k").select("id")) == [(1,), (2,), (3,)]
    assert rows(spark.read.parquet(f"{out}/c").select("_seq")) == [(1,), (3,), (5,), (6,)]


def test_windows_with_watermark(spark, tmp_path):
    src = str(tmp_path / "in")
    spark.sql("select timestamp'2020-01-01 10:00:00' at, 'a' k union all select timestamp'2020-01-01 11:00:00', 'a' union all select timestamp'2020-02-01 00:00:00', 'b'").coalesce(1).write.parquet(src)
    counts = ingest.windowed_counts(ingest.stream_log(spark, src), "at", "k")
    q = counts.writeStream.format("memory").queryName("w_out").outputMode("append").option("checkpointLocation", str(tmp_path / "s")).trigger(availableNow=True).start()
    q.awaitTermination()
    assert rows(spark.table("w_out").select("k", "records")) == [("a", 2)]


def test_session_helpers(spark):
    a, b = spark.createDataFrame([(None, 1), (2, 2)], "k int, x int"), spark.createDataFrame([(None, 5), (3, 6)], "k int, y int")
    assert rows(join_null_safe(a, b, ["k"])) == [(None, 1, 5)]
    assert rows(join_null_safe(a, b, ["k"], "full_outer").select("k", "x", "y")) == [(None, 1, 5), (2, 2, None), (3, None, 6)]
    assert rows(join_null_safe(a, b, ["k"], "left_anti")) == [(2, 2)]
    assert "ResolvedHint" in small(a)._jdf.queryExecution().analyzed().toString() and "ResolvedHint" not in small(a, 1)._jdf.queryExecution().analyzed().toString()
