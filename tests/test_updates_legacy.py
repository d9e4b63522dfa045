import struct

from conftest import rows

from commitlake.operators import updates
from commitlake.sources import legacy


def test_rename_and_move(spark):
    urls = spark.createDataFrame([(1, 7, "Git", "a"), (2, 8, "Git", "b"), (3, 7, "Git", "c")], "_seq bigint, project_id bigint, url_kind string, url_name string")
    renames = spark.createDataFrame([(7, "GitHub", "x"), (8, "Git", "b"), (9, "Git", "n")], "project_id bigint, url_kind string, url_name string")
    new, status = updates.rename(urls, renames, 50, 10)
    assert rows(new) == [(10, 7, "GitHub", "x"), (11, 9, "Git", "n")]
    assert rows(status.select("_seq", "project_id", "kind", "time", "old_offset")) == [(10, 7, "Rename", 50, 3), (11, 9, "Rename", 50, None)]
    heads, status = updates.change_substore(spark.createDataFrame([(7, "Go")], "project_id bigint, substore string"), 60, 20)
    assert heads.first()["heads"] == {} and status.first()["new_kind"] == "Go"


def test_update_status(spark):
    h = lambda *r: spark.createDataFrame(list(r), "project_id bigint, branch string, commit_id bigint")
    projects = spark.createDataFrame([(1, None), (2, None), (3, "gone"), (4, None)], "project_id bigint, error string")
    changed = spark.createDataFrame([(4,)], "project_id bigint")
    got = updates.update_status(projects, h((1, "a", 1), (2, "a", 1)), h((1, "a", 2), (2, "a", 1)), 9, 100, changed)
    assert rows(got.select("project_id", "kind", "error", "_seq")) == [(1, "Ok", None, 100), (2, "NoChange", None, 101), (3, "Error", "gone", 102), (4, "Ok", None, 103)]


def test_file_sizes(spark, tmp_path):
    (tmp_path / "t").mkdir()
    (tmp_path / "t/a").write_bytes(b"xyz")
    assert rows(updates.file_sizes(spark, {"t": str(tmp_path / "t")})) == [("t", 1, 3)]


def test_legacy_folder(spark, tmp_path):
    (tmp_path / "commit_ids.csv").write_text("sha,id\ns1,1\ns2,2\ns3,3\ns4,4\n")
    (tmp_path / "commit_records.csv").write_text("x,id,c,ct,a,at\n0,1,5,10,6,11\n0,2,5,20,6,21\n0,3,5,30,6,31\n")
    (tmp_path / "commit_parents.csv").write_text("x,c,p\n0,2,1\n0,2,4\n0,1,3\n")
    (tmp_path / "commit_messages.dat").write_bytes(struct.pack("<QI", 1, 1) + b"m")
    (tmp_path / "commit_changes.dat").write_bytes(struct.pack("<QIQQQQ", 2, 1, 0, 0, 7, 70))
    got = {r.commit_id: r for r in legacy.commits(spark, str(tmp_path)).collect()}
    assert set(got) == {1, 2} and got[2].parents == [1] and got[1].parents == [] and got[2].changes == {7: 70} and got[1].message == "m"


def test_legacy_projects(spark):
    e = [(1, 0, "GH", "init", "", "u"), (1, 1, "GH", "start", "", ""), (1, 2, "GH", "head", "m", "s1"), (1, 3, "GH", "start", "", ""), (1, 4, "GH", "head", "m", "s2"), (1, 5, "GH", "meta", "stars", "3"), (1, 6, "GH", "start", "", ""), (2, 0, "GH", "head", "m", "s"), (2, 1, "GH", "error", "", ""), (3, 0, "XX", "head", "m", "s")]
    events = spark.createDataFrame([(p, i, 0, s, k, key, v) for p, i, s, k, key, v in e], "project_id bigint, pos bigint, time bigint, source string, kind string, key string, value string")
    assert rows(legacy.project_heads(events)) == [(1, "m", "s2")]
    assert rows(legacy.project_counts(events)) == [(1, 3, 0, 0), (2, 0, 0, 0), (3, 0, 0, 0)]
