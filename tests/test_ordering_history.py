import random

from conftest import rows
from pyspark.sql import functions as F

from commitlake.operators import history, ordering


def test_positions_equal_a_plain_ranking(spark):
    random.seed(3)
    data = [(random.choice([None, 1, 1, 1, 2]), s, f"v{s}") for s in random.sample(range(10_000), 300)]
    got = ordering.positions(spark.createDataFrame(data, "k int, s int, idx_clash string"), ["k"], ["s"], "pos", blocks=7)
    want = []
    for k in {d[0] for d in data}:
        want += [(k, s, v, i + 1) for i, (_, s, v) in enumerate(sorted((d for d in data if d[0] == k), key=lambda d: d[1]))]
    assert rows(got) == sorted(want, key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_positions_with_equal_and_null_axis(spark):
    got = ordering.positions(spark.createDataFrame([(1, 5, 1), (1, 5, 2), (1, None, 3)], "k int, a int, b int"), ["k"], ["a", "b"], "pos")
    assert rows(got) == [(1, None, 3, 1), (1, 5, 1, 2), (1, 5, 2, 3)]
    assert ordering.positions(spark.createDataFrame([], "k int, a int"), ["k"], ["a"], "pos").count() == 0


def _tables(spark, updates=(), heads=(), metadata=(), keys=(("stars", "int"),)):
    return (
        spark.createDataFrame(list(updates), "_seq bigint, project_id bigint, kind string, time bigint, version int, old_offset bigint, new_kind string, error string, idx int"),
        spark.createDataFrame(list(heads), "_seq bigint, project_id bigint, heads map<string, struct<commit_id: bigint, sha: string>>, item string"),
        spark.createDataFrame(list(metadata), "_seq bigint, project_id bigint, key string, value string, state string"),
        spark.createDataFrame(list(keys), "metakey string, value_type string"),
    )


def _head(**branches):
    return {k: (v, "x") for k, v in branches.items()}


def test_heads_versions_with_periods(spark):
    heads = [
        (1, 9, _head(a=1, b=1), "x"), (2, 9, None, "x"), (3, 9, _head(a=1), "x"), (4, 9, {}, "x"), (5, 9, _head(a=1, b=None), "x"), (5, 9, _head(a=1, b=None), "x"), (6, None, _head(a=1), "x"),
    ]
    events = history.project_events(*_tables(spark, heads=heads))
    got = rows(history.versions(events).select("item", "from_seq", "to_seq", "state"))
    assert got == [("a", 1, 4, "1"), ("a", 5, None, "1"), ("b", 1, 3, "1"), ("b", 5, None, None)]


def test_status_is_ordered_by_time_and_repeats_start_nothing(spark):
    u = lambda s, t, k, e=None: (s, 1, k, t, 0, None, None, e, 0)
    updates = [u(1, 50, "Ok"), u(2, 10, "Ok"), u(3, 20, "Error", "x"), u(4, 20, "Error", "y"), u(5, None, "Ok"), u(5, None, "Ok"), (None, 1, "Ok", 1, 0, None, None, None, 0)]
    got = rows(history.versions_started(history.project_events(*_tables(spark, updates=updates))))
    assert got == [("status", 1, "", 1), ("status", 1, "", 3), ("status", 1, "", 4), ("status", 1, "", 5)]


def test_metadata_keys_agree_and_null_is_a_state(spark):
    m = [(1, 1, "stars", "3", "c"), (2, 1, " Stars", "3", "c"), (3, 1, "STARS", None, "c"), (4, 1, "stars", None, "c"), (5, 1, "sTars", "3", "c"), (6, 1, "other", "3", "c"), (7, 1, None, "3", "c")]
    got = rows(history.versions(history.project_events(*_tables(spark, metadata=m))).select("from_seq", "to_seq", "state"))
    assert got == [(1, 3, "3"), (3, 5, None), (5, None, "3")]


def test_no_rows_no_history(spark):
    assert history.versions(history.project_events(*_tables(spark, keys=()))).count() == 0


def test_hot_item_equals_brute_force(spark):
    random.seed(5)
    m = [(s, random.choice([1, 1, 1, 2]), "stars", random.choice(["1", "2", None]), "") for s in random.sample(range(5000), 400)]
    got = rows(history.versions(history.project_events(*_tables(spark, metadata=m))).select("project_id", "from_seq", "to_seq", "state"))
    want = []
    for p in (1, 2):
        seq = sorted(x for x in m if x[1] == p)
        starts = [x for i, x in enumerate(seq) if i == 0 or seq[i - 1][3] != x[3]]
        want += [(p, x[0], starts[i + 1][0] if i + 1 < len(starts) else None, x[3]) for i, x in enumerate(starts)]
    assert got == sorted(want, key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_with_previous_keeps_other_columns(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 2, "b")], "k int, s int, prev string")
    assert rows(ordering.with_previous(df, ["k"], ["s"], ["prev"]).select("s", "prev_prev", F.col("has_prev"))) == [(1, None, False), (2, "a", True)]


def test_positions_of_ties_by_all_columns_and_without_keys(spark):
    data = [(7, t, n) for t in "ba" for n in (3, 1, 2)]
    got = ordering.positions(spark.createDataFrame(data, "a int, t string, n int"), [], ["a", "t", "n"], "pos", blocks=3)
    assert rows(got) == sorted((7, t, n, i + 1) for i, (t, n) in enumerate(sorted((t, n) for _, t, n in data)))


def test_first_id_after_a_lone_sentinel(spark):
    from commitlake.operators import log

    known = spark.createDataFrame([(0, "")], "id bigint, v string")
    new = spark.createDataFrame([("x", 1), ("", 2), ("y", 3)], "v string, seq bigint")
    assert sorted(tuple(r) for r in log.get_or_create(known, new, "v", "id", "seq").select("v", "id", "is_new").collect()) == [("", 0, False), ("x", 1, True), ("y", 2, True)]
    assert sorted(tuple(r) for r in log.get_or_create(known.limit(0), new.limit(1), "v", "id", "seq").select("v", "id").collect()) == [("x", 0)]
