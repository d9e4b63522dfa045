import random

import pytest
from conftest import rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from commitlake.operators import graph, hierarchy

SETTINGS = settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])


def _paths(parent):
    out = {}
    for n in parent:
        path, x, seen = [], n, set()
        while x is not None and x not in seen:
            seen.add(x)
            path.append(x)
            x = parent[x]
        out[n] = None if x is not None else path[::-1]
    return out


def _check_forest(spark, parent):
    got = {r.id: r for r in hierarchy.hierarchy(spark.createDataFrame(list(parent.items()), "id bigint, parent bigint")).collect()}
    want = _paths(parent)
    assert {n: r.path for n, r in got.items()} == want
    for n, p in want.items():
        below = sum(1 for q in want.values() if q and n in q[:-1])
        assert (got[n].root, got[n].depth, got[n].n_descendants) == ((p[0], len(p) - 1, below) if p else (None, None, None))


def test_deep_chain_with_branches(spark):
    random.seed(1)
    parent = {0: None} | {i: i - 1 if i < 400 else random.randrange(i) for i in range(1, 700)}
    _check_forest(spark, parent)


@SETTINGS
@given(st.lists(st.integers(0, 39), min_size=1, max_size=40))
def test_any_pointer_graph(spark, targets):
    n = len(targets)
    _check_forest(spark, {i: (t if t < n else None) for i, t in enumerate(targets)})


def _classes(edges, nodes):
    reach = {n: set() for n in nodes}
    for a in nodes:
        todo = [b for x, b in edges if x == a]
        while todo:
            b = todo.pop()
            if b not in reach[a]:
                reach[a].add(b)
                todo += [c for x, c in edges if x == b]
    return sorted((min(m for m in nodes if m == n or (m in reach[n] and n in reach[m])), n) for n in nodes if n in reach[n])


@SETTINGS
@given(st.integers(2, 40).flatmap(lambda n: st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1)), max_size=2 * n)))
def test_circles_of_any_graph(spark, edges):
    nodes = sorted({x for e in edges for x in e} | {0})
    links = spark.createDataFrame([(n, [b for a, b in edges if a == n], n * 7 % 11) for n in nodes], "id bigint, parents array<bigint>, potential bigint")
    assert rows(hierarchy.circular_nodes(links)) == _sorted(_classes(edges, nodes))


@SETTINGS
@given(st.integers(2, 30).flatmap(lambda n: st.lists(st.tuples(st.integers(0, n - 1), st.integers(0, n - 1)), min_size=1, max_size=2 * n)))
def test_circles_reduced_again_and_again(spark, edges):
    got = {}
    for r in hierarchy.circles(spark.createDataFrame(edges, "a bigint, b bigint").distinct(), split=2).collect():
        got.setdefault(r.comp, set()).add(r.id)
    nodes = {x for e in edges for x in e}
    want = {}
    for least, n in _classes(edges, sorted(nodes)):
        want.setdefault(least, set()).add(n)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def _sorted(rs):
    return sorted(rs, key=lambda t: tuple((x is not None, str(x)) for x in t))


def test_long_circles_without_and_with_splitters(spark):
    edges = [(i, (i + 1) % 150) for i in range(150)] + [(200, 201), (201, 200), (300, 300), (400, 0), (0, 500)]
    nodes = sorted({x for e in edges for x in e})
    links = spark.createDataFrame([(n, [b for a, b in edges if a == n], n) for n in nodes], "id bigint, parents array<bigint>, potential bigint")
    assert rows(hierarchy.circular_nodes(links)) == _sorted(_classes(edges, nodes))


@pytest.mark.parametrize("potential", [None, 5])
def test_dirty_links(spark, potential):
    schema = "_seq bigint, commit_id bigint, parents array<bigint>, committer_time bigint, path string"
    data = [(1, 1, [2, 2, None, 99], potential, ""), (2, 2, [3], potential, ""), (3, 2, [1], potential, ""), (4, 3, None, potential, ""), (5, 4, [4], 3, ""), (6, None, [1], 1, ""), (4, 3, None, potential, "")]
    links = hierarchy.latest_links(spark.createDataFrame(data, schema))
    assert rows(hierarchy.circular_nodes(links)) == [(1, 1), (1, 2), (4, 4)]
    assert hierarchy.circular_nodes(hierarchy.latest_links(spark.createDataFrame([], schema))).count() == 0
    assert hierarchy.hierarchy(hierarchy.first_parents(hierarchy.latest_links(spark.createDataFrame([], schema)))).count() == 0


@SETTINGS
@given(st.lists(st.tuples(st.integers(0, 30), st.integers(0, 30)), max_size=60), st.sets(st.integers(0, 30), max_size=4))
def test_reachable(spark, edges, roots):
    want = set()
    for r in roots:
        todo = [r]
        while todo:
            x = todo.pop()
            if (r, x) not in want:
                want.add((r, x))
                todo += [b for a, b in edges if a == x]
    got = graph.reachable(spark.createDataFrame([(r, r) for r in roots], "key bigint, id bigint"), spark.createDataFrame(edges, "a bigint, b bigint").distinct())
    assert {tuple(r) for r in got.select("key", "id").collect()} == want


def test_descendants_through_any_parent(spark, tmp_path):
    from commitlake.plans.problems import QUERIES

    links = [(1, []), (2, [1]), (3, [1]), (4, [2, 3]), (5, [4, 99]), (6, []), (7, [5, 6]), (8, [9]), (9, [8])]
    spark.createDataFrame([(i, c, p, 100 + i) for i, (c, p) in enumerate(links)], "_seq bigint, commit_id bigint, parents array<bigint>, committer_time bigint").write.parquet(str(tmp_path / "commits_info.parquet"))
    want = [(a, b) for a, bs in {1: [2, 3, 4, 5, 7], 2: [4, 5, 7], 3: [4, 5, 7], 4: [5, 7], 5: [7], 6: [7], 8: [9], 9: [8]}.items() for b in bs]
    assert sorted(tuple(r) for r in QUERIES["p4_descendants"](spark, str(tmp_path)).collect()) == want


def test_circles_with_commits_of_unknown_time(spark):
    random.seed(8)
    n = 60
    parents = {i: [i - 1, random.randrange(max(0, i - 6), i)] if i else [] for i in range(n)}
    for a, b in ((3, 9), (20, 24), (40, 55)):  # an older commit names a newer one as its parent
        parents[a].append(b)
    time = {i: None if i % 4 == 1 else 100 * i for i in range(n)}
    reach = {i: set() for i in range(n)}
    for i in range(n):
        todo = list(parents[i])
        while todo:
            x = todo.pop()
            if x not in reach[i]:
                reach[i].add(x)
                todo += parents[x]
    want = sorted((min(j for j in reach[i] if i in reach[j]), i) for i in range(n) if i in reach[i])
    links = spark.createDataFrame([(i, parents[i], time[i]) for i in range(n)], "id bigint, parents array<bigint>, potential bigint")
    assert want and sorted(tuple(r) for r in hierarchy.circular_nodes(links).collect()) == want
    kept = hierarchy.localise(hierarchy.edges_of(links), links).count()
    assert kept < hierarchy.edges_of(links).count()
