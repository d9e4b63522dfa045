import random

import numpy as np
import pytest
from conftest import rows

from commitlake.llm import names as N


@pytest.mark.parametrize(
    "typed, reading",
    [
        ('Benjamin "Ben" Svank', ("person", "svank", "benjamin", "")), ("Svank, B. C.", ("person", "svank", "b", "c")), (" 'Tim\tSvänk' via web", ("person", "svank", "tim", "")), ("Dr. Ben Svank, PhD", ("person", "svank", "ben", "")),
        ("b-svank", ("person", "svank", "b", "")), ("Ned Svank (contractor)", ("person", "svank", "ned", "")), ("ned.svank", ("person", "svank", "ned", "")), ("The Svank Engineering", ("org", "svank", "engineering", "")),
        ("Svank Eng Ltd", ("org", "svank", "engineering", "")), ("Collective, Svank", ("org", "svank", "collective", "")), ("bsvank", ("word", "bsvank", "", "")),
    ],
)
def test_readings(typed, reading):
    assert N.readings(typed)[0] == reading


def test_both_orders_are_readings():
    assert [r[1:3] for r in N.readings("SVANK Benjamin")] == [("benjamin", "svank"), ("svank", "benjamin")]
    assert ("org", "svank", "foundation", "") in N.readings("SvankFoundation")


@pytest.mark.parametrize("typed", ["root", "(no author)", "Your Name", "x[bot]", "  ", "...", "Unknown"])
def test_nobody(typed):
    assert N.readings(typed) == []


def test_slips():
    assert [N.slips(*x) for x in (("brewala", "brewlaa"), ("brewala", "brewala"), ("brewalson", "brwalsn"), ("abc", "abd"), ("brewala", "dremola"))] == [1, 0, 2, -1, -1]


def _users(spark, typed):
    return spark.createDataFrame([(i, "S", u, k, v, "n") for i, (u, k, v) in enumerate(typed)], "_seq bigint, substore string, id bigint, key string, value string, node string")


def test_linked_users(spark):
    typed = [(1, "name", "Ned Brewala"), (2, "name", "Brewala, Edward"), (3, "name", "E. Brewala"), (4, "name", "Rebecca Brewala"), (5, "name", "brewalar"), (6, "name", "root"), (7, "name", "root"), (8, "name", None), (9, "name", " "), (10, "location", "Ned Brewala"), (11, "name", "Kim Other"), (11, "name", "Ned Brewala"), (12, "name", "Kim Other"), (2, "name", "Brewala, Edward"), (None, "name", "Ned Brewala"), (13, "name", "x" * 3000), (14, "name", "x" * 3000)]
    got = rows(N.same_pairs(N.linked_users(_users(spark, typed))))
    assert {(1, 2), (1, 3), (2, 3), (1, 11), (11, 12), (13, 14)} <= set(got)
    assert not {p for p in got if set(p) & {6, 7, 8, 9, 10}} and (1, 4) not in got and len(got) == len(set(got))
    assert N.same_pairs(N.linked_users(_users(spark, typed).limit(0))).count() == 0


def test_who_is_the_same_by_cosine(spark):
    """Unknown given names, turned orders, slips, initials, run-together words and a short form; others of the family stay apart."""
    same = ["Wolfdietrich Brewala", "Brewala Wolfdietrich", "Brewala, W.", "Wolfdeitrich Brewala", "wbrewala", "wolfdietrichbrewala"]
    others = ["Gudrun Brewala", "Olga Brewala", "Wolfdietrich Dremola", "Wolfdietrich Adler", "Wolfdietrich Sommer", "Wulfhild Sommer", "Olga Sommer", "Olga Adler"]
    short = ["Bill Ukolsen", "William Ukolsen"]
    typed = [(i, "name", n) for i, n in enumerate(same + others + short)]
    got = rows(N.same_pairs(N.linked_users(_users(spark, typed))))
    assert {(0, 1), (0, 2), (0, 3), (0, 5), (14, 15)} <= set(got)
    assert not [p for p in got if (p[0] < len(same)) != (p[1] < len(same))]
    assert (14, 15) not in rows(N.same_pairs(N.linked_users(_users(spark, typed), {})))


def test_family_pairs_lose_none(spark):
    random.seed(2)
    ids = sorted({f"p{random.choice('xy')}|" + "".join(random.choice("abc") for _ in range(random.randint(4, 7))) for _ in range(60)})
    vecs = N.vectors(spark.createDataFrame([(i, *i.split("|")) for i in ids], "id string, tag string, word string"))
    v = {}
    for r in vecs.collect():
        v.setdefault(r.id, {})[r.gram] = r.weight
    assert all(abs(sum(w * w for w in x.values()) - 1) < 1e-9 for x in v.values())
    cosine = lambda a, b: sum(w * v[b].get(g, 0) for g, w in v[a].items())
    want = {(a, b) for i, a in enumerate(ids) for b in ids[i + 1 :] if cosine(a, b) >= N.FAMILY + 1e-9 and N.slips(a.split("|")[1], b.split("|")[1]) >= 0}
    got = {(r.a, r.b): r.cosine for r in N.similar_families(vecs).collect()}
    assert want == set(got) and want
    assert all(abs(c - cosine(a, b)) < 1e-9 for (a, b), c in got.items())


def _linkage(n, sim, threshold):
    clusters = [{i} for i in range(n)]
    while True:
        best = max(((sum(sim.get((min(x, y), max(x, y)), 0) for x in a for y in b) / (len(a) * len(b)), i, j) for i, a in enumerate(clusters) for j, b in enumerate(clusters) if i < j), default=(0, 0, 0))
        if best[0] < threshold:
            return {frozenset(c) for c in clusters}
        clusters[best[1]] |= clusters.pop(best[2])


def test_average_linkage_equals_merging_the_closest(spark):
    rng = np.random.default_rng(4)
    n = 24
    sim = {(i, j): float(rng.uniform(0.3, 1)) for i in range(n) for j in range(i + 1, n) if rng.random() < (0.8 if i // 6 == j // 6 else 0.1)}
    nodes = spark.createDataFrame([(f"n{i:02d}",) for i in range(n)], "node string")
    pairs = spark.createDataFrame([(f"n{i:02d}", f"n{j:02d}", s) for (i, j), s in sim.items()], "a string, b string, score double")
    got = {}
    for r in N.average_linkage(nodes, pairs).collect():
        got.setdefault(r.cluster, set()).add(int(r.node[1:]))
    assert {frozenset(c) for c in got.values()} == _linkage(n, sim, N.COSINE)
