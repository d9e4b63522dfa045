import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from commitlake.llm import leakage as L
from commitlake.llm import mixture as M
from commitlake.llm import quality as Q

DOC = "doc_id bigint, text string, source string, item_id bigint, tokens string"


def _docs(spark, texts, source="s"):
    return spark.createDataFrame([(i, t, source, None, "clash") for i, t in enumerate(texts)], DOC)


def _words(n, seed, vocabulary=400):
    r = random.Random(seed)
    return [f"w{r.randrange(vocabulary)}" for _ in range(n)]


def _brute(train, test):
    """Any window of the passage in the document with few, single replaced words."""
    for i in range(len(train) - L.WINDOW + 1):
        for j in range(len(test) - L.WINDOW + 1):
            miss = [train[i + k] != test[j + k] for k in range(L.WINDOW)]
            if sum(miss) <= L.REPLACED and not any(a and b for a, b in zip(miss, miss[1:])):
                return True
    return False


def test_suffix_array():
    t = np.array([3, 1, 2, 1, 2, 0, 1, 2], dtype=np.int64)
    order = L.suffix_array(t)
    assert sorted(range(8), key=lambda i: t[i:].tolist()) == order.tolist()
    assert L.suffix_array(np.zeros(0, dtype=np.int64)).tolist() == []


def test_leaks_equal_brute_force(spark):
    items = [_words(60, s) for s in range(4)]
    r = random.Random(9)
    docs = []
    for k in range(60):
        d = _words(r.randrange(0, 60), 100 + k)
        it, at, n = items[k % 4], r.randrange(0, 30), r.randrange(20, 34)
        piece = it[at : at + n]
        for x in r.sample(range(len(piece)), r.randrange(0, 5)):
            piece[x] = "other"
        docs.append(d[: len(d) // 2] + piece + d[len(d) // 2 :])
    texts = [" ".join(f"**{w.upper()}**,\n" if r.random() < 0.2 else w for w in d) for d in docs]
    table = spark.createDataFrame([(100 + i, "s", " ".join(w)) for i, w in enumerate(items)], "item_id bigint, suite string, item_text string")
    got = {(x.doc_id, x.item_id) for x in L.leaks(_docs(spark, texts), table).collect()}
    assert got == {(i, 100 + j) for i, d in enumerate(docs) for j, t in enumerate(items) if _brute(d, t)}


def test_shared_instructions_and_odd_texts(spark):
    passage = [_words(40, s) for s in range(2)]
    instruction = " ".join(f"do{i}" for i in range(30)) + "."
    items = spark.createDataFrame([(i, "s", f"{instruction} {' '.join(p)}.") for i, p in enumerate(passage)] + [(7, "s", None), (8, "s", ""), (9, "s", "too short"), (None, "s", "x")], "item_id bigint, suite string, item_text string")
    texts = [instruction, " ".join(passage[0]), " ".join(passage[0]), None, "", " ".join(_words(300_000, 5)) + " " + " ".join(passage[1]), "<b>" + "</b> <i>".join(passage[1]) + "</i>"]
    found = L.leaks(_docs(spark, texts), items)
    assert rows(found.select("doc_id", "item_id")) == [(1, 0), (2, 0), (5, 1), (6, 1)]
    assert found.filter("doc_id = 1").first()["longest"] == 40
    assert rows(L.decontaminated(_docs(spark, texts), found).select("doc_id")) == [(0,), (3,), (4,)]
    assert L.leaks(_docs(spark, texts).limit(0), items).count() == 0 and L.leaks(_docs(spark, texts), items.limit(0)).count() == 0


def test_sharding_does_not_change_the_result(spark, monkeypatch):
    item = _words(50, 999)
    texts = [" ".join(_words(30, k) + (item[:30] if k % 3 == 0 else [])) for k in range(30)]
    items = spark.createDataFrame([(1, "s", " ".join(item))], "item_id bigint, suite string, item_text string")
    whole = rows(L.leaks(_docs(spark, texts), items))
    monkeypatch.setattr(L, "SHARD_WORDS", 100)
    assert rows(L.leaks(_docs(spark, texts).coalesce(1), items)) == whole and len(whole) == 10


def test_items_in_blocks_find_the_same(spark, monkeypatch):
    instruction = " ".join(f"do{i}" for i in range(30)) + "."
    passages = [_words(40, s) for s in range(5)]
    items = spark.createDataFrame([(i, "s", f"{instruction} {' '.join(p)}.") for i, p in enumerate(passages)], "item_id bigint, suite string, item_text string")
    docs = _docs(spark, [instruction, *(" ".join(p[:30]) for p in passages)])
    whole = rows(L.leaks(docs, items).select("doc_id", "item_id"))
    monkeypatch.setattr(L, "ITEMS", 4)
    assert rows(L.leaks(docs, items).select("doc_id", "item_id")) == whole == [(i + 1, i) for i in range(5)]


COMMON = ["the", "a", "and", "to", "of", "in", "is", "der", "und"]


def test_statistics(spark):
    common = spark.createDataFrame([("en", w) for w in COMMON] + [("en", None)], "lang string, word string")
    got = {r.doc_id: r for r in Q.statistics(_docs(spark, ["The cat and 2 dogs.\nBye!", None, "", "###"]), common).collect()}
    r = got[0]
    assert (r.n_chars, r.n_words, r.line_end_ratio) == (24, 6, 1.0)
    assert r.mean_word_length == pytest.approx(17 / 6) and r.common_ratio == pytest.approx(2 / 6) and r.symbol_ratio == pytest.approx(2 / 19) and r.digit_ratio == pytest.approx(1 / 19)
    assert all(got[1][s] is None for s in Q.STATISTICS) and got[2].n_words == 0 and got[3].symbol_ratio == 1
    assert Q.statistics(_docs(spark, ["a"]), common.limit(0)).first()["common_ratio"] == 0


def test_types(spark):
    rng = random.Random(1)
    prose = [" ".join(f"the {w} and a {v} is in the house of words." for w, v in zip(_words(6, s), _words(6, s + 1))) for s in range(60)]
    lists = ["\n".join(f"{i}. item{rng.randrange(99)} widget" for i in range(12)) for _ in range(12)]
    tables = ["\n".join(f"| x{i} | {rng.randrange(999)} | y |" for i in range(12)) for _ in range(12)]
    junk = ["".join(rng.choice("#<>|=~^_*/") for _ in range(300)) for _ in range(12)]
    common = spark.createDataFrame([("en", w) for w in COMMON], "lang string, word string")
    texts = prose + lists + tables + junk + [None, "", "   "]
    got = {r.doc_id: r.text_type for r in Q.text_types(_docs(spark, texts), common).collect()}
    want = ["prose"] * 60 + ["list"] * 12 + ["table"] * 12 + ["junk"] * 12 + [None, "junk", "junk"]
    assert [got[i] for i in range(len(texts))] == want
    assert Q.text_types(_docs(spark, texts).limit(0), common).count() == 0


def test_learning_finds_the_better_function():
    rng = np.random.default_rng(0)
    truth = rng.integers(0, 2, 4000)
    votes = np.stack([np.where(rng.random(4000) < a, truth, 1 - truth) for a in (0.95, 0.95, 0.6)], axis=1)
    patterns, counts = np.unique(votes, axis=0, return_counts=True)
    _, emission = Q.learn(patterns, counts.astype(float))
    assert emission[0, 0, 1] > 0.85 and emission[0, 2, 1] < 0.75


def test_goals():
    assert M.goals({"a": 100, "b": 100}, {"a": (0.5, 1), "b": (0.5, 1)}, 100) == {"a": 50, "b": 50}
    assert M.goals({"a": 10, "b": 100}, {"a": (0.5, 2), "b": (0.25, 9), "c": (0.25, 9)}, 100) == {"a": 20, "b": 80, "c": 0}
    assert M.goals({}, {"a": (1.0, 1)}, 100) == {"a": 0}


def _counts(spark, n=400, hot=300):
    return spark.createDataFrame([(i, "hot" if i < hot else "small", 1 + i % 7, 1.0 + (i % 2)) for i in range(n)] + [(n, None, 5, 1.0), (n + 1, "unnamed", 5, 1.0), (n + 2, "hot", 0, 1.0)], "doc_id bigint, source string, tokens bigint, weight double")


def test_mixture(spark):
    targets = spark.createDataFrame([("hot", 0.5, 1), ("small", 0.5, 3), ("absent", 0.0, None), (None, 0.3, 1)], "source string, target_share double, max_repeats int")
    chosen, shares = M.mixture(_counts(spark), targets)
    s = {r.source: r for r in shares.collect()}
    for name in ("hot", "small"):
        assert abs(s[name].tokens_reached - s[name].tokens_goal) <= 7 and abs(s[name].share_reached - 0.5) < 0.02
    assert s["absent"].tokens_reached == 0
    by = {r.doc_id: r.copies for r in chosen.collect()}
    assert all(by[i] in (1, 2, 3) for i in by) and all(by[i] >= 2 for i in range(300, 400)) and all(by[i] == 1 for i in by if i < 300)
    assert rows(M.mixture(_counts(spark), targets)[0]) == rows(chosen)
    assert rows(M.mixture(_counts(spark), targets, seed=5)[0]) != rows(chosen)
    empty, none = M.mixture(_counts(spark).limit(0), targets)
    assert empty.count() == 0 and {r.share_reached for r in none.collect()} == {0.0}
    assert M.mixture(_counts(spark), targets.limit(0))[0].count() == 0


def test_unequal_inclusion(spark):
    targets = spark.createDataFrame([("hot", 1.0, 1)], "source string, target_share double, max_repeats int")
    picked = [0, 0]
    for seed in range(4):
        chosen, _ = M.mixture(_counts(spark), targets, total=400, seed=seed, weight="weight")
        for r in chosen.collect():
            picked[r.doc_id % 2] += 1
    assert picked[1] > 1.4 * picked[0]


def test_token_counts(spark):
    got = M.token_counts(_docs(spark, ["hello world", "", None, "<|endoftext|>"])).collect()
    assert {r.doc_id: r.tokens for r in got} == {0: 2, 3: {r.doc_id: r.tokens for r in got}[3]} and {r.doc_id: r.tokens for r in got}[3] > 1
    assert M.token_counts(_docs(spark, ["a"], None)).count() == 0


def test_whole_texts_are_read(spark):
    long = "the cat and a dog is in the house. " * 20_000
    common = spark.createDataFrame([("en", w) for w in COMMON], "lang string, word string")
    assert Q.statistics(_docs(spark, [long]), common).select(F.col("n_chars")).first()[0] == len(long)


def test_fenced_text_is_judged(spark):
    common = spark.createDataFrame([("en", w) for w in "the and of to is in it".split()], "lang string, word string")
    line = "The report of the last run is in the log and it is kept.\n"
    log = "".join(f"0x{i * 7919:08x} ERR {i} [{i % 7}] == {i * 31} %%\n" for i in range(60))
    texts = [line + "```\n" + log + "```\n", line + "```\n" + line * 20, line * 20 + "```\nx = 1\n```\n"]
    got = {r.doc_id: r for r in Q.statistics(_docs(spark, texts), common).collect()}
    assert [got[i].n_chars for i in range(3)] == [len(t) for t in texts]
    assert got[0].fenced_ratio > 0.9 and got[0].prose_ratio < 0.1 and got[1].fenced_ratio == 0 and got[1].prose_ratio > 0.9 and got[2].fenced_ratio < 0.1 and got[2].prose_ratio > 0.9
    prose = [f"The part {w} of the plan is in the hands of it and to be done.\n" * 3 for w in "one two three four five six seven".split()]
    kinds = {r.doc_id: r.text_type for r in Q.text_types(_docs(spark, texts + prose + [log, log[:900]]), common).collect()}
    assert kinds[0] != "prose" and kinds[1] == kinds[2] == "prose"
