"""Evaluation texts leaking into training text, by suffix arrays over shards of the corpus.

Each shard (a run of documents of one partition, bounded in words) is turned into word numbers, its suffix array is sorted by prefix
doubling, and every suffix of every evaluation passage is binary-searched in it. A hit is a verbatim run of ``SEED`` words at a
location; it is extended on its diagonal to the longest verbatim match and to the best window of ``WINDOW`` words. A passage leaked
if a window has at most ``REPLACED`` replaced words, no two of them adjacent; by the pigeonhole principle such a window holds a
verbatim run of at least ``SEED`` words, so the search misses none. Corpus text never leaves its partition; the passages are a
stated query set, searched for in blocks of bounded size.

Words are runs of letters and digits in lower case, so case, punctuation, spacing, line breaks and markup do not matter. Sentences
that several items share (instructions) are no part of an item's own passage.

Defined results: null or empty texts hold nothing; repeated documents each get their own rows; an empty corpus or no items give an
empty result; items shorter than the window cannot leak; other columns of the inputs are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.session import bounded_collect, cut

WINDOW = 25
REPLACED = 3
SEED = (WINDOW - REPLACED + REPLACED) // (REPLACED + 1)
#: Words per shard: bounds the memory of a task; a single longer document is a shard of its own.
SHARD_WORDS = 2_000_000
#: Depth in words to which suffixes are ordered; equal prefixes beyond it keep any order, matches are extended by comparison.
ORDERED = 32
#: Evaluation items searched for in one pass over the corpus, which every task holds; more take more passes.
ITEMS = 100_000

MARKUP = re.compile(r"</?[A-Za-z][^<>]{0,300}>|&(?:[a-z]{2,8}|#\d{1,6});|\]\([^()\s]{1,300}\)")
WORD = re.compile(r"[^\W_]+")
SENTENCE_END = re.compile(r"[.?!:;]+(?=\s|$)|\n+")


def words(text: str) -> list[str]:
    return WORD.findall(MARKUP.sub(" ", text).lower())


def sentences(text: str | None) -> list[list[str]]:
    """The words of each sentence."""
    return [words(x) for x in SENTENCE_END.split(text or "")]


def with_shared(items: DataFrame) -> DataFrame:
    """``item_id, item_text, shared``: each item with its sentences of four words or more that another item has too."""

    def told(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for t in batches:
            rows = [(i, x) for i, text in zip(t["item_id"], t["item_text"]) for x in {" ".join(w) for w in sentences(text) if len(w) >= 4}]
            yield pd.DataFrame(rows, columns=["item_id", "sentence"])

    one = items.filter("item_id is not null and item_text is not null").groupBy(F.col("item_id").cast("long").alias("item_id")).agg(F.max("item_text").alias("item_text"))
    of_item = cut(one.mapInPandas(told, "item_id bigint, sentence string"))
    common = of_item.groupBy("sentence").agg(F.count("*").alias("n")).filter("n > 1").select("sentence")
    shared = of_item.join(common, "sentence", "left_semi").groupBy("item_id").agg(F.collect_set("sentence").alias("shared"))
    return one.join(shared, "item_id", "left")


def own_passages(items: list[tuple[int, str, list[str] | None]]) -> list[tuple[int, list[list[str]]]]:
    """Each item's stretches of words between the sentences it shares with another item."""
    out = []
    for i, text, shared in items:
        stretches: list[list[str]] = [[]]
        for s in sentences(text):
            if shared and " ".join(s) in shared:
                stretches.append([])
            else:
                stretches[-1].extend(s)
        out.append((i, [s for s in stretches if s]))
    return out


def suffix_array(tokens: np.ndarray, depth: int = ORDERED) -> np.ndarray:
    """Positions of ``tokens`` in the order of their suffixes, compared over the first ``depth`` words."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64)
    order = np.argsort(rank, kind="stable")
    h = 1
    while h < depth:
        second = np.zeros(n, dtype=np.int64)
        second[: n - h] = rank[h:] + 1 if h < n else 0
        key = rank * np.int64(n + 2) + second
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        fresh = np.empty(n, dtype=np.int64)
        fresh[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        rank = fresh
        if n == 0 or rank[order[-1]] == n - 1:
            break
        h *= 2
    return order


def _bounds(tokens: np.ndarray, order: np.ndarray, patterns: np.ndarray, upper: bool) -> np.ndarray:
    """Binary search of all patterns at once: the first suffix not below (``upper``: above) each pattern."""
    width = patterns.shape[1]
    lo, hi = np.zeros(len(patterns), dtype=np.int64), np.full(len(patterns), len(order), dtype=np.int64)
    while True:
        open_ = np.flatnonzero(lo < hi)
        if not len(open_):
            return lo
        mid = (lo[open_] + hi[open_]) // 2
        at = order[mid]
        sign, same = np.zeros(len(open_), dtype=np.int8), np.ones(len(open_), dtype=bool)
        for k in range(width):
            a, b = tokens[at + k], patterns[open_, k]
            sign = np.where(same & (a != b), np.where(a < b, -1, 1), sign)
            same &= a == b
        below = (sign < 0) | (same if upper else False)
        lo[open_] = np.where(below, mid + 1, lo[open_])
        hi[open_] = np.where(below, hi[open_], mid)


class Passages:
    """The query set: all passages in one array, 0 between them."""

    def __init__(self, items: list[tuple[int, str, list[str] | None]]):
        self.vocabulary: dict[str, int] = {}
        flat, owner = [0] * WINDOW, [-1] * WINDOW
        for item, stretches in own_passages(items):
            for s in stretches:
                for w in s:
                    flat.append(self.vocabulary.setdefault(w, len(self.vocabulary) + 1))
                    owner.append(item)
                flat.extend([0] * WINDOW)
                owner.extend([-1] * WINDOW)
        self.tokens, self.owner = np.array(flat, dtype=np.int64), np.array(owner, dtype=np.int64)
        starts = np.arange(max(0, len(flat) - SEED + 1))
        inside = np.ones(len(starts), dtype=bool)
        for k in range(SEED):
            inside &= self.tokens[starts + k] != 0
        self.starts = starts[inside]
        self.patterns = self.tokens[self.starts[:, None] + np.arange(SEED)[None, :]]


def search(texts: list[list[int]], doc_ids: list[int], passages: Passages) -> pd.DataFrame:
    """All windows of leaked words in one shard: ``doc_id, item_id, doc_word, item_word, longest, replaced`` (best per document and item)."""
    empty = pd.DataFrame({c: pd.Series(dtype="int64") for c in OUT_COLUMNS})
    if not texts or not len(passages.starts):
        return empty
    sep = [0] * WINDOW
    flat, doc_at, first = list(sep), [-1] * WINDOW, []
    tokens_parts, owner_parts, offset = [np.zeros(WINDOW, dtype=np.int64)], [np.full(WINDOW, -1, dtype=np.int64)], WINDOW
    for k, t in enumerate(texts):
        first.append(offset)
        tokens_parts.append(np.array(t + sep, dtype=np.int64))
        owner_parts.append(np.concatenate([np.full(len(t), k, dtype=np.int64), np.full(WINDOW, -1, dtype=np.int64)]))
        offset += len(t) + WINDOW
    tokens, owner, first = np.concatenate(tokens_parts), np.concatenate(owner_parts), np.array(first)
    del flat, doc_at, tokens_parts, owner_parts
    order = suffix_array(tokens)
    order = order[order < len(tokens) - WINDOW]
    lo, hi = _bounds(tokens, order, passages.patterns, False), _bounds(tokens, order, passages.patterns, True)
    found = []
    q_all, counts = passages.starts, hi - lo
    block = 4_000_000
    begin = 0
    edges = np.cumsum(counts)
    while begin < len(q_all):
        base = edges[begin - 1] if begin else 0
        stop = max(begin + 1, int(np.searchsorted(edges, base + block, side="right")))
        c = counts[begin:stop]
        total = int(c.sum())
        if total:
            within = np.arange(total) - np.repeat(np.cumsum(c) - c, c)
            p, q = order[np.repeat(lo[begin:stop], c) + within], np.repeat(q_all[begin:stop], c)
            new_run = (tokens[p - 1] != passages.tokens[q - 1]) | (passages.tokens[q - 1] == 0)  # each verbatim run once
            found.append(_extend(tokens, passages.tokens, p[new_run], q[new_run]))
        begin = stop
    hits = np.concatenate(found) if found else np.zeros((0, 4), dtype=np.int64)
    if not len(hits):
        return empty
    p, q, longest, replaced = hits.T
    k = owner[p]
    out = pd.DataFrame({"doc_id": np.array(doc_ids, dtype=np.int64)[k], "item_id": passages.owner[q], "doc_word": p - first[k], "item_word": q, "longest": longest, "replaced": replaced})
    return out.sort_values(["longest", "replaced", "doc_word", "item_word"], ascending=[False, True, True, True]).drop_duplicates(["doc_id", "item_id"])


def _extend(train: np.ndarray, test: np.ndarray, p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Rows ``p, q, longest, replaced`` of the runs starting at ``p, q`` that lie in a window of leaked words."""
    # necessary: with at most REPLACED mismatches each way, the reach to both sides covers a window
    reach = []
    for step in (1, -1):
        far, wrong, alive = np.zeros(len(p), dtype=np.int64), np.zeros(len(p), dtype=np.int64), np.arange(len(p))
        for k in range(WINDOW):
            at = k if step > 0 else -k - 1
            a, b = train[p[alive] + at], test[q[alive] + at]
            wrong[alive] += (a != b) | (b == 0)
            go = (wrong[alive] <= REPLACED) & (b != 0) & (a != 0)
            alive = alive[go]
            far[alive] += 1
            if not len(alive):
                break
        reach.append(far)
    keep = np.flatnonzero(reach[0] + reach[1] >= WINDOW)
    p, q = p[keep], q[keep]
    if not len(p):
        return np.zeros((0, 4), dtype=np.int64)
    span = np.arange(-WINDOW + 1, WINDOW)
    a, b = train[p[:, None] + span], test[q[:, None] + span]
    inside, miss = (a != 0) & (b != 0), a != b
    best = np.full(len(p), -1, dtype=np.int64)
    for s in range(WINDOW):  # a window starting s words before WINDOW - 1 words ahead of the run, up to the run's own start
        w = slice(s, s + WINDOW)
        n = miss[:, w].sum(axis=1)
        pair = (miss[:, s : s + WINDOW - 1] & miss[:, s + 1 : s + WINDOW]).any(axis=1)
        good = inside[:, w].all(axis=1) & (n <= REPLACED) & ~pair
        best = np.where(good & ((best < 0) | (n < best)), n, best)
    ok = np.flatnonzero(best >= 0)
    p, q, best = p[ok], q[ok], best[ok]
    longest, alive = np.full(len(p), SEED, dtype=np.int64), np.arange(len(p))
    while len(alive):
        alive = alive[(train[p[alive] + longest[alive]] == test[q[alive] + longest[alive]]) & (test[q[alive] + longest[alive]] != 0)]
        longest[alive] += 1
    return np.stack([p, q, longest, best], axis=1)


OUT_COLUMNS = ["doc_id", "item_id", "doc_word", "item_word", "longest", "replaced"]


def leaks(documents: DataFrame, items: DataFrame) -> DataFrame:
    """``doc_id, item_id, doc_word, item_word, longest, replaced``: each document with each item found in it, at its longest verbatim match."""
    asked = cut(with_shared(items))
    blocks = -(-asked.count() // ITEMS)
    placed = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(max(1, 2 * blocks) if blocks > 1 else 1)))
    corpus = spread(documents.filter("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    found = []
    for block in range(2 * blocks if blocks > 1 else 1):
        rows = bounded_collect(placed.filter(F.col("block") == block), ITEMS)
        found.append(_search_all(corpus, Passages(sorted((r.item_id, r.item_text, r.shared) for r in rows))))
    return reduce(DataFrame.unionByName, found)


def _search_all(corpus: DataFrame, passages: Passages) -> DataFrame:
    """One pass over the corpus for the passages of one block of items."""

    def shard(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        get, other = passages.vocabulary.get, len(passages.vocabulary) + 1
        texts, ids, size = [], [], 0
        for batch in batches:
            for doc, text in zip(batch["doc_id"], batch["text"]):
                numbers = [get(w, other) for w in words(text)]
                texts.append(numbers)
                ids.append(doc)
                size += len(numbers) + WINDOW
                if size >= SHARD_WORDS:
                    yield search(texts, ids, passages)
                    texts, ids, size = [], [], 0
        yield search(texts, ids, passages)

    return corpus.mapInPandas(shard, ", ".join(f"{c} bigint" for c in OUT_COLUMNS))


def spread(df: DataFrame) -> DataFrame:
    """Spread a table of fewer partitions than cores (so a small one); a large one stays where it is read."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(2 * cores) if df.rdd.getNumPartitions() < cores else df


def decontaminated(documents: DataFrame, found: DataFrame) -> DataFrame:
    """The documents without those in which any item was found."""
    return documents.join(found.select("doc_id").distinct(), "doc_id", "left_anti")
