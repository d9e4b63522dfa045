"""Mixing sources to target weights, by Pareto order sampling.

Tokens are counted per document with a public tokenizer. Every source gets a goal of tokens: its target share of the total, at most
its tokens times its repeats; what sources too small or absent cannot give is spread over the others in proportion to their targets.
Within a source, ``goal / tokens`` expected copies split into whole copies that every document gets for certain and a fraction. The
fraction is drawn by Pareto order sampling: documents are ranked by random odds over inclusion odds, and the first are taken until
their tokens reach the rest of the goal. Inclusion odds follow an optional weight per document, so probabilities may be unequal.

The random number of a document is a hash of its id and the seed, so runs agree. A source's ranking is never sorted in one task: ranks
are cut into buckets, bucket sums decide all but one bucket, and only that one is ordered.

Defined results: null or empty texts and documents without a named source are not part of a mixture; null shares count as 0 and null
repeats as 1; targets of equal sources are taken once; without documents the mixture is empty and every reached share 0; other columns
are ignored.
"""

from __future__ import annotations

import os
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlake.llm.leakage import spread
from commitlake.session import bounded_collect, cut, small

TOKENIZER = "/opt/tokenizers/byte_bpe_50k.json"
SEED = 17
BUCKETS = 2_048
#: Bound of the table of targets.
MAX_SOURCES = 10_000


def token_counts(documents: DataFrame, tokenizer: str = TOKENIZER) -> DataFrame:
    """``doc_id, source, tokens`` of the documents with a text; the tokenizer file must lie at this path on every executor."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        t = Tokenizer.from_file(tokenizer)
        t.encode_special_tokens = True  # their strings in a text are ordinary text
        for batch in batches:
            sizes = []
            for i in range(0, len(batch), 256):
                sizes += [len(e.ids) for e in t.encode_batch_fast(batch["text"].iloc[i : i + 256].tolist(), add_special_tokens=False)]
            yield pd.DataFrame({"doc_id": batch["doc_id"], "source": batch["source"], "tokens": sizes})

    rows = documents.filter("doc_id is not null and source is not null and length(text) > 0").select(F.col("doc_id").cast("long").alias("doc_id"), "source", "text")
    return spread(rows).mapInPandas(count, "doc_id bigint, source string, tokens bigint")


def goals(available: dict[str, int], targets: dict[str, tuple[float, int]], total: int) -> dict[str, float]:
    """Tokens each source shall give: shares of ``total`` up to what its repeats allow, the missing spread over the rest."""
    most = {s: available.get(s, 0) * max(0, r) for s, (_, r) in targets.items()}
    goal = dict.fromkeys(targets, 0.0)
    left, open_ = float(total), {s for s, (share, _) in targets.items() if share > 0 and most[s] > 0}
    while left > 1e-9 and open_:
        shares = sum(targets[s][0] for s in open_)
        full = {s for s in open_ if goal[s] + left * targets[s][0] / shares >= most[s]}
        if not full:
            for s in open_:
                goal[s] += left * targets[s][0] / shares
            break
        for s in full:
            left -= most[s] - goal[s]
            goal[s] = float(most[s])
        open_ -= full
    return goal


def mixture(counts: DataFrame, mix_targets: DataFrame, total: int | None = None, seed: int = SEED, weight: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(chosen, shares)``.

    ``chosen``: ``doc_id, source, tokens, copies`` of the documents in the mixture. ``shares``: per source ``target_share``,
    ``tokens_available``, ``tokens_goal``, ``tokens_reached``, ``share_reached``. ``total`` defaults to all tokens of the named
    sources; ``weight`` names a positive column of ``counts`` to which inclusion is proportional.
    """
    spark = counts.sparkSession
    rows = bounded_collect(mix_targets.filter("source is not null").groupBy("source").agg(F.max("target_share").alias("share"), F.max("max_repeats").alias("repeats")), MAX_SOURCES)
    targets = {r.source: (float(r.share or 0.0), 1 if r.repeats is None else int(r.repeats)) for r in rows}
    named = spark.createDataFrame([(s,) for s in targets], "source string")
    docs = cut(counts.filter("tokens > 0").join(F.broadcast(named), "source").select("doc_id", "source", "tokens", (F.col(weight).cast("double") if weight else F.lit(1.0)).alias("weight")))
    sums = {r.source: r for r in docs.groupBy("source").agg(F.sum("tokens").alias("tokens"), (F.sum(F.col("weight") * F.col("tokens")) / F.sum("tokens")).alias("mean")).collect()}  # one row per named source
    available = {s: int(sums[s].tokens) if s in sums else 0 for s in targets}
    want = goals(available, targets, sum(available.values()) if total is None else total)
    plan = []
    for s in targets:
        expected = want[s] / available[s] if available[s] else 0.0
        whole = int(expected + 1e-9)
        plan.append((s, whole, max(0.0, expected - whole), max(0.0, want[s] - whole * available[s]), float(sums[s]["mean"]) if s in sums else 1.0))
    planned = docs.join(F.broadcast(spark.createDataFrame(plan, "source string, whole int, fraction double, rest double, mean double")), "source")
    # random odds over inclusion odds; a fraction above what a weight allows counts as almost certain
    u = (F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(2**52)).cast("double") + 0.5) / F.lit(float(2**52))
    p = F.least(F.col("fraction") * F.col("weight") / F.col("mean"), F.lit(1 - 1e-9))
    ranked = planned.withColumn("rank", F.when(p > 0, (u / (1 - u)) / (p / (1 - p))))
    ranked = cut(ranked.withColumn("bucket", F.least(F.floor(F.lit(float(BUCKETS)) * F.col("rank") / (1 + F.col("rank"))), F.lit(BUCKETS - 1)).cast("int")))
    before = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    buckets = ranked.filter("rank is not null").groupBy("source", "bucket").agg(F.sum("tokens").alias("in_bucket")).withColumn("before", F.coalesce(F.sum("in_bucket").over(before), F.lit(0)))
    placed = ranked.join(small(cut(buckets)), ["source", "bucket"], "left")
    inside = Window.partitionBy("source", "bucket").orderBy("rank", "doc_id").rowsBetween(Window.unboundedPreceding, 0)
    cut_bucket = placed.filter((F.col("before") < F.col("rest")) & (F.col("before") + F.col("in_bucket") > F.col("rest")))
    # taken while the middle of a document lies before the rest of the goal, so the sum is off by half a document at most
    drawn = cut_bucket.withColumn("upto", F.col("before") + F.sum("tokens").over(inside)).filter(F.col("upto") - F.col("tokens") / 2.0 <= F.col("rest"))
    sure = placed.filter(F.col("before") + F.col("in_bucket") <= F.col("rest"))
    extra = sure.select("doc_id", "source").unionByName(drawn.select("doc_id", "source")).withColumn("extra", F.lit(1))
    copies = F.col("whole") + F.coalesce("extra", F.lit(0))
    chosen = planned.join(extra, ["doc_id", "source"], "left").select("doc_id", "source", "tokens", copies.cast("bigint").alias("copies")).filter("copies > 0")
    chosen = cut(chosen)
    reached = chosen.groupBy("source").agg(F.sum(F.col("tokens") * F.col("copies")).alias("tokens_reached"))
    report = spark.createDataFrame([(s, targets[s][0], available[s], float(want[s])) for s in targets], "source string, target_share double, tokens_available bigint, tokens_goal double")
    shares = report.join(reached, "source", "left").withColumn("tokens_reached", F.coalesce("tokens_reached", F.lit(0)))
    whole_sum = chosen.agg(F.coalesce(F.sum(F.col("tokens") * F.col("copies")), F.lit(0)).alias("n")).first()["n"]
    return chosen, shares.withColumn("share_reached", F.col("tokens_reached") / F.lit(float(whole_sum)) if whole_sum else F.lit(0.0))
