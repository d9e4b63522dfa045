"""Connected components of a graph given by its links, by contraction."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from commitlake.session import keep

HALF = 0xFFFFFFFF


def _mixed(c: str) -> Column:
    """A number whose order is that of no input: two rounds of a Feistel network over the halves of an id, so that it can be undone."""
    low = F.col(c).bitwiseAND(F.lit(HALF))
    first = F.shiftrightunsigned(c, 32).bitwiseXOR(F.xxhash64(low).bitwiseAND(F.lit(HALF)))
    return F.shiftleft(first, 32).bitwiseOR(low.bitwiseXOR(F.xxhash64(first).bitwiseAND(F.lit(HALF))))


def _unmixed(c: str) -> Column:
    first = F.shiftrightunsigned(c, 32)
    low = F.col(c).bitwiseAND(F.lit(HALF)).bitwiseXOR(F.xxhash64(first).bitwiseAND(F.lit(HALF)))
    return F.shiftleft(first.bitwiseXOR(F.xxhash64(low).bitwiseAND(F.lit(HALF))), 32).bitwiseOR(low)


def components(links: DataFrame) -> DataFrame:
    """``node, leader``: the nodes of the links ``a, b`` with a node of their connected component, the same for all of it.

    Contraction: every node hooks on to the first node around it in a random order and on to that one's own; links between different
    leaders are the links of the next graph, a fraction of the size. The leaders are resolved from the last graph back to the first.
    """
    links = keep(links.filter("a <> b").select(_mixed("a").alias("a"), _mixed("b").alias("b")).distinct())
    levels = []
    while levels == [] or links.limit(1).count():
        salt = 0x5DEECE66D1F3A7 * len(levels) & 2**62 - 1  # another order for each graph
        turned = lambda c: F.col(c).bitwiseXOR(F.lit(salt))
        both = links.select(F.col("a").alias("node"), turned("b").alias("x")).unionByName(links.select(F.col("b").alias("node"), turned("a").alias("x")))
        around = both.groupBy("node").agg(F.min("x").alias("x")).select("node", F.least("x", turned("node")).bitwiseXOR(F.lit(salt)).alias("leader"))
        hook = keep(through(around, around))
        levels.append(hook)
        for side in ("a", "b"):
            links = links.join(hook.select(F.col("node").alias(side), F.col("leader").alias(f"l{side}")), side)
        links = keep(links.select(F.least("la", "lb").alias("a"), F.greatest("la", "lb").alias("b")).filter("a <> b").distinct())
    label = levels[-1]
    for hook in reversed(levels[:-1]):
        label = through(hook, label)
    return keep(label.select(_unmixed("node").alias("node"), _unmixed("leader").alias("leader")))


def through(hook: DataFrame, label: DataFrame) -> DataFrame:
    """Each node with the leader of its leader, if that one has any."""
    on = label.select(F.col("node").alias("leader"), F.col("leader").alias("further"))
    return hook.join(on, "leader", "left").select("node", F.coalesce("further", "leader").alias("leader"))
