"""Positions within ordered groups, without ever sorting one whole group in one task.

A plain ``row_number() over (partition by key)`` puts every row of a hot key into a single task. Here the rows are range-partitioned by
key and order together, so a hot key spreads over as many partitions as its rows need; a row's position is its place in its partition,
less the place of its key's first row there, plus the key's rows in the partitions before, of which there are at most as many as
partitions.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from commitlake.session import cut

#: Bits of ``monotonically_increasing_id`` that number the rows of a partition; the others number the partition.
ROW_BITS = 33


def positions(df: DataFrame, keys: list[str], order: list[str], out: str = "idx", blocks: int | None = None) -> DataFrame:
    """Add the 1-based position ``out`` of each row in its group ``keys`` ordered by ``order`` (nulls first, unique per group).

    ``blocks``: number of ranges; by default that of the shuffle partitions, or fewer where the rows are few.
    """
    by = [F.col(c).asc_nulls_first() for c in [*keys, *order]]
    ranged = df.repartitionByRange(blocks, *by) if blocks else df.repartitionByRange(*by)
    # written once: every later use must see the same numbers
    placed = cut(ranged.sortWithinPartitions(*by).withColumn("__at", F.monotonically_increasing_id()))
    part = F.shiftright("__at", ROW_BITS)
    stretches = placed.groupBy(*keys, part.alias("__part")).agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))
    before = F.sum("__n").over(Window.partitionBy(*(keys or [F.lit(0)])).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1))
    offsets = stretches.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.col("__part").alias("__k_part"), (F.coalesce(before, F.lit(0)) - F.col("__first") + 1).alias("__shift"))
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys], part == F.col("__k_part"))
    return placed.join(offsets, cond).withColumn(out, F.col("__at") + F.col("__shift")).drop("__at", "__shift", "__k_part", *[f"__k_{k}" for k in keys])


def with_previous(df: DataFrame, keys: list[str], order: list[str], state: list[str], blocks: int | None = None) -> DataFrame:
    """Add ``prev_<c>`` for each state column and ``has_prev`` from the row before in the group."""
    placed = positions(df, keys, order, "__pos", blocks)
    prev = placed.select(
        *[F.col(k).alias(f"__p_{k}") for k in keys],
        (F.col("__pos") + 1).alias("__p_pos"),
        *[F.col(c).alias(f"prev_{c}") for c in state],
        F.lit(True).alias("__had"),
    )
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"__p_{k}")) for k in keys]) & (F.col("__pos") == F.col("__p_pos"))
    return (
        placed.join(prev, cond, "left")
        .withColumn("has_prev", F.col("__had").isNotNull())
        .drop("__pos", "__p_pos", "__had", *[f"__p_{k}" for k in keys])
    )
