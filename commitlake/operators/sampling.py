"""Sampling by the order of a hash: the same sample on every run and engine, and more of it when k grows."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def hashed(column: str, seed: int | None = None):
    text = F.col(column).cast("string")
    return F.md5(text if seed is None else F.concat(text, F.lit(f":{seed}")))


def uniform(df: DataFrame, key: str, k: int, seed: int | None = None) -> DataFrame:
    """``k`` rows without replacement (all if there are fewer): a top-k, which each task cuts before the shuffle."""
    return df.withColumn("__h", hashed(key, seed)).orderBy("__h", key).limit(k).drop("__h")


def stratified(df: DataFrame, stratum: str, key: str, k: int, seed: int | None = None) -> DataFrame:
    """Up to ``k`` rows of each stratum; small strata stay whole. The rank filter prunes before and after the shuffle."""
    order = Window.partitionBy(stratum).orderBy("__h", key)
    return df.withColumn("__h", hashed(key, seed)).withColumn("__rn", F.row_number().over(order)).filter(F.col("__rn") <= k).drop("__h", "__rn")


def first(df: DataFrame, order: list[str], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
