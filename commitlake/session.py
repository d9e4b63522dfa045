"""Session helpers: shared checkpoint folder, lineage cuts, size-checked broadcasts, null-safe joins."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows up to which a side may be broadcast once it has been counted.
BROADCAST_ROWS = 20_000


def checkpoint_dir(spark: SparkSession) -> str:
    """The folder all executors share, from ``spark.checkpoint.dir``. Where none is set, a local master gets one below its working folder;
    on a cluster that is an error, as a machine's own folder would not survive the machine."""
    sc = spark.sparkContext
    current = sc._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = sc.getConf().get("spark.checkpoint.dir", None)
    master = sc.master or ""
    if not folder and (not master.startswith("local") or master.startswith("local-cluster")):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    sc.setCheckpointDir(folder or f"/tmp/commitlake-{sc.applicationId}")
    return sc._jsc.sc().getCheckpointDir().get()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared folder and continue from there: survives lost executors and ends the lineage."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def keep(df: DataFrame) -> DataFrame:
    """Like ``cut``, as a table in the shared folder. Its size is then known; over the rounds of a loop, checkpoints only multiply estimates."""
    path = f"{checkpoint_dir(df.sparkSession)}/table-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if it was counted to hold at most ``rows`` rows, else unchanged (shuffle join)."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def bounded_collect(df: DataFrame, rows: int) -> list:
    """Collect a table that must be small by design; raises instead of pulling an unbounded one to the driver."""
    got = df.limit(rows + 1).collect()
    if len(got) > rows:
        raise ValueError(f"expected at most {rows} rows")
    return got


def join_null_safe(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner") -> DataFrame:
    """Equi-join treating nulls as equal; keeps one copy of the key columns (of the side that has the row)."""
    r = right.withColumnsRenamed({c: f"__r_{c}" for c in on})
    cond = reduce(lambda a, b: a & b, [left[c].eqNullSafe(r[f"__r_{c}"]) for c in on])
    out = left.join(r, cond, how)
    if how in ("left_semi", "left_anti"):
        return out
    if how in ("full_outer", "full", "outer", "right", "right_outer"):
        out = out.withColumns({c: F.coalesce(F.col(c), F.col(f"__r_{c}")) for c in on})
    return out.drop(*[f"__r_{c}" for c in on])


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
