"""History of changing attributes (slowly changing versions with validity periods).

Consecutive snapshots of an entity are numbered; each snapshot's items are full-outer-joined, null-safe, with the items of the
snapshot before. An item only in the later one was inserted, only in the earlier one deleted, in both with another state changed.
The change events are unioned over all attributes and a version is valid until the next event of its item.

Defined results for odd input: rows without entity, item or position (``_seq``) are no observations; records delivered twice
count once; a null state is a state of its own; an empty table gives an empty history; other columns of the input are ignored.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from commitlake.operators.ordering import positions
from commitlake.session import cut, small

EVENT_COLUMNS = ["attr", "project_id", "item", "pos", "seq", "op", "state"]


def difference(snapshots: DataFrame, items: DataFrame | None, order: list[str]) -> DataFrame:
    """Change events between consecutive snapshots of each entity.

    ``snapshots``: entity columns ``attr, project_id, scope``, numeric ``order`` columns, ``seq`` unique per snapshot.
    ``items``: ``attr, project_id, scope, seq, item, state``; ``None`` if each snapshot row itself carries ``item`` and ``state``.
    """
    keys = ["attr", "project_id", "scope"]
    indexed = positions(snapshots, keys, order, "pos")
    if items is None:
        content = indexed.select(*keys, "item", "pos", "seq", "state")
        index = None
    else:
        index = indexed.select(*keys, "pos", "seq")
        content = items.join(index, [*keys, "seq"], "inner").select(*keys, "item", "pos", "seq", "state")
    on = [*keys, "item", "pos"]
    cur = content.withColumn("is_cur", F.lit(True))
    old = content.select(
        *[F.col(k).alias(f"o_{k}") for k in [*keys, "item"]], (F.col("pos") + 1).alias("o_pos"), F.col("state").alias("o_state"), F.lit(True).alias("is_old")
    )
    both = cur.join(old, reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"o_{k}")) for k in on]), "full_outer")
    op = (
        F.when(F.col("is_old").isNull(), "inserted")
        .when(F.col("is_cur").isNull(), "deleted")
        .when(~F.col("state").eqNullSafe(F.col("o_state")), "changed")
    )
    events = both.select(*[F.coalesce(k, f"o_{k}").alias(k) for k in on], "seq", op.alias("op"), "state").filter("op is not null")
    if index is None:  # one item per snapshot: an item missing from the next snapshot only means there is no next one
        return events.filter("op <> 'deleted'").select(*EVENT_COLUMNS)
    gone = events.filter("op = 'deleted'").drop("seq").join(index, [*keys, "pos"], "inner")
    return events.filter("op <> 'deleted'").select(*EVENT_COLUMNS).unionByName(gone.select(*EVENT_COLUMNS))


def versions(events: DataFrame) -> DataFrame:
    """Versions with the period they were valid: from ``from_seq`` until before ``to_seq`` (null: still valid).

    The lead is taken over event numbers that are computed block-wise, so one item with very many events stays distributed.
    """
    keys = ["attr", "project_id", "item"]
    numbered = positions(cut(events), keys, ["pos"], "n")
    following = numbered.select(*[F.col(k).alias(f"f_{k}") for k in keys], (F.col("n") - 1).alias("f_n"), F.col("seq").alias("to_seq"))
    cond = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"f_{k}")) for k in [*keys, "n"]])
    return (
        numbered.filter("op <> 'deleted'")
        .join(following, cond, "left")
        .select(*keys, F.col("seq").alias("from_seq"), "to_seq", "op", "state")
    )


def status_snapshots(updates: DataFrame) -> DataFrame:
    """One observation of the status per record: ``kind``, ``new_kind`` and ``error`` together, in order of ``time``, then ``_seq``."""
    return (
        updates.filter("project_id is not null and _seq is not null")
        .select(
            F.lit("status").alias("attr"), F.col("project_id").cast("long").alias("project_id"), F.lit("").alias("scope"), F.lit("").alias("item"),
            F.col("time").cast("long").alias("time"), F.col("_seq").cast("long").alias("seq"), status_state().alias("state"),
        )
        .dropDuplicates(["project_id", "seq"])
    )


def status_state():
    """The status as one comparable text; JSON keeps a null apart from any text."""
    return F.to_json(F.struct("kind", "new_kind", "error"), {"ignoreNullFields": "false"})


def heads_state():
    """A whole head map as one comparable text, independent of the order of its entries."""
    entries = F.transform(F.map_entries("heads"), lambda e: F.struct(e["key"].alias("k"), e["value"]["commit_id"].alias("c")))
    return F.to_json(F.array_sort(entries), {"ignoreNullFields": "false"})


def proper_keys(metadata_keys: DataFrame) -> DataFrame:
    """``metakey, value_type, norm``: ways of writing a key agree once case and all but letters and digits are gone."""
    return (
        metadata_keys.filter("metakey is not null")
        .select("metakey", "value_type", normal_key("metakey").alias("norm"))
        .groupBy("norm").agg(F.min_by("metakey", "metakey").alias("metakey"), F.min_by("value_type", "metakey").alias("value_type"))
    )


def normal_key(column: str):
    return F.regexp_replace(F.lower(F.col(column)), "[^a-z0-9]", "")


def metadata_snapshots(metadata: DataFrame, metadata_keys: DataFrame) -> DataFrame:
    """One observation of a proper key's value per record, over all ways of writing the key; other keys are no attributes."""
    return (
        metadata.filter("project_id is not null and _seq is not null and key is not null")
        .select(F.col("project_id").cast("long").alias("project_id"), F.col("_seq").cast("long").alias("seq"), "value", normal_key("key").alias("norm"))
        .join(small(proper_keys(metadata_keys)), "norm")
        .select(
            F.lit("metadata").alias("attr"), "project_id", F.col("metakey").alias("scope"), F.col("metakey").alias("item"),
            "seq", F.col("value").alias("state"),
        )
        .dropDuplicates(["project_id", "item", "seq"])
    )


def heads_snapshots(heads: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Snapshots and their branches; a null map is no snapshot, an empty one is a snapshot without branches."""
    snaps = (
        heads.filter("project_id is not null and _seq is not null and heads is not null")
        .select(F.col("project_id").cast("long").alias("project_id"), F.col("_seq").cast("long").alias("seq"), "heads")
        .withColumn("attr", F.lit("heads")).withColumn("scope", F.lit(""))
    )
    items = snaps.select("attr", "project_id", "scope", "seq", F.explode("heads").alias("item", "v")).select(
        "attr", "project_id", "scope", "seq", "item", F.col("v.commit_id").cast("string").alias("state")
    ).dropDuplicates(["project_id", "seq", "item"])
    return snaps.select("attr", "project_id", "scope", "seq").dropDuplicates(["project_id", "seq"]), items


def project_events(updates: DataFrame, heads: DataFrame, metadata: DataFrame, metadata_keys: DataFrame) -> DataFrame:
    """Change events of the status, every branch and every proper metadata key of all projects."""
    snaps, items = heads_snapshots(heads)
    return (
        difference(status_snapshots(updates), None, ["time", "seq"])
        .unionByName(difference(metadata_snapshots(metadata, metadata_keys), None, ["seq"]))
        .unionByName(difference(snaps, items, ["seq"]))
    )


def versions_started(events: DataFrame) -> DataFrame:
    """``attr, project_id, item, from_seq``: each version by the ``_seq`` of its first record."""
    return events.filter("op <> 'deleted'").select("attr", "project_id", "item", F.col("seq").alias("from_seq"))
