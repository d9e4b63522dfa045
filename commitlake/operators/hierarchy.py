"""Parent-child links of unknown depth: full paths, depth, root, descendants, and the nodes on circular links.

Nodes whose hashed id falls into one of ``SPLIT`` classes (and roots) are splitters, chosen without coordination and the same on
every run. Every node walks to its next splitter (a walk of about ``SPLIT`` links, by pointer doubling, whatever the depth of the
tree); the splitters with their next splitters form a reduced pointer graph, a ``SPLIT``-th of the size, which is solved by
doubling; exact paths are expanded from the segments. Walks that meet no splitter end in a circle and are handled separately.

Defined results: links of nodes never recorded and null parents are ignored; a node recorded again takes its last record; repeated
links count once; a node linking to itself is a circle of one; nodes on or leading into a circle have no root and a null path; an
empty table gives empty results; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from commitlake.session import cut, keep, small

SPLIT = 8
#: Equal-width stretches of the potential axis on which circles are localised; bounds the rows of the sweep.
STRETCHES = 16_384


def latest_links(commits: DataFrame, position: str = "_seq") -> DataFrame:
    """``id, parents, potential`` from the last record of each commit."""
    return (
        commits.filter("commit_id is not null")
        .select(F.col("commit_id").cast("long").alias("id"), F.struct(F.coalesce(F.col(position), F.lit(-1)).alias("at"), "parents", F.col("committer_time").cast("long").alias("potential")).alias("r"))
        .groupBy("id").agg(F.max_by("r", "r.at").alias("r"))
        .select("id", F.col("r.parents").alias("parents"), F.col("r.potential").alias("potential"))
    )


def splitter(node: str, level: int = 0, split: int = SPLIT) -> Column:
    return F.pmod(F.xxhash64(F.col(node), F.lit(level)), F.lit(split)) == 0


# --- forests: one parent per node -----------------------------------------------------------------------------------------


def first_parents(links: DataFrame) -> DataFrame:
    """``id, parent``: the first recorded parent of every node, null for roots."""
    recorded = links.select(F.col("id").alias("parent"))
    wanted = links.select("id", F.posexplode("parents").alias("at", "parent")).filter("parent is not null")
    chosen = wanted.join(recorded, "parent", "left_semi").groupBy("id").agg(F.min_by("parent", "at").alias("parent"))
    return links.select("id").join(chosen, "id", "left")


def forest(nodes: DataFrame, split: int = SPLIT) -> DataFrame:
    """``id, root, depth, path`` for every node of ``id, parent``; ``path`` runs from the root to the node itself."""
    start = cut(nodes.select("id", "parent").withColumn("stop", F.col("parent").isNull() | splitter("id", 0, split)))
    stops = start.filter("stop").select(F.col("id").alias("at"))
    # walk: seg holds the nodes passed after the node itself, at is the node reached
    walk = start.filter("parent is not null").select("id", F.col("parent").alias("at"), F.array("parent").alias("seg"))
    walk = cut(walk.join(stops.withColumn("done", F.lit(True)), "at", "left").select("id", "at", "seg", F.coalesce("done", F.lit(False)).alias("done")))
    left = walk.filter("not done").count()
    while left:
        step = walk.select(F.col("id").alias("at"), F.col("at").alias("at2"), F.col("seg").alias("seg2"), F.col("done").alias("done2"))
        step = step.filter(~splitter("at", 0, split))
        moving = walk.filter("not done").join(step, "at").select(
            "id", F.col("at2").alias("at"), F.concat("seg", "seg2").alias("seg"), F.col("done2").alias("done")
        )
        circling = F.array_contains(F.col("seg"), F.col("id")) | (F.size(F.array_distinct("seg")) < F.size("seg"))  # it met no splitter and came back
        moving = cut(moving.withColumn("lost", ~F.col("done") & circling))
        walk = walk.filter("done").unionByName(moving.filter("not lost").drop("lost"))
        left = moving.filter("not lost and not done").count()
        walk = cut(walk)
    # reduced pointer graph over the splitters: chain lists the splitters from the first one ahead to the last reached
    reduced = cut(
        start.filter("stop").select("id", "parent").join(walk.select("id", "at"), "id", "left")
        .filter("parent is null or at is not null")  # a splitter whose walk ended in a circle is neither root nor open
        .select("id", "at", F.when(F.col("at").isNotNull(), F.array("at")).otherwise(F.array().cast("array<bigint>")).alias("chain"))
    )
    solved = reduced.filter("at is null").select("id", F.col("id").alias("root"), "chain")
    open_ = reduced.filter("at is not null")
    while open_.limit(1).count():
        # one step: reached a solved splitter -> solved; else jump to where that splitter has got
        joined = open_.join(solved.select(F.col("id").alias("at"), "root", F.col("chain").alias("c2")), "at", "left")
        newly = joined.filter("root is not null").select("id", "root", F.concat("chain", "c2").alias("chain"))
        rest = joined.filter("root is null").select("id", "at", "chain")
        jump = open_.select(F.col("id").alias("at"), F.col("at").alias("at2"), F.col("chain").alias("c2"))
        rest = rest.join(jump, "at").select("id", F.col("at2").alias("at"), F.concat("chain", "c2").alias("chain"))
        rest = rest.filter(~F.array_contains("chain", F.col("id")) & (F.size(F.array_distinct("chain")) == F.size("chain")))  # a circle never reaches a root
        solved, open_ = cut(solved.unionByName(newly)), cut(rest)
    # exact expansion: node, its walk's segment, then the segments of the splitters on the chain
    segments = walk.select(F.col("id").alias("s"), "seg")
    pieces = solved.select("id", F.posexplode("chain").alias("k", "n")).select("id", (F.col("k") + 1).alias("k"), F.col("n").alias("s")).unionByName(
        solved.select("id", F.lit(0).alias("k"), F.col("id").alias("s"))
    )
    upward = (
        pieces.join(segments, "s")
        .groupBy("id").agg(F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "seg"))), lambda p: p["seg"])).alias("ups"))
    )
    of_splitter = solved.select("id", "root").join(upward, "id", "left").select(
        F.col("id").alias("at"), "root", F.coalesce("ups", F.array().cast("array<bigint>")).alias("ups")
    )
    own = start.select("id").join(walk.select("id", "at", "seg"), "id", "left")
    is_stop = start.filter("stop").select("id").withColumn("is_stop", F.lit(True))
    own = own.join(is_stop, "id", "left").select("id", F.when(F.col("is_stop"), F.col("id")).otherwise(F.col("at")).alias("at"), F.when(F.col("is_stop"), F.array().cast("array<bigint>")).otherwise(F.col("seg")).alias("seg"))
    out = own.join(of_splitter, "at", "left").select(
        "id", "root",
        F.when(F.col("root").isNotNull(), F.reverse(F.concat(F.array("id"), "seg", "ups"))).alias("path"),
    )
    return out.select("id", "root", (F.size("path") - 1).cast("long").alias("depth"), "path").withColumn("depth", F.when(F.col("root").isNotNull(), F.col("depth")))


def descendants(trees: DataFrame) -> DataFrame:
    """``id, descendant, distance``: every node with each node below it, read off the exact paths."""
    return trees.filter("root is not null").select(F.col("id").alias("descendant"), "depth", F.posexplode("path").alias("at", "id")).filter("id <> descendant").select(
        "id", "descendant", (F.col("depth") - F.col("at")).alias("distance")
    )


def hierarchy(nodes: DataFrame) -> DataFrame:
    """``id, root, depth, path, n_descendants`` of a forest."""
    trees = cut(forest(nodes))
    below = descendants(trees).groupBy("id").agg(F.count("*").alias("n_descendants"))
    return trees.join(below, "id", "left").withColumn("n_descendants", F.when(F.col("root").isNotNull(), F.coalesce("n_descendants", F.lit(0))))


# --- circles: any number of parents ---------------------------------------------------------------------------------------


def edges_of(links: DataFrame) -> DataFrame:
    """``a, b``: distinct links from a node to each of its recorded parents."""
    recorded = links.select(F.col("id").alias("b"))
    return links.select(F.col("id").alias("a"), F.explode("parents").alias("b")).filter("b is not null").distinct().join(recorded, "b", "left_semi").select("a", "b")


def localise(edges: DataFrame, links: DataFrame) -> DataFrame:
    """Exact pruning: only the links that can lie on a circle.

    Going round a circle the potential (commit time) cannot fall at every link, and each stretch of the axis a circle spans is crossed
    by one of its rising links, whatever number each node has. So a circle lies within one maximal stretch covered by rising links. A
    node without a number takes the highest one around it, which keeps its links short. The sweep runs over at most ``2 * STRETCHES``
    rows, whatever the input.
    """
    at = links.select("id", "potential")
    span = at.agg(F.min("potential").alias("lo"), F.max("potential").alias("hi"), F.count(F.when(F.col("potential").isNull(), 1)).alias("unknown")).first()
    if span["lo"] is None:
        return edges
    if span["unknown"]:
        ends = edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).join(at.filter("potential is null").select(F.col("id").alias("a")), "a", "left_semi")
        around = ends.join(at.filter("potential is not null").select(F.col("id").alias("b"), "potential"), "b").groupBy(F.col("a").alias("id")).agg(F.max("potential").alias("near"))
        at = cut(at.join(around, "id", "left").select("id", F.coalesce("potential", "near", F.lit(span["lo"])).alias("potential")))
    width = max(1, (span["hi"] - span["lo"]) // STRETCHES + 1)
    placed = at.select("id", F.floor((F.col("potential") - F.lit(span["lo"])) / F.lit(width)).cast("int").alias("s"), "potential")
    e = edges.join(placed.select(F.col("id").alias("a"), F.col("s").alias("sa"), F.col("potential").alias("pa")), "a")
    e = e.join(placed.select(F.col("id").alias("b"), F.col("s").alias("sb"), F.col("potential").alias("pb")), "b")
    e = cut(e.select("a", "b", "sa", "sb", (F.col("pb") >= F.col("pa")).alias("rising")))
    rising = e.filter("rising")
    sweep = rising.select(F.col("sa").alias("s"), F.lit(1).alias("d")).unionByName(rising.select((F.col("sb") + 1).alias("s"), F.lit(-1).alias("d")))
    steps = sweep.groupBy("s").agg(F.sum("d").alias("d"))
    over = Window.orderBy("s").rowsBetween(Window.unboundedPreceding, 0)
    level = steps.withColumn("open", F.sum("d").over(over)).withColumn("to_s", F.lead("s").over(Window.orderBy("s"))).withColumn("before", F.lag("open").over(Window.orderBy("s")))
    run = level.withColumn("run", F.sum(F.when(F.coalesce("before", F.lit(0)) == 0, 1).otherwise(0)).over(over)).filter("open > 0")
    stretch = F.broadcast(run.select(F.explode(F.sequence("s", F.col("to_s") - 1)).alias("s"), "run"))  # at most STRETCHES rows
    inside = e.join(stretch.select(F.col("s").alias("sa"), F.col("run").alias("ra")), "sa").join(stretch.select(F.col("s").alias("sb"), F.col("run").alias("rb")), "sb")
    return inside.filter("ra = rb").select("a", "b")


def trim(edges: DataFrame) -> DataFrame:
    """Drop links whose start nothing leads to or whose end leads nowhere: they lie on no circle."""
    edges = edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi")
    edges = edges.join(edges.select(F.col("a").alias("b")).distinct(), "b", "left_semi").select("a", "b")
    return keep(edges)


def _walks(edges: DataFrame, level: int, split: int) -> DataFrame:
    """All ``a, b`` such that a walk from ``a`` reaches ``b`` meeting no splitter in between (doubling to the fixed point)."""
    pairs = keep(edges.distinct())
    size = pairs.count()
    while True:
        onward = pairs.filter(~splitter("b", level, split))
        further = onward.select("a", F.col("b").alias("m")).join(pairs.select(F.col("a").alias("m"), "b"), "m").select("a", "b")
        pairs = keep(pairs.unionByName(further).distinct())
        grown = pairs.count()
        if grown == size:
            return pairs
        size = grown


def circles(edges: DataFrame, level: int = 0, split: int = SPLIT) -> DataFrame:
    """``id, comp``: the nodes from which the links lead back to themselves, ``comp`` equal within a strongly connected class.

    The reduced graph over splitters is solved by the same function, with splitters drawn anew. A node between splitters belongs to the
    class of a splitter that reaches it and that it reaches; classes without any splitter are read off the mutual walks.
    """
    pairs = _walks(trim(edges), level, split)
    s_a, s_b = splitter("a", level, split), splitter("b", level, split)
    reduced = keep(pairs.filter(s_a & s_b))
    of_splitter = reduced.filter("a = b").select(F.col("a").alias("id"), F.col("a").alias("comp"))
    if reduced.filter("a <> b").limit(1).count():
        deeper = circles(reduced.filter("a <> b"), level + 1, split)
        of_splitter = keep(deeper.unionByName(of_splitter.join(deeper, "id", "left_anti")))
    ahead = pairs.filter(~s_a & s_b).join(of_splitter.withColumnRenamed("id", "b"), "b").select(F.col("a").alias("id"), "comp")
    behind = pairs.filter(s_a & ~s_b).join(of_splitter.withColumnRenamed("id", "a"), "a").select(F.col("b").alias("id"), "comp")
    between = ahead.distinct().join(behind.distinct(), ["id", "comp"], "left_semi")
    found = of_splitter.unionByName(between)
    mutual = pairs.filter(~s_a & ~s_b)
    mutual = mutual.join(mutual.select(F.col("b").alias("a"), F.col("a").alias("b")), ["a", "b"], "left_semi")
    splitterless = mutual.groupBy("a").agg(F.min("b").alias("comp")).withColumnRenamed("a", "id")
    return keep(found.unionByName(splitterless.join(found, "id", "left_anti")))


def circular_nodes(links: DataFrame) -> DataFrame:
    """``cycle_min, id``: every node on a circle, with the smallest id of its strongly connected class."""
    found = circles(localise(edges_of(links), links))
    least = found.groupBy("comp").agg(F.min("id").alias("cycle_min"))
    return found.join(least, "comp").select("cycle_min", "id")
