"""Web-graph measures over an edge table ``src, dst``; repeated edges are kept."""

from __future__ import annotations

from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomwork.operators.skew import (
    SALT,
    SALT_ROWS,
    attach,
    hot_keys,
    repeated,
    salted,
    typed,
)
from loomwork.shared import cut_lineage, release

# Neighbours in one row of the adjacency index.
SEGMENT_NEIGHBOURS = 10_000
# Rounds of an iteration planned as one job, between two lineage cuts.
ROUNDS_PER_CUT = 2
# Rows of a partition of the layouts that stay in place over all rounds.
PARTITION_ROWS = 500_000
MIN_PARTITIONS = 8


def _complete(edges: DataFrame) -> DataFrame:
    return edges.select("src", "dst").dropna()


def _weighted(edges: DataFrame) -> DataFrame:
    """Each distinct edge with how often it occurs."""
    return _complete(edges).groupBy("src", "dst").agg(F.count(F.lit(1)).alias("edges"))


def out_degree(edges: DataFrame) -> DataFrame:
    """Nodes by their number of distinct targets."""
    degrees = _complete(edges).groupBy("src").agg(F.count_distinct("dst").alias("out_degree"))
    return degrees.select(F.col("src").alias("node"), "out_degree").orderBy(
        F.desc("out_degree"), "node"
    )


def in_degree(edges: DataFrame) -> DataFrame:
    """Nodes by their number of distinct sources."""
    degrees = _complete(edges).groupBy("dst").agg(F.count_distinct("src").alias("in_degree"))
    return degrees.select(F.col("dst").alias("node"), "in_degree").orderBy(
        F.desc("in_degree"), "node"
    )


# Two to this power registers in a sketch of distinct neighbours: a standard error of
# 0.0104 on large counts. Counts of up to about a hundred and fifty are exact.
SKETCH_SIZE = 12


def degree_sketches(edges: DataFrame, node: str = "dst", size: int = SKETCH_SIZE) -> DataFrame:
    """``node, sketch``: a mergeable sketch of each node's distinct neighbours.

    With ``node="src"`` of its targets, with ``"dst"`` of its sources. Sketches of a node are
    made in the map tasks, so a hub sends one per task and not its edges. They are stored
    like any column, and new edges need only sketches of their own.
    """
    other = {"src": "dst", "dst": "src"}[node]
    made = _complete(edges).groupBy(F.col(node).alias("node"))
    return made.agg(F.hll_sketch_agg(other, size).alias("sketch"))


def merged_sketches(*sketches: DataFrame) -> DataFrame:
    """``node, sketch`` of all edges that went into any of the given sketches of one size."""
    every = reduce(DataFrame.unionByName, sketches)
    return every.groupBy("node").agg(F.hll_union_agg("sketch").alias("sketch"))


def sketched_degrees(sketches: DataFrame) -> DataFrame:
    """``node, degree``: about how many distinct neighbours each node has, most first."""
    return sketches.select("node", F.hll_sketch_estimate("sketch").alias("degree")).orderBy(F.desc("degree"), "node")


def _lists(
    weighted: DataFrame, node: str, neighbour: str, per_row: int, salt_rows: int
) -> DataFrame:
    totals = weighted.groupBy(node).agg(
        F.sum("edges").alias("_total"), F.count(F.lit(1)).alias("_rows")
    )
    parts = totals.withColumn("_parts", F.ceil(F.col("_total") / per_row).cast("int"))
    with_parts = attach(
        weighted, parts, [node], [neighbour], rows="_rows", salt_rows=salt_rows
    )
    # an edge repeated more often than a row holds goes to several rows as well
    pieces = with_parts.withColumn(
        "_piece", F.explode(F.sequence(F.lit(0), F.ceil(F.col("edges") / per_row).cast("int") - 1))
    ).withColumn(
        "_copies", F.least(F.lit(per_row), F.col("edges") - F.col("_piece") * per_row).cast("int")
    )
    return (
        pieces.withColumn("segment", F.pmod(F.xxhash64(neighbour, "_piece"), F.col("_parts")))
        .groupBy(F.col(node).alias("node"), F.col("segment").cast("int").alias("segment"))
        .agg(
            F.sort_array(
                F.flatten(F.collect_list(F.array_repeat(F.col(neighbour), F.col("_copies"))))
            ).alias("neighbours")
        )
    )


def adjacency(
    edges: DataFrame,
    per_row: int = SEGMENT_NEIGHBOURS,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """The lists of targets (``out``) and sources (``in``) of every node.

    A node with up to ``per_row`` edges has one row per direction, segment 0.
    The list of a larger node is cut into segments of about that size, so that no
    task and no row holds a hub's whole list; together the segments are the list.
    """
    weighted = _weighted(edges)
    out = _lists(weighted, "src", "dst", per_row, salt_rows)
    into = _lists(weighted, "dst", "src", per_row, salt_rows)
    return out.select("node", F.lit("out").alias("direction"), "segment", "neighbours").unionByName(
        into.select("node", F.lit("in").alias("direction"), "segment", "neighbours")
    )


def neighbors(edges: DataFrame, node) -> DataFrame:
    """The targets and sources of one node, one row each with the number of edges.

    An unknown node gives no rows.
    """
    rows = _complete(edges)
    out = rows.where(F.col("src") == typed(edges, "src", node)).select(
        F.lit("out").alias("direction"), F.col("dst").alias("neighbour")
    )
    into = rows.where(F.col("dst") == typed(edges, "dst", node)).select(
        F.lit("in").alias("direction"), F.col("src").alias("neighbour")
    )
    return (
        out.unionAll(into)
        .groupBy("direction", "neighbour")
        .agg(F.count(F.lit(1)).alias("edges"))
        .orderBy("direction", "neighbour")
    )


def nodes(edges: DataFrame) -> DataFrame:
    """All nodes at either end of an edge."""
    rows = _complete(edges)
    return (
        rows.select(F.col("src").alias("id"))
        .unionAll(rows.select(F.col("dst").alias("id")))
        .distinct()
    )


def _partitions(rows: int) -> int:
    return max(MIN_PARTITIONS, -(-rows // PARTITION_ROWS))


def _laid_out(df: DataFrame, rows: int, *keys: str) -> DataFrame:
    """``df``, of about ``rows`` rows, kept by ``keys``, so that all rounds find it in place.

    Blocks that are lost with an executor are computed again. The count fills the
    cache: before that, adaptive execution has not settled the layout, and the first
    rounds would be planned with another shuffle.
    """
    placed = df.repartition(_partitions(rows), *keys).sortWithinPartitions(*keys)
    kept = placed.persist(StorageLevel.MEMORY_AND_DISK)
    kept.count()
    return kept


def _sent(layout: DataFrame, end: str, values: DataFrame, hot: DataFrame, to: str) -> DataFrame:
    """What each node receives when ``values`` (``id, value``) go along the edges.

    Nodes that receive nothing have no row.
    """
    keyed = values.select(F.col("id").alias(end), "value")
    return (
        layout.join(repeated(keyed, [end], hot), [end, SALT])
        .groupBy(F.col(to).alias("id"))
        .agg(F.sum(F.col("weight") * F.col("value")).alias("value"))
    )


def _everywhere(vertices: DataFrame, values: DataFrame, name: str) -> DataFrame:
    """``vertices`` with the values as column ``name``, 0 where there is none."""
    value = F.coalesce("value", F.lit(0.0)).alias(name)
    return vertices.join(values, "id", "left").select(*vertices.columns, value)


def pagerank(
    edges: DataFrame,
    damping: float = 0.85,
    iters: int = 10,
    salt_rows: int = SALT_ROWS,
) -> DataFrame:
    """PageRank after ``iters`` rounds: ``id, rank``.

    Repeated edges count. A node without out-edges passes nothing on, so its mass
    leaves the graph; a node without in-edges has (1 - damping) / N.

    A node without in-edges has the same rank in all rounds after the first, so what
    its edges carry is summed once per target. The other edges are laid out once by
    source, with hot sources split over salts, and are not shuffled again; a round
    moves one value per node with in-edges and salt, and the partial sums per target.
    """
    weighted = cut_lineage(_weighted(edges))
    targets = cut_lineage(weighted.select(F.col("dst").alias("id")).distinct())
    totals = weighted.groupBy("src").agg(
        F.sum("edges").alias("_total"), F.count(F.lit(1)).alias("_rows")
    )
    moves = targets.select(F.col("id").alias("src"), F.lit(True).alias("_moves"))
    sources = cut_lineage(totals.join(moves, "src", "left"))
    hot = cut_lineage(hot_keys(sources, ["src"], "_rows", salt_rows))
    shares = cut_lineage(
        salted(weighted, ["src"], hot, ["dst"])
        .join(repeated(sources.select("src", "_total", "_moves"), ["src"], hot), ["src", SALT])
        .select("src", SALT, "dst", (F.col("edges") / F.col("_total")).alias("weight"), "_moves")
    )
    moving = shares.where("_moves").drop("_moves")
    by_src = _laid_out(moving, moving.count(), "src", SALT)
    still = (
        shares.where("_moves IS NULL").groupBy(F.col("dst").alias("id")).agg(F.sum("weight").alias("value"))
    )
    reached = targets.count()
    vertices = _laid_out(_everywhere(targets, still, "_still"), reached, "id")
    others = sources.where("_moves IS NULL").select(F.col("src").alias("id"))
    size = reached + others.count()

    base = (1.0 - damping) / max(size, 1)
    # ``of_others``: the rank of every node without in-edges
    of_others, kept = 1.0 / max(size, 1), None
    state = vertices.select("id", F.lit(of_others).alias("value"))
    for done in range(1, iters + 1):
        received = _everywhere(vertices, _sent(by_src, "src", state, hot, "dst"), "_received")
        carried = F.col("_received") + F.col("_still") * of_others
        state, of_others = received.select("id", (F.lit(base) + F.lit(damping) * carried).alias("value")), base
        if done == iters:
            state = state.unionByName(others.withColumn("value", F.lit(of_others)))
        if done % ROUNDS_PER_CUT == 0 or done == iters:
            state, before = cut_lineage(state), kept
            kept = state
            release(*[before] if before is not None else [])
    for layout in (by_src, vertices):
        layout.unpersist()
    release(weighted, targets, sources, hot, shares)
    return state.withColumnRenamed("value", "rank")


def _unit(df: DataFrame, value: str) -> Column:
    """The column divided by its L2 norm; all zero if the norm is."""
    norm = df.select(F.sqrt(F.sum(F.col(value) * F.col(value)))).scalar()
    return F.coalesce(F.try_divide(F.col(value), norm), F.lit(0.0)).alias(value)


def hits(edges: DataFrame, iters: int = 10, salt_rows: int = SALT_ROWS) -> DataFrame:
    """Hub and authority scores after ``iters`` rounds: ``id, hub, auth``, unit L2 norm, best authorities first.

    The hub step uses the round's new authorities. Both steps are linear, so the
    vectors come out the same whether they are divided by their norms after each
    step or only before each lineage cut; in between they stay far from overflow.
    """
    weighted = cut_lineage(_weighted(edges).withColumnRenamed("edges", "weight"))
    pairs = weighted.count()
    hot, layouts, counts = {}, {}, {}
    for end, other in (("src", "dst"), ("dst", "src")):
        counts[end] = cut_lineage(weighted.groupBy(end).agg(F.count(F.lit(1)).alias("_rows")))
        hot[end] = cut_lineage(hot_keys(counts[end], [end], "_rows", salt_rows))
        layouts[end] = _laid_out(salted(weighted, [end], hot[end], [other]), pairs, end, SALT)
    ends = [counts[end].select(F.col(end).alias("id")) for end in ("src", "dst")]
    vertices = ends[0].unionAll(ends[1]).distinct()

    # nodes without out-edges have no hub in any round: nobody asks for theirs
    hub = ends[0].withColumn("value", F.lit(1.0))
    state = vertices.select("id", F.lit(1.0).alias("hub"), F.lit(1.0).alias("auth"))
    kept = None
    for done in range(1, iters + 1):
        auth = _sent(layouts["src"], "src", hub, hot["src"], "dst")
        if done < iters:
            hub = _sent(layouts["dst"], "dst", auth, hot["dst"], "src")
            if done % ROUNDS_PER_CUT == 0:
                hub, before = cut_lineage(hub), kept
                kept = hub
                release(*[before] if before is not None else [])
                hub = hub.select("id", _unit(hub, "value"))
        else:
            # the hub step needs the authorities as well: written once, read by both
            met = cut_lineage(auth)
            hub = _sent(layouts["dst"], "dst", met, hot["dst"], "src")
            raw = cut_lineage(_everywhere(_everywhere(vertices, met, "auth"), hub, "hub"))
            release(met, *[kept] if kept is not None else [])
            state = raw.select("id", _unit(raw, "hub"), _unit(raw, "auth"))
    for layout in layouts.values():
        layout.unpersist()
    release(weighted, *hot.values(), *counts.values())
    return state.orderBy(F.desc("auth"), "id")
