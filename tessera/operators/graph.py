"""Walks over the dependency graph."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera import constants as C


def oriented(edges: DataFrame, direction: str, relations: Sequence[str] | None = None) -> DataFrame:
    """(from, to, relation, weight) in walking direction; without a list of relations all but mentions count."""
    if direction not in ("downstream", "upstream"):
        raise ValueError(f"unknown direction {direction!r}")
    rows = edges.filter(F.col("relation").isin(*relations)) if relations else edges.filter(F.col("relation") != "mentions")
    a, b = ("source_id", "target_id") if direction == "downstream" else ("target_id", "source_id")
    return rows.select(F.col(a).alias("src"), F.col(b).alias("dst"), "relation", F.col("weight").cast("double").alias("weight"))


def walk(edges: DataFrame, starts: DataFrame, direction: str = "downstream", max_depth: int = 3, relations: Sequence[str] | None = None) -> DataFrame:
    """All simple paths of up to max_depth edges from the nodes in starts (node_id): start, node_id, depth, weight, relation.

    One join per depth; the visited nodes travel with a path and stop cycles. The number of simple paths can grow fast in
    dense graphs; depth is bounded for that reason.
    """
    if not 1 <= max_depth <= C.GRAPH_DEPTH_MAX:
        raise ValueError(f"depth must be 1 to {C.GRAPH_DEPTH_MAX}")
    steps = oriented(edges, direction, relations)
    front = starts.select(F.col("node_id").alias("start"), "node_id", F.lit(0).alias("depth"), F.lit(0.0).alias("weight"), F.lit(None).cast("string").alias("relation"), F.array("node_id").alias("seen"))
    found = None
    for depth in range(1, max_depth + 1):
        joined = front.alias("f").join(steps.alias("s"), F.col("f.node_id") == F.col("s.src")).filter(~F.array_contains("seen", F.col("dst")))
        front = joined.select("start", F.col("dst").alias("node_id"), F.lit(depth).alias("depth"), (F.col("f.weight") + F.col("s.weight")).alias("weight"), F.col("s.relation").alias("relation"), F.array_append("seen", F.col("dst")).alias("seen"))
        found = front if found is None else found.unionAll(front)
    return found.drop("seen")


def reached(edges: DataFrame, starts: DataFrame, direction: str = "downstream", max_depth: int = 3, relations: Sequence[str] | None = None) -> DataFrame:
    """start, node_id, depth, total_weight, via: shortest depth, greatest weight of any walk, relations of shortest walks."""
    paths = walk(edges, starts, direction, max_depth, relations)
    by_depth = paths.groupBy("start", "node_id", "depth").agg(F.max("weight").alias("weight"), F.array_join(F.sort_array(F.collect_set("relation")), ",").alias("via"))
    best = by_depth.groupBy("start", "node_id").agg(F.min("depth").alias("depth"), F.max("weight").alias("total_weight"), F.min_by("via", "depth").alias("via"))
    return best.select("start", "node_id", F.col("depth").cast("long").alias("depth"), F.round("total_weight", 4).alias("total_weight"), "via")


def graph_query(edges: DataFrame, nodes: DataFrame, start: str, direction: str = "downstream", max_depth: int = 3, relations: Sequence[str] | None = None, limit: int = 50) -> DataFrame:
    """Reached nodes with their attributes, nearest and heaviest first; an unknown start reaches nothing."""
    starts = edges.sparkSession.createDataFrame([(start,)], "node_id string")
    rows = reached(edges, starts, direction, max_depth, relations).join(nodes.select("node_id", "kind", "label"), "node_id", "left")
    return rows.orderBy(F.asc("depth"), F.desc("total_weight"), F.asc("node_id")).limit(limit)


def resolve(nodes: DataFrame, needle: str, limit: int = 10) -> DataFrame:
    """Nodes whose id or label holds the text, exact ones first, then by degree."""
    n = needle.lower()
    low = lambda c: F.lower(F.col(c))
    rows = nodes.filter((F.instr(low("node_id"), n) > 0) | (F.instr(low("label"), n) > 0))
    exact = ((low("node_id") == n) | (low("label") == n)).cast("int")
    degree = F.col("in_degree") + F.col("out_degree")
    return rows.withColumns({"exact": exact, "degree": degree}).orderBy(F.desc("exact"), F.desc("degree"), F.asc("node_id")).limit(limit)


def touching(edges: DataFrame, ids: DataFrame) -> DataFrame:
    """Edges with an end among ids (node_id)."""
    key = ["source_id", "target_id", "relation"]
    by = lambda c: edges.join(ids.select(F.col("node_id").alias(c)), c, "left_semi").select(*edges.columns)
    return by("source_id").unionAll(by("target_id")).dropDuplicates(key)


def dedup_edges(edges: DataFrame) -> DataFrame:
    """One edge for each (source, target, relation): the first in the order of the remaining columns."""
    from tessera.operators.layers import first_by

    key = ["source_id", "target_id", "relation"]
    return first_by(edges, key, [F.asc_nulls_last(c) for c in edges.columns if c not in key])


def connected_only(nodes: DataFrame, edges: DataFrame, hidden: Sequence[str] = ("symbol", "module")) -> tuple[DataFrame, DataFrame]:
    """What a viewer shows: no nodes of hidden kinds, no edges left dangling, no nodes without an edge."""
    shown = nodes.filter(~F.col("kind").isin(*hidden))
    ids = shown.select("node_id")
    kept = edges.join(ids.withColumnRenamed("node_id", "source_id"), "source_id", "left_semi").join(ids.withColumnRenamed("node_id", "target_id"), "target_id", "left_semi")
    ends = kept.select(F.col("source_id").alias("node_id")).union(kept.select("target_id")).distinct()
    return shown.join(ends, "node_id", "left_semi"), kept


def change_signature(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    return nodes.agg(F.count("*").alias("nodes")).join(F.broadcast(edges.agg(F.count("*").alias("edges"))))


def hubs(nodes: DataFrame, n: int = 6) -> DataFrame:
    return nodes.withColumn("degree", F.col("in_degree") + F.col("out_degree")).orderBy(F.desc("degree"), F.asc("node_id")).limit(n)


def layout_step(nodes: DataFrame, edges: DataFrame, alpha: float = 1.0) -> DataFrame:
    """One step of a force layout of a drawing's (few) nodes (node_id, x, y, vx, vy): repulsion, springs, gravity, damping."""
    a, b = nodes.alias("a"), nodes.alias("b")
    dx, dy = F.col("a.x") - F.col("b.x"), F.col("a.y") - F.col("b.y")
    d2 = F.greatest(dx * dx + dy * dy, F.lit(1.0))
    push = a.join(b, F.col("a.node_id") != F.col("b.node_id")).groupBy(F.col("a.node_id").alias("node_id")).agg(F.sum(dx / F.sqrt(d2) * 2600 / d2).alias("px"), F.sum(dy / F.sqrt(d2) * 2600 / d2).alias("py"))
    both = edges.select(F.col("source_id").alias("n"), F.col("target_id").alias("m"), "weight").unionAll(edges.select("target_id", "source_id", "weight"))
    pair = both.join(nodes.alias("p"), F.col("n") == F.col("p.node_id")).join(nodes.alias("q"), F.col("m") == F.col("q.node_id"))
    ex, ey = F.col("q.x") - F.col("p.x"), F.col("q.y") - F.col("p.y")
    dist = F.greatest(F.sqrt(ex * ex + ey * ey), F.lit(1.0))
    pull = (dist - (74 + (1 - F.col("weight")) * 70)) / dist * 0.04
    springs = pair.groupBy(F.col("n").alias("node_id")).agg(F.sum(ex * pull).alias("sx"), F.sum(ey * pull).alias("sy"))
    rows = nodes.join(push, "node_id", "left").join(springs, "node_id", "left").fillna(0.0)
    v = lambda p, s, x, vx: (F.col(vx) + alpha * (F.col(p) + F.col(s) - 0.012 * F.col(x))) * 0.86
    moved = rows.withColumns({"vx": v("px", "sx", "x", "vx"), "vy": v("py", "sy", "y", "vy")})
    return moved.select("node_id", (F.col("x") + F.col("vx")).alias("x"), (F.col("y") + F.col("vy")).alias("y"), "vx", "vy")
