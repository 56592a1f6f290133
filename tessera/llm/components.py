"""Connected components of a table of links by alternating star contractions.

Defined cases: links of a node to itself, repeated links and links given in both directions change nothing; links with a null
end are dropped; without links no node appears; nodes may be numbers or structs of numbers.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import drop_staged, staged


def star(edges: DataFrame, large: bool, scratch: list[DataFrame]) -> DataFrame:
    """One contraction: hang larger neighbours (or the smaller ones and the node itself) on the smallest neighbour.

    The smallest neighbours are stored before they are joined: both sides of the join are then plain exchanges, which
    adaptive execution can split where one centre holds very many links.
    """
    if large:
        rows = edges.select("a", "b").unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = rows.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        rows = rows.filter("b > a")
    else:
        rows = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b")
        least = rows.groupBy("a").agg(F.min("b").alias("m"))
    least = staged(least, "least-neighbours")
    scratch.append(least)
    hung = rows.join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return hung if large else hung.unionAll(least.select("a", F.col("m").alias("b")))


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): root is the smallest node of the component. Nodes without links do not appear."""
    mark = F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h")
    now = staged(edges.select(F.greatest(a, b).alias("a"), F.least(a, b).alias("b")).filter("a <> b").distinct(), "links")
    before = None
    while True:
        state = now.agg(mark, F.count("*").alias("n")).first()
        if state == before or not state["n"]:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root")).unionAll(now.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
        before, scratch = state, [now]
        now = staged(star(star(now, True, scratch), False, scratch).filter("a <> b").distinct(), "links")
        for done in scratch:
            drop_staged(done)
