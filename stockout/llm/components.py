"""Connected components of an edge table, by repeated contraction.

In each round every node points to its smallest neighbour (or itself), pointers are followed
two, four, eight, ... steps, and edges are rewritten to where their ends point. A component's
edges stay connected under any such rewriting and its smallest node always points to itself, so
the graph shrinks until each component is that node. Following more steps each round makes long
chains fall as fast as dense groups. Only tables are kept between rounds; the driver sees one
count per round.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stockout.stage import write_stage


def connected_components(edges: DataFrame) -> DataFrame:
    """Rows (node, component): for every node that has an edge, the smallest node that it
    reaches. ``edges`` has long columns a and b; direction, repeats and loops do not matter,
    nulls do not link."""
    edges = (edges.where(F.col("a") != F.col("b"))
             .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    edges = write_stage(edges, "component_edges")
    whole = None
    hops = 1
    while True:
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        to = both.groupBy("a").agg(F.least("a", F.min("b")).alias("to")).withColumnRenamed("a", "node")
        to = write_stage(to, "component_pointers")
        for _ in range(hops):
            step = to.select(F.col("node").alias("to"), F.col("to").alias("next"))
            to = to.join(step, "to").select("node", F.col("next").alias("to"))
        to = write_stage(to, "component_pointers")
        if whole is None:
            whole = to.withColumnRenamed("to", "component")
        else:
            moved = to.select(F.col("node").alias("component"), "to")
            whole = (whole.join(moved, "component", "left")
                     .select("node", F.coalesce("to", "component").alias("component")))
        ends = (edges.join(to.select(F.col("node").alias("a"), F.col("to").alias("x")), "a")
                .join(to.select(F.col("node").alias("b"), F.col("to").alias("y")), "b")
                .where(F.col("x") != F.col("y")))
        edges = write_stage(ends.select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b")).distinct(),
                            "component_edges")
        if edges.isEmpty():
            return whole
        hops += 1
