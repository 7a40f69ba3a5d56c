"""Connected components of an edge table, by contraction.

Each round, every node points to the smallest node among itself and its neighbours. Pointers lead to
ever smaller nodes, so they form trees; doubling them (each node takes over the pointer of the node
it points to) flattens a tree of any depth in a logarithmic number of joins. Then the edges between
different trees are kept, as edges between their roots, and the next round works on those. Every
round at least halves the number of trees of each component that has an edge left.

Minima are combined before the shuffle, so a node with many neighbours sends one row per task. Every
join is between written tables, so that adaptive execution can split a hot node. Nothing but counts
reaches the driver, and each step is a table in the shared folder, so a lost executor costs the tasks
it ran, not the rounds before.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pledgeline.llm.common import stored


def components(edges: DataFrame, folder: str, name: str = "components") -> DataFrame:
    """``node`` and ``root`` (the smallest node of its component) for each node of ``src, dst``.

    Nodes may be of any type with an order. Edges with a null end and loops are ignored; a node that
    has no other edge is not in the result.
    """
    count = 0

    def kept(df: DataFrame) -> DataFrame:
        nonlocal count
        count += 1
        return stored(df, folder, f"{name}-{count}")

    edges = kept(edges.filter("src <> dst").select("src", "dst").distinct())
    roots = None
    while not edges.isEmpty():
        both = edges.union(edges.select("dst", "src"))
        parents = kept(
            both.groupBy(F.col("src").alias("node")).agg(F.min("dst").alias("least")).select(
                "node", F.least("node", "least").alias("root")
            )
        )
        while True:
            above = parents.select(F.col("node").alias("root"), F.col("root").alias("next"))
            parents = kept(
                parents.join(above, "root").select(
                    "node", F.col("next").alias("root"), (F.col("next") != F.col("root")).alias("moved")
                )
            )
            if parents.filter("moved").isEmpty():
                break
            parents = parents.drop("moved")
        parents = parents.drop("moved")
        if roots is None:
            roots = parents
        else:
            higher = parents.select(F.col("node").alias("root"), F.col("root").alias("higher"))
            roots = kept(
                roots.join(higher, "root", "left").select(
                    "node", F.coalesce("higher", "root").alias("root")
                )
            )
        from_src = parents.select(F.col("node").alias("src"), F.col("root").alias("a"))
        from_dst = parents.select(F.col("node").alias("dst"), F.col("root").alias("b"))
        edges = kept(
            edges.join(from_src, "src")
            .join(from_dst, "dst")
            .filter("a <> b")
            .select(F.least("a", "b").alias("src"), F.greatest("a", "b").alias("dst"))
            .distinct()
        )
    if roots is None:
        return edges.select(F.col("src").alias("node"), F.col("dst").alias("root"))
    return roots
