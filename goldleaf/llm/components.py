"""Connected components of a link table, by contraction.

Each round every vertex points at its smallest neighbour (or itself), the
pointers are followed to their roots by doubling, and the links are rewritten
between roots; loops and repeats fall away. Each round at least halves the
vertices that still have links, so rounds grow with the logarithm. Minima
aggregate before the shuffle, so a vertex with very many links costs one row
per task. Every round ends in written tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldleaf.llm.common import saved


def components(links: DataFrame) -> DataFrame:
    """``links`` has columns a, b (equal types, any direction, repeats and
    loops allowed; a null end is no link). Returns (id, component): every
    vertex of a link with the smallest vertex it reaches."""
    edges = saved(links.where("a is not null and b is not null and a <> b")
                  .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), "cc-links")
    labels = None
    while not edges.isEmpty():
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        parent = saved(both.groupBy("a").agg(F.min("b").alias("m"))
                       .select(F.col("a").alias("id"), F.least("a", "m").alias("p")), "cc-parents")
        while True:
            up = parent.select(F.col("id").alias("p"), F.col("p").alias("pp"))
            moved = F.col("pp") != F.col("p")
            if parent.join(up, "p").where(moved).isEmpty():
                break
            parent = saved(parent.join(up, "p").select("id", F.col("pp").alias("p")), "cc-parents")
        if labels is None:
            labels = parent.select("id", F.col("p").alias("component"))
        else:
            root = parent.select(F.col("id").alias("component"), "p")
            labels = saved(labels.join(root, "component", "left").select(
                "id", F.coalesce("p", "component").alias("component")), "cc-labels")
        to_a, to_b = (parent.select(F.col("id").alias(c), F.col("p").alias(f"p{c}")) for c in "ab")
        edges = saved(edges.join(to_a, "a").join(to_b, "b").where("pa <> pb")
                      .select(F.least("pa", "pb").alias("a"), F.greatest("pa", "pb").alias("b")).distinct(), "cc-links")
    if labels is None:
        return edges.select(F.col("a").alias("id"), F.col("b").alias("component"))
    return labels
