"""Connected components of a large graph by alternating stars, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionvol.plans.joins import lookup_join
from sessionvol.session import settle


def _parents(edges: DataFrame) -> DataFrame:
    """Smallest neighbour of every node that has a smaller one."""
    return edges.groupBy("u").agg(F.min("v").alias("m"))


def _with_parent(edges: DataFrame, end: str) -> DataFrame:
    """Edges with the parent of one end, by a lookup that splits nodes of any number of edges."""
    parents = _parents(edges).withColumnRenamed("u", end)
    return lookup_join(edges, parents, [end], "left", spread=("u", "v"))


def components(links: DataFrame, a: str = "a", b: str = "b", rounds: int = 60) -> DataFrame:
    """Nodes with a link, and the smallest node of their component: (node, root).

    Edges go from the larger to the smaller node. In a round every node's larger neighbours are linked to its
    smallest one (large star), then its smaller ones (small star), until nothing changes. The number of rounds follows the
    logarithm of the longest path. Tables are stored in the shared folder between rounds; the driver sees sums and sizes.
    """
    edges = settle(links.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).filter("u <> v").distinct())
    before = None
    for _ in range(rounds):
        large = _with_parent(edges, "v").select("u", F.coalesce("m", "v").alias("v"))
        large = settle(large.filter("u <> v").distinct())
        small = _with_parent(large, "u")
        after = small.select(F.col("v").alias("u"), F.col("m").alias("v")).union(small.select("u", F.col("m").alias("v")))
        edges = settle(after.filter("u <> v").distinct())
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == before:
            break
        before = now
    else:
        raise RuntimeError(f"components not found in {rounds} rounds")
    roots = edges.select("v").distinct()
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots.select("v", "v"))
