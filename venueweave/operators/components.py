"""Connected components of an edge table by label propagation with contraction.

Each round maps every vertex to the neighbour of least random rank, follows that map once more, and replaces the edges
by the edges between the images. Ranks are drawn anew in each round, so long chains shrink by a constant factor
whatever the order of their ids. A vertex with many neighbours is an aggregate with map-side combine, never a group
in one task; the maps are written to the shared folder and resolved backwards at the end.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueweave.storage import Stash


def both_ways(edges: DataFrame) -> DataFrame:
    return edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def plain_edges(df: DataFrame, left: str, right: str) -> DataFrame:
    """(a, b) with a < b, each once; null ends and loops are left out."""
    a, b = F.col(left), F.col(right)
    return df.filter(a.isNotNull() & b.isNotNull() & (a != b)).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def component_roots(edges: DataFrame) -> DataFrame:
    """(id, root): one arbitrary but common member for all vertices of a component. ``edges`` as of ``plain_edges``."""
    maps: list[Stash] = []
    current, held = edges, None
    while True:
        rank = lambda c: F.struct(F.xxhash64(c, F.lit(len(maps))), c.alias("v"))  # noqa: B023, E731
        first = both_ways(current).groupBy("a").agg(F.min(rank(F.col("b"))).alias("m"))
        first = first.select(F.col("a").alias("id"), F.least(F.col("m"), rank(F.col("a"))).getField("v").alias("to"))
        hop = Stash(first, "hop")
        second = hop.df.select(F.col("id").alias("to"), F.col("to").alias("next"))
        mapped = Stash(hop.df.join(second, "to", "left").select("id", F.coalesce("next", "to").alias("to")), "map")
        hop.drop()
        maps.append(mapped)
        image = mapped.df
        moved = current.join(image.select(F.col("id").alias("a"), F.col("to").alias("x")), "a").join(image.select(F.col("id").alias("b"), F.col("to").alias("y")), "b")
        following = Stash(plain_edges(moved, "x", "y"), "edges")
        if held:
            held.drop()
        current, held = following.df, following
        if not following.rows:
            held.drop()
            break
    labels = maps[-1].df.withColumnRenamed("to", "root")
    for level in reversed(maps[:-1]):
        labels = level.df.join(labels.select(F.col("id").alias("to"), "root"), "to", "left").select("id", F.coalesce("root", "to").alias("root"))
    return labels


def least_member(labels: DataFrame) -> DataFrame:
    """(id, group_id): the least id of each group; the aggregate is combined map-side, so a giant group is no burden."""
    least = labels.groupBy("root").agg(F.min("id").alias("group_id"))
    return labels.join(least, "root").select("id", "group_id")


def components(df: DataFrame, left: str = "a", right: str = "b") -> DataFrame:
    """(id, group_id) for every vertex with an edge to another one; ``group_id`` is the least id of its component."""
    edges = Stash(plain_edges(df, left, right), "edges")
    return least_member(component_roots(edges.df))
