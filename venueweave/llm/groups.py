"""Consolidating pairwise matches into groups: the giant component is peeled first, the rest by minimum propagation.

From the vertex of highest degree the frontier is joined with the edges, round by round; the edges of what it reached are
anti-joined away, so each round reads fewer. Peeling goes on while the frontier grows, or while it takes away a fair share
of the edges left, whatever the size of the hub; it ends in the thin tails of a component, where a round costs a pass over
the edges and gains little. What was reached then stands for one vertex in the remaining graph, which is small, and whose
labels come from minimum propagation. The result is exact however early the peeling stops.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from venueweave.operators.components import both_ways, plain_edges
from venueweave.storage import Stash, broadcast_if_small

#: A frontier that isn't this many times the one before must take away this share of the edges left to pay for its pass:
#: propagation needs about as many passes as that share has parts.
GROWTH, PAYING_SHARE = 1.5, 0.125


def followed(step: Stash) -> Stash:
    """Where each id of (id, to) ends if ``to`` is followed as long as it leads on; it must not lead in circles. The
    distance doubles with each join, so the longest way of n steps takes log n of them. ``step`` is dropped."""
    while True:
        up = step.df.select(F.col("id").alias("to"), F.col("to").alias("next"))
        further = Stash(step.df.join(up, "to", "left").select("id", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved")), "followed")
        moved = further.df.filter("moved").limit(1).count()
        step.drop()
        step = further
        if not moved:
            return step


def propagate_minimum(edges: DataFrame) -> DataFrame:
    """(id, group_id) for the vertices of ``edges`` (a < b, each once): the least id each is linked to.

    Every vertex takes the least of its neighbours, if that is less than itself, and then what that one took, until
    nothing moves (pointers double, so a chain of n takes log n joins). The edges between what is left are the next
    round's; plain propagation without this contraction would need as many rounds as the longest chain has links.
    Aggregates combine map-side and nothing is grouped in a task, so a vertex may have any number of neighbours.
    """
    maps: list[Stash] = []
    current, held = edges, None
    while True:
        step = Stash(current.groupBy(F.col("b").alias("id")).agg(F.min("a").alias("to")), "least")
        if not step.rows:
            step.drop()
            break
        step = followed(step)
        maps.append(step)
        image = step.df.select("id", "to")
        for c in ("a", "b"):
            current = current.join(image.select(F.col("id").alias(c), F.col("to").alias(f"{c}_to")), c, "left").withColumn(c, F.coalesce(f"{c}_to", c)).drop(f"{c}_to")
        following = Stash(plain_edges(current, "a", "b"), "links")
        if held:
            held.drop()
        current, held = following.df, following
    if not maps:
        return edges.select(F.col("a").alias("id"), F.col("a").alias("group_id")).limit(0)
    labels = maps[-1].df.select("id", F.col("to").alias("group_id"))
    for level in reversed(maps[:-1]):
        above = labels.select(F.col("id").alias("to"), "group_id")
        labels = labels.unionByName(level.df.join(above, "to", "left").select("id", F.coalesce("group_id", "to").alias("group_id")))
    # the least vertex of a group has nothing to take
    return labels.unionByName(labels.select(F.col("group_id").alias("id"), "group_id").distinct())


def peel(arcs: Stash, start: int, kind) -> tuple[DataFrame, DataFrame, bool]:
    """(reached ids, arcs left, whether some arcs left may end in a reached id) of the frontier search from ``start``.

    ``arcs`` holds every edge both ways; it is dropped when it is no longer needed.
    """
    frontier = Stash(arcs.df.sparkSession.range(1).select(F.lit(start).cast(kind).alias("id")), "frontier")
    reached, grown = [frontier], 1
    while True:
        side = broadcast_if_small(frontier).withColumnRenamed("id", "a")
        seen = reduce(DataFrame.unionByName, [r.df for r in reached])
        following = Stash(arcs.df.join(side, "a", "left_semi").select(F.col("b").alias("id")).distinct().join(seen, "id", "left_anti"), "frontier")
        left = Stash(arcs.df.join(side, "a", "left_anti"), "arcs")
        taken, before = arcs.rows - left.rows, arcs.rows
        arcs.drop()
        arcs = left
        if following.rows:
            reached.append(following)
        growing, paying = following.rows >= GROWTH * grown, taken >= PAYING_SHARE * before
        grown, frontier = following.rows, following
        if not following.rows or not (growing or paying):
            return reduce(DataFrame.unionByName, [r.df for r in reached]), arcs.df, bool(following.rows)


def consolidate(df: DataFrame, left: str, right: str, valid: DataFrame | None = None) -> DataFrame:
    """(id, group_id) for every linked record; ``group_id`` is the least id it is linked to, directly or not.

    Null ends, loops and repeated or reversed pairs are harmless; with ``valid`` (one column of ids) only pairs with
    both ends in it link; an empty table gives an empty result; other columns are ignored.
    """
    pairs = plain_edges(df, left, right)
    if valid is not None:
        ids = valid.select(F.col(valid.columns[0]).alias("id")).distinct()
        pairs = pairs.join(ids.withColumnRenamed("id", "a"), "a", "left_semi").join(ids.withColumnRenamed("id", "b"), "b", "left_semi").select("a", "b")
    edges = Stash(pairs, "links")
    arcs = Stash(both_ways(edges.df).repartition("a"), "arcs")
    top = arcs.df.groupBy("a").agg(F.count("*").alias("n")).agg(F.max(F.struct("n", -F.col("a"))).alias("top")).first()["top"]
    if top is None:
        return edges.df.select(F.col("a").alias("id"), F.col("a").alias("group_id"))
    start = -top[1]
    reached, rest, open_ended = peel(arcs, start, edges.df.schema["a"].dataType)
    peeled = Stash(reached, "peeled")
    side = broadcast_if_small(peeled)
    inner = rest
    if open_ended:  # the last frontier's edges are still there
        inner = rest.join(side.withColumnRenamed("id", "a"), "a", "left_anti").join(side.withColumnRenamed("id", "b"), "b", "left_anti")
        border = rest.join(side.withColumnRenamed("id", "b"), "b", "left_semi").join(side.withColumnRenamed("id", "a"), "a", "left_anti")
        inner = inner.unionByName(border.select("a", F.lit(start).cast(edges.df.schema["a"].dataType).alias("b")))
    remaining = Stash(plain_edges(inner, "a", "b"), "links")
    others = Stash(propagate_minimum(remaining.df), "groups").df
    # the giant's label is the least of what was reached and of what the start was found linked to
    own = others.filter(F.col("id") == start).agg(F.min("group_id")).first()[0]
    least = min(x for x in (own, peeled.df.agg(F.min("id")).first()[0]) if x is not None)
    giant = F.lit(least).cast(edges.df.schema["a"].dataType)
    found = others.filter(F.col("id") != start)
    if own is not None:
        found = found.withColumn("group_id", F.when(F.col("group_id") == own, giant).otherwise(F.col("group_id")))
    return found.unionByName(peeled.df.select("id", giant.alias("group_id")))
