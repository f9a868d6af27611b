"""Weighted character n-grams with prefix filters, and keys of pieces that like texts share, as DataFrame plans."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def ngrams(c: Column, n: int = 2) -> Column:
    """Distinct character n-grams of a text framed by '^' and '$'."""
    framed = F.concat(F.lit("^"), c, F.lit("$"))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), F.length(framed) - (n - 1))), lambda i: F.substr(framed, i, F.lit(n))))


def weighted_ngrams(texts: DataFrame, text: str, threshold: float, n: int = 2) -> DataFrame:
    """(text, grams, prefix): unit vectors of damped inverse frequencies, rarest gram first, and their index prefix.

    ``grams`` is a map from gram to weight; the weight is the square root of the usual logarithm, so that a mistyped
    gram, always rare, doesn't outweigh the rest. ``prefix`` holds the leading grams without which a cosine of
    ``threshold`` is out of reach: two vectors at least that similar share one of them. ``texts`` must be distinct.
    """
    each = texts.select(text, F.explode(ngrams(F.col(text), n)).alias("gram"))
    counts = each.groupBy("gram").agg(F.count("*").alias("df"))  # as many rows as there are n-grams of the alphabet
    total = texts.agg(F.count("*").alias("total"))  # one row
    weighed = each.join(counts, "gram").crossJoin(F.broadcast(total)).withColumn("w", F.sqrt(F.log(1.0 + F.col("total") / F.col("df"))))
    vectors = weighed.groupBy(text).agg(F.array_sort(F.collect_list(F.struct("df", "gram", "w"))).alias("v"), F.sqrt(F.sum(F.col("w") * F.col("w"))).alias("norm"))
    squares = F.transform("v", lambda x: F.pow(x["w"] / F.col("norm"), F.lit(2.0)))
    tail = lambda i: F.aggregate(F.slice(squares, i + 1, F.size("v")), F.lit(0.0), lambda a, x: a + x)
    prefix = F.transform(F.filter(F.col("v"), lambda x, i: tail(i) >= threshold * threshold - 1e-9), lambda x: x["gram"])
    return vectors.select(text, F.map_from_arrays(F.transform("v", lambda x: x["gram"]), F.transform("v", lambda x: x["w"] / F.col("norm"))).alias("grams"), prefix.alias("prefix"))


def cosine(a: Column, b: Column) -> Column:
    """Dot product of two gram maps."""
    return F.aggregate(F.map_entries(a), F.lit(0.0), lambda s, e: s + e["value"] * F.coalesce(F.try_element_at(b, e["key"]), F.lit(0.0)))


def _piece(length: Column, i: Column, edits: int) -> tuple[Column, Column]:
    """Start from 0 and length of the i-th of edits + 1 pieces of a text of this length."""
    start = F.floor(length * i / (edits + 1)).cast("int")
    return start, F.floor(length * (i + 1) / (edits + 1)).cast("int") - start


def piece_keys(text: Column, edits: int) -> Column:
    """Keys of the edits + 1 pieces of a text: one of them is among the ``probe_keys`` of every text within so many edits."""
    length, keys = F.length(text), []
    for i in range(edits + 1):
        start, n = _piece(length, F.lit(i), edits)
        keys.append(F.xxhash64(length, F.lit(i), text.substr(start + 1, n)))
    return F.array(*keys)


def places(edits: int, shorter: bool = True) -> Column:
    """(more, i, moved): where the i-th piece of a text that is ``more`` letters longer may stand, moved so far from its start.
    This depends on the difference of the lengths alone, so it is one list for all rows; exploded, each place is a row and
    its ``probe_key`` a short expression, which the JVM compiles. Without ``shorter`` only of texts at least as long as this one,
    which is enough where each pair is probed from both sides."""
    each = [
        (more, i, moved)
        for more in range(-edits if shorter else 0, edits + 1)
        for i in range(edits + 1)
        for moved in range(max(-i, i - edits - more), min(i, edits - i - more) + 1)
    ]
    return F.array(*[F.struct(F.lit(more).alias("more"), F.lit(i).alias("i"), F.lit(moved).alias("moved")) for more, i, moved in each])


def probe_key(text: Column, place: Column, edits: int) -> Column:
    """Key of the piece at one of the ``places`` of a text; null where the text has no such place."""
    own = F.length(text)
    length = own + place["more"]
    start, n = _piece(length, place["i"], edits)
    s = start + place["moved"]
    return F.when((length >= 0) & (s >= 0) & (s + n <= own), F.xxhash64(length, place["i"], text.substr(s + 1, n)))


def probe_keys(text: Column, edits: int, shorter: bool = True) -> Column:
    """Keys of all places where a piece of a text within so many edits may stand in this one."""
    return F.array_distinct(F.array_compact(F.transform(places(edits, shorter), lambda place: probe_key(text, place, edits))))
