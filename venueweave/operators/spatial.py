"""Points near other points and points inside regions, by joins on Morton (Z-order) codes.

A disc is covered by the quadtree cells it touches, at a level where that is four cells at most; each cell is an
aligned range of the sorted codes, so that the range join becomes an equality on the code's prefix. A region is
covered by ranges of cells wholly inside it, which need no further test, and by cells on its edge, which carry the
few edges that touch them and whether a corner is inside. Every candidate is then refined exactly. No cross join, no driver-side index; hot cells are
split by adaptive execution, since the joins are ordinary inner equi-joins.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from venueweave.functions.geo import EARTH_RADIUS_M, MORTON_BITS, axis_cell, haversine_m, morton, morton_code, usable
from venueweave.storage import BROADCAST_BYTES, Stash, measured_bytes

_DEGREE_M = math.pi * EARTH_RADIUS_M / 180.0


def _level(lat: Column, metres: float, finer: int = 0) -> Column:
    """Deepest quadtree level whose cells are at least 2 * metres wide and high at this latitude, or so many levels finer."""
    rows = int(math.floor(math.log2(180.0 * _DEGREE_M / (2 * metres))))
    width = F.cos(F.radians(F.least(F.lit(90.0), F.abs(lat)))) * (360.0 * _DEGREE_M / (2 * metres))
    level = F.floor(F.log2(F.greatest(F.lit(1.0), width)))
    level = F.greatest(F.lit(0), F.least(F.lit(max(0, min(rows, MORTON_BITS - finer))), level))
    return (F.when(level == 0, 0).otherwise(level + finer) if finer else level).cast("bigint")


def _key(level: Column, row: Column, column: Column) -> Column:
    return F.shiftleft(level, 54).bitwiseOR(morton(row, column))


def disc_cells(lat: Column, lon: Column, metres: float, finer: int = 0) -> Column:
    """Keys of the cells that a disc of this radius touches; across the date line, and over a pole at level 0.

    Four cells at most, or more but smaller ones with ``finer``: fewer candidates for more keys."""
    reach = metres / _DEGREE_M
    level = _level(F.abs(lat) + reach, metres, finer)
    n = F.pow(F.lit(2.0), level)
    wide = F.abs(lat) + reach >= 89.9999
    dlon = F.when(wide, F.lit(180.0)).otherwise(F.degrees(F.asin(F.least(F.lit(1.0), math.sin(metres / EARTH_RADIUS_M) / F.cos(F.radians(lat)))))) * 1.000001
    rows = F.sequence(axis_cell(lat - reach * 1.000001, -90.0, 180.0, level), axis_cell(lat + reach * 1.000001, -90.0, 180.0, level))
    first = F.floor((lon - dlon + 180.0) / 360.0 * n).cast("bigint")
    last = F.floor((lon + dlon + 180.0) / 360.0 * n).cast("bigint")
    columns = F.sequence(first, F.least(last, first + n.cast("bigint") - 1))
    cells = F.transform(rows, lambda r: F.transform(columns, lambda c: _key(level, r, F.pmod(c, n.cast("bigint")))))
    return F.flatten(cells)


def point_cells(lat: Column, lon: Column, metres: float, finer: int = 0) -> Column:
    """Keys under which a point is found by the discs that may hold it: one level nearly everywhere."""
    reach = 1.000001 * metres / _DEGREE_M
    low, high = _level(F.abs(lat) + 2 * reach, metres, finer), _level(F.greatest(F.lit(0.0), F.abs(lat) - reach), metres, finer)
    levels = F.sequence(low, F.greatest(low, high))
    return F.transform(levels, lambda v: _key(v, axis_cell(lat, -90.0, 180.0, v), axis_cell(lon, -180.0, 360.0, v)))


def _points(df: DataFrame, key: str, lat: str, lon: str) -> DataFrame:
    return df.select(F.col(key).alias("id"), F.col(lat).cast("double").alias("lat"), F.col(lon).cast("double").alias("lon")).filter(F.col("id").isNotNull() & usable("lat", "lon")).distinct()


def near_pairs(df: DataFrame, metres: float, key: str = "raw_id", lat: str = "lat", lon: str = "lon") -> DataFrame:
    """Pairs (id_a < id_b, distance_m) of rows at most ``metres`` apart.

    Rows without a key or with unusable coordinates take no part; copies of a row count once; an empty table gives
    an empty result; all other columns are ignored, so names may clash. Ties at exactly the distance are in.
    """
    points = _points(df, key, lat, lon)
    a = points.select(F.col("id").alias("id_a"), F.col("lat").alias("lat_a"), F.col("lon").alias("lon_a"), F.explode(disc_cells(F.col("lat"), F.col("lon"), metres)).alias("cell"))
    b = points.select(F.col("id").alias("id_b"), F.col("lat").alias("lat_b"), F.col("lon").alias("lon_b"), F.explode(point_cells(F.col("lat"), F.col("lon"), metres)).alias("cell"))
    reach = 1.000001 * metres / _DEGREE_M
    close = (F.col("id_a") < F.col("id_b")) & (F.abs(F.col("lat_a") - F.col("lat_b")) <= reach)
    pairs = a.join(b, "cell").filter(close).withColumn("distance_m", haversine_m(F.col("lat_a"), F.col("lon_a"), F.col("lat_b"), F.col("lon_b")))
    return pairs.filter(F.col("distance_m") <= metres).select("id_a", "id_b", "distance_m")


# ------------------------------------------------------------------------------------------------ regions

#: Quadtree nodes a region part is cut into at least, if its edge needs them; edges that an edge cell may hold beyond that.
COVER_NODES, CELL_EDGES = 40, 32
_BUCKET_LEVELS = (15, 10, 5, 0)
_SPAN = 64


def _parts(geojson: str | None) -> list[np.ndarray]:
    """Edges [x1, y1, x2, y2] of each polygon of a Polygon or MultiPolygon, holes included; nothing for other texts."""
    try:
        shape = json.loads(geojson or "null")
        shape = shape.get("geometry", shape)
        polygons = {"Polygon": lambda c: [c], "MultiPolygon": lambda c: c}[shape["type"]](shape["coordinates"])
    except (ValueError, KeyError, AttributeError, TypeError):
        return []
    out = []
    for rings in polygons:
        edges = []
        for ring in rings:
            points = np.array([p[:2] for p in ring], dtype=float).reshape(-1, 2)
            if len(points) >= 3:
                edges.append(np.hstack([points, np.roll(points, -1, axis=0)]))
        if edges:
            every = np.vstack(edges)
            out.append(every[(every[:, :2] != every[:, 2:]).any(axis=1)])
    return out


def _touching(e: np.ndarray, x0: float, y0: float, x1: float, y1: float) -> np.ndarray:
    """Which edges touch the closed rectangle (separating-axis test)."""
    near = (np.minimum(e[:, 0], e[:, 2]) <= x1) & (np.maximum(e[:, 0], e[:, 2]) >= x0) & (np.minimum(e[:, 1], e[:, 3]) <= y1) & (np.maximum(e[:, 1], e[:, 3]) >= y0)
    dx, dy = e[:, 2] - e[:, 0], e[:, 3] - e[:, 1]
    side = np.stack([dx * (y - e[:, 1]) - dy * (x - e[:, 0]) for x in (x0, x1) for y in (y0, y1)])
    return near & (side.min(axis=0) <= 0) & (side.max(axis=0) >= 0)


def _crossed(e: np.ndarray, x: float, y: float, cx: float, cy: float) -> bool:
    """Whether the way from (x, y) right to cx and down to cy crosses these edges an odd number of times."""
    a = e[(e[:, 1] > y) != (e[:, 3] > y)]
    across = (a[:, 2] - a[:, 0]) * (y - a[:, 1]) / (a[:, 3] - a[:, 1]) + a[:, 0]
    b = e[(e[:, 0] > cx) != (e[:, 2] > cx)]
    height = (b[:, 3] - b[:, 1]) * (cx - b[:, 0]) / (b[:, 2] - b[:, 0]) + b[:, 1]
    return bool((((across > x) & (across <= cx)).sum() + ((height > cy) & (height <= y)).sum()) % 2)


def _cover(edges: np.ndarray) -> tuple[list[tuple[int, int]], list[tuple]]:
    """(ranges of codes wholly inside, edge cells as (low, high, x and y of the cell's lower right corner, whether that
    corner is inside, edges that touch the cell)).

    A point of an edge cell is inside as its corner is, unless the way from it, straight to the cell's right border and
    down that border, crosses the edge an odd number of times; all edges it can cross touch the cell. So no edge stands in
    cells it doesn't touch, and the cells shrink until few edges are left in each, however many the region has. The globe's
    corner, on the south pole's line, is outside; a cell's corner follows from that of the cell it was cut from.
    """
    inside, edge = [], []
    queue, nodes = [(0, 0, 0, np.arange(len(edges)), edges, (180.0, -90.0, False))], 0
    while queue:
        following = []
        for level, row, column, own, around, (px, py, odd) in queue:
            n = 1 << level
            h, w = 180.0 / n, 360.0 / n
            y0, x0 = -90.0 + row * h, -180.0 + column * w
            pad = 1e-9
            hit = own[_touching(edges[own], x0 - pad, y0 - pad, x0 + w + pad, y0 + h + pad)]
            code = int("".join(a + b for a, b in zip(format(row, f"0{max(level, 1)}b"), format(column, f"0{max(level, 1)}b"), strict=True)), 2)
            shift = 2 * (MORTON_BITS - level)
            low, high = code << shift, ((code + 1) << shift) - 1
            corner = (x0 + w, y0, odd != _crossed(around, x0 + w, y0, px, py))
            if not len(hit):
                if corner[2]:
                    inside.append((low, high))
                continue
            if level >= MORTON_BITS or (nodes >= COVER_NODES and level >= 1 and len(hit) <= CELL_EDGES):
                edge.append((low, high, *corner, edges[hit]))
                continue
            nodes += 1
            following += [(level + 1, 2 * row + i, 2 * column + j, hit, edges[hit], corner) for i in (0, 1) for j in (0, 1)]
        queue = following
    merged: list[tuple[int, int]] = []
    for low, high in sorted(inside):
        if merged and merged[-1][1] + 1 == low:
            merged[-1] = (merged[-1][0], high)
        else:
            merged.append((low, high))
    return merged, edge


_COVER_SCHEMA = "region string, parts int, low bigint, high bigint, bucket_level int, cx double, cy double, corner boolean, edges array<struct<x1: double, y1: double, x2: double, y2: double>>"


def _crossing(p1: Column, p2: Column, q1: Column, q2: Column, q: Column, test) -> Column:
    """Test of the place p at which the line from (p1, q1) to (p2, q2) passes q; false where it runs along it."""
    return F.coalesce(test((p2 - p1) * (q - q1) / F.when(q2 != q1, q2 - q1) + p1), F.lit(False))


def region_cover(regions: DataFrame, name: str = "name", geojson: str = "geojson") -> DataFrame:
    """One row for each range of codes of each region; ``edges`` null where the range lies wholly inside."""

    def work(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for region, text in zip(batch["region"], batch["geojson"], strict=True):
                parts = _parts(text)
                for edges in parts:
                    inside, edge = _cover(edges)
                    for low, high, cx, cy, corner, own in [*((a, b, None, None, None, None) for a, b in inside), *edge]:
                        level = next(v for v in _BUCKET_LEVELS if v == 0 or (high >> 2 * (MORTON_BITS - v)) - (low >> 2 * (MORTON_BITS - v)) < _SPAN)
                        rows.append((region, len(parts), low, high, level, cx, cy, corner, None if own is None else [dict(zip(("x1", "y1", "x2", "y2"), map(float, x), strict=True)) for x in own]))
            yield pd.DataFrame(rows, columns=[c.split(" ")[0] for c in _COVER_SCHEMA.split(", ")[:8]] + ["edges"])

    chosen = regions.select(F.col(name).alias("region"), F.col(geojson).alias("geojson")).filter("region is not null and geojson is not null").distinct()
    spread = chosen.repartition(chosen.sparkSession.sparkContext.defaultParallelism)  # a few large texts, much work each
    return spread.mapInPandas(work, _COVER_SCHEMA)


def inside_regions(df: DataFrame, regions: DataFrame, key: str = "raw_id", lat: str = "lat", lon: str = "lon", name: str = "name", geojson: str = "geojson") -> DataFrame:
    """(id, region) for each row and each region that contains it; holes are outside.

    Unusable coordinates, null names and texts that are no polygon take no part; copies count once. The cover grows with
    the edges of the regions; it is broadcast only after its bytes were measured, else joined by shuffle.
    """
    shift = lambda code, level: F.shiftright(code, 2 * (MORTON_BITS - level))
    cover = Stash(region_cover(regions, name, geojson), "cover").df
    points = _points(df, key, lat, lon).withColumn("code", morton_code("lat", "lon"))
    x, y = F.col("lon"), F.col("lat")
    # edges crossed on the way to the right border and down it to the corner; ends count as a hair above and to the right
    along = lambda e: ((e.y1 > y) != (e.y2 > y)) & _crossing(e.x1, e.x2, e.y1, e.y2, y, lambda at: (at > x) & (at <= F.col("cx")))
    down = lambda e: ((e.x1 > F.col("cx")) != (e.x2 > F.col("cx"))) & _crossing(e.y1, e.y2, e.x1, e.x2, F.col("cx"), lambda at: (at > F.col("cy")) & (at <= y))
    crossed = F.aggregate("edges", F.lit(0), lambda n, e: n + F.when(along(e), 1).otherwise(0) + F.when(down(e), 1).otherwise(0))
    found = None
    for level in _BUCKET_LEVELS:
        first, last = shift(F.col("low"), level), shift(F.col("high"), level)
        ranges = cover.filter(F.col("bucket_level") == level).withColumn("bucket", F.explode(F.sequence(first, last))).drop("bucket_level")
        size = measured_bytes(ranges)
        if not size:
            continue
        ranges = F.broadcast(ranges) if size <= BROADCAST_BYTES else ranges
        hits = points.withColumn("bucket", shift(F.col("code"), level)).join(ranges, "bucket").filter((F.col("code") >= F.col("low")) & (F.col("code") <= F.col("high")))
        hits = hits.filter(F.col("edges").isNull() | ((crossed % 2 == 1) != F.col("corner"))).select("id", "region", "parts")
        found = hits if found is None else found.unionByName(hits)
    if found is None:
        return points.select("id", F.lit(None).cast("string").alias("region")).limit(0)
    one, several = found.filter("parts = 1").drop("parts"), found.filter("parts > 1").drop("parts").distinct()
    return one.unionByName(several)
