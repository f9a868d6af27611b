"""Coordinates: usability, distance, geohash cells and Morton (Z-order) codes, all as built-in expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from venueweave.functions.text import col

EARTH_RADIUS_M = 6_371_000.0
_BASE32 = "0123456789bcdefghjkmnpqrstuvwxyz"  # fixed value: the geohash alphabet
#: Bits of an axis in a full Morton code; 2 * 26 = 52 bits.
MORTON_BITS = 26


def usable(lat: Column | str, lon: Column | str) -> Column:
    """True where both coordinates are present, no NaN, not 0 and within ±90 / ±180."""
    lat, lon = col(lat), col(lon)
    ok = lat.isNotNull() & lon.isNotNull() & ~F.isnan(lat) & ~F.isnan(lon)
    return ok & (lat != 0) & (lon != 0) & (F.abs(lat) <= 90) & (F.abs(lon) <= 180)


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance in metres; null where a coordinate is null."""
    p1, p2 = F.radians(col(lat1)), F.radians(col(lat2))
    s1, s2 = F.sin((p2 - p1) / 2), F.sin(F.radians(col(lon2) - col(lon1)) / 2)
    h = F.sqrt(s1 * s1 + F.cos(p1) * F.cos(p2) * s2 * s2)
    # least() skips nulls, so the bound is set by a condition, which doesn't
    return 2 * EARTH_RADIUS_M * F.asin(F.when(h > 1.0, F.lit(1.0)).otherwise(h))


def axis_cell(value: Column, low: float, extent: float, bits: int | Column) -> Column:
    """Index of the cell that holds ``value`` among 2^bits equal cells of the axis; the upper end belongs to the last."""
    n = F.pow(F.lit(2.0), F.lit(bits) if isinstance(bits, int) else bits)
    cell = F.floor((value - low) / extent * n).cast("bigint")
    return F.greatest(F.lit(0).cast("bigint"), F.least(n.cast("bigint") - 1, cell))


def _spread(x: Column) -> Column:
    """The bits of x, one zero bit between each two: its binary digits read in base four."""
    return F.conv(F.bin(x), 4, 10).cast("bigint")


def morton(row: Column, column: Column) -> Column:
    """Z-order code of the cell (row, column)."""
    return F.shiftleft(_spread(row), 1).bitwiseOR(_spread(column))


def morton_code(lat: Column | str, lon: Column | str, bits: int = MORTON_BITS) -> Column:
    """Z-order code of a point on the grid of 2^bits by 2^bits cells over the whole globe."""
    return morton(axis_cell(col(lat), -90.0, 180.0, bits), axis_cell(col(lon), -180.0, 360.0, bits))


def geohash(lat: Column | str, lon: Column | str, precision: int = 7) -> Column:
    """Base-32 geohash text of a point."""
    total = 5 * precision
    lon_bits, lat_bits = (total + 1) // 2, total // 2
    i, j = axis_cell(col(lon), -180.0, 360.0, lon_bits), axis_cell(col(lat), -90.0, 180.0, lat_bits)
    if total % 2:  # the first and the last bit are of the longitude
        code = _spread(i).bitwiseOR(F.shiftleft(_spread(j), 1))
    else:
        code = F.shiftleft(_spread(i), 1).bitwiseOR(_spread(j))
    mark = lambda c, k: F.substr(F.lit(_BASE32), F.shiftright(c, 5 * (precision - 1 - k)).bitwiseAND(F.lit(31)).cast("int") + 1, F.lit(1))
    return F.element_at(F.transform(F.array(code), lambda c: F.concat(*[mark(c, k) for k in range(precision)])), 1)


def geohash_cell(lat: Column | str, lon: Column | str, precision: int = 7) -> tuple[Column, Column]:
    """(row, column) of a point's geohash cell: the form to join on."""
    total = 5 * precision
    return axis_cell(col(lat), -90.0, 180.0, total // 2), axis_cell(col(lon), -180.0, 360.0, (total + 1) // 2)


#: (row step, column step) of the own cell and then n, s, e, w, ne, nw, se, sw.
NEIGHBOURS = [(0, 0), (1, 0), (-1, 0), (0, 1), (0, -1), (1, 1), (1, -1), (-1, 1), (-1, -1)]
