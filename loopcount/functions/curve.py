"""Z-order of places (K4): one number per point, so that near points are mostly near in it.

Longitude and latitude are cut into 2**20 cells each (about 40 m); the bits of the two cell
numbers alternate in ``place``. A box becomes a few ranges of ``place`` (the quadrants that
cover it), which skip files and row groups of a table in that order; the exact comparison of
lon and lat stays in the filter.
"""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 20
CELLS = 1 << BITS
LON, LAT = (-180.0, 180.0), (-90.0, 90.0)
#: Ranges of ``place`` that a box becomes at most; fewer ranges cover more than the box.
MOST_RANGES = 24

_SPREAD = [(16, 0x0000FFFF0000FFFF), (8, 0x00FF00FF00FF00FF), (4, 0x0F0F0F0F0F0F0F0F), (2, 0x3333333333333333), (1, 0x5555555555555555)]


def _cell_column(value: Column, bounds: tuple[float, float]) -> Column:
    share = F.floor((value - F.lit(bounds[0])) / F.lit(bounds[1] - bounds[0]) * F.lit(float(CELLS)))
    return F.least(F.greatest(share, F.lit(0).cast("long")), F.lit(CELLS - 1).cast("long"))


def cell(value: float, bounds: tuple[float, float]) -> int:
    return min(max(math.floor((value - bounds[0]) / (bounds[1] - bounds[0]) * float(CELLS)), 0), CELLS - 1)


def _spread_column(x: Column) -> Column:
    for shift, mask in _SPREAD:
        x = x.bitwiseOR(F.shiftleft(x, shift)).bitwiseAND(F.lit(mask).cast("long"))
    return x


def _spread(x: int) -> int:
    for shift, mask in _SPREAD:
        x = (x | x << shift) & mask
    return x


def place(lon: Column, lat: Column) -> Column:
    """The place of a point; NULL for no point. Coordinates beyond the globe count as its edge."""
    both = _spread_column(_cell_column(lon, LON)).bitwiseOR(F.shiftleft(_spread_column(_cell_column(lat, LAT)), 1))
    return F.when(lon.isNotNull() & lat.isNotNull(), both)


def code(x: int, y: int) -> int:
    return _spread(x) | _spread(y) << 1


def box_ranges(lon_min: float, lat_min: float, lon_max: float, lat_max: float, most: int = MOST_RANGES) -> list[tuple[int, int]]:
    """At most ``most`` ranges (both ends included, ascending, apart) that cover all places of the box:
    quadrants that the box cuts are split, the largest first."""
    if not (lon_min <= lon_max and lat_min <= lat_max):
        return []
    x0, x1, y0, y1 = cell(lon_min, LON), cell(lon_max, LON), cell(lat_min, LAT), cell(lat_max, LAT)
    inside: list[tuple[int, int, int]] = []
    cut = [(-CELLS, 0, 0)]
    while cut and len(cut) + len(inside) + 3 <= max(most, 4):
        size, x, y = heapq.heappop(cut)
        half = -size // 2
        for u, v in ((x, y), (x + half, y), (x, y + half), (x + half, y + half)):
            if u > x1 or u + half - 1 < x0 or v > y1 or v + half - 1 < y0:
                continue
            if half == 1 or (x0 <= u and u + half - 1 <= x1 and y0 <= v and v + half - 1 <= y1):
                inside.append((-half, u, v))
            else:
                heapq.heappush(cut, (-half, u, v))
    ranges: list[tuple[int, int]] = []
    for low, size in sorted((code(x, y), size * size) for size, x, y in inside + cut):
        if ranges and ranges[-1][1] + 1 == low:
            ranges[-1] = (ranges[-1][0], low + size - 1)
        else:
            ranges.append((low, low + size - 1))
    return ranges


def in_box(lon_min: float, lat_min: float, lon_max: float, lat_max: float) -> Column:
    """Whether a row (place, lon, lat) lies in the box, edges included."""
    near = F.lit(False)
    for low, high in box_ranges(lon_min, lat_min, lon_max, lat_max):
        near = near | F.col("place").between(low, high)
    return near & F.col("lon").between(float(lon_min), float(lon_max)) & F.col("lat").between(float(lat_min), float(lat_max))
