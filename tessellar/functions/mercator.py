"""Web Mercator tiles: x grows east, y grows south, 2**z tiles a side."""

from __future__ import annotations

import math
from collections.abc import Iterator

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the tile grid.
LAT_LIMIT = 85.0511287798066
Z_BUCKET = 6
Z_MAX = 14
PEEL_DEG = 10
TILE_BYTES = 20 * 1024 * 1024

ColumnOrName = Column | str


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c if isinstance(c, Column) else F.lit(c)


def whole(c: Column) -> Column:
    """A value that is not NaN; NaN stops the query, null stays null."""
    return F.when(F.isnan(c), F.raise_error(F.lit("coordinate is NaN")).cast("double")).otherwise(c)


def clamp_lat(lat: ColumnOrName) -> Column:
    """Null falls to the southern limit."""
    return F.least(F.lit(LAT_LIMIT), F.greatest(F.lit(-LAT_LIMIT), _col(lat)))


def tile_x(lng: ColumnOrName, z: int) -> Column:
    """Null falls to the last column, as ``least`` and ``greatest`` pass over nulls."""
    n = 1 << z
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((_col(lng) + 180.0) / 360.0 * n).cast("int")))


def tile_y(lat: ColumnOrName, z: int) -> Column:
    n = 1 << z
    r = F.radians(_col(lat))
    return F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((1.0 - F.log(F.tan(r) + 1.0 / F.cos(r)) / F.pi()) / 2.0 * n).cast("int")))


def edge_lng(x: ColumnOrName, z) -> Column:
    """West edge of column x; ``z`` may be a column."""
    n = F.pow(F.lit(2.0), _col(z)) if not isinstance(z, int) else F.lit(float(1 << z))
    return _col(x) / n * 360.0 - 180.0


def edge_lat(y: ColumnOrName, z) -> Column:
    """North edge of row y."""
    n = F.pow(F.lit(2.0), _col(z)) if not isinstance(z, int) else F.lit(float(1 << z))
    v = F.pi() - F.lit(2.0) * F.pi() * (_col(y) / n)
    return F.degrees(F.atan((F.exp(v) - F.exp(-v)) / 2.0))


def extent(z, x: ColumnOrName, y: ColumnOrName) -> dict[str, Column]:
    """West, south, east and north of a tile."""
    return {"west": edge_lng(x, z), "south": edge_lat(_col(y) + 1, z), "east": edge_lng(_col(x) + 1, z), "north": edge_lat(y, z)}


def ancestor(c: ColumnOrName, levels: int | Column) -> Column:
    return F.shiftright(_col(c), levels) if isinstance(levels, int) else F.floor(_col(c) / F.pow(F.lit(2.0), levels)).cast("int")


def children(z: ColumnOrName, x: ColumnOrName, y: ColumnOrName) -> Column:
    """The four child addresses as an array of structs."""
    x, y, z = _col(x), _col(y), _col(z)
    return F.array(*[F.struct((z + 1).cast("int").alias("z"), (x * 2 + i).cast("int").alias("x"), (y * 2 + j).cast("int").alias("y")) for j in (0, 1) for i in (0, 1)])


def leaves(x6: ColumnOrName, y6: ColumnOrName, z: int) -> tuple[Column, Column]:
    """Arrays of the x and the y of a bucket's leaves at zoom z."""
    side = 1 << (z - Z_BUCKET)
    return tuple(F.sequence((_col(c) * side).cast("int"), (_col(c) * side + side - 1).cast("int")) for c in (x6, y6))


def centre_lng(west: ColumnOrName, east: ColumnOrName) -> Column:
    w, e = _col(west), _col(east)
    wrapped = (w + e + 360.0) / 2.0 + 180.0
    return F.when(e < w, wrapped - F.floor(wrapped / 360.0) * 360.0 - 180.0).otherwise((w + e) / 2.0)


# ---- scalar twins ----


def lng_lat_to_tile(lng: float, lat: float, z: int) -> tuple[int, int]:
    if z < 0:
        raise ValueError(f"zoom must not be negative: {z}")
    n = 1 << z
    lat = max(-LAT_LIMIT, min(LAT_LIMIT, lat))
    r = math.radians(lat)
    x = math.floor((lng + 180.0) / 360.0 * n)
    y = math.floor((1.0 - math.log(math.tan(r) + 1.0 / math.cos(r)) / math.pi) / 2.0 * n)
    return max(0, min(n - 1, x)), max(0, min(n - 1, y))


def tile_extent(z: int, x: int, y: int) -> tuple[float, float, float, float]:
    n = 1 << z if z >= 0 else 0
    if not (0 <= x < n and 0 <= y < n):
        raise ValueError(f"no such tile: {z}/{x}/{y}")
    lat = lambda v: math.degrees(math.atan(math.sinh(math.pi - 2 * math.pi * v / n)))
    return x / n * 360.0 - 180.0, lat(y + 1), (x + 1) / n * 360.0 - 180.0, lat(y)


def buckets_of_range(lo: float, hi: float, lats: tuple[float, float] = (-LAT_LIMIT, LAT_LIMIT), z: int = Z_BUCKET) -> list[tuple[int, int]]:
    """All (x, y) whose extent meets the range, which is open at its high end."""
    if hi <= lo or lats[1] <= lats[0]:
        raise ValueError(f"empty range: {lo}..{hi}, {lats}")
    n = 1 << z
    at = lambda v: (v + 180.0) / 360.0 * n
    first, last = max(0, math.floor(at(lo))), min(n - 1, math.floor(at(hi) - 1e-12) if at(hi) > 0 else 0)
    top, bottom = (lng_lat_to_tile(0.0, v, z)[1] for v in (lats[1], lats[0]))
    return [(x, y) for x in range(first, last + 1) for y in range(top, bottom + 1)]


def peel_count(width: int = PEEL_DEG) -> int:
    return 360 // width


def peel_range(i: int, width: int = PEEL_DEG) -> tuple[float, float]:
    if not 0 <= i < peel_count(width):
        raise ValueError(f"no such peel: {i}")
    return -180.0 + i * width, -180.0 + (i + 1) * width


def peel_order(width: int = PEEL_DEG) -> Iterator[int]:
    """From 0 degrees east around the world."""
    n = peel_count(width)
    return ((i + n // 2) % n for i in range(n))


def tile_path(z: int, x: int, y: int) -> str:
    return f"tiles/{z}/{x}/{y}.parquet"
