"""Keys of features: the z=6 bucket of the centre, peels, 0.1 degree cells and coarse cells."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessellar.functions import grid
from tessellar.functions import mercator as m
from tessellar.sources.features import has_box, lng_band, overlaps


def centred(features: DataFrame) -> DataFrame:
    """Rows with a box, and the centre's tile at z=6 (mercator_x, mercator_y)."""
    lng = m.whole((F.col("bbox.xmin") + F.col("bbox.xmax")) / 2.0)
    lat = m.whole((F.col("bbox.ymin") + F.col("bbox.ymax")) / 2.0)
    return features.filter(has_box()).withColumns({"mercator_x": m.tile_x(lng, m.Z_BUCKET), "mercator_y": m.tile_y(m.clamp_lat(lat), m.Z_BUCKET)})


def keyed(features: DataFrame, z: int) -> DataFrame:
    """The centre's tile at any zoom, as x and y."""
    lng, lat = (F.col("bbox.xmin") + F.col("bbox.xmax")) / 2.0, (F.col("bbox.ymin") + F.col("bbox.ymax")) / 2.0
    return features.filter(has_box()).withColumns({"x": m.tile_x(m.whole(lng), z), "y": m.tile_y(m.clamp_lat(m.whole(lat)), z)})


def in_peels(features: DataFrame, width: int = m.PEEL_DEG, own_columns: bool = False) -> DataFrame:
    """A row for each peel that a feature's box overlaps, with its bucket. Peels share the rows that cross their borders;
    ``own_columns`` leaves out rows whose bucket's column doesn't meet the peel."""
    n = m.peel_count(width)
    place = lambda c: F.floor((F.col(f"bbox.{c}") + 180.0) / width)
    lo, hi = F.greatest(place("xmin") - 1, F.lit(0)), F.least(place("xmax") + 1, F.lit(n - 1))
    out = centred(features).withColumns({"_a": lo, "_b": hi}).filter("_b >= _a")
    out = out.withColumn("peel_idx", F.explode(F.sequence(F.col("_a").cast("int"), F.col("_b").cast("int")))).drop("_a", "_b")
    low = F.col("peel_idx") * float(width) - 180.0
    out = out.filter(lng_band(low, low + float(width)))
    if own_columns:
        columns = 1 << m.Z_BUCKET
        first = F.floor((low + 180.0) / 360.0 * columns)
        last = F.floor((low + float(width) + 180.0) / 360.0 * columns - 1e-12)
        out = out.filter(F.col("mercator_x").between(first, last))
    return out


def celled(features: DataFrame, region: grid.Box | None = None, max_span: int = grid.MAX_SPAN) -> DataFrame:
    """Rows with a box, in a region if given, with the range of 0.1 degree cells; boxes of too many cells go."""
    rows = features.filter(has_box())
    if region:
        rows = rows.filter(overlaps(region.west, region.south, region.east, region.north))
    return rows.withColumns(grid.cell_bounds()).filter(grid.within_span(max_span))


def _exploded(rows: DataFrame, lon: tuple[Column, Column], lat: tuple[Column, Column], names: tuple[str, str]) -> DataFrame:
    rows = rows.withColumns({"_a": lon[0], "_b": lon[1], "_c": lat[0], "_d": lat[1]}).filter("_b >= _a and _d >= _c")
    rows = rows.withColumn(names[0], F.explode(F.sequence("_a", "_b")))
    return rows.withColumn(names[1], F.explode(F.sequence("_c", "_d"))).drop("_a", "_b", "_c", "_d")


def coarse_cells(cells: DataFrame, region: grid.Box | None = None, clip: bool = False) -> DataFrame:
    """A row for each coarse cell that a feature touches. With a region, rows outside of it go; with ``clip`` the cells
    outside of it go too. A box that crosses the date line touches none."""
    lon, lat = (grid.coarse("_lon_lo"), grid.coarse("_lon_hi")), (grid.coarse("_lat_lo"), grid.coarse("_lat_hi"))
    if region:
        edges = [int((region.west + 180) / grid.CELL_DEG), int((region.east + 180) / grid.CELL_DEG), int((region.south + 90) / grid.CELL_DEG), int((region.north + 90) / grid.CELL_DEG)]
        if clip:
            c = [e // grid.FINE_PER_COARSE for e in edges]
            lon = F.greatest(lon[0], F.lit(c[0])), F.least(lon[1], F.lit(c[1]))
            lat = F.greatest(lat[0], F.lit(c[2])), F.least(lat[1], F.lit(c[3]))
        else:
            cells = cells.filter((F.col("_lon_hi") >= edges[0]) & (F.col("_lon_lo") <= edges[1]) & (F.col("_lat_hi") >= edges[2]) & (F.col("_lat_lo") <= edges[3]))
    return _exploded(cells, lon, lat, ("coarse_lon", "coarse_lat"))


def fine_cells(cells: DataFrame) -> DataFrame:
    """A row for each 0.1 degree cell that a feature touches, edges included: x is the latitude index, y the
    longitude index."""
    return _exploded(cells, (F.col("_lon_lo"), F.col("_lon_hi")), (F.col("_lat_lo"), F.col("_lat_hi")), ("y", "x"))


def extents(cells: DataFrame) -> DataFrame:
    """Rows and the outer cells of a table; nulls if it has none."""
    return cells.agg(F.count(F.lit(1)).alias("rows"), F.min("_lon_lo").alias("lon_lo_min"), F.max("_lon_hi").alias("lon_hi_max"), F.min("_lat_lo").alias("lat_lo_min"), F.max("_lat_hi").alias("lat_hi_max"))
