"""Web-mercator cells and quadkeys as column expressions."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: The latitude at which the square of the projection ends.
EDGE = 85.0511287798


def cell_x(lon: Column, zoom: int) -> Column:
    n = 1 << zoom
    return F.least(F.greatest(F.floor((lon + 180) / 360 * n), F.lit(0)), F.lit(n - 1)).cast("int")


def cell_y(lat: Column, zoom: int) -> Column:
    n = 1 << zoom
    inside = F.radians(F.least(F.greatest(lat, F.lit(-EDGE)), F.lit(EDGE)))
    return F.least(F.greatest(F.floor((1 - F.asinh(F.tan(inside)) / math.pi) / 2 * n), F.lit(0)), F.lit(n - 1)).cast("int")


def quadkey(x: Column, y: Column, zoom: int) -> Column:
    """One digit of 0-3 for each level, the coarsest first."""
    if not zoom:
        return F.lit("")
    return F.concat(*[(F.shiftright(x, k).bitwiseAND(F.lit(1)) + 2 * F.shiftright(y, k).bitwiseAND(F.lit(1))).cast("string") for k in range(zoom - 1, -1, -1)])


def quadkey_of(lon: Column, lat: Column, zoom: int) -> Column:
    return quadkey(cell_x(lon, zoom), cell_y(lat, zoom), zoom)


def bounds(x: Column, y: Column, zoom: int) -> Column:
    """struct(west, south, east, north) of a cell."""
    n = float(1 << zoom)
    lat = lambda v: F.degrees(F.atan(F.sinh(F.lit(math.pi) * (1 - 2 * v / n))))
    return F.struct((x / n * 360 - 180).alias("west"), lat(y + 1).alias("south"), ((x + 1) / n * 360 - 180).alias("east"), lat(y).alias("north"))


def in_key_range(key: Column, prefix: str) -> Column:
    """Whether a quadkey lies under the prefix, as a range that Parquet's minima and maxima can prune by."""
    if not prefix:
        return key.isNotNull()
    return (key >= prefix) & (key < prefix[:-1] + chr(ord(prefix[-1]) + 1))
