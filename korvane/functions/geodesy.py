"""Positions on the ellipsoid: distances, a metric projection and its inverse, and the order of cells on a Hilbert curve."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Mean radius; semi-major axis and flattening of the ellipsoid; scale on the central meridian.
MEAN_RADIUS_M = 6371008.8
AXIS_M, FLATTENING, SCALE = 6378137.0, 1 / 298.257223563, 0.9996
_n = FLATTENING / (2 - FLATTENING)
_A = AXIS_M / (1 + _n) * (1 + _n**2 / 4 + _n**4 / 64)
_alpha = (_n / 2 - 2 * _n**2 / 3 + 5 * _n**3 / 16, 13 * _n**2 / 48 - 3 * _n**3 / 5, 61 * _n**3 / 240)
_beta = (_n / 2 - 2 * _n**2 / 3 + 37 * _n**3 / 96, _n**2 / 48 + _n**3 / 15, 17 * _n**3 / 480)
_delta = (2 * _n - 2 * _n**2 / 3 - 2 * _n**3, 7 * _n**2 / 3 - 8 * _n**3 / 5, 56 * _n**3 / 15)
_e = 2 * _n**0.5 / (1 + _n)


def great_circle_m(lon1: Column, lat1: Column, lon2: Column, lat2: Column) -> Column:
    """Metres over the sphere of the mean radius, right to half a percent of the ellipsoid's."""
    a, b = F.radians(lat1), F.radians(lat2)
    h = F.pow(F.sin((b - a) / 2), 2) + F.cos(a) * F.cos(b) * F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return 2 * MEAN_RADIUS_M * F.asin(F.sqrt(F.least(h, F.lit(1.0))))


def metric(lon: Column, lat: Column, meridian: Column | float) -> Column:
    """struct(x, y): the transverse Mercator projection about a meridian, in metres, by a series of the third order (a millimetre within 3 degrees)."""
    phi, lam = F.radians(lat), F.radians(lon - meridian)
    s = F.sin(phi)
    t = F.sinh(F.atanh(s) - F.lit(_e) * F.atanh(F.lit(_e) * s))
    xi, eta = F.atan2(t, F.cos(lam)), F.atanh(F.sin(lam) / F.sqrt(1 + t * t))
    x, y = eta, xi
    for j, a in enumerate(_alpha, 1):
        x = x + F.lit(a) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
        y = y + F.lit(a) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
    return F.struct((F.lit(SCALE * _A) * x).alias("x"), (F.lit(SCALE * _A) * y).alias("y"))


def unmetric(x: Column, y: Column, meridian: Column | float) -> Column:
    """struct(lon, lat) of metric()."""
    xi, eta = y / (SCALE * _A), x / (SCALE * _A)
    p, q = xi, eta
    for j, b in enumerate(_beta, 1):
        p = p - F.lit(b) * F.sin(2 * j * xi) * F.cosh(2 * j * eta)
        q = q - F.lit(b) * F.cos(2 * j * xi) * F.sinh(2 * j * eta)
    chi = F.asin(F.sin(p) / F.cosh(q))
    phi = chi
    for j, d in enumerate(_delta, 1):
        phi = phi + F.lit(d) * F.sin(2 * j * chi)
    return F.struct((meridian + F.degrees(F.atan2(F.sinh(q), F.cos(p)))).alias("lon"), F.degrees(phi).alias("lat"))


def metric_ring(ring: Column, meridian: Column | float) -> Column:
    """A ring of struct(x = longitude, y = latitude) in metres."""
    return F.transform(ring, lambda p: metric(p["x"], p["y"], meridian))


def corners_metric(box: Column, meridian: Column | float) -> Column:
    """The box in metres around the four projected corners of a box(x0, y0, x1, y1) of degrees."""
    at = [metric(box[a], box[b], meridian) for a in ("x0", "x1") for b in ("y0", "y1")]
    return F.struct(F.least(*[p["x"] for p in at]).alias("x0"), F.least(*[p["y"] for p in at]).alias("y0"), F.greatest(*[p["x"] for p in at]).alias("x1"), F.greatest(*[p["y"] for p in at]).alias("y1"))


def hilbert(x: Column, y: Column, zoom: int) -> Column:
    """The place of cell (x, y) of a level on the Hilbert curve through all its cells, from 0."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"), F.lit(0).cast("long").alias("d"))

    def step(a: Column, k: Column) -> Column:
        s = F.call_function("shiftleft", F.lit(1).cast("long"), k.cast("int"))
        rx, ry = F.when(a["x"].bitwiseAND(s) > 0, 1).otherwise(0), F.when(a["y"].bitwiseAND(s) > 0, 1).otherwise(0)
        low = s - 1
        px, py = a["x"].bitwiseAND(low), a["y"].bitwiseAND(low)
        fx, fy = F.when((ry == 0) & (rx == 1), low - px).otherwise(px), F.when((ry == 0) & (rx == 1), low - py).otherwise(py)
        return F.struct(F.when(ry == 0, fy).otherwise(fx).alias("x"), F.when(ry == 0, fx).otherwise(fy).alias("y"), (a["d"] + s * s * (3 * rx).bitwiseXOR(ry).cast("long")).alias("d"))

    return F.aggregate(F.sequence(F.lit(zoom - 1), F.lit(0)), start, step, lambda a: a["d"]) if zoom else F.lit(0).cast("long")
