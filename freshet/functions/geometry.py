"""Column expressions over coordinates, rings and radar or satellite cells."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_KM = 6371.0
KM_PER_DEGREE = 111.0


def haversine_km(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    s = F.pow(F.sin(F.radians(lat2 - lat1) / 2), 2)
    t = F.pow(F.sin(F.radians(lon2 - lon1) / 2), 2)
    return F.lit(2 * EARTH_KM) * F.asin(F.sqrt(s + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * t))


def planar_km(lat: Column, lon: Column, lat0: Column, lon0: Column) -> Column:
    dy = (lat - lat0) * KM_PER_DEGREE
    dx = (lon - lon0) * KM_PER_DEGREE * F.cos(F.radians(lat0))
    return F.sqrt(dx * dx + dy * dy)


def distance_rank(km: Column) -> Column:
    """Distances equal to a millimetre are ties, so that engines and platforms order alike."""
    return F.floor(km * 1e6)


def snap_quarter(x: Column) -> Column:
    return F.bround(x * 4) / 4


def within_box(lat: Column, lon: Column, south: float, west: float, north: float, east: float) -> Column:
    return lat.between(south, north) & lon.between(west, east)


def cell_key(x: Column, size: float) -> Column:
    return F.floor(x / size).cast("bigint")


def crosses(lon: Column, lat: Column, e: Column) -> Column:
    """Whether a line to the east of a point crosses an edge struct (x1, y1, x2, y2)."""
    at = (e["x2"] - e["x1"]) * (lat - e["y1"]) / F.nullif(e["y2"] - e["y1"], F.lit(0.0)) + e["x1"]
    return ((e["y1"] > lat) != (e["y2"] > lat)) & (lon < at)


def inside_ring(lon: Column, lat: Column, edges: Column) -> Column:
    """Crossing parity over an array of edge structs (x1, y1, x2, y2)."""
    return F.size(F.filter(edges, lambda e: crosses(lon, lat, e))) % 2 == 1


def ring_edges(ring: Column) -> Column:
    """Edges of an array of (x, y) structs, closed back to the first vertex."""
    n = F.size(ring)
    return F.transform(
        ring,
        lambda p, i: F.struct(
            p["x"].alias("x1"),
            p["y"].alias("y1"),
            F.get(ring, (i + 1) % n)["x"].alias("x2"),
            F.get(ring, (i + 1) % n)["y"].alias("y2"),
        ),
    )


def decibel_to_linear(db: Column) -> Column:
    return F.pow(F.lit(10.0), db / 10)


# fixed value: open water scatters back less than -18 dB
WATER_DB = -18.0


def is_water(sigma0: Column, threshold_db: float = WATER_DB) -> Column:
    """Valid cells darker than the threshold; null and near-zero fill are never water."""
    return F.coalesce((sigma0 > 1e-12) & (sigma0 < 10 ** (threshold_db / 10)), F.lit(False))


def satellite_mm(raw: Column, fill: float = 29999.0, scale: float = 2.4) -> Column:
    """Fill masked, tenths of mm/h to mm/day."""
    return F.when(raw < fill, raw * scale)


# fixed values: WGS84 ellipsoid and the UTM scale
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
UTM_K0 = 0.9996
UTM_FALSE_EASTING = 500000.0


def utm_to_lonlat(x: Column, y: Column, zone: Column) -> tuple[Column, Column]:
    """Inverse transverse Mercator (Snyder's series) for UTM north zones, as (lon, lat) degrees."""
    e2 = 2 * WGS84_F - WGS84_F**2
    ep2 = e2 / (1 - e2)
    root = (1 - e2) ** 0.5
    e1 = (1 - root) / (1 + root)
    east = (x - UTM_FALSE_EASTING) / UTM_K0
    mu = (y / UTM_K0) / (WGS84_A * (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256))
    foot = mu
    for k, coef in (
        (2, 3 * e1 / 2 - 27 * e1**3 / 32),
        (4, 21 * e1**2 / 16 - 55 * e1**4 / 32),
        (6, 151 * e1**3 / 96),
        (8, 1097 * e1**4 / 512),
    ):
        foot = foot + F.sin(mu * k) * coef
    w = F.lit(1.0) - F.pow(F.sin(foot), 2) * e2
    n = F.lit(WGS84_A) / F.sqrt(w)
    r = F.lit(WGS84_A * (1 - e2)) / F.pow(w, 1.5)
    t = F.pow(F.tan(foot), 2)
    c = F.pow(F.cos(foot), 2) * ep2
    d = east / n
    lat_terms = (
        F.pow(d, 2) / 2
        - (t * 3 + c * 10 - c * c * 4 + (5 - 9 * ep2)) * F.pow(d, 4) / 24
        + (t * 90 + c * 298 + t * t * 45 - c * c * 3 + (61 - 252 * ep2)) * F.pow(d, 6) / 720
    )
    lon_terms = (
        d
        - (t * 2 + c + 1) * F.pow(d, 3) / 6
        + (t * 28 + t * t * 24 - c * 2 - c * c * 3 + (5 + 8 * ep2)) * F.pow(d, 5) / 120
    )
    lat = F.degrees(foot - n * F.tan(foot) / r * lat_terms)
    lon = (zone - 1) * 6 - 177 + F.degrees(lon_terms / F.cos(foot))
    return lon, lat
