"""Column expressions on positions (degrees) and distances (metres)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EARTH_M = 6_371_000.0
WALK_M_PER_MIN, WALK_DETOUR = 75.0, 1.2


def haversine_m(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Great-circle distance; null if any input is."""
    half_lat = F.sin(F.radians(lat2 - lat1) / 2)
    half_lon = F.sin(F.radians(lon2 - lon1) / 2)
    h = half_lat * half_lat + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * half_lon * half_lon
    # not least(1, ...), which a null doesn't reach
    return 2 * EARTH_M * F.asin(F.when(h > 1, 1.0).otherwise(F.sqrt(h)))


def grid_cell(degrees: Column, size: float) -> Column:
    """Number of the grid cell of one coordinate."""
    return F.floor(degrees / F.lit(size)).cast("long")


def walk_minutes(metres: Column) -> Column:
    return metres * WALK_DETOUR / WALK_M_PER_MIN


def transfer_seconds(metres: Column) -> Column:
    """Two minutes and a walk at a metre a second, in whole minutes."""
    return (F.ceil((F.lit(120) + metres) / 60) * 60).cast("long")


def side(ax: Column, ay: Column, bx: Column, by: Column, px: Column, py: Column) -> Column:
    """Twice the signed area of a, b, p."""
    return (bx - ax) * (py - ay) - (by - ay) * (px - ax)


def segments_cross(a: tuple, b: tuple, c: tuple, d: tuple) -> Column:
    """Whether segments a-b and c-d cross in the inside of both; points are (x, y) columns."""
    ab = F.signum(side(*a, *b, *c)) * F.signum(side(*a, *b, *d))
    cd = F.signum(side(*c, *d, *a)) * F.signum(side(*c, *d, *b))
    return (ab < 0) & (cd < 0)


def in_box(lat: Column, lon: Column, south: float, west: float, north: float, east: float, closed: bool = True) -> Column:
    if closed:
        return lat.between(south, north) & lon.between(west, east)
    return (lat > south) & (lat < north) & (lon > west) & (lon < east)
