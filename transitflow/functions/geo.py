"""Spherical geometry as native Spark column expressions.

Every function returns a ``Column`` built from ``pyspark.sql.functions``, so
the maths runs inside whole-stage codegen (no Python worker in the plan).
Points are (lat, lon) in degrees; distances are metres on a sphere.

Functions come in two flavours: ``*_latlon`` helpers that take degree columns,
and vector forms (``Vec3``) so a job can compute each point's unit vector once
per row *before* a join instead of once per candidate pair.
"""

from __future__ import annotations

import math
from typing import NamedTuple, Union

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Union[Column, str]

# Fixed values (must equal the original application's for equal results):
# mean Earth radius in metres, and the corridor tolerance of the on-segment
# test in unit-sphere chord units.
EARTH_RADIUS_M = 6371000.0
ON_SEGMENT_TOLERANCE = 3.3e-7


def _c(c: ColumnOrName | float) -> Column:
    if isinstance(c, Column):
        return c
    if isinstance(c, str):
        return F.col(c)
    return F.lit(c)


class Vec3(NamedTuple):
    """Three double columns forming a 3-vector."""

    x: Column
    y: Column
    z: Column

    @staticmethod
    def of(x: ColumnOrName, y: ColumnOrName, z: ColumnOrName) -> "Vec3":
        return Vec3(_c(x), _c(y), _c(z))

    def plus(self, o: "Vec3") -> "Vec3":
        return Vec3(self.x + o.x, self.y + o.y, self.z + o.z)

    def minus(self, o: "Vec3") -> "Vec3":
        return Vec3(self.x - o.x, self.y - o.y, self.z - o.z)

    def dot(self, o: "Vec3") -> Column:
        return self.x * o.x + self.y * o.y + self.z * o.z

    def cross(self, o: "Vec3") -> "Vec3":
        return Vec3(self.y * o.z - self.z * o.y,
                    self.z * o.x - self.x * o.z,
                    self.x * o.y - self.y * o.x)

    def norm(self) -> Column:
        return F.sqrt(self.x * self.x + self.y * self.y + self.z * self.z)

    def angle_to(self, o: "Vec3", about: "Vec3 | None" = None) -> Column:
        """Angle in radians, ``atan2(|a x b|, a . b)``, from 0 to pi.  Given a
        direction ``about``, the angle is negative where the turn from this
        vector to the other is clockwise as seen from its tip."""
        normal = self.cross(o)
        size = normal.norm()
        if about is not None:
            size = F.when(normal.dot(about) < 0, -size).otherwise(size)
        return F.atan2(size, self.dot(o))

    def to_latlon(self) -> tuple[Column, Column]:
        """Direction of the vector as (lat, lon) degrees; any length."""
        lat = F.degrees(F.atan2(self.z, F.sqrt(self.x * self.x + self.y * self.y)))
        lon = F.degrees(F.atan2(self.y, self.x))
        return lat, lon

    def columns(self, prefix: str) -> list[Column]:
        return [self.x.alias(f"{prefix}x"), self.y.alias(f"{prefix}y"), self.z.alias(f"{prefix}z")]

    @staticmethod
    def named(prefix: str) -> "Vec3":
        return Vec3(F.col(f"{prefix}x"), F.col(f"{prefix}y"), F.col(f"{prefix}z"))


def nvector(lat: ColumnOrName, lon: ColumnOrName) -> Vec3:
    """Unit vector of a point: (cos lat cos lon, cos lat sin lon, sin lat)."""
    la, lo = F.radians(_c(lat)), F.radians(_c(lon))
    return Vec3(F.cos(la) * F.cos(lo), F.cos(la) * F.sin(lo), F.sin(la))


def same_point(lat1, lon1, lat2, lon2) -> Column:
    return (_c(lat1) == _c(lat2)) & (_c(lon1) == _c(lon2))


# ---- distances --------------------------------------------------------------

def distance_v(a: Vec3, b: Vec3, equal: Column) -> Column:
    """Great-circle distance in metres between unit vectors; 0 when the
    points are exactly equal in (lat, lon)."""
    return F.when(equal, F.lit(0.0)).otherwise(F.lit(EARTH_RADIUS_M) * a.angle_to(b))


def distance(lat1, lon1, lat2, lon2) -> Column:
    """Great-circle distance in metres; exactly equal points give 0."""
    return distance_v(nvector(lat1, lon1), nvector(lat2, lon2), same_point(lat1, lon1, lat2, lon2))


def haversine(lat1, lon1, lat2, lon2) -> Column:
    """Haversine great-circle distance in metres."""
    p1, p2 = F.radians(_c(lat1)), F.radians(_c(lat2))
    dlat = F.radians(_c(lat2) - _c(lat1))
    dlon = F.radians(_c(lon2) - _c(lon1))
    a = F.pow(F.sin(dlat / 2), 2) + F.pow(F.sin(dlon / 2), 2) * F.cos(p1) * F.cos(p2)
    # rounding can push a past 1 for near-antipodal points
    return F.lit(EARTH_RADIUS_M) * 2 * F.asin(F.sqrt(F.least(a, F.lit(1.0))))


# ---- point vs segment tests ---------------------------------------------------

def on_segment_v(n0: Vec3, n1: Vec3, n2: Vec3, degenerate: Column, at_start: Column,
                 tolerance: float = ON_SEGMENT_TOLERANCE) -> Column:
    """Corridor test: ``| |n0-n1| + |n0-n2| - |n2-n1| | < tolerance``.

    ``degenerate`` marks a zero-length segment (equal end points), for which
    the test is exact equality with the start point (``at_start``)."""
    gap = n0.minus(n1).norm() + n0.minus(n2).norm() - n2.minus(n1).norm()
    return F.when(degenerate, at_start).otherwise(F.abs(gap) < F.lit(tolerance))


def on_segment(lat, lon, lat1, lon1, lat2, lon2, tolerance: float = ON_SEGMENT_TOLERANCE) -> Column:
    """Is (lat, lon) inside the thin ellipsoidal corridor around the segment?"""
    return on_segment_v(nvector(lat, lon), nvector(lat1, lon1), nvector(lat2, lon2),
                        same_point(lat1, lon1, lat2, lon2), same_point(lat, lon, lat1, lon1),
                        tolerance)


def between_perpendiculars_v(n0: Vec3, n1: Vec3, n2: Vec3, degenerate: Column,
                             at_start: Column) -> Column:
    """Slab test: the point lies between the planes through each end point
    perpendicular to the chord, ``(n0-n1).(n2-n1) >= 0`` and
    ``(n0-n2).(n1-n2) >= 0``; zero-length segment means equality."""
    e1 = n0.minus(n1).dot(n2.minus(n1))
    e2 = n0.minus(n2).dot(n1.minus(n2))
    return F.when(degenerate, at_start).otherwise((e1 >= 0) & (e2 >= 0))


def between_perpendiculars(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    return between_perpendiculars_v(nvector(lat, lon), nvector(lat1, lon1), nvector(lat2, lon2),
                                    same_point(lat1, lon1, lat2, lon2),
                                    same_point(lat, lon, lat1, lon1))


# ---- projections onto the great circle -------------------------------------------

def nearest_on_circle_v(n0: Vec3, n1: Vec3, n2: Vec3) -> Vec3:
    """Nearest point to n0 on the great circle through n1, n2 (not clamped to
    the segment): ``c1 x (n0 x c1)`` with ``c1 = n1 x n2``; not normalised."""
    c1 = n1.cross(n2)
    return c1.cross(n0.cross(c1))


def nearest_point_on_circle(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    """``struct<lat double, lon double>`` of the nearest great-circle point."""
    la, lo = nearest_on_circle_v(nvector(lat, lon), nvector(lat1, lon1), nvector(lat2, lon2)).to_latlon()
    return F.struct(la.alias("lat"), lo.alias("lon"))


def along_track_v(n0: Vec3, n1: Vec3, n2: Vec3) -> Column:
    """Unsigned along-track distance in metres from the segment start to the
    projection of n0 on the great circle; 0 for a zero-length segment."""
    return F.lit(EARTH_RADIUS_M) * n1.angle_to(nearest_on_circle_v(n0, n1, n2))


def along_track(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    return along_track_v(nvector(lat, lon), nvector(lat1, lon1), nvector(lat2, lon2))


def along_track_via_nearest(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    """Older form: great-circle distance from the start to the nearest point
    expressed back in degrees (a zero-length segment measures to (0, 0))."""
    near = nearest_point_on_circle(lat, lon, lat1, lon1, lat2, lon2)
    return distance(lat1, lon1, near["lat"], near["lon"])


def cross_track(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    """Absolute cross-track distance in metres to the great circle through the
    segment; a zero-length segment measures to its point."""
    n0, n1, n2 = nvector(lat, lon), nvector(lat1, lon1), nvector(lat2, lon2)
    off = F.abs(F.lit(EARTH_RADIUS_M) * (n1.cross(n2).angle_to(n0) - F.lit(math.pi / 2)))
    return F.when(same_point(lat1, lon1, lat2, lon2), distance(lat, lon, lat1, lon1)).otherwise(off)


def cross_track_signed(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    """Cross-track distance in metres, negative to the left of the direction
    from the first end point to the second; a zero-length segment measures
    (unsigned) to its point."""
    n0, n1, n2 = nvector(lat, lon), nvector(lat1, lon1), nvector(lat2, lon2)
    off = F.lit(EARTH_RADIUS_M) * (n1.cross(n2).angle_to(n0) - F.lit(math.pi / 2))
    return F.when(same_point(lat1, lon1, lat2, lon2), distance(lat, lon, lat1, lon1)).otherwise(off)


def turn_angle(lat1, lon1, lat2, lon2, lat3, lon3) -> Column:
    """Change of direction at the second of three points, in degrees: positive
    to the left, 180 for a way straight back; null where two neighbours are the
    same point, since no direction leads from one to the other."""
    n1, n2, n3 = nvector(lat1, lon1), nvector(lat2, lon2), nvector(lat3, lon3)
    turn = F.degrees(n1.cross(n2).angle_to(n2.cross(n3), about=n2))
    still = same_point(lat1, lon1, lat2, lon2) | same_point(lat2, lon2, lat3, lon3)
    return F.when(~still, turn)


# ---- the same distances from bearings ------------------------------------------

def bearing(lat1, lon1, lat2, lon2) -> Column:
    """Initial bearing in degrees from north, clockwise, in [0, 360)."""
    p1, p2, dl = F.radians(_c(lat1)), F.radians(_c(lat2)), F.radians(_c(lon2) - _c(lon1))
    east = F.sin(dl) * F.cos(p2)
    north = F.cos(p1) * F.sin(p2) - F.sin(p1) * F.cos(p2) * F.cos(dl)
    return F.pmod(F.degrees(F.atan2(east, north)), F.lit(360.0))


def _leg(lat, lon, lat1, lon1, lat2, lon2) -> tuple[Column, Column]:
    """Arc from the first end point to the point, and its angle to the segment."""
    turn = F.radians(bearing(lat1, lon1, lat, lon) - bearing(lat1, lon1, lat2, lon2))
    return haversine(lat1, lon1, lat, lon) / F.lit(EARTH_RADIUS_M), turn


def cross_track_by_bearing(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    """Signed cross-track distance in metres (negative to the left)."""
    arc, turn = _leg(lat, lon, lat1, lon1, lat2, lon2)
    return F.lit(EARTH_RADIUS_M) * F.asin(F.sin(arc) * F.sin(turn))


def along_track_by_bearing(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    """Signed along-track distance in metres (negative behind the start)."""
    arc, turn = _leg(lat, lon, lat1, lon1, lat2, lon2)
    return F.lit(EARTH_RADIUS_M) * F.atan2(F.sin(arc) * F.cos(turn), F.cos(arc))


# ---- planar approximations in degree space ------------------------------------

# Fixed value (must equal the original's): metres per degree of the planar
# approximation.
PLANAR_METRES_PER_DEGREE = 100000.0


def planar_distance(lat1, lon1, lat2, lon2) -> Column:
    """Euclidean distance in degree space scaled to approximate metres."""
    dlat, dlon = _c(lat2) - _c(lat1), _c(lon2) - _c(lon1)
    return F.sqrt(dlat * dlat + dlon * dlon) * F.lit(PLANAR_METRES_PER_DEGREE)


def planar_projection(lat, lon, lat1, lon1, lat2, lon2) -> Column:
    """``struct<lat, lon>``: orthogonal projection of the point on the line
    through the end points, in degree space (not clamped to the segment)."""
    dlat, dlon = _c(lat2) - _c(lat1), _c(lon2) - _c(lon1)
    t = (dlat * (_c(lat) - _c(lat1)) + dlon * (_c(lon) - _c(lon1))) / (dlat * dlat + dlon * dlon)
    return F.struct((_c(lat1) + dlat * t).alias("lat"), (_c(lon1) + dlon * t).alias("lon"))
