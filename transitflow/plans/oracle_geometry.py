"""Geometry of the reference SQL, written apart from the library's formulas.

Where a quantity has more than one formula, this module takes another one
than the library does: lengths from chords (``2 R asin(c / 2)``), projections
by taking the normal component away, offsets from the sine of the angle to the
normal.  Nothing here comes from ``transitflow.functions``.
"""

from __future__ import annotations

EARTH_M = "6371000e0"
CORRIDOR = "3.3e-7"


def xyz(lat: str, lon: str) -> list[str]:
    return [f"cos(radians({lat})) * cos(radians({lon}))", f"cos(radians({lat})) * sin(radians({lon}))", f"sin(radians({lat}))"]


def chord(a: list[str], b: list[str]) -> str:
    return "sqrt(" + " + ".join(f"pow(({p}) - ({q}), 2)" for p, q in zip(a, b, strict=True)) + ")"


def inner(a: list[str], b: list[str]) -> str:
    return "(" + " + ".join(f"({p}) * ({q})" for p, q in zip(a, b, strict=True)) + ")"


def normal(a: list[str], b: list[str]) -> list[str]:
    """Unit normal of the plane through two directions."""
    raw = [f"(({a[(i + 1) % 3]}) * ({b[(i + 2) % 3]}) - ({a[(i + 2) % 3]}) * ({b[(i + 1) % 3]}))" for i in range(3)]
    size = "sqrt(" + " + ".join(f"pow({r}, 2)" for r in raw) + ")"
    return [f"({r} / {size})" for r in raw]


def same(lat1: str, lon1: str, lat2: str, lon2: str) -> str:
    return f"({lat1} = {lat2} and {lon1} = {lon2})"


def arc(a: list[str], b: list[str]) -> str:
    return f"({EARTH_M} * 2 * asin(least(1e0, {chord(a, b)} / 2)))"


def dist_sql(lat1, lon1, lat2, lon2) -> str:
    return f"(case when {same(lat1, lon1, lat2, lon2)} then 0e0 else {arc(xyz(lat1, lon1), xyz(lat2, lon2))} end)"


def haversine_sql(lat1, lon1, lat2, lon2) -> str:
    return arc(xyz(lat1, lon1), xyz(lat2, lon2))


def on_segment_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    p, a, b = xyz(lat, lon), xyz(lat1, lon1), xyz(lat2, lon2)
    return (f"(case when {same(lat1, lon1, lat2, lon2)} then {same(lat, lon, lat1, lon1)} "
            f"else abs({chord(p, a)} + {chord(p, b)} - {chord(a, b)}) < {CORRIDOR} end)")


def between_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    """Neither angle at an end is obtuse: by the cosine rule on the chords."""
    p, a, b = xyz(lat, lon), xyz(lat1, lon1), xyz(lat2, lon2)
    side = [f"(({q}) - ({r}))" for q, r in zip(b, a, strict=True)]
    t = inner([f"(({x}) - ({y}))" for x, y in zip(p, a, strict=True)], side)
    return (f"(case when {same(lat1, lon1, lat2, lon2)} then {same(lat, lon, lat1, lon1)} "
            f"else {t} between 0 and {inner(side, side)} end)")


def _foot(p: list[str], a: list[str], b: list[str]) -> list[str]:
    """The direction p without its part along the normal of a and b, unit."""
    n = normal(a, b)
    h = inner(p, n)
    raw = [f"(({x}) - {h} * {y})" for x, y in zip(p, n, strict=True)]
    return [f"({r} / sqrt(1 - pow({h}, 2)))" for r in raw]


def along_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    p, a, b = xyz(lat, lon), xyz(lat1, lon1), xyz(lat2, lon2)
    return f"(case when {same(lat1, lon1, lat2, lon2)} then 0e0 else {arc(a, _foot(p, a, b))} end)"


def nearest_latlon_sql(lat, lon, lat1, lon1, lat2, lon2) -> tuple[str, str]:
    f = _foot(xyz(lat, lon), xyz(lat1, lon1), xyz(lat2, lon2))
    return f"degrees(asin({f[2]}))", f"degrees(atan2({f[1]}, {f[0]}))"


def signed_cross_track_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    p, a, b = xyz(lat, lon), xyz(lat1, lon1), xyz(lat2, lon2)
    return (f"(case when {same(lat1, lon1, lat2, lon2)} then {dist_sql(lat, lon, lat1, lon1)} "
            f"else -{EARTH_M} * asin({inner(p, normal(a, b))}) end)")


def signed_along_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    """Angle from the start, measured in the segment's plane toward its end."""
    p, a, b = xyz(lat, lon), xyz(lat1, lon1), xyz(lat2, lon2)
    n = normal(a, b)
    ahead = [f"(({n[(i + 1) % 3]}) * ({a[(i + 2) % 3]}) - ({n[(i + 2) % 3]}) * ({a[(i + 1) % 3]}))" for i in range(3)]
    return f"({EARTH_M} * atan2({inner(p, ahead)}, {inner(p, a)}))"


def cross_track_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    return f"abs{signed_cross_track_sql(lat, lon, lat1, lon1, lat2, lon2)}"


def near_side_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    p, a, b = xyz(lat, lon), xyz(lat1, lon1), xyz(lat2, lon2)
    return f"({inner(p, a)} + {inner(p, b)} > 0)"


def planar_distance_sql(lat1, lon1, lat2, lon2) -> str:
    return f"(100000e0 * sqrt(pow({lat1} - {lat2}, 2) + pow({lon1} - {lon2}, 2)))"


def planar_projection_sql(lat, lon, lat1, lon1, lat2, lon2) -> tuple[str, str]:
    """Foot of the perpendicular, measured from the second end point."""
    u, v = f"({lat1} - {lat2})", f"({lon1} - {lon2})"
    t = f"(({u} * ({lat} - {lat2}) + {v} * ({lon} - {lon2})) / (pow({u}, 2) + pow({v}, 2)))"
    return f"({lat2} + {u} * {t})", f"({lon2} + {v} * {t})"


def line_code_sql(c: str) -> str:
    return (f"(case when length({c}) < 3 then '' when length({c}) = 3 then regexp_replace('00' || {c}, '[.].*', '') "
            f"when length({c}) = 4 then regexp_replace('0' || {c}, '[.].*', '') else regexp_replace({c}, '[.].*', '') end)")


def course_sql(lat1, lon1, lat2, lon2) -> str:
    """Direction at the first point toward the second, in degrees from north."""
    return (f"degrees(atan2(sin(radians({lon2} - {lon1})) * cos(radians({lat2})), "
            f"cos(radians({lat1})) * sin(radians({lat2})) - "
            f"sin(radians({lat1})) * cos(radians({lat2})) * cos(radians({lon2} - {lon1}))))")


def turn_sql(lat0, lon0, lat1, lon1, lat2, lon2) -> str:
    """Course held before the middle point less the one after it, in (-180, 180]."""
    left = f"({course_sql(lat1, lon1, lat0, lon0)} + 180e0 - {course_sql(lat1, lon1, lat2, lon2)})"
    turn = f"round({left} - 360e0 * round({left} / 360e0), 2)"
    return f"(case when {turn} = -180e0 then 180e0 else {turn} + 0e0 end)"
