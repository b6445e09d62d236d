"""Geometry and line-code formulas as SQL text.

The same formulas as the column functions in :mod:`.geo` and :mod:`.text`,
written once as SQL so they can back SQL-callable functions
(``CREATE TEMPORARY FUNCTION ... RETURN <expr>``, inlined by Spark into
native expressions) and run in other SQL engines.
"""

from __future__ import annotations

R = "6371000e0"
TOL = "3.3e-7"


def nvec(lat: str, lon: str) -> tuple[str, str, str]:
    return (f"(cos(radians({lat})) * cos(radians({lon})))",
            f"(cos(radians({lat})) * sin(radians({lon})))",
            f"sin(radians({lat}))")


def _minus(a, b):
    return tuple(f"({x} - {y})" for x, y in zip(a, b))


def _dot(a, b):
    return "(" + " + ".join(f"{x} * {y}" for x, y in zip(a, b)) + ")"


def _cross(a, b):
    return (f"({a[1]} * {b[2]} - {a[2]} * {b[1]})", f"({a[2]} * {b[0]} - {a[0]} * {b[2]})",
            f"({a[0]} * {b[1]} - {a[1]} * {b[0]})")


def _norm(a):
    return f"sqrt({_dot(a, a)})"


def _angle(a, b):
    return f"atan2({_norm(_cross(a, b))}, {_dot(a, b)})"


def dist_sql(lat1, lon1, lat2, lon2) -> str:
    a, b = nvec(lat1, lon1), nvec(lat2, lon2)
    return f"(case when {lat1} = {lat2} and {lon1} = {lon2} then 0e0 else {R} * {_angle(a, b)} end)"


def on_segment_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    n0, n1, n2 = nvec(lat, lon), nvec(lat1, lon1), nvec(lat2, lon2)
    gap = f"{_norm(_minus(n0, n1))} + {_norm(_minus(n0, n2))} - {_norm(_minus(n2, n1))}"
    return (f"(case when {lat1} = {lat2} and {lon1} = {lon2} then ({lat} = {lat1} and {lon} = {lon1}) "
            f"else abs({gap}) < {TOL} end)")


def between_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    n0, n1, n2 = nvec(lat, lon), nvec(lat1, lon1), nvec(lat2, lon2)
    e1 = _dot(_minus(n0, n1), _minus(n2, n1))
    e2 = _dot(_minus(n0, n2), _minus(n1, n2))
    return (f"(case when {lat1} = {lat2} and {lon1} = {lon2} then ({lat} = {lat1} and {lon} = {lon1}) "
            f"else ({e1} >= 0 and {e2} >= 0) end)")


def _nearest(lat, lon, lat1, lon1, lat2, lon2):
    n0, n1, n2 = nvec(lat, lon), nvec(lat1, lon1), nvec(lat2, lon2)
    c1 = _cross(n1, n2)
    return n1, _cross(c1, _cross(n0, c1))


def along_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    n1, n = _nearest(lat, lon, lat1, lon1, lat2, lon2)
    return f"({R} * {_angle(n1, n)})"


def nearest_latlon_sql(lat, lon, lat1, lon1, lat2, lon2) -> tuple[str, str]:
    _, n = _nearest(lat, lon, lat1, lon1, lat2, lon2)
    return (f"degrees(atan2({n[2]}, sqrt({n[0]} * {n[0]} + {n[1]} * {n[1]})))",
            f"degrees(atan2({n[1]}, {n[0]}))")


def haversine_sql(lat1, lon1, lat2, lon2) -> str:
    a = (f"pow(sin(radians({lat2} - {lat1}) / 2), 2) + pow(sin(radians({lon2} - {lon1}) / 2), 2)"
         f" * cos(radians({lat1})) * cos(radians({lat2}))")
    return f"({R} * 2 * asin(sqrt(least({a}, 1e0))))"


def cross_track_sql(lat, lon, lat1, lon1, lat2, lon2) -> str:
    n0, n1, n2 = nvec(lat, lon), nvec(lat1, lon1), nvec(lat2, lon2)
    off = f"abs({R} * ({_angle(_cross(n1, n2), n0)} - pi() / 2))"
    return (f"(case when {lat1} = {lat2} and {lon1} = {lon2} then {dist_sql(lat, lon, lat1, lon1)} "
            f"else {off} end)")


def line_code_sql(c: str) -> str:
    return (f"(case when length({c}) <= 2 then '' else split_part(concat(case length({c}) when 3 then '00' "
            f"when 4 then '0' else '' end, {c}), '.', 1) end)")


def planar_distance_sql(lat1, lon1, lat2, lon2) -> str:
    return f"(sqrt(({lat2} - {lat1}) * ({lat2} - {lat1}) + ({lon2} - {lon1}) * ({lon2} - {lon1})) * 100000e0)"


def planar_projection_sql(lat, lon, lat1, lon1, lat2, lon2) -> tuple[str, str]:
    dla, dlo = f"({lat2} - {lat1})", f"({lon2} - {lon1})"
    t = f"(({dla} * ({lat} - {lat1}) + {dlo} * ({lon} - {lon1})) / ({dla} * {dla} + {dlo} * {dlo}))"
    return f"({lat1} + {dla} * {t})", f"({lon1} + {dlo} * {t})"
