from .geo import (EARTH_RADIUS_M, ON_SEGMENT_TOLERANCE, Vec3, along_track, along_track_v,
                  along_track_via_nearest, between_perpendiculars, cross_track, distance,
                  haversine, nearest_point_on_circle, nvector, on_segment, on_segment_v)
from .text import (decode_feed_escapes, format_bus_line, gps_record_text, keep_short_code,
                   line_group, parse_feed_timestamp, route_destination, stop_key)

__all__ = [
    "EARTH_RADIUS_M", "ON_SEGMENT_TOLERANCE", "Vec3", "along_track", "along_track_v",
    "along_track_via_nearest", "between_perpendiculars", "cross_track", "distance", "haversine",
    "nearest_point_on_circle", "nvector", "on_segment", "on_segment_v", "decode_feed_escapes",
    "format_bus_line", "gps_record_text", "keep_short_code", "line_group", "parse_feed_timestamp",
    "route_destination", "stop_key",
]
