"""Fixed schemas of the cleaned tables, the raw text files and the GPS feed."""

from pyspark.sql import types as T

S, I, L, D, FL = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType(), T.FloatType()


def _struct(*fields):
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


# ---- cleaned output tables ------------------------------------------------
FARES = _struct(("id", S), ("price", FL), ("transfers", I), ("transfer_duration", I))
ROUTES = _struct(("id", S), ("code", S), ("name", S), ("description", S),
                 ("dest1", S), ("dest2", S), ("color", S), ("fare_id", S))
SHAPES = _struct(("id", S), ("sequence", L), ("lat1", D), ("lon1", D),
                 ("lat2", D), ("lon2", D), ("dist", D), ("total_dist", D))
STOPS = _struct(("id", S), ("code", S), ("name", S), ("info", S), ("lat", D), ("lon", D))
TRIPS = _struct(("id", L), ("route_id", S), ("direction", I), ("headsign", S), ("shape_id", S))
STOP_TIMES = _struct(("trip_id", L), ("stop_id", S), ("sequence", I), ("shape_id", S))
TRIP_STOPS = _struct(("trip_id", L), ("stop_id", S), ("sequence", I), ("dist", D))
GPS = _struct(("datetime", T.TimestampNTZType()), ("serial_number", S), ("route_code", S),
              ("lat", D), ("lon", D), ("vel", D), ("direction", S))

# ---- raw text inputs: full-width, positional (pad columns hold a position) --
CORRUPT = "_corrupt_record"


def _raw(*fields):
    return _struct(*fields, (CORRUPT, S))


RAW_FARE_ATTRIBUTES = _raw(("pad0", S), ("fare_id", S), ("price", FL), ("pad3", S), ("pad4", S),
                           ("transfers", I), ("transfer_duration", I))
RAW_FARE_RULES = _raw(("fare_id", S), ("route_id", S))
RAW_ROUTES = _raw(("route_id", S), ("pad1", S), ("code", S), ("name", S), ("description", S),
                  ("pad5", S), ("pad6", S), ("color", S))
RAW_SHAPES = _raw(("shape_id", S), ("lat", D), ("lon", D), ("sequence", I))
RAW_STOPS = _raw(("id", S), ("code", S), ("name", S), ("info", S), ("lat", D), ("lon", D))
RAW_TRIPS = _raw(("route_id", S), ("service_id", S), ("trip_id", L), ("headsign", S),
                 ("direction", I), ("pad5", S), ("shape_id", S))
RAW_STOP_TIMES = _raw(("trip_id", L), ("pad1", S), ("pad2", S), ("stop_id", S), ("sequence", I))

# ---- GPS feed document -----------------------------------------------------
GPS_DOCUMENT = _struct(("DATA", T.ArrayType(T.ArrayType(S))))
