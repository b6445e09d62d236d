"""Text and key functions as native Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .geo import ColumnOrName, _c

# Fixed values (must equal the original application's for equal results):
# feed time format, the line-group pattern and the record text layout.
FEED_TIME_FORMAT = "MM-dd-yyyy HH:mm:ss"
# the same layout as a pattern; parsing also accepts an optional fraction of
# a second (up to microseconds)
_FEED_TIME_RE = r"^(\d{2})-(\d{2})-(\d{4}) (\d{2}:\d{2}:\d{2}(?:\.\d{1,6})?)$"
LINE_GROUP_PATTERN = r"\bBRS?\b (([ABCDI0-9])+, ?)+([A-Za-z0-9 -])+"
FEED_ESCAPES = (("%22", '"'), ("%20", " "), ("%5B", "["), ("%5D", "]"))


def format_bus_line(c: ColumnOrName) -> Column:
    """Normalise a feed line code: length <= 2 gives ''; a 3-character code
    gets '00' in front and a 4-character one '0'; then cut at the first '.'.
    ``'123' -> '00123'``, ``'12.0' -> '012'``, ``'123.0' -> '123'``."""
    c = _c(c)
    n = F.length(c)
    pad = F.when(n == 3, F.lit("00")).when(n == 4, F.lit("0")).otherwise(F.lit(""))
    return F.when(n <= 2, F.lit("")).otherwise(F.substring_index(F.concat(pad, c), ".", 1))


def parse_feed_timestamp(c: ColumnOrName) -> Column:
    """``MM-dd-yyyy HH:mm:ss[.ffffff]`` text -> timestamp without zone; null
    when the text is not a valid date-time (garbage, Feb 31).

    Zone-free: the text is reordered to ISO and cast straight to
    ``timestamp_ntz``, so the session time zone (and its DST gaps) never
    touches the wall-clock value."""
    c = _c(c)
    iso = F.regexp_replace(c, _FEED_TIME_RE, "$3-$1-$2 $4")
    return F.when(c.rlike(_FEED_TIME_RE), iso.try_cast("timestamp_ntz"))


def route_destination(name: ColumnOrName, k: int) -> Column:
    """Token ``k`` (0-based) of the route name split on '-', trimmed; null
    when the name has too few tokens.  Trailing empty tokens do not count,
    as with Java's ``String.split``."""
    toks = F.split(F.regexp_replace(_c(name), "-+$", ""), "-")
    return F.trim(F.get(toks, F.lit(k)))


def stop_key(lat: ColumnOrName, lon: ColumnOrName) -> Column:
    """Stable stop key: lower-case hex MD5 of ``"<lat>,<lon>"`` text."""
    return F.md5(F.concat(_c(lat).cast("string"), F.lit(","), _c(lon).cast("string")))


def line_group(c: ColumnOrName) -> Column:
    """First match of the BRT/BRS line-group pattern ('' when none)."""
    return F.regexp_extract(_c(c), LINE_GROUP_PATTERN, 0)


def decode_feed_escapes(c: ColumnOrName) -> Column:
    """Undo the four URL escapes the feed text may carry."""
    out = _c(c)
    for enc, dec in FEED_ESCAPES:
        out = F.replace(out, F.lit(enc), F.lit(dec))
    return out


def gps_record_text(datetime, serial, route_code, lat, lon, vel, direction) -> Column:
    """One-line text form ``H: ...|S:...|L:...|P:(lat,lon)|V:...|D:...``."""
    s = lambda c: _c(c).cast("string")
    return F.concat(F.lit("H: "), s(datetime), F.lit("|S:"), s(serial), F.lit("|L:"), s(route_code),
                    F.lit("|P:("), s(lat), F.lit(","), s(lon), F.lit(")|V:"), s(vel),
                    F.lit("|D:"), s(direction))


def keep_short_code(code: ColumnOrName, max_len: int = 18) -> Column:
    """Stop code kept only when non-empty and at most ``max_len`` characters
    (20 with the two quote characters the original counted); else ''."""
    code = _c(code)
    n = F.length(code)
    return F.when((n > 0) & (n <= max_len), code).otherwise(F.lit(""))
