"""Column functions: JSON path values, safe casts, timestamps, unit codes,
WKB geopoints."""

from pluvio.functions.geo import geog_point_wkb, wkb_latitude, wkb_longitude
from pluvio.functions.json import iso_timestamp, json_value, safe_double, strip_unit

__all__ = [
    "geog_point_wkb",
    "iso_timestamp",
    "json_value",
    "safe_double",
    "strip_unit",
    "wkb_latitude",
    "wkb_longitude",
]
