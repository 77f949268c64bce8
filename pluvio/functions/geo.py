"""Geographic point as WKB.

Spark 4.1 has no point constructor and cannot write GEOGRAPHY to Parquet, so the
point is stored as 21-byte little-endian WKB (byte order, geometry type 1, x=lon,
y=lat); ``st_geogfromwkb`` turns it into GEOGRAPHY in a view where the geospatial
flag is enabled. Packing IEEE doubles into bytes has no built-in expression, so
this is the one vectorised (Arrow) UDF of the library.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# WKB header for a little-endian 2D point.
WKB_LITTLE_ENDIAN = 1
WKB_POINT = 1
_HEADER = np.dtype([("order", "u1"), ("type", "<u4"), ("x", "<f8"), ("y", "<f8")])


def _wrap_longitude(lon: np.ndarray) -> np.ndarray:
    out = lon.copy()
    outside = (out < -180.0) | (out > 180.0)
    out[outside] = np.mod(out[outside] + 180.0, 360.0) - 180.0
    return out


def pack_points(lon: pd.Series, lat: pd.Series) -> pd.Series:
    """Vectorised packing used by the UDF (plain pandas in, pandas out)."""
    lon_v = lon.to_numpy(dtype="float64", na_value=np.nan)
    lat_v = lat.to_numpy(dtype="float64", na_value=np.nan)
    missing = lon.isna().to_numpy() | lat.isna().to_numpy()
    ok = ~missing
    bad_lat = ok & ~(np.abs(np.where(ok, lat_v, 0.0)) <= 90.0)
    if bad_lat.any():
        raise ValueError(f"latitude must be within [-90, 90], got {lat_v[bad_lat][0]!r}")
    bad_lon = ok & ~np.isfinite(np.where(ok, lon_v, 0.0))
    if bad_lon.any():
        raise ValueError(f"longitude must be finite, got {lon_v[bad_lon][0]!r}")
    rec = np.zeros(len(lon_v), dtype=_HEADER)
    rec["order"] = WKB_LITTLE_ENDIAN
    rec["type"] = WKB_POINT
    rec["x"] = _wrap_longitude(np.where(ok, lon_v, 0.0))
    rec["y"] = np.where(ok, lat_v, 0.0)
    raw = rec.tobytes()
    size = _HEADER.itemsize
    out = [None if missing[i] else raw[i * size : (i + 1) * size] for i in range(len(rec))]
    return pd.Series(out, index=lon.index, dtype=object)


def unpack_coordinate(wkb: pd.Series, which: str) -> pd.Series:
    vals = np.full(len(wkb), np.nan)
    present = wkb.notna().to_numpy()
    if present.any():
        rec = np.frombuffer(b"".join(wkb[present].tolist()), dtype=_HEADER)
        vals[present] = rec[which]
    return pd.Series(vals, index=wkb.index).where(present, None)


@F.pandas_udf(T.BinaryType())
def _geog_point_wkb(lon: pd.Series, lat: pd.Series) -> pd.Series:
    return pack_points(lon, lat)


@F.pandas_udf(T.DoubleType())
def _wkb_x(wkb: pd.Series) -> pd.Series:
    return unpack_coordinate(wkb, "x")


@F.pandas_udf(T.DoubleType())
def _wkb_y(wkb: pd.Series) -> pd.Series:
    return unpack_coordinate(wkb, "y")


def geog_point_wkb(lon, lat) -> Column:
    """Point(lon, lat) as WKB; NULL if either is NULL; |lat| > 90 is an error;
    longitude outside [-180, 180] is wrapped."""
    lon = F.col(lon) if isinstance(lon, str) else lon
    lat = F.col(lat) if isinstance(lat, str) else lat
    return _geog_point_wkb(lon.cast("double"), lat.cast("double"))


def wkb_longitude(wkb) -> Column:
    return _wkb_x(F.col(wkb) if isinstance(wkb, str) else wkb)


def wkb_latitude(wkb) -> Column:
    return _wkb_y(F.col(wkb) if isinstance(wkb, str) else wkb)
