"""Typed views of bronze rows: the fact columns and the station columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.functions import geog_point_wkb, iso_timestamp, json_value, safe_double, strip_unit

DOC = "raw_response_json"


def parse_fact(
    bronze: DataFrame, *, on_bad_timestamp: str = "fail", doc: str = DOC, keep: Sequence[str] = ()
) -> DataFrame:
    """One typed observation per bronze row (no dedupe, no filter).

    Output: ``_record_id, _record_updated_at, noaa_station_id, noaa_record_id,
    hourly_precip_timestamp, hourly_precip_value, hourly_precip_unit,
    hourly_precip_qc`` plus the ``keep`` columns passed through.
    """
    d = F.col(doc)
    kept = [*keep, "_record_id", "_record_updated_at", "noaa_station_id", "noaa_record_id"]
    # the texts first, each once: the typed columns below name theirs several times
    texts = bronze.select(
        *keep,
        "_record_id",
        "_record_updated_at",
        json_value(d, "properties.stationId").alias("noaa_station_id"),
        json_value(d, "id").alias("noaa_record_id"),
        json_value(d, "properties.timestamp").alias("hourly_precip_timestamp"),
        json_value(d, "properties.precipitationLastHour.value").alias("hourly_precip_value"),
        json_value(d, "properties.precipitationLastHour.unitCode").alias("hourly_precip_unit"),
        json_value(d, "properties.precipitationLastHour.qualityControl").alias("hourly_precip_qc"),
    )
    return texts.select(
        *kept,
        iso_timestamp("hourly_precip_timestamp", on_bad_timestamp).alias("hourly_precip_timestamp"),
        safe_double("hourly_precip_value").alias("hourly_precip_value"),
        strip_unit("hourly_precip_unit").alias("hourly_precip_unit"),
        "hourly_precip_qc",
    )


def routine_reports(df: DataFrame, minute: int = 54, ts_col: str = "hourly_precip_timestamp") -> DataFrame:
    """Keep the routine hourly reports (observation minute == ``minute``, UTC).

    Apply it *after* ``latest_per_key``: a record whose newest version is not at
    the routine minute is dropped even when an older version was.
    NULL timestamps fail the predicate.
    """
    return df.filter(F.minute(F.col(ts_col)) == F.lit(minute))


def parse_dim(
    bronze: DataFrame, *, doc: str = DOC, with_geopoint: bool = True, keep: Sequence[str] = ()
) -> DataFrame:
    """Station attributes of each bronze row (coordinates are [lon, lat])."""
    d = F.col(doc)
    lon = safe_double(json_value(d, "geometry.coordinates[0]"))
    lat = safe_double(json_value(d, "geometry.coordinates[1]"))
    cols = [
        *keep,
        "_record_id",
        "_record_updated_at",
        json_value(d, "properties.stationId").alias("noaa_station_id"),
        json_value(d, "properties.stationName").alias("noaa_station_name"),
        lon.alias("noaa_station_longitude"),
        lat.alias("noaa_station_latitude"),
    ]
    out = bronze.select(
        *cols,
        safe_double(json_value(d, "properties.elevation.value")).alias("noaa_station_elevation_m"),
    )
    if with_geopoint:
        out = out.withColumn(
            "noaa_station_geopoint",
            geog_point_wkb(F.col("noaa_station_longitude"), F.col("noaa_station_latitude")),
        )
    return out
