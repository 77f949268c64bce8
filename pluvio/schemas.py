"""Table schemas: landing envelope, bronze, silver fact, silver station dimension.

Column descriptions are kept as column comments (``StructField`` metadata), so they
show up in ``DESCRIBE`` of catalog tables created from these schemas.
"""

from __future__ import annotations

from pyspark.sql import types as T


# Column descriptions, as declared for the three tables
# (same text wherever a column name repeats), in table column order.
COMMENTS = {
    "_record_id": "Unique identifier for the record",
    "raw_response_json": "Raw JSON response from the NOAA API",
    "_job_id": "ID of the data ingestion job",
    "_trace_id": "ID of the trace that triggered the job",
    "_record_created_at": "Record creation timestamp",
    "_record_updated_at": "Record update timestamp",
    "noaa_station_id": "NOAA station ID",
    "noaa_station_name": "Name of the NOAA station",
    "noaa_station_latitude": "Latitude of the NOAA station",
    "noaa_station_longitude": "Longitude of the NOAA station",
    "noaa_station_geopoint": "Geographical point of the NOAA station",
    "noaa_station_elevation_m": "Elevation of the NOAA station in meters",
    "noaa_record_id": "NOAA record ID",
    "hourly_precip_timestamp": "Timestamp of the hourly precipitation observation",
    "hourly_precip_value": "Precipitation value",
    "hourly_precip_unit": "Unit of the precipitation value",
    "hourly_precip_qc": "Quality control flag for the precipitation value",
}


def _f(name: str, dtype: T.DataType) -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": COMMENTS[name]})


# Partition columns (derived, UTC day). The reference partitions by an expression;
# a Parquet table needs a physical column, which readers drop.
BRONZE_PARTITION = "created_date"
# Bronze is also partitioned by the load, so that a load that is run again replaces its own rows.
BRONZE_PARTITIONS = [BRONZE_PARTITION, "_job_id"]
FACT_PARTITION = "observed_date"
DIM_PARTITION = "created_date"

# Landing envelope: one JSON object per line, {"trace_id": ..., "observations": {"features": [...]}}.
ENVELOPE_DDL = (
    "trace_id STRING, observations STRUCT<features: ARRAY<VARIANT>>, _corrupt_record STRING"
)

BRONZE = T.StructType(
    [
        _f("_record_id", T.StringType()),
        _f("raw_response_json", T.VariantType()),
        _f("_job_id", T.StringType()),
        _f("_trace_id", T.StringType()),
        _f("_record_created_at", T.TimestampType()),
        _f("_record_updated_at", T.TimestampType()),
    ]
)

FACT = T.StructType(
    [
        _f("_record_id", T.StringType()),
        _f("noaa_station_id", T.StringType()),
        _f("noaa_record_id", T.StringType()),
        _f("hourly_precip_timestamp", T.TimestampType()),
        _f("hourly_precip_value", T.DoubleType()),
        _f("hourly_precip_unit", T.StringType()),
        _f("hourly_precip_qc", T.StringType()),
        _f("_job_id", T.StringType()),
        _f("_trace_id", T.StringType()),
        _f("_record_created_at", T.TimestampType()),
        _f("_record_updated_at", T.TimestampType()),
    ]
)

# The point is stored as WKB (binary); GEOGRAPHY cannot be written to Parquet.
DIM = T.StructType(
    [
        _f("_record_id", T.StringType()),
        _f("noaa_station_id", T.StringType()),
        _f("noaa_station_name", T.StringType()),
        _f("noaa_station_latitude", T.DoubleType()),
        _f("noaa_station_longitude", T.DoubleType()),
        _f("noaa_station_geopoint", T.BinaryType()),
        _f("noaa_station_elevation_m", T.DoubleType()),
        _f("_job_id", T.StringType()),
        _f("_trace_id", T.StringType()),
        _f("_record_created_at", T.TimestampType()),
        _f("_record_updated_at", T.TimestampType()),
    ]
)

FACT_COLUMNS = [f.name for f in FACT.fields]
DIM_COLUMNS = [f.name for f in DIM.fields]
BRONZE_COLUMNS = [f.name for f in BRONZE.fields]

# MERGE keys and the columns each MERGE branch sets (silver jobs).
FACT_KEY = "noaa_record_id"
FACT_UPDATE_COLUMNS = [
    "_record_id",
    "noaa_station_id",
    "hourly_precip_timestamp",
    "hourly_precip_value",
    "hourly_precip_unit",
    "hourly_precip_qc",
    "_job_id",
    "_trace_id",
]
FACT_INSERT_COLUMNS = [
    "_record_id",
    "noaa_station_id",
    "noaa_record_id",
    "hourly_precip_timestamp",
    "hourly_precip_value",
    "hourly_precip_unit",
    "hourly_precip_qc",
    "_job_id",
    "_trace_id",
]

DIM_KEY = "noaa_station_id"
DIM_UPDATE_COLUMNS = [
    "_record_id",
    "noaa_station_id",
    "noaa_station_name",
    "noaa_station_longitude",
    "noaa_station_latitude",
    "noaa_station_geopoint",
    "noaa_station_elevation_m",
    "_job_id",
    "_trace_id",
]
DIM_INSERT_COLUMNS = list(DIM_UPDATE_COLUMNS)


def empty(spark, schema: T.StructType):
    """An empty DataFrame of a table schema (first run, tests)."""
    return spark.createDataFrame([], schema)
