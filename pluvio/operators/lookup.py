"""Observation and station lookups over the tables (the API's query parameters,
answered from bronze/silver instead of over the network)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.operators.numbering import number_rows


def _given(v) -> bool:
    """A falsy parameter is omitted; a Column is always given."""
    return isinstance(v, Column) or bool(v)


def _ts(v):
    return F.lit(v).cast("timestamp") if isinstance(v, (str, dt.datetime)) else v


def observations(
    df: DataFrame,
    station_id: str,
    start=None,
    end=None,
    limit: int | None = None,
    *,
    station_col: str = "noaa_station_id",
    ts_col: str = "hourly_precip_timestamp",
    id_col: str = "noaa_record_id",
    day_col: str = "observed_date",
) -> DataFrame:
    """Observations of one station; optional inclusive bounds; optional newest-first cap.

    A falsy parameter is omitted. Bounds are pushed into the Parquet scan, and
    over the fact table (``day_col`` = UTC day of ``ts_col``, its partition
    column) the implied day bounds prune whole partitions. The capped form is
    a top-k (``TakeOrderedAndProject``), not a full sort.
    """
    out = df.filter(F.col(station_col) == F.lit(station_id))
    by_day = day_col in df.columns
    if _given(start):
        out = out.filter(F.col(ts_col) >= _ts(start))
        if by_day:
            out = out.filter(F.col(day_col) >= F.to_date(_ts(start)))
    if _given(end):
        out = out.filter(F.col(ts_col) <= _ts(end))
        if by_day:
            out = out.filter(F.col(day_col) <= F.to_date(_ts(end)))
    if limit:
        out = out.orderBy(F.col(ts_col).desc_nulls_last(), F.col(id_col).asc()).limit(int(limit))
    return out


def last_day(
    df: DataFrame,
    station_id: str,
    now=None,
    limit: int | None = None,
    **kwargs,
) -> DataFrame:
    """Observations of the last 24 hours up to ``now`` (default: the current time),
    the default window of an extract run."""
    end = _ts(now) if now is not None else F.current_timestamp()
    start = end - F.expr("INTERVAL 1 DAY")
    return observations(df, station_id, start, end, limit, **kwargs)


def station(df: DataFrame, station_id: str, *, key: str = "noaa_station_id") -> DataFrame:
    """One station by id."""
    return df.filter(F.col(key) == F.lit(station_id))


def stations_page(
    df: DataFrame,
    id: str | None = None,
    state: str | None = None,
    limit: int = 500,
    cursor: str | None = None,
    *,
    key: str = "noaa_station_id",
    state_col: str = "state",
) -> DataFrame:
    """A page of stations in key order (keyset paging: ``key > cursor``).

    The next cursor is the last key of the page (:func:`next_cursor`).
    """
    out = df
    if id:
        out = out.filter(F.col(key) == F.lit(id))
    if state:
        out = out.filter(F.col(state_col) == F.lit(state))
    if cursor:
        out = out.filter(F.col(key) > F.lit(cursor))
    return out.orderBy(F.col(key).asc()).limit(int(limit))


def stations_listing(
    df: DataFrame,
    state: str | None = None,
    limit: int = 500,
    *,
    key: str = "noaa_station_id",
    state_col: str = "state",
    out: str = "page",
) -> DataFrame:
    """Every station with the number of its page (from 0): the whole listing as one job.

    The same pages as following the cursor, for unique keys: rows are
    range-partitioned by key and numbered by the counts of earlier ranges, so
    the plan does not grow with the listing. A cursor never gets past a NULL
    key; here such stations come first.
    """
    rows = df.filter(F.col(state_col) == F.lit(state)) if state else df
    numbered = number_rows(rows, [key], out="__number")
    return numbered.select(*df.columns, F.floor((F.col("__number") - 1) / F.lit(int(limit))).cast("long").alias(out))


def next_cursor(page: DataFrame, *, key: str = "noaa_station_id", limit: int | None = None) -> str | None:
    """Cursor for the page after ``page``: its largest key; None when the page has no keys.

    A caller that knows the page's ``limit`` may pass it: a page that is not
    full is then known to be the last, which saves reading an empty one.
    """
    row = page.agg(F.max(F.col(key)).alias("last"), F.count(F.lit(1)).alias("n")).first()
    return None if limit is not None and row["n"] < limit else row["last"]
