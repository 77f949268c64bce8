"""Envelopes -> bronze rows (one row per feature, with lineage columns)."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.schemas import BRONZE_PARTITION


def run_timestamp(run_ts: dt.datetime | Column | None) -> Column:
    """The run's "now": a given instant (testable, replayable) or current_timestamp().

    A datetime without a zone is UTC, whatever the zone of the driver process.
    """
    if run_ts is None:
        return F.current_timestamp()
    if isinstance(run_ts, Column):
        return run_ts
    if run_ts.tzinfo is None:
        run_ts = run_ts.replace(tzinfo=dt.timezone.utc)
    return F.lit(run_ts).cast("timestamp")


def ordered_record_id(run_ts: Column, position: Column, job_id: str) -> Column:
    """A UUID (version 8) that sorts by run time in milliseconds, then by position in the load.

    48 bits of time, 40 of position, 32 of a digest of job and position: the
    same load gives the same ids again, and among rows with equal stamps the
    larger id is the later run's, then the later in its load.
    """
    time = F.lpad(F.lower(F.hex(F.unix_millis(run_ts))), 12, "0")
    place = F.lpad(F.lower(F.hex(position)), 10, "0")
    tail = F.substring(F.md5(F.concat(F.lit(f"{job_id}:"), position.cast("string"))), 1, 8)
    return F.concat_ws(
        "-",
        F.substring(time, 1, 8),
        F.substring(time, 9, 4),
        F.concat(F.lit("8"), F.substring(place, 1, 3)),
        F.concat(F.lit("8"), F.substring(place, 4, 3)),
        F.concat(F.substring(place, 7, 4), tail),
    )


def to_bronze(
    envelopes: DataFrame,
    *,
    job_id: str,
    run_ts: dt.datetime | Column | None = None,
    with_partition: bool = True,
) -> DataFrame:
    """Explode ``observations.features`` into bronze rows.

    * ``_record_id``: a fresh UUID per feature (non-deterministic: write the
      result once, never recompute it for a second consumer);
    * ``_job_id``: the load's id; ``_trace_id``: from the envelope;
    * ``_record_created_at`` = ``_record_updated_at`` = run time + position in
      the feature list in microseconds, so stamps keep list order and do not
      tie within an envelope.

    A narrow transformation: no shuffle.
    """
    now = run_timestamp(run_ts)
    exploded = envelopes.select(
        F.col("trace_id"),
        now.alias("__now"),
        F.posexplode(F.col("observations.features")).alias("__pos", "__feature"),
    )
    stamp = F.timestamp_add("MICROSECOND", F.col("__pos"), F.col("__now"))
    out = exploded.select(
        F.expr("uuid()").alias("_record_id"),
        F.col("__feature").alias("raw_response_json"),
        F.lit(job_id).alias("_job_id"),
        F.col("trace_id").alias("_trace_id"),
        stamp.alias("_record_created_at"),
        stamp.alias("_record_updated_at"),
    )
    if with_partition:
        out = out.withColumn(BRONZE_PARTITION, F.to_date(F.col("_record_created_at")))
    return out
