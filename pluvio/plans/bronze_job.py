"""Bronze jobs: landed envelopes -> bronze table (C1), and the batch extract+load (C4)."""

from __future__ import annotations

import datetime as dt
import logging

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from pluvio.operators.bronze import ordered_record_id, run_timestamp
from pluvio.schemas import BRONZE_PARTITION, BRONZE_PARTITIONS
from pluvio.session import drop_materialized, materialize
from pluvio.sources.envelopes import SOURCE, quarantined_envelopes, read_envelopes, write_envelopes
from pluvio.sources.tables import WRITE_APPEND, load_table, read_bronze, replace_partitions, table_exists

log = logging.getLogger(__name__)

_AT = "__at"
#: Parts of landed files up to this number (some 100 bytes each) are broadcast with their offsets.
BROADCAST_PARTS = 100_000
#: Staged features are written and read at once: a dictionary, but for the few file names, costs more than it saves.
STAGED = {"parquet.enable.dictionary": "false", "parquet.enable.dictionary#__file": "true"}


def stage_features(envelopes: DataFrame, name: str, keep: tuple[str, ...] = ()) -> tuple[DataFrame, str, int]:
    """Evaluate a load's envelopes once: its features as a scratch table, the table's name, their number.

    ``envelopes`` carry ``SOURCE`` columns. ``__at`` numbers the features that
    one task reads, in reading order.
    """
    rows = envelopes.select("trace_id", *SOURCE, *keep, F.explode("observations.features").alias("__feature"))
    obs = Observation(name)
    rows = rows.withColumn(_AT, F.monotonically_increasing_id()).observe(obs, F.count(F.lit(1)).alias("rows"))
    staged, table = materialize(rows, name, **STAGED)
    return staged, table, int(obs.get["rows"])


def load_positions(staged: DataFrame) -> DataFrame:
    """Add ``__position``: each feature's place in the whole load, from 0.

    Folders (extract jobs) go by the time their first file landed, then by
    name; files by part number and name; then line and list position. The
    running sum sees one row per part of a file that a task read (never the
    features); each part's offset is then added to the place in the part.
    """
    folder = F.regexp_extract("__file", "^(.*)/", 1)
    number = F.regexp_extract("__file", "part-([0-9]+)[^/]*$", 1).try_cast("long")
    parts = staged.groupBy("__file", "__start").agg(
        F.count(F.lit(1)).alias("n"), F.min(_AT).alias("__first"), F.min("__landed").alias("landed")
    )
    parts = parts.select("*", folder.alias("folder"), number.alias("number"))
    parts = parts.withColumn("since", F.min("landed").over(Window.partitionBy("folder")))
    order = Window.orderBy("since", "folder", "number", "__file", "__start")
    before = F.coalesce(F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = parts.select("__file", "__start", "__first", before.alias("__before"))
    if staged.select("__file", "__start").distinct().count() <= BROADCAST_PARTS:
        parts = F.broadcast(parts)
    return staged.join(parts, ["__file", "__start"]).withColumn(
        "__position", F.col("__before") + F.col(_AT) - F.col("__first")
    )


def ordered_bronze(staged: DataFrame, *, job_id: str, run_ts: Column) -> DataFrame:
    """Bronze rows of a staged load: stamps rise by a microsecond with each feature of the whole load."""
    now, at = F.col("__now"), F.col("__position")
    stamp = F.timestamp_micros(F.unix_micros(now) + at)
    return load_positions(staged).withColumn("__now", run_ts).select(
        ordered_record_id(now, at, job_id).alias("_record_id"),
        F.col("__feature").alias("raw_response_json"),
        F.lit(job_id).alias("_job_id"),
        F.col("trace_id").alias("_trace_id"),
        stamp.alias("_record_created_at"),
        stamp.alias("_record_updated_at"),
        F.to_date(stamp).alias(BRONZE_PARTITION),
    )


def _after_last(spark: SparkSession, bronze_table: str, job_id: str, now: dt.datetime) -> dt.datetime | Column:
    """``now``, or just after the newest stamp of other loads where that is later (one column of the days since)."""
    if not table_exists(spark, bronze_table):
        return now
    since = F.lit(now).cast("timestamp")
    newer = read_bronze(spark, bronze_table).where(
        (F.col(BRONZE_PARTITION) >= F.to_date(since)) & (F.col("_job_id") != job_id) & (F.col("_record_created_at") >= since)
    )
    last = newer.agg(F.max(F.unix_micros("_record_created_at"))).first()[0]
    return now if last is None else F.timestamp_micros(F.lit(last + 1))


def run_bronze_load(
    spark: SparkSession,
    landing: str | list[str],
    bronze_table: str,
    *,
    job_id: str,
    run_ts: dt.datetime | None = None,
    on_bad: str = "fail",
    disposition: str = WRITE_APPEND,
    quarantine_path: str | None = None,
    after_last: bool = True,
) -> int:
    """Read every envelope under ``landing``, explode, stamp and append to bronze.

    The landed text is parsed once, into a scratch table; stamps are the run
    time plus the feature's position in the whole load, over all chunks of a
    trace and all envelopes. A load whose run time lies before the newest stamp
    of another load starts right after that stamp (``after_last=False``: not),
    so that a later load is newer. Appending replaces what bronze holds of the
    same ``job_id``, so a load that broke off or is run again is there once.
    Returns the rows written. Raises on an empty load.
    With ``on_bad="quarantine"`` bad lines are skipped; if ``quarantine_path``
    is given they are appended there as JSON (raw line, reason, job id).
    """
    if on_bad == "quarantine" and quarantine_path:
        bad = quarantined_envelopes(spark, landing)
        bad.select(
            "_corrupt_record", "_envelope_error", "trace_id", F.lit(job_id).alias("_job_id")
        ).write.mode("append").json(quarantine_path)
    now = run_ts or dt.datetime.now(dt.timezone.utc)
    if now.tzinfo is None:
        now = now.replace(tzinfo=dt.timezone.utc)
    staged, scratch, n = stage_features(read_envelopes(spark, landing, on_bad=on_bad, source=True), "bronze_load")
    try:
        if not n:
            raise ValueError(f"load into {bronze_table}: the rows cannot be empty")
        start = _after_last(spark, bronze_table, job_id, now) if after_last else now
        rows = ordered_bronze(staged, job_id=job_id, run_ts=run_timestamp(start))
        if disposition == WRITE_APPEND:
            n = replace_partitions(rows, bronze_table, BRONZE_PARTITIONS)
        else:
            n = load_table(rows, bronze_table, disposition=disposition, partition_col=BRONZE_PARTITIONS)
    finally:
        drop_materialized(spark, scratch)
    log.info("bronze load job_id=%s rows=%d", job_id, n)
    return n


def run_bronze(
    spark: SparkSession,
    features: DataFrame,
    landing_root: str,
    bronze_table: str,
    *,
    extract_job_id: str,
    load_job_id: str,
    run_ts: dt.datetime | None = None,
    max_features: int = 5000,
    after_last: bool = True,
) -> int:
    """Extract + load for many stations and windows at once.

    ``features`` has ``trace_id`` (one per station and window) and ``feature``
    (VARIANT). They are landed as envelopes named by the extract job, then
    loaded by the load job (its own id).
    """
    folder = write_envelopes(features, landing_root, extract_job_id, max_features=max_features)
    return run_bronze_load(spark, folder, bronze_table, job_id=load_job_id, run_ts=run_ts, after_last=after_last)
