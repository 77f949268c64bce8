"""Incremental bronze + silver as one Structured Streaming query.

New envelope files -> bronze rows -> fact MERGE, each file once. The stream's
checkpoint replaces the high-water mark: no bronze row is re-read or skipped
because of stamp order.

``foreachBatch`` is at-least-once, so each micro-batch is idempotent:

* ``_job_id`` is a deterministic function of the checkpoint and ``batchId``,
  and the bronze stamps use the micro-batch timestamp (``current_timestamp()``
  in a streaming plan is fixed per batch and recorded in the offset log, so a
  replay sees the same value);
* bronze has a partition per load, and a batch overwrites its own: a replay puts
  the same rows (ids and stamps follow from job, batch time and position) in
  place of whatever a broken append left, so bronze holds the batch once; it
  is then read back from that partition and merged (re-merging the same rows
  is idempotent for non-NULL keys).
"""

from __future__ import annotations

import functools
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pluvio import schemas as S
from pluvio.operators.bronze import run_timestamp
from pluvio.operators.dedupe import latest_per_key
from pluvio.operators.parse import parse_fact, routine_reports
from pluvio.plans.bronze_job import ordered_bronze, stage_features
from pluvio.plans.silver_job import (
    BRONZE_READ,
    ROUTINE_MINUTE,
    _record_mark,
    mark_micros,
    merge_and_publish,
    fact_new_partitions,
    merge_fact,
)
from pluvio.session import drop_materialized
from pluvio.sources.envelopes import check_envelopes, read_envelopes, with_source
from pluvio.sources.tables import read_bronze, replace_partitions, table_ddl

_BATCH_TS = "__batch_ts"


def ensure_fact_table(spark: SparkSession, fact_table: str, location: str) -> None:
    """Create an empty, partitioned fact table at ``location`` if it does not exist."""
    if not spark.catalog.tableExists(fact_table.replace("`", "")):
        spark.sql(table_ddl(fact_table, S.FACT, S.FACT_PARTITION, location=location))


def batch_job_id(checkpoint: str, batch_id: int) -> str:
    return str(uuid.uuid5(uuid.NAMESPACE_URL, f"{checkpoint.rstrip('/')}#{batch_id}"))


def medallion_batch(
    batch: DataFrame,
    batch_id: int,
    *,
    checkpoint: str,
    bronze: str,
    fact_table: str,
    snapshot_root: str,
    trace_id: str,
    minute: int = ROUTINE_MINUTE,
    max_broadcast_rows: int | None = None,
) -> dict | None:
    """One micro-batch: envelopes (+ ``__batch_ts``) -> bronze -> fact. Idempotent on replay."""
    session = batch.sparkSession
    staged, scratch, n = stage_features(batch, f"stream_batch_{batch_id}", keep=(_BATCH_TS,))
    job_id = batch_job_id(checkpoint, batch_id)
    try:
        if not n:
            return None
        rows = ordered_bronze(staged, job_id=job_id, run_ts=F.col(_BATCH_TS))
        replace_partitions(rows, bronze, S.BRONZE_PARTITIONS)
    finally:
        drop_materialized(session, scratch)
    mine = read_bronze(session, bronze).filter(F.col("_job_id") == job_id)  # the batch's own partitions
    source = routine_reports(latest_per_key(parse_fact(mine.select(*BRONZE_READ)), S.FACT_KEY), minute)
    target = session.table(fact_table)
    run_ts = mine.agg(F.max("_record_created_at")).scalar()
    counts = merge_and_publish(
        session,
        source,
        target,
        lambda t, s, b: merge_fact(t, s, job_id=job_id, trace_id=trace_id, run_ts=run_ts, broadcast_source=b),
        fact_new_partitions,
        key=S.FACT_KEY,
        table=fact_table,
        snapshot_root=snapshot_root,
        partition_col=S.FACT_PARTITION,
        max_broadcast_rows=max_broadcast_rows,
        name=f"stream_merge_{batch_id}",
    )
    if counts["source_rows"]:
        # keep the table's recorded high-water mark current for batch runs
        _record_mark(session, fact_table, mark_micros(session, fact_table), counts["written_mark"])
    counts["bronze_rows"] = n
    return counts


def envelope_stream(spark: SparkSession, landing: str, *, on_bad: str = "fail", max_files_per_trigger: int | None = None):
    """Streaming envelopes with the micro-batch timestamp attached."""
    reader = (
        spark.readStream.schema(S.ENVELOPE_DDL)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
    )
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    return check_envelopes(with_source(reader.json(landing)), on_bad).withColumn(_BATCH_TS, F.current_timestamp())


def envelope_batch(spark: SparkSession, landing: str, batch_ts, *, on_bad: str = "fail") -> DataFrame:
    """A micro-batch's envelopes read again as the stream sees them: for a replay by hand of a batch at its own time."""
    return read_envelopes(spark, landing, on_bad=on_bad, source=True).withColumn(_BATCH_TS, run_timestamp(batch_ts))


def stream_medallion(
    spark: SparkSession,
    landing: str,
    bronze: str,
    fact_table: str,
    checkpoint: str,
    *,
    snapshot_root: str,
    trace_id: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    max_files_per_trigger: int | None = None,
    minute: int = ROUTINE_MINUTE,
    on_bad: str = "fail",
    max_broadcast_rows: int | None = None,
) -> StreamingQuery:
    """Start the landing -> bronze -> fact stream; returns the running query.

    ``available_now=True`` processes what has landed and stops (a rerun with no
    new file runs no batch); otherwise ``processing_time`` sets the trigger.
    ``landing`` may be a glob over job folders. ``bronze`` is a Parquet folder
    or catalog table; ``fact_table`` a catalog table (created empty under
    ``snapshot_root`` if missing).
    """
    ensure_fact_table(spark, fact_table, f"{snapshot_root.rstrip('/')}/initial")
    envelopes = envelope_stream(spark, landing, on_bad=on_bad, max_files_per_trigger=max_files_per_trigger)
    process = functools.partial(
        medallion_batch,
        checkpoint=checkpoint,
        bronze=bronze,
        fact_table=fact_table,
        snapshot_root=snapshot_root,
        trace_id=trace_id or f"stream:{checkpoint}",
        minute=minute,
        max_broadcast_rows=max_broadcast_rows,
    )
    writer = envelopes.writeStream.foreachBatch(lambda df, bid: process(df, bid)).option(
        "checkpointLocation", checkpoint
    )
    if available_now:
        writer = writer.trigger(availableNow=True)
    elif processing_time:
        writer = writer.trigger(processingTime=processing_time)
    return writer.start()


__all__ = ["batch_job_id", "ensure_fact_table", "envelope_batch", "envelope_stream", "medallion_batch", "stream_medallion"]
