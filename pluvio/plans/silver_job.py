"""Silver jobs: incremental parse, dedupe and MERGE of bronze into the fact and
dimension tables (C2, C3), and the silver run (C5)."""

from __future__ import annotations

import datetime as dt
import logging
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from pluvio import schemas as S
from pluvio.functions import geog_point_wkb
from pluvio.operators.bronze import run_timestamp
from pluvio.operators.dedupe import latest_per_key
from pluvio.operators.incremental import high_water_mark, incremental_filter
from pluvio.operators.merge import ACTION, merge_into_table, merge_upsert
from pluvio.operators.parse import parse_dim, parse_fact, routine_reports
from pluvio.session import default_snapshot_root, drop_materialized, materialize
from pluvio.sources.key_summary import days_that_may_hold, write_summaries
from pluvio.sources.tables import (
    BRONZE_TABLE,
    FACT_TABLE,
    bucketing,
    publish_partitions,
    publish_snapshot,
    read_bronze,
    set_table_property,
    table_property,
    tracks_partitions,
)

log = logging.getLogger(__name__)

# Fixed value: routine hourly reports are issued at minute 54.
ROUTINE_MINUTE = 54
HWM_POLICIES = ("insert_time", "source_time")
_EPOCH = dt.datetime(1970, 1, 1, tzinfo=dt.timezone.utc)

BRONZE_READ = ["_record_id", "_record_updated_at", "raw_response_json"]
MARK_COLUMN = "_record_updated_at"
MARK_PROPERTY = "pluvio.high_water_mark"


def mark_micros(spark: SparkSession, table: str) -> int:
    """The table's high-water mark in microseconds since the epoch (an instant, in any zone): the recorded value if a publish stored one,
    else ``coalesce(max(_record_updated_at), epoch)`` over the table (one column scan).

    The recorded value is exact as long as the table is only written through
    :func:`merge_and_publish`: rows are never deleted and updates only raise
    the stamp, so the maximum never decreases.
    """
    recorded = table_property(spark, table, MARK_PROPERTY)
    if recorded and recorded.lstrip("-").isdigit():
        return int(recorded)
    mark = high_water_mark(spark.table(table), MARK_COLUMN).select(F.unix_micros("high_water_mark")).first()[0]
    # Record it before any publish: a run that fails half-way through its
    # partition switches then leaves this value, and the rerun re-reads.
    set_table_property(spark, table, MARK_PROPERTY, str(mark))
    return mark


def table_mark(spark: SparkSession, table: str) -> dt.datetime:
    """The mark as a collected timestamp: local time of the driver process, without a zone."""
    instant = _EPOCH + dt.timedelta(microseconds=mark_micros(spark, table))
    return instant.astimezone().replace(tzinfo=None)


def _record_mark(spark: SparkSession, table: str, previous: int, written: int | None) -> None:
    new = max(previous, written) if written is not None else previous
    set_table_property(spark, table, MARK_PROPERTY, str(new))


def fact_source(
    bronze: DataFrame,
    target: DataFrame,
    *,
    partition_col: str | None = None,
    minute: int = ROUTINE_MINUTE,
    on_bad_timestamp: str = "fail",
    mark=None,
) -> DataFrame:
    """Bronze rows above the target's mark -> typed -> newest per record -> routine minute.

    The minute filter stays above the dedupe (a record whose newest version is
    off-minute is dropped even if an older version was on it).
    """
    fresh = incremental_filter(bronze, target, "_record_updated_at", partition_col=partition_col, mark=mark)
    parsed = parse_fact(fresh.select(*BRONZE_READ), on_bad_timestamp=on_bad_timestamp)
    return routine_reports(latest_per_key(parsed, S.FACT_KEY), minute)


def merge_fact(
    target: DataFrame,
    source: DataFrame,
    *,
    job_id: str,
    trace_id: str,
    run_ts: dt.datetime | Column | None = None,
    hwm_policy: str = "insert_time",
    broadcast_source: bool | None = None,
    co_located: bool = False,
) -> DataFrame:
    """New fact snapshot (+ ``_action``) from the deduplicated source.

    ``insert_time`` (default): stamps come from the run on insert and are never
    touched on update. ``source_time``: inserts and updates carry the winning
    bronze ``_record_updated_at``, so an update-only run still moves the mark.
    """
    if hwm_policy not in HWM_POLICIES:
        raise ValueError(f"hwm_policy must be one of {HWM_POLICIES}")
    now = run_timestamp(run_ts)
    src = source.withColumn("_job_id", F.lit(job_id)).withColumn("_trace_id", F.lit(trace_id))
    update_cols = list(S.FACT_UPDATE_COLUMNS)
    insert_cols = list(S.FACT_INSERT_COLUMNS)
    defaults = {"_record_created_at": now, "_record_updated_at": now}
    if hwm_policy == "source_time":
        update_cols.append("_record_updated_at")
        insert_cols.append("_record_updated_at")
        defaults.pop("_record_updated_at")
    merged = merge_upsert(
        target.select(*S.FACT_COLUMNS),
        src,
        S.FACT_KEY,
        update_cols,
        insert_cols,
        defaults,
        broadcast_source=broadcast_source,
        co_located=co_located,
        check_unique=False,
    )
    return merged.withColumn(S.FACT_PARTITION, F.to_date(F.col("hourly_precip_timestamp")))


def fact_new_partitions(source: DataFrame) -> DataFrame:
    """Fact days a source row lands in (updates and inserts both take the source time)."""
    return source.select(F.to_date(F.col("hourly_precip_timestamp")).alias(S.FACT_PARTITION))


def dim_source(bronze: DataFrame, target: DataFrame, *, partition_col: str | None = None, mark=None) -> DataFrame:
    """Bronze rows above the mark -> station attributes -> newest per station."""
    fresh = incremental_filter(bronze, target, "_record_updated_at", partition_col=partition_col, mark=mark)
    newest = latest_per_key(parse_dim(fresh.select(*BRONZE_READ), with_geopoint=False), S.DIM_KEY)
    point = geog_point_wkb(F.col("noaa_station_longitude"), F.col("noaa_station_latitude"))
    return newest.withColumn("noaa_station_geopoint", point)  # Arrow sees one row per station only


def merge_dim(
    target: DataFrame,
    source: DataFrame,
    *,
    job_id: str,
    trace_id: str,
    run_ts: dt.datetime | Column | None = None,
    broadcast_source: bool | None = None,
) -> DataFrame:
    now = run_timestamp(run_ts)
    src = source.withColumn("_job_id", F.lit(job_id)).withColumn("_trace_id", F.lit(trace_id))
    merged = merge_upsert(
        target.select(*S.DIM_COLUMNS),
        src,
        S.DIM_KEY,
        S.DIM_UPDATE_COLUMNS,
        S.DIM_INSERT_COLUMNS,
        {"_record_created_at": now, "_record_updated_at": now},
        broadcast_source=broadcast_source,
        check_unique=False,
    )
    return merged.withColumn(S.DIM_PARTITION, F.to_date(F.col("_record_created_at")))


def _action_metrics() -> list[Column]:
    a = F.col(ACTION)
    return [
        F.count_if(a == "update").alias("updated"),
        F.count_if(a == "insert").alias("inserted"),
        F.count_if(a == "keep").alias("kept"),
        F.max(F.unix_micros(F.col(MARK_COLUMN))).alias("written_mark"),
    ]


REWRITE_MODES = ("auto", "partitions", "snapshot", "native")


def merge_and_publish(
    spark: SparkSession,
    source: DataFrame,
    target: DataFrame,
    merge,
    new_partitions,
    *,
    key: str,
    table: str,
    snapshot_root: str,
    partition_col: str,
    max_broadcast_rows: int | None = None,
    name: str,
    rewrite: str = "auto",
    native=None,
    max_partition_switches: int | None = None,
    key_summaries: bool = True,
) -> dict:
    """Merge a source into a table and publish the result; returns action counts.

    * The (incremental) source is materialised once as a scratch Parquet table
      in the shared checkpoint folder (dropped again at the end): it cuts the
      lineage and gives the planner its real size. There is one join; only a
      caller that sets ``max_broadcast_rows`` asks for a broadcast below it.
    * ``rewrite="partitions"`` (``"auto"`` when the catalog tracks the table's
      partitions): only partitions that hold a matched key or receive a changed
      row are read, merged and rewritten; the rest of the table is untouched.
      The affected partition values (a short list, at most one per day) come
      from a key-only semi join of the source keys with those days of the target
      that may hold one by the key summaries beside the published files
      (:mod:`pluvio.sources.key_summary`). Rows without a day are a partition of
      their own. A caller
      may ask for the snapshot rewrite beyond ``max_partition_switches`` under
      ``"auto"``; an explicit mode is never overridden.
    * ``rewrite="snapshot"``: the whole table is rewritten to a new folder.
    * ``rewrite="native"``: the catalog's own ``MERGE INTO`` (table formats with
      row-level operations); counts come from a key semi join before the merge.
    """
    if rewrite not in REWRITE_MODES:
        raise ValueError(f"rewrite must be one of {REWRITE_MODES}")
    source, scratch = materialize(source, f"{name}_source")
    try:
        return _merge_and_publish(
            spark, source, target, merge, new_partitions, key=key, table=table, snapshot_root=snapshot_root,
            partition_col=partition_col, max_broadcast_rows=max_broadcast_rows, name=name, rewrite=rewrite,
            native=native, max_partition_switches=max_partition_switches, key_summaries=key_summaries,
        )
    finally:
        drop_materialized(spark, scratch)


def _merge_and_publish(
    spark: SparkSession,
    source: DataFrame,
    target: DataFrame,
    merge,
    new_partitions,
    *,
    key: str,
    table: str,
    snapshot_root: str,
    partition_col: str,
    max_broadcast_rows: int | None,
    name: str,
    rewrite: str,
    native,
    max_partition_switches: int | None,
    key_summaries: bool,
) -> dict:
    n = source.count()
    if n == 0:
        return {"source_rows": 0, "updated": 0, "inserted": 0, "kept": 0, "affected": 0}
    broadcast = max_broadcast_rows is not None and n <= max_broadcast_rows
    if rewrite == "native":
        keys = source.select(key).filter(F.col(key).isNotNull())
        keys = F.broadcast(keys) if broadcast else keys
        updated = target.select(key).join(keys, key, "left_semi").count()
        native(source)
        return {
            "source_rows": n,
            "updated": updated,
            "inserted": n - updated,
            "kept": None,
            "affected": n,
            "snapshot": None,
            "rewrite": "native",
        }
    days: dict = {}
    by_partition = rewrite == "partitions" or (rewrite == "auto" and tracks_partitions(spark, table))
    obs = Observation(name)
    layout_cols = [partition_col, key]
    if by_partition:
        keys = source.select(key).filter(F.col(key).isNotNull())
        keys = F.broadcast(keys) if broadcast else keys
        may = days_that_may_hold(spark, target, source, key=key, partition_col=partition_col) if key_summaries else None
        scope = target if may is None else target.filter(_in_days(partition_col, may[0]))
        if may is not None:
            days = {"days": may[1], "days_read": len(may[0])}
        matched = scope.select(key, partition_col).join(keys, key, "left_semi").select(partition_col)
        parts = matched.union(new_partitions(source)).distinct()
        affected = [r[0] for r in parts.collect()]  # one value per calendar day
        if rewrite == "auto" and max_partition_switches is not None:
            by_partition = len(affected) <= max_partition_switches
    if by_partition:
        scoped = target.filter(_in_days(partition_col, affected))
        merged = merge(scoped, source, broadcast)
        folder = publish_partitions(
            merged,
            table,
            snapshot_root,
            partition_col=partition_col,
            affected=affected,
            layout_cols=layout_cols,
            observation=obs,
            metrics=_action_metrics(),
            drop_cols=[ACTION],
        )
    else:
        merged = merge(target, source, broadcast)
        folder = publish_snapshot(
            merged,
            table,
            snapshot_root,
            partition_col=partition_col,
            layout_cols=layout_cols,
            observation=obs,
            metrics=_action_metrics(),
            drop_cols=[ACTION],
        )
    if key_summaries:
        write_summaries(spark, folder, key)
    metrics = obs.get
    counts = {k: int(metrics[k]) for k in ("updated", "inserted", "kept")}
    counts.update(
        source_rows=n,
        affected=counts["updated"] + counts["inserted"],
        snapshot=folder,
        rewrite="partitions" if by_partition else "snapshot",
        written_mark=metrics["written_mark"],
        **days,
    )
    return counts


def _in_days(partition_col: str, days: list) -> Column:
    """Rows of the given days (None: of no day); a partition filter."""
    known = [d for d in days if d is not None]
    inside = F.col(partition_col).isin(known) if known else F.lit(False)
    return inside | F.col(partition_col).isNull() if len(known) < len(days) else inside


def run_silver_fact(
    spark: SparkSession,
    bronze_table: str,
    fact_table: str,
    *,
    job_id: str,
    trace_id: str,
    snapshot_root: str | None = None,
    run_ts: dt.datetime | None = None,
    hwm_policy: str = "insert_time",
    max_broadcast_rows: int | None = None,
    rewrite: str = "auto",
) -> dict:
    """C2: incremental MERGE of bronze into the fact table; returns action counts.

    The source is at most one row per record; it meets the affected partitions
    in one full outer join. Only the affected day partitions
    are rewritten and switched (``rewrite="auto"``, see :func:`merge_and_publish`).
    """
    bronze = read_bronze(spark, bronze_table)
    target = spark.table(fact_table)
    # The mark as a literal (static partition pruning of bronze): read from the
    # table's properties, or one small aggregate when none is recorded yet.
    mark = mark_micros(spark, fact_table)
    source = fact_source(bronze, target, partition_col=S.BRONZE_PARTITION, mark=F.timestamp_micros(F.lit(mark)))
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    root = snapshot_root or default_snapshot_root(spark, "fact")
    buckets = bucketing(spark, fact_table)
    co_located = buckets is not None and buckets[1] == [S.FACT_KEY]
    counts = merge_and_publish(
        spark,
        source,
        target,
        lambda t, s, b: merge_fact(
            t, s, job_id=job_id, trace_id=trace_id, run_ts=run_ts, hwm_policy=hwm_policy,
            broadcast_source=b, co_located=co_located,
        ),
        fact_new_partitions,
        key=S.FACT_KEY,
        table=fact_table,
        snapshot_root=root,
        partition_col=S.FACT_PARTITION,
        max_broadcast_rows=max_broadcast_rows,
        name="fact_merge",
        rewrite=rewrite,
        native=lambda s: merge_into_table(
            s,
            fact_table,
            S.FACT_KEY,
            S.FACT_UPDATE_COLUMNS + [S.FACT_PARTITION],
            S.FACT_INSERT_COLUMNS + [S.FACT_PARTITION],
            {
                "_job_id": F.lit(job_id),
                "_trace_id": F.lit(trace_id),
                S.FACT_PARTITION: F.to_date(F.col("s.hourly_precip_timestamp")),
            },
        ),
    )
    if counts["source_rows"] and counts.get("rewrite") != "native":
        _record_mark(spark, fact_table, mark, counts["written_mark"])
    return counts


def run_silver_dim(
    spark: SparkSession,
    bronze_table: str,
    dim_table: str,
    *,
    job_id: str,
    trace_id: str,
    snapshot_root: str | None = None,
    run_ts: dt.datetime | None = None,
    max_broadcast_rows: int | None = None,
    rewrite: str = "auto",
) -> dict:
    """C3: incremental MERGE of station attributes into the dimension."""
    bronze = read_bronze(spark, bronze_table)
    target = spark.table(dim_table)
    mark = mark_micros(spark, dim_table)
    source = dim_source(bronze, target, partition_col=S.BRONZE_PARTITION, mark=F.timestamp_micros(F.lit(mark)))
    run_ts = run_ts or dt.datetime.now(dt.timezone.utc)
    root = snapshot_root or default_snapshot_root(spark, "dim")
    counts = merge_and_publish(
        spark,
        source,
        target,
        lambda t, s, b: merge_dim(t, s, job_id=job_id, trace_id=trace_id, run_ts=run_ts, broadcast_source=b),
        lambda s: s.select(F.to_date(run_timestamp(run_ts)).alias(S.DIM_PARTITION)).limit(1),
        key=S.DIM_KEY,
        table=dim_table,
        snapshot_root=root,
        partition_col=S.DIM_PARTITION,
        max_broadcast_rows=max_broadcast_rows,
        name="dim_merge",
        rewrite=rewrite,
    )
    if counts["source_rows"] and counts.get("rewrite") != "native":
        _record_mark(spark, dim_table, mark, counts["written_mark"])
    return counts


def run_silver(spark: SparkSession, trace_id: str, *, schema: str = "pluvio", **kwargs) -> dict:
    """C5: one silver run with a fresh job id over ``schema``'s tables."""
    job_id = str(uuid.uuid4())
    log.info("silver run job_id=%s", job_id)
    counts = run_silver_fact(
        spark,
        f"`{schema}`.`{BRONZE_TABLE}`",
        f"`{schema}`.`{FACT_TABLE}`",
        job_id=job_id,
        trace_id=trace_id,
        **kwargs,
    )
    log.info("silver run job_id=%s affected=%s", job_id, counts.get("affected"))
    counts["job_id"] = job_id
    return counts


__all__ = [
    "dim_source",
    "fact_source",
    "merge_dim",
    "merge_and_publish",
    "merge_fact",
    "table_mark",
    "run_silver",
    "run_silver_dim",
    "run_silver_fact",
]
