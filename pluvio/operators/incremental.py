"""High-water mark and incremental read of the source."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F



def epoch() -> Column:
    """Fixed value: the mark of an empty target is the Unix epoch (UTC)."""
    return F.timestamp_seconds(F.lit(0))


def high_water_mark(target: DataFrame, ts_col: str = "_record_updated_at") -> DataFrame:
    """One row, one column ``high_water_mark``: ``coalesce(max(ts), epoch)``.

    A global aggregate: partial max per task, one row per task shuffled.
    """
    return target.agg(F.coalesce(F.max(F.col(ts_col)), epoch()).alias("high_water_mark"))


def mark_value(target: DataFrame, ts_col: str = "_record_updated_at") -> Column:
    """The mark as an uncorrelated scalar subquery (evaluated once, lazily)."""
    return high_water_mark(target, ts_col).scalar()


def incremental_filter(
    source: DataFrame,
    target: DataFrame,
    ts_col: str = "_record_updated_at",
    *,
    target_ts_col: str | None = None,
    partition_col: str | None = None,
    partition_lag_days: int = 1,
    mark=None,
) -> DataFrame:
    """Source rows strictly newer than the target's mark.

    The predicate ``ts > (scalar subquery)`` is pushed into the Parquet scan of
    the source. ``partition_col`` (a date column such as bronze ``created_date``)
    adds ``partition_col >= date(mark) - partition_lag_days`` so whole day
    partitions are pruned; safe when rows are stamped ``created <= updated`` and
    the two stamps are at most ``partition_lag_days`` apart.

    ``mark`` (a value computed once with :func:`high_water_mark`) replaces the
    subquery by a literal, so the partition predicate prunes at planning time.
    """
    if mark is None:
        mark = mark_value(target, target_ts_col or ts_col)
    elif not isinstance(mark, Column):
        mark = F.lit(mark).cast("timestamp")
    out = source.filter(F.col(ts_col) > mark)
    if partition_col is not None:
        out = out.filter(F.col(partition_col) >= F.date_sub(F.to_date(mark), partition_lag_days))
    return out
