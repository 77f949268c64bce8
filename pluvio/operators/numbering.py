"""Row numbers and running positions over a distributed sort, without a single task."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.session import scratch_path

_AT = "__at"
#: ``monotonically_increasing_id`` holds the partition above this bit and the row in it below.
_ROW_BITS = 33


def partition_offsets(df: DataFrame, size: Column, groups: Sequence[str] = ()) -> DataFrame:
    """``__part, groups..., __before``: the sum of ``size`` over earlier partitions of ``df``.

    ``df`` is a stored table whose ``__at`` column was written by
    ``monotonically_increasing_id``. One row per partition (and group in it), so
    the running sum sees as many rows as there are partitions, not the data.
    """
    part = F.shiftright(F.col(_AT), _ROW_BITS).alias("__part")
    sums = df.groupBy(part, *groups).agg(F.sum(size).alias("__size"), F.min(_AT).alias("__first"))
    before = Window.partitionBy(*groups).orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    total = F.coalesce(F.sum("__size").over(before), F.lit(0))
    return sums.select("__part", *groups, "__first", total.cast("long").alias("__before"))


def number_rows(
    df: DataFrame, order: Sequence[Column | str], *, groups: Sequence[str] = (), out: str = "row_number"
) -> DataFrame:
    """``df`` with ``out`` = 1, 2, 3 ... in the given order (per group, where groups are named).

    Rows are range-partitioned and sorted by groups and order, and stored with
    their place in their partition; the counts of earlier partitions are added.
    No task sees more than its range, and a group that holds a third of all
    rows is dealt over many ranges. The order should end in a unique column:
    rows that are equal in it share a range and are numbered arbitrarily.
    Null groups are a group; an empty table stays empty.
    """
    spark = df.sparkSession
    keys = [F.col(g) for g in groups] + [F.col(c) if isinstance(c, str) else c for c in order]
    ranged = df.repartitionByRange(*keys).sortWithinPartitions(*keys)
    path = scratch_path(spark, "numbered")
    ranged.withColumn(_AT, F.monotonically_increasing_id()).write.parquet(path)
    stored = spark.read.schema(ranged.schema.add(_AT, "long")).parquet(path)
    offsets = partition_offsets(stored, F.lit(1), groups)
    names = [f"__g{k}" for k in range(len(groups))]
    offsets = offsets.select("__part", "__first", "__before", *(F.col(g).alias(n) for g, n in zip(groups, names, strict=True)))
    if not groups:
        offsets = F.broadcast(offsets)  # a row per partition
    same = F.shiftright(F.col(_AT), _ROW_BITS) == F.col("__part")
    for g, n in zip(groups, names, strict=True):
        same &= F.col(g).eqNullSafe(F.col(n))
    number = (F.col("__before") + F.col(_AT) - F.col("__first") + 1).cast("long")
    return stored.join(offsets, same).select(*(F.col(c) for c in df.columns), number.alias(out))
