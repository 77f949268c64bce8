"""Sharding by a hierarchical weighted hash tree (operator 5).

A tree of regions, racks and shards; the weight of a node is the sum of the
shard weights below it. A key descends from the root: at each level every
child draws ``ln(u) / weight`` with ``u`` a hash of (key, child), and the
largest draw wins. A child whose weight does not change keeps its draws, so a
change of weights only moves keys into or out of the subtrees it touches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm.scratch import materialise

RACK_SHARDS = 5
REGION_RACKS = 2


def tree(shards: int, weights: dict[int, float] | None = None, full: int | None = None):
    """``{region: {rack: {shard: weight}}}``.

    Shards fill racks and regions in order, in complete regions up to ``full``
    shards (default: all). Shards added later open a region of their own, so
    growing by one only adds a child to the root and takes keys into it alone.
    """
    full = shards if full is None else full
    out: dict[int, dict[int, dict[int, float]]] = {}
    per_region = RACK_SHARDS * REGION_RACKS
    for s in range(shards):
        region = s // per_region if s < full else -(-full // per_region) + (s - full)
        rack = s // RACK_SHARDS if s < full else -(-full // RACK_SHARDS) + (s - full)
        out.setdefault(region, {}).setdefault(rack, {})[s] = (weights or {}).get(s, 1.0)
    return out


def _draw(key: Column, level: str, node: int, weight: float) -> Column:
    u = F.xxhash64(key, F.lit(f"{level}{node}"))
    # 53 bits as a fraction in (0, 1]
    u = (F.shiftrightunsigned(u, 11) + F.lit(1)).cast("double") / F.lit(float(1 << 53))
    return F.log(u) / F.lit(float(weight))


def _choose(key: Column, level: str, children: dict[int, float]) -> Column:
    """The child with the largest draw; ties go to the smaller number."""
    draws = [
        F.struct(_draw(key, level, n, w).alias("draw"), F.lit(-n).alias("n"))
        for n, w in children.items()
        if w > 0
    ]
    best = draws[0] if len(draws) == 1 else F.greatest(*draws)
    return -best["n"]


def _weight(node) -> float:
    return sum(map(_weight, node.values())) if isinstance(node, dict) else node


def place(df: DataFrame, key: Column, layout, out: str) -> DataFrame:
    """Add column ``out``: the shard of ``key`` in the tree ``layout``."""
    df = df.withColumn("_region", _choose(key, "region", {r: _weight(v) for r, v in layout.items()}))
    rack, shard = F.lit(None).cast("int"), F.lit(None).cast("int")
    for r, racks in layout.items():
        rack = F.when(F.col("_region") == r, _choose(key, "rack", {k: _weight(v) for k, v in racks.items()})).otherwise(rack)
    df = df.withColumn("_rack", rack)
    for racks in layout.values():
        for k, leaves in racks.items():
            shard = F.when(F.col("_rack") == k, _choose(key, "shard", leaves)).otherwise(shard)
    return df.withColumn(out, shard.cast("int")).drop("_region", "_rack")


def number_slots(df: DataFrame, group: str, order: list[str], rows_per_block: int = 100_000) -> DataFrame:
    """Add ``slot``: gapless numbers from 0 within each ``group``.

    A group is split into blocks of about ``rows_per_block`` rows by a hash of
    the row; blocks are numbered side by side and shifted by what precedes
    them, so no task holds a group.
    """
    n = df.count()
    blocks = max(1, -(-n // rows_per_block))
    df = df.withColumn("_block", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(blocks)))
    df = materialise(df, "blocks")
    counts = df.groupBy(group, "_block").agg(F.count("*").alias("_n"))
    before = Window.partitionBy(group).orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select(group, "_block", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    inner = Window.partitionBy(group, "_block").orderBy(*order)
    df = df.withColumn("_inner", F.row_number().over(inner) - 1)
    df = df.join(first, [group, "_block"])
    return df.withColumn("slot", (F.col("_first") + F.col("_inner")).cast("long")).drop("_block", "_first", "_inner")


def shard_documents(docs: DataFrame, shards: int = 40) -> DataFrame:
    """Put all documents into shards by law ``key`` (operator 5).

    Returns ``doc_id, size, text_crc32, law, shard, slot, grown_shard``;
    ``grown_shard`` is the shard with one more shard. A null text has size 16
    and the checksum of no bytes; a null doc_id is a key like any other.
    Repeated rows go to the same shard with slots of their own.
    """
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        (F.octet_length(text) + F.lit(16)).cast("long").alias("size"),
        F.crc32(F.encode(text, "utf-8")).alias("text_crc32"),
        F.lit("key").alias("law"),
    )
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    rows = place(rows, key, tree(shards), "shard")
    rows = place(rows, key, tree(shards + 1, full=shards), "grown_shard")
    rows = number_slots(rows, "shard", ["doc_id", "size", "text_crc32"])
    return rows.select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard")
