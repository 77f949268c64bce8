"""Connected components of a link table by alternating star contraction."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.scratch import materialise


def _contract(links: DataFrame, larger: bool) -> DataFrame:
    """One star step over links (a > b); ``larger``: hang larger neighbours on the smallest."""
    if larger:
        sides = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        sides = links.select("a", "b")
    least = sides.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    joined = sides.join(least, "a")
    if larger:
        out = joined.where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    else:
        out = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).union(
            least.select("a", F.col("m").alias("b"))
        )
    return out.where("a > b").distinct()


def components(links: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``links (a, b)`` but the roots: the smallest node reachable.

    Alternates large-star and small-star steps; each round is a stored table
    and only its count and checksum come to the driver. Minima are
    pre-aggregated before the shuffle and hot nodes meet in a join that the
    planner may split, so a star of any size is no single group.
    """
    links = links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    links = materialise(links.where("a > b").distinct(), "links")
    mark = None
    while True:
        now = links.agg(
            F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 31)))
        ).first()
        if now == mark or not now[0]:
            return links.select(F.col("a").alias("node"), F.col("b").alias("root"))
        mark = now
        links = materialise(_contract(_contract(links, True), False), "links")
