"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

_RN = "__rn"


def latest_per_key(
    df: DataFrame,
    keys: str | Sequence[str],
    order_col: str = "_record_updated_at",
    tie_breakers: Sequence[str] = ("_record_id",),
    *,
    method: str = "auto",
) -> DataFrame:
    """Keep the newest row of every key (``row_number() ... DESC = 1``).

    Newest = largest ``order_col`` (NULLs last), then largest tie-breakers, so
    the winner is deterministic. NULL keys form one group, so one NULL-key row
    survives. ``row_number() == 1`` lets Catalyst plan a partial
    ``WindowGroupLimit`` before the shuffle: each map task sends at most one row
    per key, so a key holding a third of all rows costs one row per task in the
    exchange, not a third of the data in one reducer.

    ``method="aggregate"`` computes the same rows with ``max_by`` over a
    ``groupBy`` (partial aggregation before the shuffle). ``"auto"`` uses it
    only when the session has switched the partial window limit off
    (``spark.sql.optimizer.windowGroupLimitThreshold`` < 1), so the hot-key
    protection never depends on that setting.
    """
    keys = [keys] if isinstance(keys, str) else list(keys)
    if method == "auto":
        threshold = int(df.sparkSession.conf.get("spark.sql.optimizer.windowGroupLimitThreshold", "1000"))
        method = "window" if threshold >= 1 else "aggregate"
    if method == "aggregate":
        return _latest_by_aggregate(df, keys, order_col, list(tie_breakers))
    if method != "window":
        raise ValueError(f"method must be 'auto', 'window' or 'aggregate', got {method!r}")
    order = [F.col(order_col).desc_nulls_last()] + [F.col(c).desc_nulls_last() for c in tie_breakers]
    w = Window.partitionBy(*[F.col(k) for k in keys]).orderBy(*order)
    return df.withColumn(_RN, F.row_number().over(w)).filter(F.col(_RN) == 1).drop(_RN)


def _latest_by_aggregate(df: DataFrame, keys: list[str], order_col: str, tie_breakers: list[str]) -> DataFrame:
    # Struct ordering puts NULL fields first, so max() prefers non-NULL stamps:
    # the same winner as ORDER BY order_col DESC NULLS LAST, tie-breakers DESC.
    order = F.struct(*[F.col(c) for c in [order_col, *tie_breakers]])
    row = F.struct(*[F.col(c) for c in df.columns])
    grouped = df.groupBy(*[F.col(k).alias(f"__k{i}") for i, k in enumerate(keys)]).agg(
        F.max_by(row, order).alias("__row")
    )
    return grouped.select("__row.*")
