"""SQL submission with bound parameters and qualified names."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def qualified(*parts: str) -> str:
    """``catalog.schema.table`` with every part quoted."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts if p)


def run_sql(spark: SparkSession, sql: str, *positional, **named) -> DataFrame:
    """Run SQL text with bound parameters, never string interpolation.

    Named markers (``:name``) take keyword arguments, ``?`` markers take
    positional ones. Table names can be bound too: ``FROM IDENTIFIER(:t)``.
    """
    if positional and named:
        raise ValueError("use either positional (?) or named (:name) parameters")
    args = list(positional) if positional else (named or None)
    return spark.sql(sql, args=args)
