"""Materialised intermediate tables and row keys shared by the operators."""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.session import scratch_path

_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextmanager
def _release_shuffles(spark: SparkSession):
    """Shuffle files of a query that ends in a written table go when it has ended."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared checkpoint folder and read it back.

    Cuts the lineage with a table that survives lost executors; expensive
    steps that several later steps read run once.
    """
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    with _release_shuffles(spark):
        df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete a table of ``materialise`` that only stored tables were made from."""
    files = df.inputFiles()
    if files:
        jvm, conf = df.sparkSession._jvm, df.sparkSession._jsparkSession.sessionState().newHadoopConf()
        folder = jvm.org.apache.hadoop.fs.Path(files[0]).getParent()
        if folder.getName().startswith("llm-"):
            folder.getFileSystem(conf).delete(folder, True)


def row_hash() -> Column:
    """A 128-bit digest of the text, 16 bytes (null text: none), the second half of a row's key."""
    return F.coalesce(F.unhex(F.md5(F.col("text").cast("string"))), F.lit(b""))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, _h, text``: the columns every operator needs.

    ``_h`` (a digest of the text) tells rows of one doc_id with different texts
    apart; fully repeated rows share a key and get equal results.
    """
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_hash().alias("_h"),
        F.col("text").cast("string").alias("text"),
    )


def whole_rows(docs: DataFrame) -> DataFrame:
    """``row, row_id, row_h``: each row as one struct beside its key, so that no helper name meets a caller's column."""
    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    return docs.select(row, F.col("doc_id").cast("long").alias("row_id"), row_hash().alias("row_h"))


def of_row(found: DataFrame) -> Column:
    """The join condition of ``whole_rows`` with a result that has ``doc_id`` and ``_h``."""
    return F.col("row_id").eqNullSafe(found["doc_id"]) & (F.col("row_h") == found["_h"])
