"""Landing envelopes: one JSON object per line,
``{"trace_id": ..., "observations": {"features": [...]}}``.

Reading is a batch over a directory (every landed object of every job), with an
explicit schema so nothing is inferred and each feature stays a VARIANT.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pluvio.schemas import ENVELOPE_DDL

ERROR = "_envelope_error"

# Where a landed line stands: file, offset of the part of the file that one task reads, landing time.
SOURCE = ["__file", "__start", "__landed"]


def _error_reason() -> F.Column:
    return (
        F.when(F.col("_corrupt_record").isNotNull(), F.lit("corrupt line"))
        .when(F.col("trace_id").isNull(), F.lit("missing trace_id"))
        .when(F.col("observations").isNull(), F.lit("missing observations"))
        .when(F.col("observations.features").isNull(), F.lit("missing observations.features"))
    )


def with_source(raw: DataFrame) -> DataFrame:
    """Add the ``SOURCE`` columns to the rows of a file scan (batch or streaming)."""
    names = ("file_path", "file_block_start", "file_modification_time")
    return raw.select("*", *(F.col(f"_metadata.{n}").alias(c) for n, c in zip(names, SOURCE, strict=True)))


def read_envelopes(
    spark: SparkSession, path: str | list[str], *, on_bad: str = "fail", source: bool = False
) -> DataFrame:
    """Read landed envelopes.

    A bad line (not JSON, or without ``trace_id`` / ``observations.features``):

    * ``"fail"``: the job that consumes the rows fails (checked row by row inside
      the scan's stage, no extra pass);
    * ``"quarantine"``: bad lines are dropped here; read them with
      :func:`quarantined_envelopes`;
    * ``"flag"``: all lines, with ``_envelope_error`` set on bad ones.

    An empty ``features`` array is valid (it yields no rows). ``source=True``
    keeps where each line stands (``SOURCE``), from which a load takes its order.
    """
    raw = (
        spark.read.schema(ENVELOPE_DDL)
        .option("mode", "PERMISSIVE")
        .option("columnNameOfCorruptRecord", "_corrupt_record")
        .json(path)
    )
    return check_envelopes(with_source(raw) if source else raw, on_bad)


def check_envelopes(raw: DataFrame, on_bad: str = "fail") -> DataFrame:
    """Apply the bad-line policy of :func:`read_envelopes` to raw envelope rows
    (batch or streaming)."""
    flagged = raw.withColumn(ERROR, _error_reason())
    if on_bad == "flag":
        return flagged
    if on_bad == "quarantine":
        return flagged.filter(F.col(ERROR).isNull()).drop(ERROR, "_corrupt_record")
    if on_bad != "fail":
        raise ValueError(f"on_bad must be 'fail', 'quarantine' or 'flag', got {on_bad!r}")
    checked = F.when(
        F.col(ERROR).isNotNull(),
        F.raise_error(F.concat(F.lit("invalid envelope: "), F.col(ERROR))),
    ).otherwise(F.col("trace_id"))
    return flagged.withColumn("trace_id", checked).drop(ERROR, "_corrupt_record")


def quarantined_envelopes(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The bad lines of a landing folder with their reason."""
    return read_envelopes(spark, path, on_bad="flag").filter(F.col(ERROR).isNotNull())


def write_envelopes(
    features: DataFrame,
    path: str,
    job_id: str,
    *,
    max_features: int = 5000,
    trace_col: str = "trace_id",
    feature_col: str = "feature",
) -> str:
    """Wrap features into envelopes and write them as JSON lines under ``path/job_id``.

    One envelope holds at most ``max_features`` features of one trace. Each
    task reads its part of the input in order, collects the features of the
    traces it meets, and writes them out whenever it holds ``max_features``: no
    shuffle, no sort, and a trace holding a third of all rows becomes many
    bounded envelopes in many tasks. Tasks write one file each, in the order of
    the input's partitions, so file name, line and list position together keep
    the input order of every trace. Features are VARIANT or structs (of which
    NULL fields are left out). A NULL trace id is an error (the loader
    would reject the envelope). Returns the output folder.
    """
    trace = F.when(
        F.col(trace_col).isNull(), F.raise_error(F.lit("write_envelopes: NULL trace_id"))
    ).otherwise(F.col(trace_col))

    def lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[str]] = {}
        count = 0

        def envelopes() -> pa.RecordBatch:
            found = [f'{{"trace_id":{json.dumps(t)},"observations":{{"features":[{",".join(docs)}]}}}}' for t, docs in held.items()]
            return pa.RecordBatch.from_arrays([pa.array(found, pa.string())], ["value"])

        for batch in batches:
            for t, doc in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                held.setdefault(t, []).append("null" if doc is None else doc)
                count += 1
                if count == max_features:
                    yield envelopes()
                    held, count = {}, 0
        if held:
            yield envelopes()

    texts = features.select(trace.cast("string").alias("trace_id"), F.to_json(F.col(feature_col)).alias("doc"))
    target = f"{path.rstrip('/')}/{job_id}"
    texts.mapInArrow(lines, "value string").write.mode("errorifexists").text(target)
    return target
