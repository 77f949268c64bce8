"""Key summaries beside published data: which days may hold one of a batch's keys.

Published files are sorted by key. A summary row describes a run of at most
``RUN_KEYS`` consecutive keys of one file: smallest key, largest key and a Bloom
filter of a few bytes a key. An incremental merge tests its keys against the
summaries and reads the key column of those days only that may hold one. A
wrong "may" costs reading; a "no" is certain, and a file without a summary is
always read, so results never depend on the summaries.
"""

from __future__ import annotations

import bisect
import datetime as dt
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Folder of a publish's summaries, beside its data (readers skip names that begin with an underscore).
FOLDER = "_keys"
#: Keys of one summary row, bits a key (at a full row), probes: a wrong "may" in about 1e-6 of tests.
RUN_KEYS, KEY_BITS, PROBES = 32_768, 32, 12
#: Batches of more distinct keys are not tested (a batch is sent to every task): all days are read.
MAX_KEYS = 500_000

SCHEMA = "file string, n long, lo string, hi string, bits binary"
_NO_DAY = "__HIVE_DEFAULT_PARTITION__"


def key_hash(key: str) -> Column:
    return F.xxhash64(F.col(key).cast("string"))


def _spots(hashes: np.ndarray, size: int) -> np.ndarray:
    """Bit positions of each hash (a row of ``PROBES``) in a filter of ``size`` bits, a power of two."""
    h = hashes.view(np.uint64)
    step = (h >> np.uint64(32)) | np.uint64(1)
    return (h[:, None] + np.arange(PROBES, dtype=np.uint64) * step[:, None]) & np.uint64(size - 1)


def bloom(hashes: np.ndarray) -> bytes:
    size = 1 << max(10, (KEY_BITS * max(len(hashes), 1) - 1).bit_length())
    bits = np.zeros(size, bool)
    bits[_spots(hashes, size).reshape(-1)] = True
    return np.packbits(bits, bitorder="little").tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> bool:
    raw = np.frombuffer(bits, np.uint8)
    spots = _spots(hashes, 8 * len(raw))
    return bool(((raw[spots >> np.uint64(3)] >> (spots & np.uint64(7)).astype(np.uint8)) & 1).all(1).any())


def summaries(rows: DataFrame) -> DataFrame:
    """Summary rows of ``file, k, h`` (file, key as text, its hash) in the files' order; no shuffle."""

    def runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        file, keys, hashes = None, [], []

        def row() -> pa.RecordBatch:
            values = [[file], [len(keys)], [min(keys)], [max(keys)], [bloom(np.array(hashes, np.int64))]]
            kinds = (pa.string(), pa.int64(), pa.string(), pa.string(), pa.binary())
            return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(values, kinds, strict=True)], ["file", "n", "lo", "hi", "bits"])

        for batch in batches:
            for f, k, h in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if keys and (f != file or len(keys) == RUN_KEYS):
                    yield row()
                    keys, hashes = [], []
                file = f
                keys.append(k)
                hashes.append(h)
        if keys:
            yield row()

    return rows.select("file", "k", "h").mapInArrow(runs, SCHEMA)


def write_summaries(spark: SparkSession, folder: str, key: str) -> None:
    """Summarise the keys of a published folder: one scan of its key column. NULL keys match nothing."""
    rows = spark.read.parquet(folder).where(F.col(key).isNotNull())
    rows = rows.select(F.col("_metadata.file_path").alias("file"), F.col(key).cast("string").alias("k"), key_hash(key).alias("h"))
    summaries(rows).write.mode("overwrite").parquet(f"{folder}/{FOLDER}")


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def _place(uri: str) -> str:
    """A file's path in one spelling (``file:/x`` and ``file:///x`` are one place)."""
    return re.sub(r"^([a-z0-9]+):/+", r"\1:/", uri)


def days_that_may_hold(
    spark: SparkSession, target: DataFrame, keys: DataFrame, *, key: str, partition_col: str, max_keys: int | None = None
) -> tuple[list, int] | None:
    """Days of ``target`` that may hold one of the keys, and the number of its days; None: not known.

    ``target`` reads files of published folders (``<folder>/<partition_col>=<day>/<file>``),
    ``keys`` has the batch's keys (one column). Nothing of the target is read:
    the driver gets the file names, which planning a scan lists anyway, and one
    row per file that may hold a key.
    """
    max_keys = MAX_KEYS if max_keys is None else max_keys
    wanted = keys.where(F.col(key).isNotNull()).select(F.col(key).cast("string").alias("k"), key_hash(key).alias("h")).distinct()
    wanted = sorted((r["k"], r["h"]) for r in wanted.limit(max_keys + 1).collect())
    if len(wanted) > max_keys:
        return None
    day_of, folders, plain = {}, set(), []
    for uri in target.inputFiles():
        found = re.match(rf"^(.*)/{re.escape(partition_col)}=([^/]+)/[^/]+$", uri)
        if not found:
            return None  # not laid out by day: nothing to leave out
        day_of[_place(uri)] = found[2]
        folders.add(found[1])
    known = [f for f in sorted(folders) if _exists(spark, f"{f}/{FOLDER}")]
    texts, hashes = [k for k, _ in wanted], np.array([h for _, h in wanted], np.int64)

    def test(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            may = []
            for lo, hi, bits in zip(*(batch.column(c).to_pylist() for c in ("lo", "hi", "bits")), strict=True):
                some = hashes[bisect.bisect_left(texts, lo) : bisect.bisect_right(texts, hi)]
                may.append(bool(len(some)) and may_hold(bits, some))
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(may, pa.bool_())], ["file", "may"])

    seen = {}
    if known:
        stored = spark.read.schema(SCHEMA).parquet(*(f"{f}/{FOLDER}" for f in known))
        found = stored.mapInArrow(test, "file string, may boolean").groupBy("file").agg(F.bool_or("may").alias("may"))
        seen = {_place(r["file"]): r["may"] for r in found.collect()}
    folder_known = {_place(f) for f in known}
    days = set()
    for file, day in day_of.items():
        summarised = file.rsplit("/", 2)[0] in folder_known  # a file of NULL keys alone has no row of its own
        if seen.get(file, not summarised):
            days.add(day)
    parse = lambda d: None if d == _NO_DAY else dt.date.fromisoformat(d)
    return [parse(d) for d in sorted(days)], len(set(day_of.values()))


__all__ = ["bloom", "days_that_may_hold", "may_hold", "summaries", "write_summaries"]
