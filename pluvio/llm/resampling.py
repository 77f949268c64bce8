"""Importance resampling towards a target distribution, drawn by distributed quickselect (operator 13).

Hashed word runs of all documents and of the target texts are counted per
bucket; the log ratio of each bucket is an array that every task scores whole
documents with. Gumbel noise turns the weights into a draw without replacement:
the highest scores win. The lowest winning key is found by quickselect - random
pivot keys, exact counts before and at each, and only the stretch that holds the
wanted place goes on - so the corpus is never sorted, only its winners are.
"""

from __future__ import annotations

import hashlib
import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm import text as tx
from pluvio.llm.scratch import discard, materialise
from pluvio.operators.numbering import number_rows

#: Pivot keys of one quickselect round.
PIVOTS = 15
#: Longer runs are summed one by one.
LONG_RUN = 64

_BYTE = np.arange(256)
#: A-Z folded, then the bytes of words ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+``.
_LOWER = np.where((_BYTE >= 65) & (_BYTE <= 90), _BYTE + 32, _BYTE).astype(np.uint8)
_IN_WORD = ((_LOWER >= 0x30) & (_LOWER <= 0x39)) | ((_LOWER >= 0x61) & (_LOWER <= 0x7A)) | (_LOWER >= 0x80)


def _crc_table() -> np.ndarray:
    """One step of CRC-32 (the reflected polynomial EDB88320) for each byte."""
    t = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        t = np.where(t & 1, (t >> 1) ^ np.uint32(0xEDB88320), t >> 1).astype(np.uint32)
    return t


_CRC = _crc_table()


def _runs(data: np.ndarray, bounds: np.ndarray, longest: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of every row joined by one space: the bytes, and start, end and row of every run of 1 to ``longest`` words."""
    n = len(data)
    inside = _IN_WORD[data] if n else np.zeros(0, bool)
    edge = np.zeros(n + 1, bool)
    edge[bounds] = True
    first, last = inside.copy(), inside.copy()
    if n:
        first[1:] &= ~inside[:-1] | edge[1:-1]
        last[:-1] &= ~inside[1:] | edge[1:-1]
    s, e = np.flatnonzero(first), np.flatnonzero(last) + 1
    row = np.searchsorted(bounds, s, "right") - 1
    size = e - s
    at = np.concatenate([[0], np.cumsum(size + 1)])  # places in the joined bytes
    joined = np.full(int(at[-1]), 0x20, np.uint8)
    fill = np.ones(int(at[-1]), bool)
    fill[at[1:] - 1] = False
    joined[fill] = _LOWER[data[inside]]
    starts, ends, rows = [at[:-1]], [at[:-1] + size], [row]
    for k in range(2, longest + 1):
        if len(s) >= k:
            same = row[k - 1 :] == row[: len(row) - k + 1]
            i = np.flatnonzero(same)
            starts.append(at[i])
            ends.append(at[i + k - 1] + size[i + k - 1])
            rows.append(row[i])
    return joined, np.concatenate(starts), np.concatenate(ends), np.concatenate(rows)


def crc32_runs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of ``data[start:end]`` for each pair of bounds."""
    out = np.full(len(start), 0xFFFFFFFF, np.uint32)
    size = end - start
    live = np.flatnonzero((size > 0) & (size <= LONG_RUN))
    k = 0
    while len(live):
        crc = out[live]
        out[live] = _CRC[(crc ^ data[start[live] + k]) & 0xFF] ^ (crc >> np.uint32(8))
        k += 1
        live = live[size[live] > k]
    out ^= np.uint32(0xFFFFFFFF)
    raw = data.tobytes() if (size > LONG_RUN).any() else b""
    for i in np.flatnonzero(size > LONG_RUN).tolist():
        out[i] = zlib.crc32(raw[start[i] : end[i]])
    return out


def _texts(df: DataFrame, *cols: Column) -> DataFrame:
    return df.select(*cols, F.col("text").cast("string").alias("text"))


def bucket_counts(texts: DataFrame, buckets: int, longest: int) -> np.ndarray:
    """Features per bucket over all rows; tasks add up their own and send one row per bucket they met."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, _, data, bounds in tx.slices(batch.column(0)):
                joined, s, e, _ = _runs(data, bounds, longest)
                total += np.bincount(crc32_runs(joined, s, e) % np.uint32(buckets), minlength=buckets)
        met = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(met), pa.array(total[met])], ["bucket", "n"])

    out = np.zeros(buckets, np.int64)
    for r in _texts(texts).mapInArrow(count, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n")).collect():
        out[r["bucket"]] = r["n"]  # at most ``buckets`` rows
    return out


def gains(corpus: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Thousandths of the log ratio of target to corpus share, each bucket smoothed by one, floored."""
    b, s_all, t_all = len(corpus), int(corpus.sum()), int(target.sum())
    pairs = zip(corpus.tolist(), target.tolist(), strict=True)
    ratio = (((t + 1) * (s_all + b)) / ((s + 1) * (t_all + b)) for s, t in pairs)
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def noise(doc_id: int | None, seed: int) -> int:
    """Thousandths of a Gumbel draw that the seed and the doc_id (null: nothing) decide, floored."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def score(docs: DataFrame, gain: np.ndarray, longest: int, seed: int) -> DataFrame:
    """``doc_id, n_words, n_features, weight, score`` of every row."""
    buckets = np.uint32(len(gain))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column(1)):
                joined, s, e, row = _runs(data, bounds, longest)
                worth = gain[crc32_runs(joined, s, e) % buckets]
                n = np.bincount(row, minlength=hi - lo)
                weight = np.bincount(row, worth, hi - lo).astype(np.int64)  # sums of integers, exact in doubles
                single = _runs(data, bounds, 1)[3] if longest > 1 else row
                ids = batch.column(0)[lo:hi]
                total = weight + np.array([noise(i, seed) for i in ids.to_pylist()], np.int64)
                words = np.bincount(single, minlength=hi - lo)
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(words), pa.array(n), pa.array(weight), pa.array(total)],
                    ["doc_id", "n_words", "n_features", "weight", "score"],
                )

    rows = _texts(docs, F.col("doc_id").cast("long").alias("doc_id"))
    return rows.mapInArrow(compute, "doc_id long, n_words long, n_features long, weight long, score long")


#: Best first: highest score, then smallest doc_id (null last); the rest tells unequal rows of one doc_id apart.
_KEY = ("-score", "doc_id IS NULL", "coalesce(doc_id, 0)", "n_features", "weight")


def _key() -> Column:
    return F.struct(*(F.expr(e).alias(f"k{i}") for i, e in enumerate(_KEY)))


def _literal(key) -> Column:
    return F.struct(*(F.lit(v).cast("boolean" if isinstance(v, bool) else "long").alias(f"k{i}") for i, v in enumerate(key)))


def kth_key(keys: DataFrame, k: int, pivots: int = PIVOTS, seed: int = 0):
    """The k-th smallest ``key`` of a stored table (1 <= k <= rows), by quickselect.

    Each round draws random keys of the live stretch as pivots, counts exactly
    the keys before and equal to each, and stores the one stretch between
    pivots that holds the place; its size falls by about ``pivots`` a round.
    """
    live, round_no = keys, 0
    while True:
        drawn = live.select("key").orderBy(F.xxhash64("key", F.lit(seed), F.lit(round_no)), "key").limit(pivots)
        points = sorted({tuple(r["key"]) for r in drawn.collect()})
        counts = live.agg(
            *(F.count_if(F.col("key") < _literal(p)).alias(f"b{i}") for i, p in enumerate(points)),
            *(F.count_if(F.col("key") == _literal(p)).alias(f"e{i}") for i, p in enumerate(points)),
        ).first()
        lo = hi = None
        dropped = 0
        for i, p in enumerate(points):
            before, equal = counts[f"b{i}"], counts[f"e{i}"]
            if before < k <= before + equal:
                if live is not keys:
                    discard(live)
                return p
            if k > before + equal:
                lo, dropped = p, before + equal
            else:
                hi = p
                break
        inside = F.lit(True)
        if lo is not None:
            inside &= F.col("key") > _literal(lo)
        if hi is not None:
            inside &= F.col("key") < _literal(hi)
        narrowed = materialise(live.where(inside), "quickselect")
        if live is not keys:
            discard(live)
        live, k, round_no = narrowed, k - dropped, round_no + 1


def resample(
    docs: DataFrame,
    target: DataFrame,
    percent: int = 10,
    least_words: int = 20,
    longest: int = 1,
    buckets: int = 10_000,
    seed: int = 2024,
) -> DataFrame:
    """Draw ``percent`` of the documents towards the distribution of ``target`` (operator 13).

    Returns per row ``doc_id, n_words, n_features, weight, score, rank``: words
    are ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of the A-Z folded whole text,
    features its runs of 1 to ``longest`` words, weight the sum of their gains,
    score the weight plus the draw's noise. Of the N rows with ``least_words``
    words or more, the floor(percent * N / 100) highest scores get a rank (ties
    to smaller doc_id, null last); others have none. Null text: no words,
    weight 0. A null doc_id draws the noise of the bare seed. Repeated rows are
    rows of their own, ranked next to each other. Empty documents: no rows;
    empty target: the gains favour rare buckets.
    """
    corpus = bucket_counts(docs, buckets, longest)
    gain = gains(corpus, bucket_counts(target, buckets, longest))
    scored = materialise(score(docs, gain, longest, seed).withColumn("key", _key()), "scored")
    fit = scored.where(F.col("n_words") >= least_words)
    k = percent * fit.count() // 100
    out = [F.col(c) for c in ("doc_id", "n_words", "n_features", "weight", "score")]
    none = F.lit(None).cast("long").alias("rank")
    if not k:
        return scored.select(*out, none)
    last = _literal(kth_key(fit.select("key"), k, seed=seed))
    won = (F.col("n_words") >= least_words) & (F.col("key") <= last)
    ranked = number_rows(scored.where(won), ["key"], out="rank")
    drawn = F.when(F.col("rank") <= k, F.col("rank")).alias("rank")  # rows equal to the last winner may outnumber its places
    return ranked.select(*out, drawn).union(scored.where(~won).select(*out, none))
