"""SimHash near-duplicates by pigeonhole blocks (operator 3).

Fingerprints within ``max_bits`` differing bits agree on some choice of blocks:
with six blocks and three bits, three blocks stay untouched. Distinct
fingerprints meet on each choice of blocks; the Hamming distance decides.
Copies never meet each other: equal fingerprints are one row before the join.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.components import components
from pluvio.llm.scratch import keyed, materialise, of_row, whole_rows

SEED = 42
#: A bucket above this many distinct fingerprints is cut again on its other bits.
HOT_BUCKET = 4096


def fingerprint(words: list[bytes], shingle: int) -> int:
    """Majority of the shingles' hash bits as a signed 64-bit number."""
    if not words:
        return 0
    if len(words) < shingle:
        grams = [b" ".join(words)]
    else:
        grams = list(map(b" ".join, zip(*(words[k:] for k in range(shingle)), strict=False)))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(g, SEED) for g in grams], np.uint64)
    ones = np.zeros(64, np.int64)
    for lo in range(0, len(hashes), 65_536):
        bits = np.unpackbits(hashes[lo : lo + 65_536].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``doc_id, _h, fp`` of every row; a text without words (or null) has fingerprint 0."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = [fingerprint((t.as_py() or "").encode().lower().split(), shingle) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(fps, pa.int64())], ["doc_id", "_h", "fp"]
            )

    return keyed(docs).mapInArrow(compute, "doc_id long, _h binary, fp long")


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def block_masks(bits: list[int], blocks: int, keep: int) -> list[int]:
    """Masks of every choice of ``keep`` among ``blocks`` blocks of the given bit positions."""
    cuts = [len(bits) * k // blocks for k in range(blocks + 1)]
    parts = [sum(1 << b for b in bits[lo:hi]) for lo, hi in itertools.pairwise(cuts)]
    return [sum(c) for c in itertools.combinations(parts, keep)]


def _buckets(fps: DataFrame, masks: list[int]) -> DataFrame:
    """A row ``c, key, fp`` for each fingerprint and mask."""
    keys = [F.struct(F.lit(c).alias("c"), F.col("fp").bitwiseAND(F.lit(_signed(m))).alias("key")) for c, m in enumerate(masks)]
    return fps.select("fp", F.explode(F.array(*keys)).alias("k")).select("k.c", "k.key", "fp")


def close_links(fps: DataFrame, max_bits: int = 3, hot: int = HOT_BUCKET) -> DataFrame:
    """Links ``(a, b)`` whose components are those of all pairs within ``max_bits`` bits.

    Each bucket gives at most one link per member (to the smallest member it
    reaches inside the bucket) instead of all its pairs. Members of a bucket
    with more than ``hot`` distinct fingerprints are dealt to sub-buckets by
    the same pigeonhole argument on the bits outside its mask.
    """
    blocks = max_bits + 3
    masks = block_masks(list(range(64)), blocks, 3)
    rows = _buckets(fps, masks)
    counts = rows.groupBy("c", "key").count().where(F.col("count") > hot).select("c", "key", F.lit(True).alias("hot"))
    rows = rows.join(counts, ["c", "key"], "left")
    sub: Column = F.lit(None).cast("array<struct<s:int,sub:bigint>>")
    for c, m in enumerate(masks):
        free = [b for b in range(64) if not m >> b & 1]
        finer = block_masks(free, max_bits + 1, 1)
        parts = F.array(*(
            F.struct(F.lit(s).alias("s"), F.col("fp").bitwiseAND(F.lit(_signed(x))).alias("sub"))
            for s, x in enumerate(finer)
        ))
        sub = F.when(F.col("c") == c, parts).otherwise(sub)
    none = F.array(F.struct(F.lit(-1).alias("s"), F.lit(0).cast("long").alias("sub")))
    rows = rows.withColumn("p", F.explode(F.when(F.col("hot"), sub).otherwise(none)))
    rows = rows.select("c", "key", F.col("p.s").alias("s"), F.col("p.sub").alias("sub"), "fp")
    order = ["c", "key", "s", "sub"]
    rows = rows.repartition(*order).sortWithinPartitions(*order, "fp")
    return rows.mapInArrow(lambda it: _bucket_links(it, max_bits), "a long, b long").distinct()


def _bucket_links(batches: Iterator[pa.RecordBatch], max_bits: int) -> Iterator[pa.RecordBatch]:
    """Links inside each run of equal bucket columns; a run may go over batches."""
    held: np.ndarray | None = None
    for batch in batches:
        rows = np.stack([batch.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in range(5)])
        if held is not None:
            rows = np.concatenate([held, rows], 1)
        if not rows.shape[1]:
            continue
        new = np.flatnonzero((rows[:4, 1:] != rows[:4, :-1]).any(0)) + 1
        cut = int(new[-1]) if len(new) else 0
        held = rows[:, cut:]
        if cut:
            yield _links(rows[4, :cut], new[:-1], max_bits)
    if held is not None and held.shape[1] > 1:
        yield _links(held[4], np.zeros(0, np.int64), max_bits)


def _links(fp: np.ndarray, new: np.ndarray, max_bits: int) -> pa.RecordBatch:
    """Links in runs of ``fp`` that begin at 0 and at ``new``."""
    begin = np.concatenate([[0], new])
    size = np.diff(np.concatenate([begin, [len(fp)]]))
    out = []
    for m in np.unique(size[(size > 1) & (size <= 64)]):  # all small runs of a size at once
        at = begin[size == m][:, None] + np.arange(m)
        for i in range(1, m):
            for j in range(i):
                near = np.bitwise_count(fp[at[:, i]] ^ fp[at[:, j]]) <= max_bits
                out.append(np.stack([fp[at[near, i]], fp[at[near, j]]]))
    for lo, m in zip(begin[size > 64], size[size > 64], strict=True):
        out.append(_forest(np.unique(fp[lo : lo + m]), max_bits))
    pairs = np.concatenate(out, 1) if out else np.zeros((2, 0), np.int64)
    return pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], ["a", "b"])


def _forest(fp: np.ndarray, max_bits: int) -> np.ndarray:
    """Breadth-first trees over one large run: a link for each member but the roots."""
    left = np.arange(len(fp))
    links = []
    while len(left):
        front, left = left[:1], left[1:]
        while len(front) and len(left):
            node, front = front[0], front[1:]
            near = np.bitwise_count(fp[left] ^ fp[node]) <= max_bits
            found = left[near]
            links.append(np.stack([fp[found], np.full(len(found), fp[node])]))
            front = np.concatenate([front, found])
            left = left[~near]
    return np.concatenate(links, 1) if links else np.zeros((2, 0), np.int64)


def near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """Classes of documents linked by fingerprints at ``max_bits`` or fewer bits (operator 3).

    Returns per row ``doc_id, _h, fingerprint`` (16 hex digits) ``, component_id``
    (smallest doc_id reachable) ``, keep`` (true for the one row of its class
    that stays; repeated rows are equal in all columns). Null doc_ids count as
    largest; a class of null doc_ids has a null component_id. Empty table: no rows.
    """
    rows = materialise(fingerprints(docs, shingle), "fingerprints")
    # the smallest row of each fingerprint, then of each class: minima, taken before every shuffle
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_h")
    distinct = materialise(rows.groupBy("fp").agg(F.min(order).alias("least")), "distinct")
    roots = components(close_links(distinct.select("fp"), max_bits))
    classes = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", "least", F.coalesce("root", "fp").alias("root")
    )
    first = classes.groupBy("root").agg(F.min("least").alias("first"))
    classes = materialise(classes.join(first, "root").select("fp", "first"), "classes")
    return rows.join(classes, "fp").select(
        "doc_id",
        "_h",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("first.doc_id").alias("component_id"),
        (F.col("doc_id").eqNullSafe(F.col("first.doc_id")) & (F.col("_h") == F.col("first._h"))).alias("keep"),
    )


def drop_near_duplicates(docs: DataFrame, shingle: int = 3, max_bits: int = 3) -> DataFrame:
    """``docs`` with one document of each class; columns as they came."""
    kept = near_duplicates(docs, shingle, max_bits).where("keep").select("doc_id", "_h").distinct()
    one = whole_rows(docs).join(kept, of_row(kept), "left_semi")
    return one.dropDuplicates(["row_id", "row_h"]).select("row.*")
