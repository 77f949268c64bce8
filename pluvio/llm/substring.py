"""Repeated word windows by seeds and extension (operator 7).

A window of ``length`` words holds ``length - seed + 1`` seeds (runs of
``seed`` words); the one with the smallest hash is its anchor, so equal windows
have equal anchors (winnowing). Documents are joined on anchors; only anchors
of two or more documents are extended, both ways, to the windows around them;
windows that a document with a smaller doc_id holds too are repeats, and
overlapping ones make up the maximal repeats that are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pluvio.llm import text as tx
from pluvio.llm.scratch import discard, keyed, materialise, of_row, whole_rows

EMPTY = hashlib.sha256(b"").hexdigest()


def _windows(data: np.ndarray, bounds: np.ndarray, length: int, seed: int):
    """Word rows, word hashes, and per window start: whole in its row?, anchor hash."""
    s, e, row = tx.words(data, bounds)
    h = tx.word_hashes(data, s, e)
    if len(h) < length:
        return row, h, np.zeros(0, bool), np.zeros(0, np.uint64)
    anchor = tx.sliding_min(tx.gram_hashes(h, seed), length - seed + 1)
    return row, h, row[: len(anchor)] == row[length - 1 :], anchor


def anchors(docs: DataFrame, length: int, seed: int) -> DataFrame:
    """``doc_id, _h, n_words, whole_sha256, anchors``: once per run of windows with one anchor."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column(2)):
                row, _, inside, anchor = _windows(data, bounds, length, seed)
                new = np.ones(len(anchor), bool)
                at = row[: len(anchor)]
                new[1:] = (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1]) | ~inside[:-1]
                keep = np.flatnonzero(new & inside)
                raw = data.tobytes()
                sha = [
                    hashlib.sha256(b" ".join(raw[a:b].split())).hexdigest()
                    for a, b in zip(bounds[:-1], bounds[1:], strict=True)
                ]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[lo:hi],
                        batch.column(1)[lo:hi],
                        pa.array(np.diff(tx.row_bounds(row, hi - lo)), pa.int64()),
                        pa.array(sha),
                        tx.lists(anchor[keep].view(np.int64), tx.row_bounds(at[keep], hi - lo), pa.int64()),
                    ],
                    ["doc_id", "_h", "n_words", "whole_sha256", "anchors"],
                )

    return keyed(docs).mapInArrow(
        compute, "doc_id long, _h binary, n_words long, whole_sha256 string, anchors array<bigint>"
    )


def _extend(rows: DataFrame, length: int, seed: int) -> DataFrame:
    """Windows around each row's shared anchors: ``h1, h2, doc_id, nr, at``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared = batch.column(3)
            for lo, hi, data, bounds in tx.slices(batch.column(2)):
                row, h, inside, anchor = _windows(data, bounds, length, seed)
                first = tx.row_bounds(row, hi - lo)
                hit = np.zeros(len(anchor), bool)
                for k in range(hi - lo):
                    a, b = first[k], min(first[k + 1], len(anchor))
                    known = shared[lo + k].values.to_numpy().view(np.uint64)
                    hit[a:b] = np.isin(anchor[a:b], known)
                at = np.flatnonzero(hit & inside)
                if not len(at):
                    continue
                one = tx.run_hash(h, at, at + length, tx.WORD_BASE)
                two = tx.run_hash(tx.mix(h), at, at + length, tx.CHECK_BASE)
                rows_at = pa.array(lo + row[at])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(one.view(np.int64)),
                        pa.array((two >> np.uint64(32)).astype(np.uint32).view(np.int32)),
                        batch.column(0).take(rows_at),
                        batch.column(1).take(rows_at),
                        pa.array((at - first[row[at]]).astype(np.int32)),
                    ],
                    ["h1", "h2", "doc_id", "nr", "at"],
                )

    return rows.select("doc_id", "nr", "text", "shared").mapInArrow(
        compute, "h1 long, h2 int, doc_id long, nr long, at int"
    )


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """Remove the words under the repeated windows ``at``."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, at in zip(batch.column(2), batch.column(3), strict=True):
                words = (text.as_py() or "").encode().split()
                gone = tx.runs_of(at.values.to_numpy(), length, len(words))
                kept = b" ".join(w for w, g in zip(words, gone.tolist(), strict=True) if not g)
                out.append((int(gone.sum()), hashlib.sha256(kept).hexdigest(), kept.decode()))
            removed, sha, kept = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(sha, pa.string()), pa.array(kept, pa.string())],
                ["doc_id", "_h", "n_removed", "kept_sha256", "kept_text"],
            )

    return rows.select("doc_id", "_h", "text", "at").mapInArrow(
        compute, "doc_id long, _h binary, n_removed long, kept_sha256 string, kept_text string"
    )


def remove_repeats(docs: DataFrame, length: int = 13, seed: int = 6) -> DataFrame:
    """Words left after removing windows that a smaller doc_id holds too (operator 7).

    Returns per row ``doc_id, _h, n_words, n_removed, kept_sha256, kept_text``
    (null: text unchanged). Null text: no words. A null doc_id is neither
    smaller nor larger than another: its words stay and remove none. Rows of
    one doc_id do not remove each other's words; repeated rows get equal results.
    Whole copies (equal word sequences) are settled before the seeds are joined.
    """
    rows = keyed(docs)
    seeded = materialise(anchors(docs, length, seed), "anchors")
    meta = materialise(seeded.drop("anchors"), "word-digests")
    first = meta.groupBy("whole_sha256").agg(F.min("doc_id").alias("first_id"), F.max("doc_id").alias("last_id"))
    first = first.where("first_id < last_id").select("whole_sha256", "first_id")
    first = materialise(first, "copies")  # a plain join, which the planner may split at a text with many copies
    one = Window.partitionBy("whole_sha256").orderBy(F.col("doc_id").asc_nulls_last())
    distinct = seeded.where(F.size("anchors") > 0).select("whole_sha256", "doc_id", "anchors")
    distinct = distinct.withColumn("rn", F.row_number().over(one)).where("rn = 1 AND doc_id IS NOT NULL")
    seeds = distinct.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = seeds.groupBy("anchor").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    shared = shared.where("lo < hi").select("anchor")
    shared = materialise(shared, "shared-anchors")  # a plain join, which the planner may split at hot anchors
    per_doc = seeds.join(shared, "anchor").groupBy("doc_id").agg(F.collect_set("anchor").alias("shared"))
    per_doc = materialise(per_doc, "shared")
    discard(seeded)
    candidates = rows.join(per_doc, "doc_id").withColumn("nr", F.monotonically_increasing_id())
    candidates = materialise(candidates, "candidates")
    discard(shared)
    discard(per_doc)
    windows = materialise(_extend(candidates, length, seed), "windows")
    least = windows.groupBy("h1", "h2").agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    least = materialise(least.where("lo < hi").select("h1", "h2", "lo"), "repeats")
    repeats = windows.join(least, ["h1", "h2"]).where("doc_id > lo")
    repeats = materialise(repeats.groupBy("nr").agg(F.collect_set("at").alias("at")), "repeated-starts")
    discard(windows)
    discard(least)
    texts = candidates.select("doc_id", "_h", "text", "nr")
    cut = _cut(texts.join(repeats, "nr"), length).dropDuplicates(["doc_id", "_h"])
    cut = cut.select(
        F.col("doc_id").alias("_d"), F.col("_h").alias("_k"), "n_removed", "kept_sha256", "kept_text"
    )
    base = meta.select("doc_id", "_h", "n_words", "whole_sha256").join(first, "whole_sha256", "left")
    copy = (F.col("doc_id") > F.col("first_id")) & (F.col("n_words") >= length)
    out = base.join(cut, (F.col("doc_id") == F.col("_d")) & (F.col("_h") == F.col("_k")), "left")
    return out.select(
        "doc_id",
        "_h",
        "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("n_removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, F.lit(EMPTY)).otherwise(F.coalesce("kept_sha256", "whole_sha256")).alias("kept_sha256"),
        F.when(copy, F.lit("")).otherwise(F.col("kept_text")).alias("kept_text"),
    )


def cut_repeats(docs: DataFrame, length: int = 13) -> DataFrame:
    """``docs`` with repeated words removed from ``text`` and ``n_chars`` set anew; other columns as they came.

    Texts without repeats stay as they are; the kept words of others are joined
    by one space. Documents that lose every word go.
    """
    found = remove_repeats(docs, length).where("kept_text IS NOT NULL")
    found = found.select("doc_id", "_h", "kept_text").dropDuplicates(["doc_id", "_h"])
    out = whole_rows(docs).join(found, of_row(found), "left")
    out = out.where(F.col("kept_text").isNull() | (F.col("kept_text") != ""))
    cut = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    return out.select(
        *(
            F.when(F.col("kept_text").isNull(), F.col(f"row.`{c}`")).otherwise(cut[c]).alias(c) if c in cut else F.col(f"row.`{c}`")
            for c in docs.columns
        )
    )
