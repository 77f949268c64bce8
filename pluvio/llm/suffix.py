"""Repeated byte strings by two-stage suffix sorting (operator 8).

Every string of ``length`` bytes holds many short grams; the one with the
smallest hash is its anchor, so equal strings have equal anchors. Only anchors
that occur twice can lie in a repeated string. The bytes around each of these
form a segment; segments with one anchor meet in one task, where a suffix array
of them is built by two-stage sorting: suffixes smaller than their successor
are sorted directly, all others are induced by bucket scans. Strings whose
common prefix with a neighbour reaches ``length`` are repeats. Anchors with
more than ``GROUP_BYTES`` of segments are not sorted: their strings are dealt
out by 128-bit digests of ever finer groups of starts, so no task holds all
segments of an anchor.
"""

from __future__ import annotations

import hashlib
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm import text as tx
from pluvio.llm.scratch import discard, keyed, materialise

GRAM = 32
#: Bytes of segments whose suffixes are sorted together (whole anchor groups).
SORT_BYTES = 1 << 19
#: Bytes of the distinct segments of one anchor from which its string starts are dealt out by digest.
GROUP_BYTES = 1 << 20
#: String starts of one group, level by level (each divides the one before).
STEPS = (49, 7, 1)


def _anchor_runs(data: np.ndarray, bounds: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Runs of string starts with one anchor: ``row, first start, last start + 1, anchor hash``.

    The anchor is the leftmost smallest gram; a run ends when the string moves
    past it, so two starts of one run never begin equal strings.
    """
    n = len(data)
    if n < length:
        z = np.zeros(0, np.int64)
        return z, z, z, np.zeros(0, np.uint64)
    gram = tx.gram_hashes(tx._BYTE[data], GRAM, tx.BYTE_BASE)
    anchor = tx.sliding_min(gram, length - GRAM + 1)
    row = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    at = row[: len(anchor)]
    inside = at == row[length - 1 :]
    new = np.ones(len(anchor), bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (gram[: len(anchor) - 1] == anchor[:-1])
    new[1:] |= (at[1:] != at[:-1]) | (inside[1:] != inside[:-1])
    first = np.flatnonzero(new)
    last = np.append(first[1:], len(anchor))
    ok = inside[first]
    return at[first[ok]], first[ok], last[ok], anchor[first[ok]]


def _digests(docs: DataFrame, length: int) -> DataFrame:
    """``doc_id, _h, n_bytes, whole_sha256, anchors`` (one per run) of every row."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column(2)):
                row, _, _, anchor = _anchor_runs(data, bounds, length)
                raw = data.tobytes()
                sha = [hashlib.sha256(raw[a:b]).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0)[lo:hi],
                        batch.column(1)[lo:hi],
                        pa.array(np.diff(bounds), pa.int64()),
                        pa.array(sha),
                        tx.lists(anchor.view(np.int64), tx.row_bounds(row, hi - lo), pa.int64()),
                    ],
                    ["doc_id", "_h", "n_bytes", "whole_sha256", "anchors"],
                )

    return keyed(docs).mapInArrow(
        compute, "doc_id long, _h binary, n_bytes long, whole_sha256 string, anchors array<bigint>"
    )


def _segments(rows: DataFrame, length: int) -> DataFrame:
    """``anchor, sid, seg, nr, start``: the bytes under each run of a shared anchor.

    ``sid`` is a digest of the bytes; equal segments of a batch carry them once.
    """

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column(1)):
                row, first, last, anchor = _anchor_runs(data, bounds, length)
                at = tx.row_bounds(row, hi - lo)
                keep = np.zeros(len(row), bool)
                for k in range(hi - lo):
                    known = batch.column(2)[lo + k].values.to_numpy().view(np.uint64)
                    keep[at[k] : at[k + 1]] = np.isin(anchor[at[k] : at[k + 1]], known)
                pick = np.flatnonzero(keep)
                if not len(pick):
                    continue
                raw = data.tobytes()
                seg = [raw[a : b + length - 1] for a, b in zip(first[pick].tolist(), last[pick].tolist(), strict=True)]
                sid = [hashlib.md5(x).digest() for x in seg]
                once = dict(zip(sid, seg, strict=True))  # the bytes go along once
                seg = [once.pop(x, None) for x in sid]
                owner = pa.array(lo + row[pick])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(anchor[pick].view(np.int64)),
                        pa.array(sid, pa.binary()),
                        pa.array(seg, pa.binary()),
                        batch.column(0).take(owner),
                        pa.array((first[pick] - bounds[row[pick]]).astype(np.int64)),
                    ],
                    ["anchor", "sid", "seg", "nr", "start"],
                )

    return rows.select("nr", "text", "shared").mapInArrow(
        compute, "anchor long, sid binary, seg binary, nr long, start long"
    )


def suffix_array(data: bytes, ends: np.ndarray, depth: int) -> np.ndarray:
    """Order of all suffixes by their first ``depth`` bytes at least, by two-stage sorting.

    ``ends`` gives for each position where its segment ends; a suffix stops
    there (an end is smaller than any byte). Stage one sorts the suffixes that
    are smaller than their successors, bucket by bucket of the first byte.
    Stage two scans the buckets upwards: whenever the suffix after a larger one
    is placed, the larger one is next in its own bucket.
    """
    text = np.frombuffer(data, np.uint8).astype(np.int16)
    n = len(text)
    after = np.full(n, -1, np.int16)  # the next byte, -1 at the end of a segment
    after[:-1] = text[1:]
    after[ends - 1 == np.arange(n)] = -1
    # larger than its successor: next byte smaller, or equal and the next suffix is larger than its own
    change = np.flatnonzero(after != text)
    to = change[np.searchsorted(change, np.arange(n))] if n else change
    larger = after[to] < text[to]
    smaller = np.flatnonzero(~larger)
    order = np.argsort(text[smaller], kind="stable")
    smaller = smaller[order]
    cuts = np.searchsorted(text[smaller], np.arange(257))
    stop = np.minimum(ends, np.arange(n) + depth)
    parts: list[list[np.ndarray]] = [[] for _ in range(256)]  # induced suffixes of each bucket, in order
    # a suffix of one byte follows no other: it is the smallest of its bucket
    last = np.unique(ends[ends > 0]) - 1 if n else np.zeros(0, np.int64)
    out = []

    def induce(placed: np.ndarray, c: int, into: list) -> np.ndarray:
        """Hand each placed suffix's larger predecessor to its bucket; returns those of bucket ``c``."""
        before = placed[placed > 0] - 1
        before = before[larger[before] & (ends[before] > before + 1)]
        heads = text[before]
        for b in np.unique(heads):
            if b != c:
                into[b].append(before[heads == b])
        return before[heads == c]

    for c in range(256):
        mine = last[text[last] == c]
        mine = np.concatenate([mine, *parts[c]]) if parts[c] else mine
        while len(mine):  # runs of one byte induce inside their own bucket
            out.append(mine)
            mine = induce(mine, c, parts)
        lo, hi = cuts[c], cuts[c + 1]
        if lo < hi:
            span = smaller[lo:hi].tolist()
            direct = np.array(sorted(span, key=lambda i: data[i : stop[i]]), np.int64)
            out.append(direct)
            induce(direct, c, parts)
    return np.concatenate(out) if out else np.zeros(0, np.int64)


def common_prefixes(data: bytes, ends: np.ndarray, order: np.ndarray, length: int) -> np.ndarray:
    """For each neighbouring pair of ``order``: do their first ``length`` bytes agree?"""
    raw = np.frombuffer(data, np.uint8)
    a, b = order[:-1], order[1:]
    ok = (ends[a] - a >= length) & (ends[b] - b >= length)
    pair = np.flatnonzero(ok)
    one, two = a[pair], b[pair]
    for step in range(0, length, 8):  # most pairs part early
        width = min(8, length - step)
        same = np.ones(len(pair), bool)
        for k in range(width):
            same &= raw[one + step + k] == raw[two + step + k]
        pair, one, two = pair[same], one[same], two[same]
    out = np.zeros(len(a), bool)
    out[pair] = True
    return out


def repeated_starts(segments: list[bytes], length: int) -> np.ndarray:
    """Mask over the joined segments: does the string of ``length`` bytes there occur at another place too?"""
    data = b"".join(segments)
    size = np.array([len(s) for s in segments])
    ends = np.repeat(np.cumsum(size), size)
    order = suffix_array(data, ends, length)
    same = common_prefixes(data, ends, order, length)
    hit = np.zeros(len(data), bool)
    hit[order[:-1][same]] = True
    hit[order[1:][same]] = True
    return hit


def _runs(mask: np.ndarray) -> list[tuple[int, int]]:
    edge = np.flatnonzero(np.diff(np.concatenate([[0], mask.astype(np.int8), [0]])))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist(), strict=True))


def _sorted_groups(batches: Iterator[pa.RecordBatch], length: int) -> Iterator[pa.RecordBatch]:
    """Repeated starts of distinct segments that arrive ordered by anchor."""
    held: list[tuple[int, bytes, bytes]] = []
    size = 0

    def flush() -> pa.RecordBatch:
        hit = repeated_starts([s for _, _, s in held], length)
        sid, spans, at = [], [], 0
        for _, key, seg in held:
            found = _runs(hit[at : at + len(seg)])
            if found:
                sid.append(key)
                spans.append([x for ab in found for x in ab])
            at += len(seg)
        return pa.RecordBatch.from_arrays([pa.array(sid, pa.binary()), pa.array(spans, pa.list_(pa.int32()))], ["sid", "spans"])

    for batch in batches:
        for anchor, sid, seg in zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True):
            if size >= SORT_BYTES and held[-1][0] != anchor:
                yield flush()
                held, size = [], 0
            held.append((anchor, sid, seg))
            size += len(seg)
    if held:
        yield flush()


_GROUPS = "array<struct<lo:int,hi:int,w:int>>"


def _stretches(pieces: DataFrame, length: int, step: int) -> DataFrame:
    """``sid, lo, hi, w, core, full``: the starts of ``anchor, sid, seg, groups`` in groups of ``step`` places before the anchor.

    Equal strings have their anchor at the same place, so they fall into equal
    groups. ``core`` digests the bytes that all strings of a group hold,
    ``full`` those that any of its strings in this segment holds.
    """

    def batch_of(out: list) -> pa.RecordBatch:
        cols = list(zip(*out, strict=True))
        kinds = (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
        return pa.RecordBatch.from_arrays(
            [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["sid", "lo", "hi", "w", "core", "full"]
        )

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for anchor, sid, seg, groups in zip(*(batch.column(k).to_pylist() for k in range(4)), strict=True):
                gram = tx.gram_hashes(tx._BYTE[np.frombuffer(seg, np.uint8)], GRAM, tx.BYTE_BASE)
                place = int(np.argmax(gram.view(np.int64) == anchor))
                for g in groups:
                    at, hi = g["lo"], g["hi"]
                    while at < hi:
                        group = (place - at) // step
                        a, b = place - step * (group + 1) + 1, place - step * group
                        end = min(b + 1, hi)
                        key = struct.pack("<qi", anchor, group)
                        core = hashlib.blake2b(seg[b : a + length], digest_size=16, salt=key).digest()
                        full = core
                        if step > 1:
                            key = struct.pack("<ii", place - at, place - end)
                            full = hashlib.blake2b(seg[at : end - 1 + length], digest_size=16, salt=key).digest()
                        out.append((sid, at, end, g["w"], core, full))
                        at = end
                if len(out) >= 20_000:
                    yield batch_of(out)
                    out = []
            if out:
                yield batch_of(out)

    return pieces.select("anchor", "sid", "seg", "groups").mapInArrow(
        compute, "sid binary, lo int, hi int, w int, core binary, full binary"
    )


def _dealt_groups(hot: DataFrame, length: int) -> DataFrame:
    """``sid, spans``: repeated starts of the distinct segments of large anchor groups.

    Starts are dealt out by digests of the bytes that groups of them share,
    the groups finer from level to level. A group whose full stretch occurs
    twice is settled; one whose core does not is done with; only the others
    (the edges of a shared passage) go on, beside one witness for each
    stretch that is settled. So equal strings always meet, by their digest, and
    no task holds the segments of an anchor.
    """
    hits = None
    first = F.struct(F.lit(0).alias("lo"), (F.octet_length("seg") - length + 1).cast("int").alias("hi"), F.lit(1).alias("w"))
    pieces = hot.select("anchor", "sid", "seg", F.array(first).cast(_GROUPS).alias("groups"))
    for step in STEPS:
        rows = materialise(_stretches(pieces, length, step), "stretches")
        # rows, places of one of them, and whether anything in the core occurs once: all pre-aggregated
        full = rows.groupBy("core", "full").agg(F.sum("w").alias("n"), F.min(F.struct("sid", "lo", "hi")).alias("one"))
        full = materialise(full, "full-stretches")
        twice = materialise(full.where("n > 1").select("core", "full"), "repeated-stretches")
        found = rows.join(twice, ["core", "full"]).select("sid", F.array("lo", "hi").alias("spans"))
        found = materialise(found, "settled")
        hits = found if hits is None else hits.union(found)
        discard(rows)
        if step == 1:
            return hits
        cores = full.groupBy("core").agg(F.sum("n").alias("n"), F.min("n").alias("least")).where("n > 1 AND least = 1")
        open_ = full.join(materialise(cores.select("core"), "open-cores"), "core")
        group = F.struct(F.col("one.lo").alias("lo"), F.col("one.hi").alias("hi"), F.least("n", F.lit(2)).cast("int").alias("w"))
        open_ = open_.select(F.col("one.sid").alias("sid"), group.alias("g")).groupBy("sid").agg(F.collect_list("g").alias("groups"))
        open_ = materialise(open_, "open-groups")
        discard(full)
        pieces = hot.join(open_.select("sid", F.col("groups").cast(_GROUPS).alias("groups")), "sid")


def _by_size(distinct: DataFrame, group_bytes: int) -> tuple[DataFrame, DataFrame]:
    """``anchor, sid, seg`` of the anchor groups to sort, and of those too large for one task."""
    size = F.sum(F.octet_length("seg")).alias("bytes")
    groups = distinct.groupBy("anchor").agg(F.count("*").alias("members"), size).where("members > 1")
    groups = materialise(groups.select("anchor", (F.col("bytes") > group_bytes).alias("large")), "groups")
    both = distinct.select("anchor", "sid", "seg")
    return tuple(both.join(groups.where(x).select("anchor"), "anchor") for x in ("NOT large", "large"))


def _cut(rows: DataFrame, length: int) -> DataFrame:
    """Remove the bytes under the repeated starts of each document."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for text, starts in zip(batch.column(2), batch.column(3), strict=True):
                raw = (text.as_py() or "").encode()
                change = np.zeros(len(raw) + 1, np.int32)
                pairs = starts.values.to_numpy().reshape(-1, 2)
                np.add.at(change, pairs[:, 0], 1)
                np.add.at(change, np.minimum(pairs[:, 1] + length - 1, len(raw)), -1)
                gone = np.cumsum(change[:-1]) > 0
                kept = np.frombuffer(raw, np.uint8)[~gone].tobytes()
                out.append((int(gone.sum()), len(_runs(gone)), hashlib.sha256(kept).hexdigest()))
            removed, spans, sha = zip(*out, strict=True) if out else ((), (), ())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(sha, pa.string())],
                ["_d", "_k", "n_removed", "n_spans", "kept_sha256"],
            )

    return rows.select("doc_id", "_h", "text", "starts").mapInArrow(
        compute, "_d long, _k binary, n_removed long, n_spans long, kept_sha256 string"
    )


def remove_repeated_bytes(docs: DataFrame, length: int = 400, group_bytes: int = GROUP_BYTES) -> DataFrame:
    """Bytes left after removing every string of ``length`` bytes that starts anywhere else too (operator 8).

    Returns per row ``doc_id, _h, n_bytes, n_removed, n_spans, kept_sha256``.
    Null text: no bytes. Matches never cross documents, but may lie in one
    document and overlap. A repeated row is another place; a null doc_id is
    like any other. Equal segments are settled by their count alone, so copies
    never meet in the sort; distinct segments of an anchor with more than
    ``group_bytes`` of them are settled by digests of their strings.
    """
    seeded = materialise(_digests(docs, length), "digests")
    meta = materialise(seeded.drop("anchors"), "byte-digests")
    seeds = seeded.where(F.size("anchors") > 0).select("doc_id", "_h", F.explode("anchors").alias("anchor"))
    shared = seeds.groupBy("anchor").agg(F.count("*").alias("n")).where("n > 1").select("anchor")
    shared = materialise(shared, "shared-anchors")  # a plain join, which the planner may split at hot anchors
    per_doc = seeds.join(shared, "anchor").groupBy("doc_id", "_h").agg(F.collect_set("anchor").alias("shared"))
    per_doc = per_doc.select(F.col("doc_id").alias("_d"), F.col("_h").alias("_k"), "shared")
    per_doc = materialise(per_doc, "shared")
    discard(seeded)
    rows = keyed(docs)
    candidates = rows.join(per_doc, rows["doc_id"].eqNullSafe(per_doc["_d"]) & (rows["_h"] == per_doc["_k"]))
    candidates = candidates.select("doc_id", "_h", "text", "shared").withColumn("nr", F.monotonically_increasing_id())
    candidates = materialise(candidates, "candidates")
    discard(per_doc)
    segments = materialise(_segments(candidates, length), "segments")
    # one row per distinct segment; those that occur twice are repeats throughout
    distinct = segments.groupBy("anchor", "sid").agg(F.first("seg", ignorenulls=True).alias("seg"), F.count("*").alias("n"))
    distinct = materialise(distinct, "distinct")
    spots = materialise(segments.select("sid", "nr", "start"), "places")
    discard(segments)
    to_sort, hot = _by_size(distinct, group_bytes)
    to_sort = to_sort.repartition("anchor").sortWithinPartitions("anchor")
    sorted_hits = to_sort.mapInArrow(lambda it: _sorted_groups(it, length), "sid binary, spans array<int>")
    whole = distinct.where("n > 1").select(
        "sid", F.array(F.lit(0), (F.octet_length("seg") - length + 1).cast("int")).alias("spans")
    )
    hits = materialise(whole.union(sorted_hits), "sorted")
    hot = materialise(hot, "large-groups")
    discard(distinct)
    if not hot.isEmpty():
        hits = hits.union(_dealt_groups(hot, length))
    hits = hits.groupBy("sid").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    hits = materialise(hits, "hits")  # a plain join, which the planner may split at a segment with many copies
    places = spots.join(hits, "sid")
    shifted = F.transform("spans", lambda x: x.cast("long") + F.col("start"))
    places = places.select("nr", shifted.alias("starts"))
    places = places.groupBy("nr").agg(F.flatten(F.collect_list("starts")).alias("starts"))
    cut = _cut(candidates.select("doc_id", "_h", "text", "nr").join(places, "nr"), length).dropDuplicates(["_d", "_k"])
    base = meta.select("doc_id", "_h", "n_bytes", "whole_sha256")
    out = base.join(cut, base["doc_id"].eqNullSafe(cut["_d"]) & (base["_h"] == cut["_k"]), "left")
    return out.select(
        "doc_id",
        "_h",
        "n_bytes",
        F.coalesce("n_removed", F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce("n_spans", F.lit(0)).cast("long").alias("n_spans"),
        F.coalesce("kept_sha256", "whole_sha256").alias("kept_sha256"),
    )
