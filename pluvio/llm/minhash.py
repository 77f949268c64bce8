"""Near-duplicate classes by b-bit MinHash (operator 12).

Band keys over full minima bring candidates together. Members of shared bands
get a signature: of several hundred minima only the low bits are kept, packed
into a few words, and equal bit groups, corrected for chance collisions,
estimate the similarity that sorts out candidates below the threshold. What is
left is confirmed on the full shingle sets.

Pairs of a bucket are never rows: members are compared with the bucket's
smallest member first, then those still apart with each other, block by block
inside tasks that return a forest of what they found. Estimates join members
into clusters; the full sets of a cluster's members meet once, in blocks too,
and every candidate pair between two classes is tested there.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm import text as tx
from pluvio.llm.components import components
from pluvio.llm.scratch import discard, keyed, materialise, of_row

U64 = np.uint64
#: Chance that a pair at the threshold shares no band, and most minima that all bands may take.
MISS, BAND_MINIMA = 5e-9, 256
#: Minima of a signature, and low bits kept of each.
SIGNATURE, BITS = 512, 2
#: Standard errors below the threshold at which an estimate rules a candidate out.
ERRORS = 6
#: Members of one block that a task compares at a time, and shingles that count as one more member where sets meet.
BLOCK, MEMBER_SHINGLES = 2048, 4096
#: Keys of needed rows up to this number (24 bytes each) are broadcast; more are joined by a shuffle.
BROADCAST_ROWS = 500_000

_r = np.random.default_rng(20_250_801)
_MUL = _r.integers(0, 1 << 63, SIGNATURE, dtype=np.int64).view(U64) * U64(2) + U64(1)
_XOR = _r.integers(0, 1 << 63, SIGNATURE, dtype=np.int64).view(U64)


def shingle_sets(data: np.ndarray, bounds: np.ndarray, shingle: int) -> list[np.ndarray]:
    """Sorted distinct hashes of each row's shingles (fewer words: of the whole sequence; none: empty)."""
    s, e, row = tx.words(data, bounds)
    h = tx.word_hashes(data, s, e, lower=True)
    first = tx.row_bounds(row, len(bounds) - 1)
    grams = tx.gram_hashes(h, shingle)
    out = []
    for a, b in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
        if b - a >= shingle:
            out.append(np.unique(grams[a : b - shingle + 1]))
        else:  # the number of words goes into the hash, so that no shorter sequence equals a shingle
            out.append(tx.gram_hashes(h[a:b], b - a, tx.CHECK_BASE) if b > a else np.zeros(0, U64))
    return out


def minima(values: np.ndarray, first: np.ndarray, functions: int) -> np.ndarray:
    """Minima of the first hash functions over each run of ``values`` that begins at ``first``; a row per run."""
    out = np.empty((len(first), functions), U64)
    for k in range(functions):
        out[:, k] = np.minimum.reduceat((values ^ _XOR[k]) * _MUL[k], first)
    return out


def banding(percent: int) -> tuple[int, int]:
    """Bands, and minima per band: as many of these as ``BAND_MINIMA`` allows at a chance of ``MISS``.

    At 80 percent 49 bands of 5: a pair that only shares a common passage (similarity 0.2)
    meets in 0.016 bands on average, so a passage makes no hot bucket. Thresholds below 20 raise.
    """
    if percent < 20:
        raise ValueError("near_classes needs a threshold of 20 percent or more")
    bands = lambda rows: math.ceil(math.log(MISS) / math.log1p(-min((percent / 100) ** rows, 1 - MISS)))
    rows = max((k for k in range(1, 9) if k * bands(k) <= BAND_MINIMA), default=1)
    return bands(rows), rows


def band_keys(low: np.ndarray, bands: int) -> np.ndarray:
    """A key per band of each row of minima."""
    key = np.arange(1, bands + 1, dtype=U64)[None, :] * U64(tx.CHECK_BASE)
    for k in range(low.shape[1] // bands):
        key = tx.mix(key + low[:, k * bands : (k + 1) * bands])
    return key


def pack(low: np.ndarray) -> np.ndarray:
    """The low ``BITS`` bits of each minimum, packed into 64-bit words."""
    bits = (low[:, :, None] >> np.arange(BITS, dtype=U64)) & U64(1)
    return np.packbits(bits.astype(np.uint8).reshape(len(low), -1), axis=1, bitorder="little").view(U64)


_LOWEST = U64(sum(1 << k for k in range(0, 64, BITS)))


def similarity(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Estimated similarity of packed signatures (last axis: words), corrected for chance collisions."""
    differ = x ^ y
    for k in range(1, BITS):  # any differing bit of a group lands on its lowest bit
        differ = differ | ((x ^ y) >> U64(k))
    unequal = np.bitwise_count(differ & _LOWEST).sum(-1, dtype=np.int64)
    chance = 2.0**-BITS
    return (1 - unequal / SIGNATURE - chance) / (1 - chance)


def least_estimate(percent: int) -> float:
    """An estimate below this rules a pair out: ``ERRORS`` standard errors under the threshold."""
    chance, t = 2.0**-BITS, percent / 100
    p = t + (1 - t) * chance
    return t - ERRORS * (p * (1 - p) / SIGNATURE) ** 0.5 / (1 - chance)


def signatures(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """``doc_id, _h, n, digest, bands`` of every row; an empty set has null digest and bands."""
    bands, rows = banding(percent)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column(2), 1 << 19):
                sets = shingle_sets(data, bounds, shingle)
                size = np.array([len(x) for x in sets], np.int64)
                full = np.flatnonzero(size)
                keys: list = [None] * (hi - lo)
                if len(full):
                    low = minima(np.concatenate(sets), (np.cumsum(size) - size)[full], bands * rows)
                    for k, band in zip(full.tolist(), band_keys(low, bands).view(np.int64), strict=True):
                        keys[k] = band
                digests = [hashlib.md5(x, usedforsecurity=False).digest() if len(x) else None for x in sets]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(size), pa.array(digests, pa.binary())]
                    + [pa.array(keys, pa.list_(pa.int64()))],
                    ["doc_id", "_h", "n", "digest", "bands"],
                )

    return keyed(docs).mapInArrow(compute, "doc_id long, _h binary, n long, digest binary, bands array<bigint>")


def full_sets(docs: DataFrame, needed: DataFrame, shingle: int) -> DataFrame:
    """``sid, n, sig, grams``: size, signature and sorted set of the rows ``doc_id, _h, sid`` (none empty), each once."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column(1), 1 << 19):
                sets = shingle_sets(data, bounds, shingle)
                size = np.array([len(x) for x in sets], np.int64)
                sigs = pack(minima(np.concatenate(sets), np.cumsum(size) - size, SIGNATURE))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(size), pa.array([x.tobytes() for x in sigs], pa.binary())]
                    + [pa.array([x.tobytes() for x in sets], pa.binary())],
                    ["sid", "n", "sig", "grams"],
                )

    needed = needed.select("doc_id", "_h", "sid")
    if needed.count() <= BROADCAST_ROWS:
        needed = F.broadcast(needed)
    rows = keyed(docs).select(F.col("doc_id").alias("row_id"), F.col("_h").alias("row_h"), "text")
    grams = rows.join(needed, of_row(needed)).select("sid", "text").mapInArrow(compute, "sid long, n long, sig binary, grams binary")
    whole = grams.groupBy("sid").agg(F.first(F.struct("n", "sig", "grams")).alias("s"))  # repeated rows of one key
    return whole.select("sid", "s.*")


def confirm(pairs: DataFrame, grams: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose full sets reach the threshold."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3), strict=True):
                one, two = (np.frombuffer(v.as_buffer(), U64) for v in (x, y))
                both = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(100 * both >= percent * (len(one) + len(two) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    one = grams.select(F.col("sid").alias("a"), F.col("grams").alias("x"))
    two = grams.select(F.col("sid").alias("b"), F.col("grams").alias("y"))
    both = pairs.join(one, "a").join(two, "b").select("a", "b", "x", "y")
    return both.mapInArrow(compute, "a long, b long")


def _words(column: pa.Array) -> np.ndarray:
    """A binary column of signatures as rows of 64-bit words."""
    return np.frombuffer(b"".join(column.to_pylist()), U64).reshape(len(column), -1)


def likely_pairs(pairs: DataFrame, marks: DataFrame, percent: int) -> DataFrame:
    """Pairs ``a, b`` whose sizes and signatures do not rule the threshold out."""
    least = least_estimate(percent)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = similarity(_words(batch.column(2)), _words(batch.column(3))) >= least
            yield batch.select(["a", "b"]).filter(pa.array(near))

    side = lambda k: marks.select(F.col("sid").alias(k), F.col("n").alias(f"n_{k}"), F.col("sig").alias(f"s_{k}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b")
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return both.where(fits).select("a", "b", "s_a", "s_b").mapInArrow(compute, "a long, b long")


def _apart(members: DataFrame, classes: DataFrame, block: int) -> DataFrame:
    """Blocks of the groups ``key, sid, pivot, weight`` that hold several classes: ``key, kind, i, j, side, sid, root``.

    Members outside the class of the group's pivot (the rest) meet the members
    of that class (kind 0) and each other (kind 1), block by block.
    """
    root = classes.select(F.col("node").alias("sid"), "root")
    rows = members.join(root, "sid", "left").withColumn("root", F.coalesce("root", "sid"))
    pivot_root = F.min(F.when(F.col("sid") == F.col("pivot"), F.col("root")))
    split = rows.groupBy("key").agg(pivot_root.alias("main"), F.min("root").alias("lo"), F.max("root").alias("hi"))
    split = materialise(split.where("lo < hi").select("key", "main"), "split-buckets")
    rows = rows.join(split, "key").withColumn("rest", F.col("root") != F.col("main"))
    # blocks by hash: the number of either side is at most the group's size
    blocks = lambda side: F.greatest(F.ceil(F.sum(F.when(side, F.col("weight"))) / block), F.lit(1)).cast("int")
    count = rows.groupBy("key").agg(blocks(F.col("rest")).alias("b_rest"), blocks(~F.col("rest")).alias("b_main"))
    count = materialise(count, "bucket-blocks")
    rows = rows.join(count, "key")
    own = F.pmod(F.xxhash64("sid"), F.when(F.col("rest"), F.col("b_rest")).otherwise(F.col("b_main"))).cast("int")
    rows = rows.withColumn("own", own)
    spot = lambda kind, i, j, side: F.struct(F.lit(kind).alias("kind"), i.alias("i"), j.alias("j"), F.lit(side).alias("side"))
    up_to = lambda c: F.sequence(F.lit(0), F.col(c) - 1)
    mains = F.transform(up_to("b_rest"), lambda i: spot(0, i, F.col("own"), 1))
    meets = F.transform(up_to("b_main"), lambda j: spot(0, F.col("own"), j, 0))
    earlier = F.transform(F.sequence(F.lit(0), F.col("own")), lambda i: spot(1, i, F.col("own"), 1))
    later = F.transform(F.sequence(F.col("own"), F.col("b_rest") - 1), lambda j: spot(1, F.col("own"), j, 0))
    places = F.when(F.col("rest"), F.concat(meets, earlier, later)).otherwise(mains)
    rows = rows.select("key", "sid", "root", F.explode(places).alias("p"))
    return rows.select("key", "p.kind", "p.i", "p.j", "p.side", "sid", "root")


_ORDER = ["key", "kind", "i", "j"]


def _shared(grams: list, x: int, others: np.ndarray) -> np.ndarray:
    """Number of shingles that the set ``x`` has in common with each of the others."""
    flat = np.concatenate([grams[k] for k in others.tolist()])
    size = np.array([len(grams[k]) for k in others.tolist()])
    at = np.minimum(np.searchsorted(grams[x], flat), len(grams[x]) - 1)
    return np.add.reduceat((grams[x][at] == flat).astype(np.int64), np.cumsum(size) - size)


def _links(rows: DataFrame, percent: int, most: int) -> DataFrame:
    """``a, b``: a forest per block of ``_apart`` that joins all classes with a candidate pair there.

    With a column ``grams`` the full sets decide, for each member's likeliest
    ``most`` partners first; else sizes and estimates do. A pair is passed over
    only if links already given join its classes.
    """
    least = least_estimate(percent)
    exact = "grams" in rows.columns

    def links(block: list) -> pa.RecordBatch:
        side, sid, root, n, sig = block[:5]
        label = np.unique(root, return_inverse=True)[1]
        y = np.flatnonzero(side == 1)
        grams = [np.frombuffer(v, U64) for v in block[5]] if exact else None
        found: list[tuple[int, int]] = []

        def join(x: int, those: np.ndarray) -> None:
            """Link ``x`` with one member of each class among ``those``."""
            own, first = np.unique(label[those], return_index=True)
            found.extend((sid[x], k) for k in sid[those[first]].tolist())
            label[np.isin(label, own)] = label[x]

        for x in np.flatnonzero(side == 0).tolist():
            fits = label[y] != label[x]
            fits &= 100 * np.minimum(n[y], n[x]) >= percent * np.maximum(n[y], n[x])
            those = y[fits]
            if not len(those):
                continue
            est = similarity(sig[those], sig[x])
            those, est = those[est >= least], est[est >= least]
            if not exact:
                if len(those):
                    join(x, those)
                continue
            those = those[np.lexsort((sid[those], -est))]
            while len(those):
                some, those = those[:most], those[most:]
                both = _shared(grams, x, some)
                some = some[100 * both >= percent * (n[some] + n[x] - both)]
                if len(some):
                    join(x, some)
                    those = those[label[those] != label[x]]
        both = np.array(found, np.int64).reshape(-1, 2)
        return pa.RecordBatch.from_arrays([pa.array(both.max(1)), pa.array(both.min(1))], ["a", "b"])

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys = cols = None  # rows of the last block, which may go on in the next batch

        def part(cols: list, lo: int, hi: int) -> list:
            return [x[lo:hi] for x in cols]

        for batch in batches:
            if not batch.num_rows:
                continue
            more = np.stack([batch.column(c).to_numpy().astype(np.int64) for c in _ORDER])
            now = [batch.column(c).to_numpy() for c in ("side", "sid", "root", "n")] + [_words(batch.column("sig"))]
            if exact:
                now.append(np.array(batch.column("grams").to_pylist(), object))
            if keys is not None:
                more = np.concatenate([keys, more], 1)
                now = [np.concatenate(x) for x in zip(cols, now, strict=True)]
            cuts = [0, *(np.flatnonzero((more[:, 1:] != more[:, :-1]).any(0)) + 1).tolist()]
            for lo, hi in zip(cuts[:-1], cuts[1:], strict=True):
                yield links(part(now, lo, hi))
            keys, cols = more[:, cuts[-1] :], part(now, cuts[-1], len(now[0]))
        if keys is not None:
            yield links(cols)

    dealt = rows.repartition(*_ORDER).sortWithinPartitions(*_ORDER)
    return dealt.mapInArrow(compute, "a long, b long")


def _clusters(nodes: DataFrame, classes: DataFrame) -> DataFrame:
    """``key, sid, pivot`` of the members of clusters ``node, root`` that hold several classes; the pivot stands for the largest."""
    rows = nodes.select(F.col("node").alias("sid"), F.col("root").alias("key"))
    rows = rows.union(rows.select(F.col("key").alias("sid"), "key").distinct())
    of = rows.join(classes.select(F.col("node").alias("sid"), "root"), "sid", "left")
    sizes = of.groupBy("key", F.coalesce("root", "sid").alias("c")).agg(F.count("*").alias("m"))
    pivots = sizes.groupBy("key").agg(F.max_by("c", F.struct("m", "c")).alias("pivot"), F.count("*").alias("classes"))
    return rows.join(pivots.where("classes > 1").select("key", "pivot"), "key")


def near_classes(docs: DataFrame, shingle: int = 4, percent: int = 80, block: int = BLOCK, most: int = 32) -> DataFrame:
    """Classes of documents linked by shared shingles (operator 12).

    A document's set holds its distinct runs of ``shingle`` words (A-Z folded;
    fewer words: the whole sequence). Sets link where 100 * intersection >=
    ``percent`` * union. Returns per row ``doc_id, n_shingles, component_id``
    (smallest doc_id reachable) ``, kept`` (doc_id = component_id). Null or
    empty texts and texts without words have no shingles and link with
    nothing; their component is their doc_id. Null doc_ids count as largest:
    a class of them alone has a null component_id and its rows are kept.
    Repeated rows get equal results. Empty table: no rows.
    """
    rows = materialise(signatures(docs, shingle, percent), "signatures")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "_h")
    sets = rows.where("digest IS NOT NULL").groupBy("digest").agg(
        F.min(order).alias("least"), F.first("bands").alias("bands")
    )
    sets = sets.select("digest", "least", "bands", F.monotonically_increasing_id().alias("sid"))
    sets = materialise(sets, "sets")  # equal sets are one from here on
    spread = sets.select("sid", F.explode("bands").alias("key"))
    buckets = spread.groupBy("key").agg(F.min("sid").alias("pivot"), F.max("sid").alias("last"))
    buckets = materialise(buckets.where("pivot < last").select("key", "pivot"), "buckets")
    members = materialise(spread.join(buckets, "key"), "members")
    new = members.where("sid != pivot").select(F.col("sid").alias("a"), F.col("pivot").alias("b")).distinct()
    needed = sets.join(members.select("sid").distinct(), "sid").select("sid", "least.doc_id", "least._h")
    grams = materialise(full_sets(docs, materialise(needed, "needed"), shingle), "grams")
    marks = grams.select("sid", "n", "sig")
    joined = lambda one, two: components(one.select("a", "b").union(two.select("a", "b")))
    as_links = lambda classes: classes.select(F.col("node").alias("a"), F.col("root").alias("b"))
    new = materialise(likely_pairs(new, marks, percent), "candidates")
    near = components(new)
    apart = _apart(members.withColumn("weight", F.lit(1.0)), near, block).join(marks, "sid")
    near = joined(as_links(near), materialise(_links(apart, percent, most), "near"))
    classes = components(materialise(confirm(new, grams, percent), "confirmed"))
    weight = 1 + F.col("n") / MEMBER_SHINGLES
    inside = _clusters(near, classes).join(marks.select("sid", weight.alias("weight")), "sid")
    apart = _apart(materialise(inside, "clusters"), classes, block).join(grams, "sid")
    classes = joined(as_links(classes), materialise(_links(apart, percent, most), "linked"))
    discard(grams)
    roots = sets.join(classes, sets["sid"] == classes["node"], "left").select(
        "digest", F.col("least.doc_id").alias("least_id"), F.coalesce("root", "sid").alias("root")
    )
    first = roots.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_set = materialise(roots.join(first, "root").select(F.col("digest").alias("d"), "component_id"), "classes")
    out = rows.select("doc_id", "n", "digest").join(by_set, F.col("digest") == F.col("d"), "left")
    component = F.when(F.col("digest").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("component_id"))
    )
