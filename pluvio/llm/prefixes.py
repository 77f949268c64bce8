"""Trie of shared conversation prefixes from sorted sequences (operator 11).

Every conversation is a byte string of one fixed-width element per turn, so
sorted strings have the members of every prefix side by side. The distinct
strings are dealt to key ranges; each block of a sorted range builds a sparse
table of range minima over the common-prefix lengths of neighbours, and every
candidate prefix finds its first and its last member by two binary searches
that do not depend on each other. What a node sums over its members is additive
over blocks, so only nodes that go over the edge of a block meet again by key.
"""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pluvio.llm.scratch import materialise

#: Bytes of one turn in a sequence: 16 of its digest, 4 of its number of words.
WIDTH = 20
#: Turns of one block, whose tables a task holds at a time.
BLOCK_TURNS = 1 << 18
#: Turns that a key range aims at, ranges at most, and sampled keys per range.
RANGE_TURNS, MAX_RANGES, SAMPLED = 1 << 13, 1000, 16
#: Sequences of more turns are not taken as bounds of ranges (a bound is sent to every task).
BOUND_TURNS = 64
#: Conversation ids in one piece of an id list.
PIECE_IDS = 4096
#: Copies of a node that goes over an edge, to spread the children that look for it.
SALTS = 32

NO_ENDS = hashlib.sha256(b"").hexdigest()


def _element() -> Column:
    """A turn as hex: digest of role and text (null: empty), then the words of the text."""
    role, text = (F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("role", "text"))
    digest = F.md5(F.concat(F.length(role).cast("string"), F.lit(":"), role, text))
    words = F.regexp_count(text, F.lit("[^\\x20\\x09-\\x0D]+"))
    return F.concat(digest, F.lpad(F.hex(words.cast("long")), 8, "0"))


def rebuilt(conversations: DataFrame, family: int = 20, heads: int = 4) -> DataFrame:
    """``conv_id, seq``: each conversation as the bytes of its turns, with the head of its family's first one.

    The first h turns, h = crc32(conv_id) % heads, are those of conversation
    ``conv_id - conv_id % family``. Turns go by ``turn`` (null first), equal ones by digest.
    """
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), _element().alias("e")
    ).where("conv_id IS NOT NULL")
    own = turns.groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "e"))).alias("t"))
    own = materialise(own.select("conv_id", F.transform("t", lambda x: x["e"]).alias("t")), "turns")
    first = own.where(F.col("conv_id") % family == 0).select(
        F.col("conv_id").alias("first_id"), F.slice("t", 1, heads - 1).alias("head")
    )
    h = (F.crc32(F.col("conv_id").cast("string")) % heads).cast("int")
    both = own.join(first, own["conv_id"] - own["conv_id"] % family == first["first_id"], "left")
    head = F.slice(F.coalesce("head", F.array().cast("array<string>")), F.lit(1), h)
    rest = F.slice("t", h + 1, F.greatest(F.size("t") - h, F.lit(0)))
    return both.select("conv_id", F.unhex(F.array_join(F.concat(head, rest), "")).alias("seq"))


def id_list_digests(members: DataFrame) -> DataFrame:
    """``seq, ends_sha256`` of the ids of each sequence, ascending, joined by commas.

    Sorted runs are joined to pieces of text in key ranges that may cut a
    sequence anywhere; a digest then reads a sequence's pieces in order, and
    one piece at a time is all that a task holds.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, ids = None, []

        def row():
            return pa.RecordBatch.from_arrays(
                [pa.array([seq], pa.binary()), pa.array([ids[0]], pa.int64()), pa.array([",".join(map(str, ids))])],
                ["seq", "first_id", "ids"],
            )

        for batch in batches:
            for s, i in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if ids and (s != seq or len(ids) == PIECE_IDS):
                    yield row()
                    ids = []
                seq = s
                ids.append(i)
        if ids:
            yield row()

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seq, sha = None, None

        def row():
            return pa.RecordBatch.from_arrays([pa.array([seq], pa.binary()), pa.array([sha.hexdigest()])], ["seq", "ends_sha256"])

        for batch in batches:
            for s, text in zip(batch.column(0), batch.column(1), strict=True):
                if s.as_py() != seq:
                    if sha is not None:
                        yield row()
                    seq, sha = s.as_py(), hashlib.sha256()
                else:
                    sha.update(b",")
                sha.update(text.as_py().encode())
        if sha is not None:
            yield row()

    ranged = members.select("seq", "conv_id").repartitionByRange("seq", "conv_id").sortWithinPartitions("seq", "conv_id")
    parts = ranged.mapInArrow(pieces, "seq binary, first_id long, ids string")
    parts = parts.repartition("seq").sortWithinPartitions("seq", "first_id").select("seq", "ids")
    return parts.mapInArrow(digests, "seq binary, ends_sha256 string")


def distinct_sequences(convs: DataFrame) -> DataFrame:
    """``seq, n, least, ends_sha256``: each sequence once, with its members."""
    some = materialise(convs.groupBy("seq").agg(F.count("*").alias("n"), F.min("conv_id").alias("least")), "sequences")
    # the root of many copies is pre-aggregated above; only members of repeated sequences go on to the id lists
    many = convs.join(some.where("n > 1").select("seq"), "seq", "left_semi")
    lists = id_list_digests(many)
    single = F.sha2(F.col("least").cast("string").cast("binary"), 256)
    return some.join(lists, "seq", "left").select("seq", "n", "least", F.coalesce("ends_sha256", single).alias("ends_sha256"))


def range_bounds(rows: DataFrame) -> list[bytes]:
    """Sequences of the table that split it into key ranges of about equal numbers of turns."""
    turns = rows.agg(F.sum(F.length("seq") / WIDTH + 1)).first()[0] or 0
    ranges = int(min(MAX_RANGES, turns // RANGE_TURNS + 1))
    want = ranges * SAMPLED
    short = rows.where(F.length("seq") <= WIDTH * BOUND_TURNS).select("seq")
    count = short.count()
    every = max(1, count // want)
    sample = short.where(F.pmod(F.xxhash64("seq"), F.lit(every)) == 0)
    # keys drawn by their hash; at most twice the wanted number, whatever the table's size
    keys = sorted({bytes(r["seq"]) for r in sample.orderBy(F.xxhash64("seq")).limit(2 * want).collect()})
    step = max(1, len(keys) // ranges)
    return keys[step::step][: ranges - 1] if ranges > 1 else []


def _with_range(rows: DataFrame, bounds: list[bytes]) -> DataFrame:
    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = [bisect.bisect_right(bounds, s) for s in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), *batch.columns], ["part", *batch.schema.names])

    return rows.mapInArrow(place, "part int, seq binary, n long, least long, ends_sha256 string")


class RangeMin:
    """Sparse table: the minimum of any stretch of ``x`` from two overlapping powers of two."""

    def __init__(self, x: np.ndarray):
        self.rows = [x]
        while 2 * (w := 1 << (len(self.rows) - 1)) <= len(x):
            last = self.rows[-1]
            self.rows.append(np.minimum(last[:-w], last[w:]))

    def __call__(self, lo: np.ndarray, hi: np.ndarray) -> np.ndarray:
        """Minima of ``x[lo:hi]``, each stretch not empty."""
        level = np.frexp(hi - lo)[1] - 1
        out = np.empty(len(lo), self.rows[0].dtype)
        for k in np.unique(level):
            at = level == k
            row = self.rows[k]
            out[at] = np.minimum(row[lo[at]], row[hi[at] - (1 << int(k))])
        return out


def _leftmost(low: RangeMin, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """First row that shares the first ``depth`` turns of row ``at``; ``low`` is over the
    common lengths ``lcp[i]`` of rows i - 1 and i."""
    good, bad = at.copy(), np.full(len(at), -1)  # row 0 may be reached, row -1 never
    while len(k := np.flatnonzero(good - bad > 1)):
        mid = (good[k] + bad[k]) // 2
        fits = low(mid + 1, at[k] + 1) >= depth[k]
        good[k[fits]], bad[k[~fits]] = mid[fits], mid[~fits]
    return good


def _rightmost(low: RangeMin, rows: int, at: np.ndarray, depth: np.ndarray) -> np.ndarray:
    """Last row that shares the first ``depth`` turns of row ``at``."""
    good, bad = at.copy(), np.full(len(at), rows)
    while len(k := np.flatnonzero(bad - good > 1)):
        mid = (good[k] + bad[k]) // 2
        fits = low(at[k] + 1, mid + 1) >= depth[k]
        good[k[fits]], bad[k[~fits]] = mid[fits], mid[~fits]
    return good


def common_length(a: bytes, b: bytes) -> int:
    """Turns that two sequences share from the start."""
    n = min(len(a), len(b))
    x, y = np.frombuffer(a[:n], np.uint8), np.frombuffer(b[:n], np.uint8)
    differ = np.flatnonzero(x != y)
    return (int(differ[0]) if len(differ) else n) // WIDTH


def _path_keys(seq: bytes, depths: int) -> list[bytes]:
    """Digests of the first 0, 1 ... ``depths`` turns."""
    h = hashlib.md5(usedforsecurity=False)
    out = [h.digest()]
    for k in range(depths):
        h.update(seq[k * WIDTH : (k + 1) * WIDTH])
        out.append(h.digest())
    return out


#: ``key`` names nodes that may go on in other blocks, ``up`` the parent where that is one; others are whole.
NODE = (
    "key binary, up binary, conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, "
    "n_leaves long, saved_tokens long, ends_sha256 string"
)
_NAMES = [c.split()[0] for c in NODE.split(", ")]


def block_nodes(
    seqs: list[bytes], n: np.ndarray, least: np.ndarray, ends: list[str], before: int, after: int, shared_first: int
) -> pa.RecordBatch:
    """Nodes of one block of sorted, distinct sequences.

    ``before`` is the common length of the first row with the row before the
    block (-1: no such row, or not known), ``after`` that of the last row with
    the row after it (-1: none). Nodes on the first row's path down to
    ``shared_first`` and on the last row's down to ``after`` carry keys.
    """
    rows = len(seqs)
    size = np.array([len(s) // WIDTH for s in seqs], np.int64)
    first = np.concatenate([[0], np.cumsum(size)])
    flat = np.frombuffer(b"".join(seqs), np.uint8).reshape(-1, WIDTH)
    words = np.ascontiguousarray(flat[:, 16:]).view(">u4").reshape(-1).astype(np.int64)
    sums = np.concatenate([[0], np.cumsum(words)])
    # common lengths of neighbours
    lcp = np.zeros(rows, np.int64)
    if rows > 1:
        short = np.minimum(size[1:], size[:-1])
        owner = np.repeat(np.arange(1, rows), short)
        step = np.arange(len(owner)) - np.repeat(np.cumsum(short) - short, short)
        differ = (flat[first[owner] + step] != flat[first[owner - 1] + step]).any(1) if len(owner) else np.zeros(0, bool)
        lcp[1:] = short
        np.minimum.at(lcp, owner[differ], step[differ])
    low = RangeMin(lcp)
    # candidates: every prefix of every row (the empty one only of the first); the first member stands for the node
    at = np.concatenate([[0], np.repeat(np.arange(rows), size)])
    depth = np.concatenate([[0], np.arange(len(flat)) - np.repeat(first[:-1], size) + 1])
    own = _leftmost(low, at, depth) == at
    at, depth = at[own], depth[own]
    last = _rightmost(low, rows, at, depth)
    many = np.concatenate([[0], np.cumsum(n)])
    total = np.concatenate([[0], np.cumsum(n * (sums[first[1:]] - sums[first[:-1]]))])
    up_to = np.append(lcp[1:], after)  # common length with the next row
    leaf = np.concatenate([[0], np.cumsum((up_to < size) | ((size == 0) & (up_to < 0)))])
    fresh = sums[first[1:]] - sums[first[:-1] + lcp]  # words of the nodes that a row is the first member of
    fresh = np.concatenate([[0], np.cumsum(fresh)])
    above = np.maximum(depth - 1, 0)
    n_convs = many[last + 1] - many[at]
    n_leaves = leaf[last + 1] - leaf[at]
    conv = RangeMin(least)(at, last + 1)
    # children: later rows that branch off at this depth, and the first row's own next turn
    branch = np.sort(lcp * (rows + 1) + np.arange(rows))
    children = np.searchsorted(branch, depth * (rows + 1) + last, "right") - np.searchsorted(branch, depth * (rows + 1) + at, "right")
    old = np.where(at == 0, max(before, 0), 0)  # turns of the first row that an earlier row introduced
    children += (size[at] > depth) & ~((at == 0) & (depth < old))
    base = first[at]
    nodes = sums[first[at + 1]] - sums[base + np.maximum(above, old)] + fresh[last + 1] - fresh[at + 1]
    saved = total[last + 1] - total[at] - n_convs * (sums[base + above] - sums[base]) - nodes
    # a parent is the node of depth - 1 that holds the row: its place among the nodes
    place = {spot: k for k, spot in enumerate(zip(at.tolist(), depth.tolist(), strict=True))}
    left = _leftmost(low, at, above)
    parent = np.array([place[spot] for spot in zip(left.tolist(), above.tolist(), strict=True)], np.int64)
    keys: list[bytes | None] = [None] * len(at)
    for row, deepest in ((0, max(shared_first, 0)), (rows - 1, max(after, 0))):
        path = _path_keys(seqs[row], min(deepest, int(size[row])))
        spot = _leftmost(low, np.full(len(path), row), np.arange(len(path)))
        for d, key in enumerate(path):
            keys[place[int(spot[d]), d]] = key
    up = [None if d == 0 else keys[p] for d, p in zip(depth.tolist(), parent.tolist(), strict=True)]
    parent_conv = [None if d == 0 or keys[p] is not None else int(conv[p]) for d, p in zip(depth.tolist(), parent.tolist(), strict=True)]
    sha = [ends[a] if size[a] == d else None for a, d in zip(at.tolist(), depth.tolist(), strict=True)]
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.binary()), pa.array(up, pa.binary()), pa.array(conv, pa.int64()), pa.array(depth, pa.int64())]
        + [pa.array(parent_conv, pa.int64())]
        + [pa.array(x, pa.int64()) for x in (n_convs, children, n_leaves, saved)]
        + [pa.array(sha, pa.string())],
        _NAMES,
    )


def _counted_twice(last: bytes, bound: bytes) -> pa.RecordBatch:
    """What the next range, which does not see ``last``, counts again for its first row, ``bound``."""
    shared = common_length(last, bound)
    path = _path_keys(bound, shared)
    words = np.ascontiguousarray(np.frombuffer(bound, np.uint8).reshape(-1, WIDTH)[:, 16:]).view(">u4").reshape(-1)
    sums = np.concatenate([[0], np.cumsum(words.astype(np.int64))])
    depth = np.arange(shared + 1)
    none, zero = pa.nulls(shared + 1, pa.int64()), pa.array(np.zeros(shared + 1, np.int64))
    children = pa.array(np.where(depth < shared, -1, 0))
    saved = pa.array(sums[shared] - sums[np.maximum(depth - 1, 0)])
    up = pa.array([None, *path[:-1]], pa.binary())
    return pa.RecordBatch.from_arrays(
        [pa.array(path, pa.binary()), up, none, pa.array(depth), none, zero, children, zero, saved, pa.nulls(shared + 1, pa.string())],
        _NAMES,
    )


def _range_nodes(rows: DataFrame, bounds: list[bytes], block_turns: int) -> DataFrame:
    """Nodes of every block of the sorted ranges."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        turns, part, last = 0, None, None  # last: the row before the block in its range

        def flush(following: bytes | None) -> pa.RecordBatch:
            seqs = [r[0] for r in held]
            before = -1 if last is None else common_length(last, seqs[0])
            shared = before if last is not None else (len(seqs[0]) // WIDTH if part else 0)
            after = -1 if following is None else common_length(seqs[-1], following)
            n, least = (np.array([r[k] for r in held], np.int64) for k in (1, 2))
            return block_nodes(seqs, n, least, [r[3] for r in held], before, after, shared)

        def close() -> Iterator[pa.RecordBatch]:
            following = bounds[part] if part < len(bounds) else None
            yield flush(following)
            if following is not None:
                yield _counted_twice(held[-1][0], following)

        for batch in batches:
            for p, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if held and p != part:
                    yield from close()
                    held, turns, last = [], 0, None
                elif held and turns >= block_turns:
                    yield flush(row[0])
                    held, turns, last = [], 0, held[-1][0]
                part = p
                held.append(tuple(row))
                turns += len(row[0]) // WIDTH + 1
        if held:
            yield from close()

    dealt = _with_range(rows, bounds).repartition("part").sortWithinPartitions("part", "seq")
    return dealt.mapInArrow(compute, NODE)


def prefix_trie(
    conversations: DataFrame, family: int = 20, heads: int = 4, block_turns: int = BLOCK_TURNS, bounds: list[bytes] | None = None
) -> DataFrame:
    """Nodes of the trie of all rebuilt conversations (operator 11).

    Returns per node, the textless root included, ``conv_id`` (smallest
    member) ``, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256``. Null role or text: empty. Null turns come
    first; equal turns go by their digest; repeated rows are turns of their own.
    Rows of a null conv_id belong to no conversation and are left out. A
    conversation may lose all its turns and then ends at the root. Empty
    table: no nodes.

    A conversation's digests (20 bytes a turn, not its texts) are one row;
    beyond that no group is held by one task: copies are counted before the
    shuffle, a common first turn is cut into many key ranges, long id lists
    into pieces.
    """
    convs = materialise(rebuilt(conversations, family, heads), "rebuilt")
    rows = materialise(distinct_sequences(convs), "distinct-sequences")
    if bounds is None:
        bounds = range_bounds(rows)
    nodes = materialise(_range_nodes(rows, bounds, block_turns), "nodes")
    sums = ("n_convs", "n_children", "n_leaves", "saved_tokens")
    over = nodes.where("key IS NOT NULL").groupBy("key").agg(
        F.max("up").alias("up"),
        F.min("conv_id").alias("conv_id"),
        F.max("depth").alias("depth"),
        F.lit(None).cast("long").alias("parent_conv_id"),
        *(F.sum(c).alias(c) for c in sums),
        F.max("ends_sha256").alias("ends_sha256"),
    )
    over = materialise(over, "edge-nodes")
    every = nodes.where("key IS NULL").union(over.select(*_NAMES))
    salted = F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("p_salt")
    parents = over.select(F.col("key").alias("p_key"), F.col("conv_id").alias("p_conv"), salted)
    salt = F.pmod(F.xxhash64("conv_id", "depth"), F.lit(SALTS)).cast("int")
    below = every.where("up IS NOT NULL").withColumn("salt", salt)
    below = below.join(parents, (F.col("up") == F.col("p_key")) & (F.col("salt") == F.col("p_salt")))
    out = ["conv_id", "depth", "parent_conv_id", *sums, "ends_sha256"]
    found = every.where("up IS NULL").select(*out).union(below.withColumn("parent_conv_id", F.col("p_conv")).select(*out))
    return found.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
