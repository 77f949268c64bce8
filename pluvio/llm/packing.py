"""Packing token sequences into fixed-length training sequences (operator 10).

Pieces are dealt at random into groups of bounded size; each group is packed by
best fit (longest first) and then improved by a local search that exchanges
one-for-one, two-for-one or moves pieces between underfull bins. Every step
raises the sum of squared fills, so fuller bins fill up at the cost of the
emptiest until it is empty.
"""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm.scratch import materialise
from pluvio.llm.tokens import _END, default_tokenizer, encoder

GROUP_PIECES = 20_000


def best_fit(lengths: list[int], capacity: int) -> list[list[int]]:
    """Best-fit decreasing: each piece into the fullest bin that still takes it."""
    bins: list[list[int]] = []
    by_room: list[list[int]] = [[] for _ in range(capacity + 1)]
    open_rooms = 0  # bit r: some bin has room r
    for i in sorted(range(len(lengths)), key=lambda k: (-lengths[k], k)):
        need = lengths[i]
        fit = open_rooms >> need
        if need and fit:
            room = (fit & -fit).bit_length() - 1 + need
            b = by_room[room].pop()
            if not by_room[room]:
                open_rooms ^= 1 << room
            bins[b].append(i)
        else:
            room, b = capacity, len(bins)
            bins.append([i])
        left = room - need
        if left:
            by_room[left].append(b)
            open_rooms |= 1 << left
    return bins


def _improve(source: list[int], target: list[int], room: int, lengths: list[int]) -> int:
    """One step that fills ``target`` from ``source`` most; returns the gain in fill (0: none).

    Candidates: move a piece, exchange one for one, two of the source for one,
    one of the source for two of the target.
    """
    have = sorted(source, key=lengths.__getitem__)
    sizes = [lengths[i] for i in have]
    pairs = sorted((sizes[a] + sizes[b], a, b) for a in range(len(have)) for b in range(a))[:4096]
    sums = [p[0] for p in pairs]
    best, step = 0, None

    def largest(values: list[int], most: int) -> int:
        return bisect.bisect_right(values, most) - 1

    swaps: list[tuple[int, tuple[int, ...]]] = [(0, ())] + [(lengths[j], (j,)) for j in target]
    small = sorted(target, key=lengths.__getitem__)[:64]
    swaps += [(lengths[x] + lengths[y], (x, y)) for k, x in enumerate(small) for y in small[:k]]
    for out, gone in swaps:
        k = largest(sizes, out + room)
        if k >= 0 and sizes[k] - out > best:
            best, step = sizes[k] - out, ((have[k],), gone)
        if len(gone) < 2 and sums:
            k = largest(sums, out + room)
            if k >= 0 and sums[k] - out > best:
                best, step = sums[k] - out, ((have[pairs[k][1]], have[pairs[k][2]]), gone)
    if step:
        into, gone = step
        for i in into:
            source.remove(i)
        for j in gone:
            target.remove(j)
        source.extend(gone)
        target.extend(into)
    return best


def local_search(bins: list[list[int]], lengths: list[int], capacity: int, patience: int = 4) -> list[list[int]]:
    """Empty the emptiest bins into the other underfull ones until no step helps.

    Stops at the least possible number of bins, or when ``patience`` source
    bins in a row could not be emptied. Each step raises the sum of squared
    fills, so the search ends.
    """
    least = -(-sum(lengths) // capacity)
    fill = [sum(lengths[i] for i in b) for b in bins]
    stuck: set[int] = set()
    alive = {b for b in range(len(bins)) if bins[b]}
    while len(alive) > least and len(stuck) < patience:
        order = sorted((b for b in alive if fill[b] < capacity), key=lambda b: (fill[b], b))
        source = next((b for b in order if b not in stuck), None)
        if source is None:
            break
        moved = False
        for b in reversed(order):  # the fullest first: the largest gain in squared fill
            if b == source:
                continue
            while bins[source] and fill[b] < capacity and fill[b] >= fill[source]:
                gain = _improve(bins[source], bins[b], capacity - fill[b], lengths)
                if not gain:
                    break
                fill[b] += gain
                fill[source] -= gain
                moved = True
            if not bins[source]:
                break
        if not bins[source]:
            alive.discard(source)
        if moved:
            stuck.clear()
        else:
            stuck.add(source)
    return [bins[b] for b in sorted(alive)]


def token_pieces(docs: DataFrame, capacity: int, tokenizer: str, added_tokens: bool = False) -> DataFrame:
    """``doc_id, piece, start, length, ids_crc32`` of every document (null text: only the end id).

    A document longer than ``capacity`` is cut from its end into full pieces;
    what is left over is its first piece.
    """

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(tokenizer, added_tokens)
        for batch in batches:
            rows: list[tuple] = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encode(text.as_py() or "") + _END
                n = len(ids) // 4
                first = n % capacity or capacity
                ends = range(first, n + 1, capacity)
                at = 0
                for piece, end in enumerate(ends):
                    rows.append((doc_id, piece, at, end - at, zlib.crc32(ids[4 * at : 4 * end])))
                    at = end
            cols = list(zip(*rows, strict=True)) or [()] * 5
            kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(cols, kinds, strict=True)],
                ["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    pieces = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return pieces.mapInArrow(cut, "doc_id long, piece int, start long, length long, ids_crc32 long")


def pack(pieces: DataFrame, capacity: int, group_pieces: int = GROUP_PIECES) -> DataFrame:
    """Add ``sequence_id`` and ``offset`` to a stored table of pieces.

    Rows are dealt by a hash of their place in the table, so repeated rows and
    a hot or null doc_id spread evenly. Each group wastes less than one
    sequence over the least possible.
    """
    n = pieces.count()
    groups = max(1, -(-n // group_pieces))
    dealt = pieces.withColumn("_g", F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(groups)))

    def one(table: pa.Table) -> pa.Table:
        order = table.sort_by([(c, "ascending") for c in ("doc_id", "piece", "ids_crc32", "length")])
        lengths = order["length"].to_pylist()
        bins = local_search(best_fit(lengths, capacity), lengths, capacity)
        sequence, offset = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
        group = order["_g"][0].as_py()
        for b, rows in enumerate(bins):
            at = 0
            for i in sorted(rows):
                sequence[i], offset[i] = group << 32 | b, at
                at += lengths[i]
        out = order.drop_columns(["_g"])
        return out.append_column("sequence_id", pa.array(sequence)).append_column("offset", pa.array(offset))

    schema = pieces.schema.simpleString()[7:-1].replace(":", " ") + ", sequence_id long, offset long"
    return dealt.groupBy("_g").applyInArrow(one, schema.replace(",", ", "))


def pack_documents(
    docs: DataFrame, capacity: int = 2048, tokenizer: str | None = None, added_tokens: bool = False
) -> DataFrame:
    """Tokenise, cut and pack all documents (operator 10).

    Returns per piece ``doc_id, piece, start, length, ids_crc32, sequence_id,
    offset``. Empty table: no rows. Repeated rows are packed as often as they occur.
    ``added_tokens``: see ``Encoder``.
    """
    pieces = materialise(token_pieces(docs, capacity, tokenizer or default_tokenizer(), added_tokens), "pieces")
    return pack(pieces, capacity)
