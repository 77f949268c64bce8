"""Benchmark decontamination by latent semantic retrieval (operator 6).

Benchmark items and overlapping document passages are TF-IDF vectors over the
words of the benchmark. A randomised SVD gives a latent space; passages near an
item by cosine there are candidates. A longest-common-subsequence and an answer
check on the words decide, which also finds items with words changed, added or
left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm import text as tx
from pluvio.llm.scratch import materialise, of_row, row_hash, whole_rows

#: Items that share one latent space; larger benchmarks are handled block by block.
BLOCK_ITEMS = 256
WINDOW, STRIDE = 64, 32
#: Passages for items of up to 3/4 of the size; longer items take the last. Strides are half a window.
WINDOWS = (8, 16, 32, WINDOW)
ITEM_WEIGHT = 4.0
#: Words in more than this share of all passages say nothing about an item.
COMMON = 0.08
#: Pairs of words up to which a task keeps their sums as a dense matrix, and in sparse form before it multiplies them out.
DENSE_PAIRS, SPARSE_PAIRS = 1 << 25, 1 << 22


def _hash_words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Lower-cased word hashes of all texts and their bounds."""
    hashes, bounds = [], [0]
    for _, _, data, at in tx.slices(pa.array(texts, pa.large_string())):
        s, e, row = tx.words(data, at)
        hashes.append(tx.word_hashes(data, s, e, lower=True))
        bounds.extend((bounds[-1] + tx.row_bounds(row, len(at) - 1)[1:]).tolist())
    return (np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)), np.array(bounds)


def passages(bounds: np.ndarray, window: int = WINDOW, stride: int = STRIDE) -> np.ndarray:
    """``(row, first word, last word + 1)`` of overlapping passages that cover every word of every row."""
    size = np.diff(bounds)
    many = np.where(size > 0, 1 + np.maximum(0, -(-(size - window) // stride)), 0)
    row = np.repeat(np.arange(len(size)), many)
    k = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
    first = bounds[row] + k * stride
    return np.stack([row, first, np.minimum(first + window, bounds[row + 1])], 1)


def _terms(hashes: np.ndarray, vocabulary: np.ndarray) -> np.ndarray:
    """Place of each word in the sorted vocabulary, or -1."""
    at = np.minimum(np.searchsorted(vocabulary, hashes), len(vocabulary) - 1)
    return np.where(vocabulary[at] == hashes, at, -1)


def _places(hashes: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the words that the vocabulary holds, and their terms."""
    begins = np.zeros(1 << 16, bool)  # most words are told apart by their first bits
    begins[vocabulary >> tx.U64(48)] = True
    place = np.flatnonzero(begins[hashes >> tx.U64(48)])
    term = _terms(hashes[place], vocabulary)
    return place[term >= 0], term[term >= 0]


def _pairs_at(place: np.ndarray, term: np.ndarray, spans: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(passage, term, count)`` of the vocabulary words in each passage, from ``_places``."""
    lo, hi = np.searchsorted(place, spans[:, 1]), np.searchsorted(place, spans[:, 2])
    size = hi - lo
    passage = np.repeat(np.arange(len(spans)), size)
    at = np.repeat(lo - (np.cumsum(size) - size), size) + np.arange(size.sum())
    code, count = np.unique(passage * terms + term[at], return_counts=True)
    return code // terms, code % terms, count


def _pairs(hashes: np.ndarray, spans: np.ndarray, vocabulary: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``(passage, term, count)`` of the vocabulary words in each passage."""
    return _pairs_at(*_places(hashes, vocabulary), spans, len(vocabulary))


def _weights(pairs, idf: np.ndarray) -> np.ndarray:
    return (1 + np.log(pairs[2])) * idf[pairs[1]]


def _norms(pairs, weight: np.ndarray, rows: int) -> np.ndarray:
    return np.maximum(np.sqrt(np.bincount(pairs[0], weight * weight, minlength=rows)), 1e-9)


def _project(pairs, weight: np.ndarray, basis: np.ndarray, rows: int, chunk: int = 256) -> np.ndarray:
    """Rows of the sparse passage matrix times ``basis``, in chunks that stay in the cache.

    Passages of equally many terms are summed together, term by term, in eight
    lanes: the order in which ``np.add.reduceat`` sums each one up, at a
    fraction of its time, so that cosines agree with it to the last bit.
    """
    out = np.zeros((rows, basis.shape[1]), np.float32)
    passage, term = pairs[0], pairs[1]
    first = np.flatnonzero(np.diff(passage, prepend=-1))  # a passage's pairs stand together
    size = np.diff(first, append=len(passage))
    order = np.argsort(size, kind="stable")
    weight = weight.astype(np.float32)[:, None]

    def summed(at: np.ndarray, many: int) -> np.ndarray:
        def part(k: int) -> np.ndarray:
            row = basis[term[at + k]]
            row *= weight[at + k]
            return row

        over = 1 + (many - 1) // 8 * 8  # terms from here on fill no eight
        lanes = [part(k) for k in range(1, min(over, 9))]
        for k in range(9, over):
            lanes[(k - 1) % 8] += part(k)
        while len(lanes) > 1:
            lanes = [x + y for x, y in zip(lanes[::2], lanes[1::2], strict=True)]
        rest = [*lanes, *map(part, range(over, many))]
        for x in rest[1:]:
            rest[0] += x
        total = part(0)
        return total + rest[0] if rest else total

    cuts = np.searchsorted(size[order], np.arange(1, size.max(initial=0) + 2))
    for many, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True), 1):
        for lo in range(a, b, chunk):
            at = first[order[lo : min(lo + chunk, b)]]
            out[passage[at]] = summed(at, many)
    return out


def passage_frequencies(docs: DataFrame, vocabulary: np.ndarray) -> tuple[int, np.ndarray]:
    """Number of passages of all documents, and of those that hold each vocabulary word."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, df = 0, np.zeros(len(vocabulary), np.int64)
        for batch in batches:
            for _, _, data, at in tx.slices(batch.column(0)):
                s, e, row = tx.words(data, at)
                spans = passages(tx.row_bounds(row, len(at) - 1))
                term = _pairs(tx.word_hashes(data, s, e, lower=True), spans, vocabulary)[1]
                df += np.bincount(term, minlength=len(vocabulary))
                n += len(spans)
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(seen, -1), pa.int32()), pa.array(np.append(df[seen], n), pa.int64())], ["term", "df"]
        )

    found = docs.select(F.col("text").cast("string")).mapInArrow(count, "term int, df long")
    df = np.zeros(len(vocabulary), np.int64)
    n = 0
    for r in found.groupBy("term").agg(F.sum("df").alias("df")).toLocalIterator():  # a row per benchmark word
        if r["term"] < 0:
            n = r["df"]
        else:
            df[r["term"]] = r["df"]
    return n, df


def _word_products(pairs, weight: np.ndarray, terms: int) -> tuple[np.ndarray, np.ndarray]:
    """Products of the weights of each two words of a passage: codes ``lower * terms + upper`` and values (a word with itself: half)."""
    passage, term = pairs[0], pairs[1]
    codes, values = [term * terms + term], [weight * weight / 2]
    for step in range(1, len(term)):  # a passage's terms ascend
        i = np.flatnonzero(passage[:-step] == passage[step:])
        if not len(i):
            break
        codes.append(term[i] * terms + term[i + step])
        values.append(weight[i] * weight[i + step])
    return np.concatenate(codes), np.concatenate(values).astype(np.float32)


def _summed(code: np.ndarray, value: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct codes in order and the sum of each one's values."""
    code, place = np.unique(code, return_inverse=True)
    return code, np.bincount(place, value, len(code)).astype(np.float32)


def _times(code: np.ndarray, value: np.ndarray, basis: np.ndarray, block: int = 512) -> np.ndarray:
    """The symmetric matrix of ``_word_products`` times ``basis``, by blocks of its rows."""
    terms = len(basis)
    out = np.zeros_like(basis)
    low, high = code // terms, code % terms
    row, column, value = np.concatenate([low, high]), np.concatenate([high, low]), np.tile(value, 2)
    order = np.argsort(row)
    row, column, value = row[order], column[order], value[order]
    cuts = np.searchsorted(row, np.arange(0, terms + block, block))
    for k, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True)):
        if a < b:
            held, place = np.unique(column[a:b], return_inverse=True)
            part = np.zeros((min(block, terms - k * block), len(held)), np.float32)
            np.add.at(part, (row[a:b] - k * block, place), value[a:b])
            out[k * block : k * block + len(part)] = part @ basis[held]
    return out


def fit_space(docs: DataFrame, items: tuple[np.ndarray, np.ndarray], vocabulary: np.ndarray, idf: np.ndarray, rank: int) -> np.ndarray:
    """Right singular vectors of the passage matrix by a randomised range finder.

    Each task multiplies its passages' transpose times themselves (products of
    two words of a passage, summed) with a fixed random matrix, so only
    vocabulary-sized sums leave it. The rows are the passages of all documents
    and the items, which weigh ``ITEM_WEIGHT`` times as much as all of those:
    the space has to tell items apart first.
    """
    size = rank + 8
    rng = np.random.default_rng(5)
    draw = rng.standard_normal((len(vocabulary), size)).astype(np.float32)
    none = np.zeros(0, np.int64), np.zeros(0, np.float32)
    dense = len(vocabulary) ** 2 <= DENSE_PAIRS

    def products(hashes: np.ndarray, spans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        pairs = _pairs(hashes, spans, vocabulary)
        w = _weights(pairs, idf)
        return _word_products(pairs, w / _norms(pairs, w, len(spans))[pairs[0]], len(vocabulary))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros_like(draw)
        held = none
        matrix = np.zeros((len(vocabulary),) * 2 if dense else (0, 0), np.float32)
        for batch in batches:
            for _, _, data, at in tx.slices(batch.column(0)):
                s, e, row = tx.words(data, at)
                more = products(tx.word_hashes(data, s, e, lower=True), passages(tx.row_bounds(row, len(at) - 1)))
                if dense:
                    np.add.at(matrix.reshape(-1), *more)
                    continue
                held = _summed(*(np.concatenate(x) for x in zip(held, more, strict=True)))
                if len(held[0]) > SPARSE_PAIRS:
                    total += _times(*held, draw)
                    held = none
        total += matrix @ draw + matrix.T @ draw if dense else _times(*held, draw)
        some = np.flatnonzero(total.any(1))
        flat = pa.FixedSizeListArray.from_arrays(pa.array(total[some].ravel()), size).cast(pa.list_(pa.float32()))
        yield pa.RecordBatch.from_arrays([pa.array(some, pa.int32()), flat], ["term", "y"])

    def add(table: pa.Table) -> pa.Table:
        y = np.stack(table["y"].to_numpy()).sum(0)
        return pa.table({"term": pa.array([table["term"][0].as_py()], pa.int32()), "y": pa.array([y.astype(np.float32)], pa.list_(pa.float32()))})

    texts = docs.select(F.col("text").cast("string").alias("text"))
    y = np.zeros_like(draw)
    n = 0
    for r in texts.mapInArrow(sums, "term int, y array<float>").groupBy("term").applyInArrow(add, "term int, y array<float>").toLocalIterator():
        y[r["term"]] = r["y"]
        n += 1
    own = _times(*products(items[0], passages(items[1])), draw)
    scale = ITEM_WEIGHT * np.linalg.norm(y) / max(float(np.linalg.norm(own)), 1e-9) if n else 1.0
    u, _, _ = np.linalg.svd(y + max(scale, 1.0) * own, full_matrices=False)
    return np.ascontiguousarray(u[:, :rank].astype(np.float32))


def lcs_length(a: list, b: list) -> int:
    """Longest common subsequence by bit-parallel rows."""
    where: dict = {}
    for k, x in enumerate(a):
        where[x] = where.get(x, 0) | 1 << k
    full = (1 << len(a)) - 1
    row = full
    for x in b:
        hit = row & where.get(x, 0)
        row = (row + hit) | (row - hit)
        row &= full
    return len(a) - row.bit_count()


def find_leaks(docs: DataFrame, benchmark: DataFrame, rank: int = 192, near: float = 0.45, same: float = 0.8, likely: float = 0.6) -> DataFrame:
    """Documents that hold a benchmark item or a paraphrase of it (operator 6).

    Returns ``doc_id, _h, item_id, cosine, lcs_ratio, answer_found``, one row per
    pair found. A passage whose latent cosine with an item is ``near`` or more
    (of the part of the item that the space holds) is checked on the words around it: the longest common subsequence must
    cover ``same`` of the item, or ``likely`` of it if the item's answer (column
    ``answer`` where the benchmark has one, else its last five words) stands
    there in full and in order. Null or empty texts and items match nothing;
    null doc_ids are searched and returned; repeated rows give equal rows once.
    Items are the query set: they are sent to all tasks in blocks of ``BLOCK_ITEMS``.
    """
    cols = [F.col("item_id").cast("long").alias("item_id"), F.col("text").cast("string").alias("text")]
    cols.append((F.col("answer") if "answer" in benchmark.columns else F.lit(None)).cast("string").alias("answer"))
    items = benchmark.select(*cols).where("item_id IS NOT NULL AND text IS NOT NULL").orderBy("item_id")
    found, block = [], []
    for r in items.toLocalIterator():
        block.append((r["item_id"], r["text"], r["answer"]))
        if len(block) == BLOCK_ITEMS:
            found.append(_search(docs, block, rank, near, same, likely))
            block = []
    if block or not found:
        found.append(_search(docs, block, rank, near, same, likely))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.dropDuplicates(["doc_id", "_h", "item_id"])


_LEAKS = "doc_id long, _h binary, item_id long, cosine double, lcs_ratio double, answer_found boolean"


def _search(docs: DataFrame, block: list, rank: int, near: float, same: float, likely: float) -> DataFrame:
    hashes, bounds = _hash_words([t for _, t, _ in block])
    keep = [k for k in range(len(block)) if bounds[k + 1] > bounds[k]]
    if not keep:
        return docs.sparkSession.createDataFrame([], _LEAKS)
    ids = [block[k][0] for k in keep]
    words = [hashes[bounds[k] : bounds[k + 1]].tolist() for k in keep]
    answers = []
    for k, w in zip(keep, words, strict=True):
        own = _hash_words([block[k][2] or ""])[0].tolist()
        answers.append(own or w[-5:])
    flat, ends = np.concatenate([np.array(w, np.uint64) for w in words]), np.cumsum([0, *map(len, words)])
    vocabulary = np.unique(flat)
    n, df = passage_frequencies(docs, vocabulary)
    rare = df <= COMMON * n
    for w in words:  # an item of common words only keeps them all
        at = np.searchsorted(vocabulary, np.array(w, np.uint64))
        if not rare[at].any():
            rare[at] = True
    vocabulary, df = vocabulary[rare], df[rare]
    idf = np.log((n + 1) / (df + 1)) + 1e-3
    space = fit_space(docs, (flat, ends), vocabulary, idf, min(rank, len(vocabulary)))
    spans = passages(ends)  # an item longer than a window has several
    pairs = _pairs(flat, spans, vocabulary)
    weight = _weights(pairs, idf)
    queries = _project(pairs, weight, space, len(spans))
    held = np.maximum(np.linalg.norm(queries, axis=1), 1e-9)
    queries /= held[:, None]
    least = np.maximum(near * held / _norms(pairs, weight, len(spans)), 0.1).astype(np.float32)
    owner = spans[:, 0]
    # a short item is sought in short passages, so that what stands around it does not hide it
    fits = np.array([next((x for x in WINDOWS if 4 * len(w) <= 3 * x), WINDOW) for w in words])
    classes = [(x, np.flatnonzero(fits[owner] == x)) for x in WINDOWS if (fits == x).any()]

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, at in tx.slices(batch.column(2)):
                s, e, row = tx.words(data, at)
                h = tx.word_hashes(data, s, e, lower=True)
                first = tx.row_bounds(row, hi - lo)
                place, term = _places(h, vocabulary)
                best: dict[tuple[int, int], tuple] = {}
                for window, of in classes:
                    spots = passages(first, window, window // 2)
                    hit = _pairs_at(place, term, spots, len(vocabulary))
                    weight = _weights(hit, idf)
                    z = _project(hit, weight, space, len(spots))
                    z /= _norms(hit, weight, len(spots))[:, None]
                    near_items = queries[of].T
                    for c in range(0, len(z), 4096):
                        cosine = z[c : c + 4096] @ near_items
                        p, q = np.nonzero(cosine >= least[of])
                        for a, b in zip((p + c).tolist(), q.tolist(), strict=True):
                            k, item = int(spots[a, 0]), int(owner[of[b]])
                            reach = len(words[item])
                            begin = max(first[k], spots[a, 1] - reach)
                            there = h[begin : min(first[k + 1], spots[a, 2] + reach)]
                            if np.isin(there, words[item]).sum() < likely * reach:
                                continue
                            ratio, answered = _compare(words[item], answers[item], there.tolist())
                            if ratio >= same or (ratio >= likely and answered):
                                value = (ratio, answered, float(cosine[a - c, b]))
                                best[k, item] = max(best.get((k, item), value), value)
                rows = [(lo + k, ids[i], v[2], v[0], v[1]) for (k, i), v in best.items()]
                if rows:
                    at_row, item, cosine, ratio, answered = zip(*rows, strict=True)
                    yield pa.RecordBatch.from_arrays(
                        [
                            batch.column(0).take(pa.array(at_row)),
                            batch.column(1).take(pa.array(at_row)),
                            pa.array(item, pa.int64()),
                            pa.array(cosine, pa.float64()),
                            pa.array(ratio, pa.float64()),
                            pa.array(answered, pa.bool_()),
                        ],
                        ["doc_id", "_h", "item_id", "cosine", "lcs_ratio", "answer_found"],
                    )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), row_hash().alias("_h"), F.col("text").cast("string").alias("text")
    )
    return rows.mapInArrow(search, _LEAKS)


def _compare(item: list, answer: list, there: list) -> tuple[float, bool]:
    """Share of the item in its best stretch of the words there, and whether the answer stands there.

    The subsequence is sought in stretches of one and a half item lengths, so
    words scattered over a long passage do not add up.
    """
    size = max(len(item) * 3 // 2, len(item) + 4)
    step = max(1, len(item) // 2)
    starts = range(0, max(1, len(there) - size + step), step)
    ratio = max(lcs_length(item, there[a : a + size]) for a in starts) / len(item)
    n = len(answer)
    answered = any(there[k : k + n] == answer for k in range(len(there) - n + 1))
    return ratio, answered


def drop_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``docs`` without those that hold a benchmark item; columns as they came."""
    found = materialise(find_leaks(docs, benchmark), "leaks")
    found = found.select("doc_id", "_h").distinct()
    return whole_rows(docs).join(found, of_row(found), "left_anti").select("row.*")
