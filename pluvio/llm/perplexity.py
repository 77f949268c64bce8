"""Quality rules with modified Kneser-Ney perplexity bands (operator 2).

The model of the queries (``characters=True``) counts trigrams of code points over
all documents, per language, every one in full. Each order is stored as a sorted
array of 64-bit n-gram hashes with counts beside it, and each context with its
total and the discounts that it leaves to the lower order. A document is scored by
the counts of all other rows: a text that counted itself would bear itself out.

The class model counts trigrams of 64 character classes (at most 64**3 a language),
stored with log probabilities and back-off weights. Members of one class are told
apart by the language's own counts of every code point (a class n-gram model:
p(class | two classes before) * p(code point | class)).
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm import text as tx
from pluvio.llm.scratch import materialise, of_row, row_hash, whole_rows

CLASSES = 64
GRAMS = CLASSES**3
CODE_POINTS = 0x110000
#: Languages whose models are counted and sent together; more are handled block by block.
MAX_LANGUAGES = 64
#: Bytes of code point models sent to the tasks at once; the texts are read once for each such lot of languages.
MODEL_BYTES = 128 << 20
#: Distinct trigrams that a counting task holds before it sends them on.
HELD_GRAMS = 1 << 22
#: A code point takes 21 bits, so a trigram is one number of 63.
BITS = 21

_CONT = (np.arange(256) & 0xC0) == 0x80
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(9, 14)]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


def _class_table() -> np.ndarray:
    """Class of a code point below 0x300: space 0, letters, digits, punctuation, others by remainder."""
    cp = np.arange(0x300)
    low = np.where((cp >= 0xC0) & (cp <= 0xDE) & (cp != 0xD7), cp + 32, cp)
    out = 40 + low % 24
    for c in range(128):
        ch = chr(c).lower()
        if c in (0x20, *range(9, 14)):
            out[c] = 0
        elif "a" <= ch <= "z":
            out[c] = ord(ch) - 96
        elif ch.isdigit():
            out[c] = 27
        elif ch in ".,":
            out[c] = 28 + (ch == ",")
        else:
            out[c] = 30 + c % 10
    return out.astype(np.int64)


_TABLE = _class_table()


def classes(cp: np.ndarray) -> np.ndarray:
    return np.where(cp < 0x300, _TABLE[np.minimum(cp, 0x2FF)], 40 + cp % 24)


def _code_points(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code point of every character, and each row's first and last + 1 place; rows begin after two spaces."""
    raw = data.tobytes()
    rows = [raw[a:b] for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
    cp = np.frombuffer(b"  ".join([b"", *rows]).decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    chars = np.zeros(len(data) + 1, np.int64)
    np.cumsum(~_CONT[data], out=chars[1:])
    first = chars[bounds[:-1]] + 2 * np.arange(1, len(bounds))
    return cp, first, first + np.diff(chars[bounds])


def _trigrams(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Code point and trigram of classes of every character, and each row's first and last + 1 place."""
    cp, first, last = _code_points(data, bounds)
    k = classes(cp.astype(np.int64))
    g = np.zeros(len(k), np.int64)
    g[2:] = k[:-2] * (CLASSES * CLASSES) + k[1:-1] * CLASSES + k[2:]
    return cp, g, first, last


def _places(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Places of all characters of all rows."""
    at = np.repeat(first - np.concatenate([[0], np.cumsum(last - first)[:-1]]), last - first)
    return at + np.arange(len(at))


def _present(cp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct code points in order, and the place of each character's among them."""
    seen = np.zeros(CODE_POINTS, bool)
    seen[cp] = True
    found = np.flatnonzero(seen)
    place = np.zeros(CODE_POINTS, np.int32)
    place[found] = np.arange(len(found))
    return found, place[cp]


def count_trigrams(docs: DataFrame, slots: dict[str | None, int]) -> DataFrame:
    """``slot, gram, n`` over all texts; each task sends one row per trigram that it saw."""
    return _counts(docs, slots).where(F.col("gram") < GRAMS)


def _counts(docs: DataFrame, slots: dict[str | None, int]) -> DataFrame:
    """``slot, gram, n`` of trigrams, and of every code point c as gram ``GRAMS + c``."""
    other = len(slots)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[int, np.ndarray] = {}
        single: dict[int, dict[int, int]] = {}
        for batch in batches:
            slot = np.array([slots.get(x, other) for x in batch.column(0).to_pylist()], np.int64)
            for lo, hi, data, bounds in tx.slices(batch.column(1)):
                cp, g, first, last = _trigrams(data, bounds)
                here, local = np.unique(slot[lo:hi], return_inverse=True)
                inside = np.repeat(local, last - first)
                at = _places(first, last)
                found = np.bincount(inside * GRAMS + g[at], minlength=len(here) * GRAMS)
                for k, s in enumerate(here.tolist()):
                    part = found[k * GRAMS : (k + 1) * GRAMS]
                    total[s] = total[s] + part if s in total else part.copy()
                known, place = _present(cp)
                found = np.bincount(inside * len(known) + place[at], minlength=len(here) * len(known))
                for k, s in enumerate(here.tolist()):
                    mine = single.setdefault(s, {})
                    for c, n in zip(known.tolist(), found[k * len(known) : (k + 1) * len(known)].tolist(), strict=True):
                        if n:
                            mine[c] = mine.get(c, 0) + n
        for s, counts in total.items():
            seen = np.flatnonzero(counts)
            gram = np.concatenate([seen, GRAMS + np.array([*single[s]], np.int64)])
            n = np.concatenate([counts[seen], np.array([*single[s].values()], np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(gram), s), pa.int32()), pa.array(gram, pa.int32()), pa.array(n, pa.int64())],
                ["slot", "gram", "n"],
            )

    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(count, "slot int, gram int, n long")
    return counts.groupBy("slot", "gram").agg(F.sum("n").alias("n"))


def _discounts(c: np.ndarray) -> np.ndarray:
    """Discount of counts 0, 1, 2, 3 and more, from the counts of counts."""
    n1, n2, n3, n4 = (float((c == k).sum()) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    d = [0.0] + [k - (k + 1) * y * b / a if a else k / 2 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    # a little is always left to the lower order, so no probability is 0
    return np.clip(np.array(d), [0.0, 0.01, 0.01, 0.01], [0.0, 1.0, 2.0, 3.0])


def _order(c: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Interpolated probabilities over the last axis, and the weight left to the lower order."""
    d = _discounts(c)[np.minimum(c, 3).astype(np.int64)]
    total = c.sum(-1, keepdims=True)
    some = np.maximum(total, 1)
    left = np.where(total > 0, d.sum(-1, keepdims=True) / some, 1.0)
    return np.where(total > 0, (c - d) / some, 0.0) + left * lower, left[..., 0]


def gram_key(order: int, gram: np.ndarray) -> np.ndarray:
    """64-bit hash of an n-gram."""
    return tx.mix(gram.astype(np.uint64) * np.uint64(4) + np.uint64(order))


def fit(counts: np.ndarray) -> list[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """``(order, sorted hashes, log probabilities, back-off weights)`` from dense trigram counts."""
    c3 = counts.reshape(CLASSES, CLASSES, CLASSES)
    c2 = (c3 > 0).sum(0)  # continuation counts: how many classes come before
    c1 = (c2 > 0).sum(0)
    p1, _ = _order(c1, np.full(CLASSES, 1 / CLASSES))
    p2, left2 = _order(c2, p1[None, :])
    p3, left3 = _order(c3, p2[None, :, :])
    out = []
    for order, seen, p, left in (
        (1, np.ones(CLASSES, bool), p1, left2),
        (2, (c2 > 0).ravel() | (c3.sum(-1) > 0).ravel(), p2.ravel(), left3.ravel()),
        (3, (c3 > 0).ravel(), p3.ravel(), np.ones(GRAMS)),
    ):
        gram = np.flatnonzero(seen)
        key = gram_key(order, gram)
        by = np.argsort(key)
        out.append((order, key[by], np.log(p[gram][by]).astype(np.float32), np.log(left[gram][by]).astype(np.float32)))
    return out


def members(cp: np.ndarray, n: np.ndarray) -> tuple[int, np.ndarray, np.ndarray, np.ndarray]:
    """Order 0: sorted code points and the log probability of each within its class; nothing to back off to."""
    by = np.argsort(cp)
    cp, n = cp[by], n[by]
    k = classes(cp)
    logp = np.log(n / np.bincount(k, n, CLASSES)[k])
    return 0, cp.astype(np.uint64), logp.astype(np.float32), np.zeros(0, np.float32)


def train(docs: DataFrame, slots: dict[str | None, int]) -> DataFrame:
    """The stored model: ``slot, order, keys, logp, backoff`` (arrays as bytes)."""

    def one(table: pa.Table) -> pa.Table:
        counts = np.zeros(GRAMS, np.int64)
        gram, n = table["gram"].to_numpy().astype(np.int64), table["n"].to_numpy()
        tri = gram < GRAMS
        counts[gram[tri]] = n[tri]
        slot = table["slot"][0].as_py()
        orders = [*fit(counts), members(gram[~tri] - GRAMS, n[~tri])]
        rows = [(slot, o, k.tobytes(), p.tobytes(), b.tobytes()) for o, k, p, b in orders]
        return pa.table(dict(zip(["slot", "order", "keys", "logp", "backoff"], zip(*rows, strict=True), strict=True)), schema=_MODEL)

    counts = _counts(docs, slots)
    model = counts.groupBy("slot").applyInArrow(one, "slot int, order int, keys binary, logp binary, backoff binary")
    return materialise(model, "perplexity-model")


_MODEL = pa.schema([("slot", pa.int32()), ("order", pa.int32()), ("keys", pa.binary()), ("logp", pa.binary()), ("backoff", pa.binary())])


def gram_counts(
    cp: np.ndarray, first: np.ndarray, last: np.ndarray, group: np.ndarray
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Group, trigram of code points and count, in order, of the distinct trigrams of each group of rows."""
    at, inside = _places(first, last), np.repeat(group, last - first)
    known, place = _present(cp)
    place, size = place.astype(np.int64), len(known)
    gram, kinds = (place[at - 2] * size + place[at - 1]) * size + place[at], None
    span = size**3
    if span * (int(group.max(initial=0)) + 1) >= 1 << 63:
        kinds, gram = np.unique(gram, return_inverse=True)
        span = len(kinds)
    found, n = np.unique(inside * span + gram, return_counts=True)
    inside, gram = np.divmod(found, span)
    before, c = np.divmod(gram if kinds is None else kinds[gram], size)
    a, b = np.divmod(before, size)
    return inside, known[a] << 2 * BITS | known[b] << BITS | known[c], n


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    gram, place = np.unique(np.concatenate([g for g, _ in parts]), return_inverse=True)
    n = np.zeros(len(gram), np.int64)
    np.add.at(n, place, np.concatenate([n for _, n in parts]))
    return gram, n


def count_characters(docs: DataFrame, slots: dict[str | None, int]) -> DataFrame:
    """``slot, gram, n`` of the trigrams of code points over all texts."""
    other = len(slots)

    def rows_of(s: int, gram: np.ndarray, n: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(gram), s), pa.int32()), pa.array(gram, pa.int64()), pa.array(n, pa.int64())],
            ["slot", "gram", "n"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        size = summed = 0
        for batch in batches:
            slot = np.array([slots.get(x, other) for x in batch.column(0).to_pylist()], np.int64)
            for lo, hi, data, bounds in tx.slices(batch.column(1)):
                here, local = np.unique(slot[lo:hi], return_inverse=True)
                inside, gram, n = gram_counts(*_code_points(data, bounds), local)
                for k, s in enumerate(here.tolist()):
                    held.setdefault(s, []).append((gram[inside == k], n[inside == k]))
                size += len(gram)
                if size > max(2 * summed, HELD_GRAMS // 4):
                    held = {s: [_summed(mine)] for s, mine in held.items()}
                    size = summed = sum(len(mine[0][0]) for mine in held.values())
                    if size > HELD_GRAMS:
                        yield from (rows_of(s, *mine[0]) for s, mine in held.items())
                        held, size, summed = {}, 0, 0
        yield from (rows_of(s, *_summed(mine)) for s, mine in held.items())

    rows = docs.select(F.col("lang").cast("string").alias("lang"), F.col("text").cast("string").alias("text"))
    counts = rows.mapInArrow(count, "slot int, gram long, n long")
    return counts.groupBy("slot", "gram").agg(F.sum("n").alias("n"))


class Level(NamedTuple):
    """One order: sorted hashes and counts of n-grams, of contexts with totals and discounted mass, discounts of 0 to 3."""

    keys: np.ndarray
    counts: np.ndarray
    contexts: np.ndarray
    totals: np.ndarray
    mass: np.ndarray
    discounts: np.ndarray


_LEVEL = pa.schema([("slot", pa.int32()), ("order", pa.int32()), *((x, pa.binary()) for x in Level._fields)])
_LEVEL_TYPES = (np.uint64, np.int64, np.uint64, np.int64, np.float64, np.float64)


def _level(gram: np.ndarray, n: np.ndarray) -> Level:
    """The level of distinct n-grams and their counts; their contexts are all but the last code point."""
    d = _discounts(n)
    context, place = np.unique(gram >> BITS, return_inverse=True)
    totals = np.zeros(len(context), np.int64)
    np.add.at(totals, place, n)
    mass = np.bincount(place, d[np.minimum(n, 3)], len(context))
    key, context = tx.mix(gram.astype(np.uint64)), tx.mix(context.astype(np.uint64))
    by, of = np.argsort(key), np.argsort(context)
    return Level(key[by], n[by], context[of], totals[of], mass[of], d)


def fit_characters(gram: np.ndarray, n: np.ndarray) -> dict[int, Level]:
    """Levels of orders 3 to 1; the lower ones hold continuation counts (how many code points come before)."""
    out = {}
    by = np.argsort(gram)
    gram, n = gram[by], n[by]
    for order in (3, 2, 1):
        out[order] = _level(gram, n)
        if order > 1:
            gram, n = np.unique(gram & (1 << (order - 1) * BITS) - 1, return_counts=True)
    return out


def train_characters(docs: DataFrame, slots: dict[str | None, int]) -> DataFrame:
    """The stored model: ``slot, order`` and the arrays of a ``Level`` as bytes."""

    def one(table: pa.Table) -> pa.Table:
        slot = table["slot"][0].as_py()
        levels = fit_characters(table["gram"].to_numpy(), table["n"].to_numpy())
        rows = [(slot, order, *(x.tobytes() for x in level)) for order, level in levels.items()]
        return pa.table(dict(zip(_LEVEL.names, zip(*rows, strict=True), strict=True)), schema=_LEVEL)

    kinds = "slot int, order int, " + ", ".join(f"{x} binary" for x in Level._fields)
    return materialise(count_characters(docs, slots).groupBy("slot").applyInArrow(one, kinds), "perplexity-characters")


def _lookup(keys: np.ndarray, values: np.ndarray, gram: np.ndarray) -> np.ndarray:
    """The value of each n-gram (0 if it is not held)."""
    key = tx.mix(gram.astype(np.uint64))
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    return np.where(keys[at] == key, values[at], 0)


def _interpolated(
    level: Level, row: np.ndarray, gram: np.ndarray, was: np.ndarray, now: np.ndarray, lower: np.ndarray | float
) -> np.ndarray:
    """Probabilities of n-grams, in order by row, after counts of the row went from ``was`` to ``now``."""
    before, d = gram >> BITS, level.discounts
    new = np.ones(len(gram), bool)
    new[1:] = (row[1:] != row[:-1]) | (before[1:] != before[:-1])
    of = np.cumsum(new) - 1
    change = d[np.minimum(now, 3)] - d[np.minimum(was, 3)]
    total = _lookup(level.contexts, level.totals, before[new]) - np.bincount(of, was - now).astype(np.int64)
    mass = _lookup(level.contexts, level.mass, before[new]) + np.bincount(of, change)
    some = np.maximum(total, 1)[of]
    return np.where(total[of] > 0, (now - d[np.minimum(now, 3)] + mass[of] * lower) / some, lower)


def left_out(model: dict[int, Level], row: np.ndarray, gram: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Log probability of each row's distinct trigrams (in order, ``n`` of each) by the counts without that row.

    Discounts and the alphabet are the whole language's.
    """
    top, mid, low = model[3], model[2], model[1]
    _, row = np.unique(row, return_inverse=True)  # rows with text, at most one a byte: 42 bits are left beside them
    was3 = _lookup(top.keys, top.counts, gram)
    now3 = np.maximum(was3 - n, 0)
    pair, of2 = np.unique(row << 2 * BITS | gram & (1 << 2 * BITS) - 1, return_inverse=True)
    row2, pair = pair >> 2 * BITS, pair & (1 << 2 * BITS) - 1
    was2 = _lookup(mid.keys, mid.counts, pair)
    now2 = was2 - np.bincount(of2, (was3 > 0) & (now3 == 0)).astype(np.int64)
    single, of1 = np.unique(row2 << BITS | pair & (1 << BITS) - 1, return_inverse=True)
    row1, single = single >> BITS, single & (1 << BITS) - 1
    was1 = _lookup(low.keys, low.counts, single)
    now1 = was1 - np.bincount(of1, (was2 > 0) & (now2 == 0)).astype(np.int64)
    p1 = _interpolated(low, row1, single, was1, now1, 1 / len(low.keys))
    p2 = _interpolated(mid, row2, pair, was2, now2, p1[of1])
    return np.log(_interpolated(top, row, gram, was3, now3, p2[of2]))


def _left_out_nll(held: dict[int, dict[int, Level]], data: np.ndarray, bounds: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Mean negative log probability per character of each row by its language's other rows."""
    cp, first, last = _code_points(data, bounds)
    row, gram, n = gram_counts(cp, first, last, np.arange(len(first)))
    nll = np.full(len(first), np.nan)
    for s in np.unique(slot).tolist():
        mine = slot[row] == s
        if s in held and mine.any():
            logp = left_out(held[s], row[mine], gram[mine], n[mine])
            some = np.flatnonzero((slot == s) & (last > first))
            nll[some] = -np.bincount(row[mine], n[mine] * logp, len(first))[some] / (last - first)[some]
    return nll


def _find(level, order: int, gram: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    keys, logp, back = level
    key = gram_key(order, gram)
    at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
    hit = keys[at] == key
    return hit, logp[at], np.where(hit, back[at], 0.0)


def score_table(levels: dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Log probability of every possible trigram, looked up with back-off in the sorted arrays."""
    g = np.arange(GRAMS)
    _, low, _ = _find(levels[1], 1, g % CLASSES)
    hit2, mid, _ = _find(levels[2], 2, g % (CLASSES * CLASSES))
    _, _, back1 = _find(levels[1], 1, g // CLASSES % CLASSES)
    mid = np.where(hit2, mid, back1 + low)
    hit3, top, _ = _find(levels[3], 3, g)
    _, _, back2 = _find(levels[2], 2, g // CLASSES)
    return np.where(hit3, top, back2 + mid).astype(np.float32)


def _member_logp(level, cp: np.ndarray) -> np.ndarray:
    """Log probability of each code point within its class (0 if the model does not hold it)."""
    keys, logp, _ = level
    at = np.minimum(np.searchsorted(keys, cp.astype(np.uint64)), len(keys) - 1)
    return np.where(keys[at] == cp, logp[at], np.float32(0))


def _base(data: np.ndarray, bounds: np.ndarray) -> list[np.ndarray]:
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words of each row."""
    rows = len(bounds) - 1
    s, e, row = tx.words(data, bounds)
    first = tx.row_bounds(row, rows)

    def total(flag: np.ndarray) -> np.ndarray:
        sums = np.zeros(len(flag) + 1, np.int64)
        np.cumsum(flag, out=sums[1:])
        return sums

    chars = np.diff(total(~_CONT[data] & ~_SPACE[data])[bounds])
    symbols = np.diff(total(_SYMBOL[data])[bounds])
    gram = tx.gram_hashes(tx.word_hashes(data, s, e), 3)
    at = np.flatnonzero(row[: len(gram)] == row[2:]) if len(row) > 2 else np.zeros(0, np.int64)
    order = at[np.lexsort((gram[at], row[at]))]
    twice = np.zeros(len(order), bool)
    if len(order) > 1:
        same = (gram[order[1:]] == gram[order[:-1]]) & (row[order[1:]] == row[order[:-1]])
        twice[1:] |= same
        twice[:-1] |= same
    repeat = np.diff(total(tx.runs_of(order[twice], 3, len(row)))[first])
    raw = data.tobytes()
    dup = np.zeros(rows, np.int64)
    for k in range(rows):
        lines = raw[bounds[k] : bounds[k + 1]].split(b"\n")
        if len(set(lines)) < len(lines):
            worded = [x for x in lines if x.strip(b" \t\n\v\f\r")]
            dup[k] = len(worded) - len(set(worded))
    return [np.diff(first), chars, symbols, dup, repeat]


def _class_nll(held: dict, tables: dict[int, np.ndarray], data: np.ndarray, bounds: np.ndarray, slot: np.ndarray) -> np.ndarray:
    """Mean negative log probability per character of each row by the class model of its language."""
    cp, g, first, last = _trigrams(data, bounds)
    known, place = _present(cp)
    own = {}
    nll = np.full(len(first), np.nan)
    for s in np.unique(slot).tolist():
        if s not in tables:
            tables[s] = score_table(held[s]) if s in held else np.zeros(GRAMS, np.float32)
        own[s] = _member_logp(held[s][0], known) if s in held else np.zeros(len(known), np.float32)
    for k in np.flatnonzero(last > first):
        a, b, s = first[k], last[k], int(slot[k])
        nll[k] = -tables[s][g[a:b]].mean(dtype=np.float64) - own[s][place[a:b]].mean(dtype=np.float64)
    return nll


def score(docs: DataFrame, model: DataFrame, slots: dict[str | None, int], characters: bool = False) -> DataFrame:
    """Base columns and ``nll`` (mean negative log probability per character; null: empty) of every row."""
    held: dict[int, dict] = {}
    for r in model.toLocalIterator():  # a block of languages, each of GRAMS entries and its code points, or of its own trigrams
        if characters:
            arrays = Level(*(np.frombuffer(r[x], t) for x, t in zip(Level._fields, _LEVEL_TYPES, strict=True)))
        else:
            arrays = np.frombuffer(r["keys"], np.uint64), np.frombuffer(r["logp"], np.float32), np.frombuffer(r["backoff"], np.float32)
        held.setdefault(r["slot"], {})[r["order"]] = arrays
    other = len(slots)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables: dict[int, np.ndarray] = {}
        for batch in batches:
            slot = np.array([slots.get(x, other) for x in batch.column(2).to_pylist()], np.int64)
            for lo, hi, data, bounds in tx.slices(batch.column(3)):
                mine = slot[lo:hi]
                nll = _left_out_nll(held, data, bounds, mine) if characters else _class_nll(held, tables, data, bounds, mine)
                base = _base(data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], batch.column(1)[lo:hi], pa.array(mine, pa.int32())]
                    + [pa.array(x, pa.int64()) for x in base]
                    + [pa.array(nll, pa.float64(), from_pandas=True)],
                    ["doc_id", "_h", "slot", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "nll"],
                )

    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        row_hash().alias("_h"),
        F.col("lang").cast("string").alias("lang"),
        F.col("text").cast("string").alias("text"),
    )
    return rows.mapInArrow(
        compute,
        "doc_id long, _h binary, slot int, n_words long, word_chars long, n_symbols long, "
        "n_dup_lines long, n_repeat_words long, nll double",
    )


def _lots(model: DataFrame) -> list[list[int]]:
    """The slots of a stored code point model in lots of about ``MODEL_BYTES``; a larger language is one alone."""
    size = sum((F.length(x) for x in Level._fields), F.lit(0).cast("long"))
    sizes = model.groupBy("slot").agg(F.sum(size).alias("size")).orderBy("slot").collect()  # a row per language
    lots, room = [], 0
    for r in sizes:
        if r["size"] > room:
            lots.append([])
            room = MODEL_BYTES
        lots[-1].append(r["slot"])
        room -= r["size"]
    return lots


def _of_languages(docs: DataFrame, langs: list[str | None]) -> DataFrame:
    lang = F.col("lang").cast("string")
    mine = lang.isin([x for x in langs if x is not None])
    return docs.where(F.when(lang.isNull(), F.lit(None in langs)).otherwise(mine))  # no value of an empty list is null


def _score_languages(docs: DataFrame, block: int, characters: bool) -> DataFrame:
    """Stored scores of all rows, each by the model of its own language, ``block`` languages at a time."""
    lang = F.col("lang").cast("string")
    top = docs.groupBy(lang.alias("lang")).count().orderBy(F.desc("count"), F.asc_nulls_first("lang"))
    langs = [r["lang"] for r in top.collect()]  # a row per language
    out = None
    for lo in range(0, max(1, len(langs)), block):
        slots = {x: lo + k for k, x in enumerate(langs[lo : lo + block])}
        rows = _of_languages(docs, [*slots]) if len(langs) > block else docs
        if characters:
            model = train_characters(rows, slots)
            lots = _lots(model)
            # languages without a single character have no model and are scored with the first lot
            none = {*slots.values()}.difference(*lots)
            parts = [{x: s for x, s in slots.items() if s in lot or (k == 0 and s in none)} for k, lot in enumerate(lots or [[]])]
        else:
            model, parts = train(rows, slots), [slots]
        for part in parts:
            mine = rows if len(parts) == 1 else _of_languages(rows, [*part])
            some = model if len(parts) == 1 else model.where(F.col("slot").isin([*part.values()]))
            scored = materialise(score(mine, some, part, characters), "perplexity")
            out = scored if out is None else out.union(scored)
    return out


def quality_rules(
    docs: DataFrame, reach: float = 3.0, least_docs: int = 50, block: int = MAX_LANGUAGES, characters: bool = False
) -> DataFrame:
    """Base rules and perplexity bands of all documents (operator 2).

    ``characters``: by trigrams of code points counted over all other rows of the
    language (as ``keep_good`` and the queries do), else by the class model.

    Per language, the band goes ``reach`` interquartile ranges below and above
    the quartiles of the log perplexity of the documents that pass the base
    rules. With fewer than ``least_docs`` of them a language keeps its own
    median, and its quartiles' distances from it are shrunk, the more the fewer
    there are, towards the mean spread of the languages that have enough (of
    all, if none has).
    Returns per row ``doc_id, _h, n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, perplexity, low, high, kept``. Null text: no
    words, base rules fail; null lang is a language of its own.
    """
    scored = _score_languages(docs, block, characters)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    scored = scored.withColumn("base_failed", failed)
    bands = scored.where("NOT base_failed").groupBy("slot").agg(
        F.percentile_approx("nll", [0.25, 0.5, 0.75], 10_000).alias("q"), F.count("nll").alias("docs")
    )
    own = F.col("q")[2] - F.col("q")[0]
    enough = F.col("docs") >= least_docs
    mean = lambda some: F.sum(F.when(some, own * F.col("docs"))) / F.sum(F.when(some, F.col("docs")))
    pooled = bands.agg(F.coalesce(mean(enough), mean(F.col("docs") > 0)).alias("pooled"))
    bands = bands.where("docs > 0").crossJoin(F.broadcast(pooled))  # one row
    share = F.least(F.col("docs") / F.lit(least_docs), F.lit(1.0))
    spread = F.lit(reach) * (share * own + (1 - share) * F.col("pooled"))
    below = share * (F.col("q")[1] - F.col("q")[0]) + (1 - share) * F.col("pooled") / 2
    above = share * (F.col("q")[2] - F.col("q")[1]) + (1 - share) * F.col("pooled") / 2
    bands = bands.select(
        "slot",
        F.when(enough, F.col("q")[0] - spread).otherwise(F.col("q")[1] - below - spread).alias("lo"),
        F.when(enough, F.col("q")[2] + spread).otherwise(F.col("q")[1] + above + spread).alias("hi"),
    )
    out = scored.join(F.broadcast(bands), "slot", "left")  # one row per model slot
    inside = F.coalesce(F.col("nll").between(F.col("lo"), F.col("hi")), F.lit(True))
    return out.select(
        "doc_id",
        "_h",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        F.exp("nll").alias("perplexity"),
        F.exp("lo").alias("low"),
        F.exp("hi").alias("high"),
        (~F.col("base_failed") & inside).alias("kept"),
    )


def keep_good(docs: DataFrame) -> DataFrame:
    """``docs`` without the documents that the rules reject; columns as they came."""
    good = quality_rules(docs, characters=True).where("kept").select("doc_id", "_h")
    return whole_rows(docs).join(good, of_row(good), "left_semi").select("row.*")
