"""The code point model of operator 2 against brute force: every trigram in full, each row scored by the others."""

from __future__ import annotations

import collections
import math
import random

import numpy as np
import pytest

from pluvio.llm import perplexity as px
from pluvio.llm.queries import op2_kn_perplexity

SCHEMA = "doc_id long, text string, lang string"


def _discounts(counts):
    n1, n2, n3, n4 = (sum(n == k for n in counts) for k in (1, 2, 3, 4))
    y = n1 / (n1 + 2 * n2) if n1 else 0.0
    d = [k - (k + 1) * y * b / a if a else k / 2 for k, a, b in ((1, n1, n2), (2, n2, n3), (3, n3, n4))]
    return [0.0, *(min(max(x, 0.01), k) for k, x in enumerate(d, 1))]


def _counts(texts):
    """Counts of trigrams, and of what comes before pairs and single characters."""
    c3 = collections.Counter(("  " + t)[k : k + 3] for t in texts for k in range(len(t)))
    c2 = collections.Counter(g[1:] for g in c3)
    return c3, c2, collections.Counter(g[1:] for g in c2)


def _brute_nll(texts, at):
    """Mean negative log probability of a character of text ``at`` by modified Kneser-Ney over all others."""
    discounts = [_discounts([*c.values()]) for c in _counts(texts)]
    levels = _counts([t for k, t in enumerate(texts) if k != at])
    alphabet = {*"".join(texts)}

    def p(gram, order):
        if order == 3:
            return 1 / len(alphabet)
        d, c = discounts[order], levels[order]
        after = {x: c[gram[:-1] + x] for x in alphabet if c[gram[:-1] + x]}
        lower = p(gram[1:], order + 1)
        if not after:
            return lower
        own, total = after.get(gram[-1], 0), sum(after.values())
        return (own - d[min(own, 3)] + sum(d[min(n, 3)] for n in after.values()) * lower) / total

    t = "  " + texts[at]
    return -sum(math.log(p(t[k : k + 3], 0)) for k in range(len(t) - 2)) / (len(t) - 2)


def _text(r, letters, n=70):
    return " ".join("".join(r.choice(letters) for _ in range(r.randint(2, 6))) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    r = random.Random(4)
    some = [(k, _text(r, "aeinrstAB,7é"), "en") for k in range(12)] + [(20, "x", "en"), (21, "", "en"), (22, None, "en")]
    some += [(30 + k, _text(r, "абвгдежзж漢字😀", 30), "ru") for k in range(6)] + [(30, "aß\n\tß", "ru"), (None, "abc", None)]
    return [*some, some[0], (50, "", "empty")]


def _docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_every_code_point_trigram_is_counted_in_full(spark):
    texts = ["abc abd", "AbC, 12é абв", "", None, "漢字😀 漢字"]
    want = _counts([t or "" for t in texts])[0]
    docs = _docs(spark, [(k, t, "en") for k, t in enumerate(texts)])
    part = lambda g, k: chr(g >> k & 0x1FFFFF)
    got = {part(r.gram, 42) + part(r.gram, 21) + part(r.gram, 0): r.n for r in px.count_characters(docs, {"en": 0}).collect()}
    assert got == want


def test_perplexities_match_brute_force(spark, rows):
    got = px.quality_rules(_docs(spark, rows), characters=True).collect()
    assert len(got) == len(rows)
    want = []
    for lang in ("en", "ru", None, "empty"):
        texts = [t or "" for _, t, x in rows if x == lang]
        ids = [i for i, _, x in rows if x == lang]
        want += [(i, len(t.split()), _brute_nll(texts, k) if t else None) for k, (i, t) in enumerate(zip(ids, texts, strict=True))]
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    have = [(x.doc_id, x.n_words, x.perplexity and math.log(x.perplexity)) for x in got]
    for a, b in zip(sorted(have, key=key), sorted(want, key=key), strict=True):
        assert a[:2] == b[:2] and (a[2] == b[2] or math.isclose(a[2], b[2], rel_tol=1e-9, abs_tol=1e-9))


def test_blocks_and_lots_of_languages_change_nothing(spark, rows, monkeypatch):
    key = lambda x: str(tuple(x))
    want = sorted(px.quality_rules(_docs(spark, rows), characters=True).collect(), key=key)
    assert sorted(px.quality_rules(_docs(spark, rows), block=2, characters=True).collect(), key=key) == want
    monkeypatch.setattr(px, "MODEL_BYTES", 1)
    assert sorted(px.quality_rules(_docs(spark, rows), characters=True).collect(), key=key) == want
    monkeypatch.setattr(px, "HELD_GRAMS", 4)
    docs = _docs(spark, rows)
    slots = {"en": 0, "ru": 1, None: 2, "empty": 3}
    got = {(r.slot, r.gram): r.n for r in px.count_characters(docs, slots).collect()}
    monkeypatch.undo()
    assert got == {(r.slot, r.gram): r.n for r in px.count_characters(docs, slots).collect()}


def test_rows_and_alphabets_beyond_one_number(monkeypatch):
    """Groups and trigrams that do not fit one 64-bit number together are numbered first."""
    r = np.random.default_rng(2)
    texts = ["".join(chr(c) for c in r.integers(0x4E00, 0x9FFF, 20)) for _ in range(3000)]
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    cp, first, last = px._code_points(data, np.arange(0, len(data) + 1, 60))
    group = np.arange(len(first)) * 1_000_000
    got = px.gram_counts(cp, first, last, group)
    want = [(k * 1_000_000, g, n) for k, t in enumerate(texts) for g, n in sorted(_counts([t])[0].items())]
    assert [*zip(*(x.tolist() for x in got), strict=True)] == [
        (k, ord(g[0]) << 42 | ord(g[1]) << 21 | ord(g[2]), n) for k, g, n in want
    ]


def test_the_query_tells_letters_of_one_class_apart_by_their_neighbours(spark, tmp_path):
    """Half of the letters share their classes with the other half; one text has the right letters beside the wrong ones."""
    r = random.Random(7)
    one = [chr(c) for c in range(0x430, 0x438)]
    two = [chr(ord(c) + 48) for c in one]
    half = lambda: " ".join("".join(r.choice(s) for _ in range(r.randint(2, 6))) for s in (r.choice((one, two)) for _ in range(70)))
    rows = [(k, half(), "ru") for k in range(80)]
    # the same classes and, in all, the same letters as in the other texts, mixed within words
    rows.append((99, "".join(c if c == " " else r.choice((c, chr(ord(c) + (48 if c in one else -48)))) for c in rows[0][1]), "ru"))
    _docs(spark, rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {x.doc_id: x for x in op2_kn_perplexity(spark, str(tmp_path)).collect()}
    assert not got[99].kept and got[99].perplexity > 1.5 * got[0].perplexity
    assert sum(got[k].kept for k in range(80)) >= 78
    kept = {x.doc_id for x in px.keep_good(spark.read.parquet(f"{tmp_path}/documents.parquet")).collect()}
    assert kept == {k for k, x in got.items() if x.kept}


def test_a_text_does_not_bear_itself_out(spark):
    """A long text of letters that no other holds scores above the band, though it makes up most of the counts."""
    r = random.Random(9)
    rows = [(k, _text(r, "aeinrst"), "en") for k in range(60)] + [(99, _text(r, "qxzjvkwbdfgmpuyc0123456789%&/()=", 6000), "en")]
    got = {x.doc_id: x for x in px.quality_rules(_docs(spark, rows), characters=True).collect()}
    assert got[99].perplexity > got[99].high and not got[99].kept
    assert sum(got[k].kept for k in range(60)) >= 58
