"""Near-duplicate, repeat and suffix operators against brute force on small documents."""

from __future__ import annotations

import collections
import hashlib
import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from pluvio.llm.components import components
from pluvio.llm.simhash import close_links, drop_near_duplicates, fingerprint, near_duplicates
from pluvio.llm.substring import cut_repeats, remove_repeats
from pluvio.llm.suffix import _by_size, remove_repeated_bytes, repeated_starts, suffix_array

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, fp long, anchor string, key int"


def _docs(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 7, "x", 1) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def rows():
    """Copies, near copies, shared passages, periodic text, nulls, empty texts, repeated rows."""
    r = random.Random(5)
    vocabulary = ["".join(r.choice("abcdeé") for _ in range(r.randint(1, 7))) for _ in range(300)]
    text = lambda n: " ".join(r.choice(vocabulary) for _ in range(n))
    passage, base = text(60), text(150)
    out = [(None, None), (0, None), (1, ""), (2, " \n\t "), (3, "One"), (4, "one two"), (5, "ONE two")]
    out += [(10 + k, base) for k in range(4)] + [(None, base), (11, base)]
    for k in range(6):
        words = base.split()
        words[r.randrange(len(words))] = "changed"
        out.append((20 + k, "\n".join(words)))
    out += [(30 + k, f"{text(40)} {passage}\n{text(30)}") for k in range(8)]
    out += [(40, "Shti " * 400), (41, "Shti " * 90 + "end"), (42, text(3000)), (43, "ab" * 700)]
    return out


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def test_simhash_matches_all_pairs(spark, rows):
    got = near_duplicates(_docs(spark, rows)).collect()
    fps = []
    for _, text in rows:
        w = _words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        grams = [" ".join(w[k : k + 3]) for k in range(len(w) - 2)] or ([" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
        fps.append(sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h)))
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3 and group[a] != group[b]:
                group = [group[b] if g == group[a] else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    want = collections.Counter(
        (i, f"{f:016x}", least.get(g)) for (i, _), f, g in zip(rows, fps, group, strict=True)
    )
    assert collections.Counter((r.doc_id, r.fingerprint, r.component_id) for r in got) == want
    kept = drop_near_duplicates(_docs(spark, rows))
    assert kept.columns == _docs(spark, rows[:1]).columns
    assert kept.count() == len(set(group))


def test_fingerprint_of_no_words_is_zero():
    assert fingerprint([], 3) == 0


def test_close_links_with_hot_buckets_lose_no_link(spark):
    r = random.Random(2)
    centre = r.getrandbits(64)
    fps = {centre ^ (1 << r.randrange(20)) ^ (1 << r.randrange(64)) for _ in range(150)}
    fps |= {r.getrandbits(64) for _ in range(300)}
    signed = [x - (1 << 64) if x >> 63 else x for x in fps]
    df = spark.createDataFrame([(x,) for x in signed], "fp long")
    for hot in (4, 100_000):
        links = close_links(df, 3, hot=hot)
        assert all((a ^ b).bit_count() <= 3 for a, b in links.select("a", "b").collect())
        roots = {n: x for n, x in components(links).collect()}
        want = {x: x for x in signed}
        for a in signed:
            for b in signed:
                if a < b and (a ^ b).bit_count() <= 3 and want[a] != want[b]:
                    lo, hi = min(want[a], want[b]), max(want[a], want[b])
                    want = {k: lo if v == hi else v for k, v in want.items()}
        assert {x: roots.get(x, x) for x in signed} == want


def test_components_of_a_long_chain(spark):
    links = spark.range(40).select(F.col("id").alias("a"), (F.col("id") + 1).alias("b"))
    assert {tuple(r) for r in components(links).collect()} == {(n, 0) for n in range(1, 41)}


def _expected_words(rows, length):
    first = {}
    for i, text in rows:
        if i is not None:
            w = _words(text)
            for k in range(len(w) - length + 1):
                key = tuple(w[k : k + length])
                first[key] = min(first.get(key, i), i)
    out = collections.Counter()
    for i, text in rows:
        w = _words(text)
        gone = [False] * len(w)
        for k in range(len(w) - length + 1):
            if i is not None and first[tuple(w[k : k + length])] < i:
                gone[k : k + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[i, len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest()] += 1
    return out


def test_repeated_words_match_brute_force(spark, rows):
    got = remove_repeats(_docs(spark, rows), length=13)
    found = collections.Counter((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect())
    assert found == _expected_words(rows, 13)


def test_cut_repeats_keeps_columns_and_clean_texts(spark, rows):
    docs = _docs(spark, rows)
    out = cut_repeats(docs, 13)
    assert out.columns == docs.columns
    by_id = collections.defaultdict(list)
    for r in out.collect():
        by_id[r.doc_id].append(r)
    assert by_id[10][0].text == dict(rows)[10] and 12 not in by_id
    assert len(by_id[31][0].text) == by_id[31][0].n_chars < len(dict(rows)[31])
    assert by_id[0][0].text is None and by_id[42][0].text == dict(rows)[42]


def _expected_bytes(rows, length):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = collections.Counter(b[k : k + length] for _, b in raw for k in range(len(b) - length + 1))
    out = collections.Counter()
    for i, b in raw:
        gone = np.zeros(len(b), bool)
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = True
        spans = int((np.diff(np.concatenate([[0], gone.astype(int)])) > 0).sum())
        kept = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[i, len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()] += 1
    return out


@pytest.mark.parametrize("length", [60, 400])
def test_repeated_bytes_match_brute_force(spark, rows, length):
    got = remove_repeated_bytes(_docs(spark, rows), length).collect()
    found = collections.Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got)
    assert found == _expected_bytes(rows, length)


@pytest.mark.parametrize("length", [60, 400])
def test_segments_of_one_hot_passage_are_split(spark, length):
    """Distinct texts around one passage: no sort group beyond the bound, and the same bytes go."""
    r = random.Random(9)
    noise = lambda n: "".join(r.choice("abcdefghij ") for _ in range(n))
    passage = noise(420)
    rows = [(k, noise(500) + r.choice("xy") + passage + r.choice("uv") + noise(500)) for k in range(40)]
    rows += [(90, noise(300) + passage[:410]), (91, rows[0][1]), (92, "x" + passage[5:]), (None, passage)]
    docs = _docs(spark, rows)
    got = remove_repeated_bytes(docs, length, group_bytes=5000).collect()
    found = collections.Counter((x.doc_id, x.n_bytes, x.n_removed, x.n_spans, x.kept_sha256) for x in got)
    assert found == _expected_bytes(rows, length)
    distinct = spark.createDataFrame([(1, b"a%d" % k, b"x" * 700) for k in range(9)] + [(2, b"b", b"y"), (2, b"c", b"z")], "anchor long, sid binary, seg binary")
    small, large = _by_size(distinct, 5000)
    assert [x.anchor for x in small.collect()] == [2, 2] and {x.anchor for x in large.collect()} == {1}
    assert large.count() == 9


def test_suffix_array_sorts_suffixes():
    r = random.Random(1)
    for trial in range(200):
        alphabet = "ab" if trial % 2 else "abcdé"
        segments = ["".join(r.choice(alphabet) for _ in range(r.randint(1, 30))).encode() for _ in range(r.randint(1, 8))]
        data, size = b"".join(segments), np.array([len(s) for s in segments])
        ends = np.repeat(np.cumsum(size), size)
        order = suffix_array(data, ends, 50)
        assert sorted(order.tolist()) == list(range(len(data)))
        assert [data[i : ends[i]] for i in order] == sorted(data[i : ends[i]] for i in range(len(data)))
        length = r.randint(1, 8)
        count = collections.Counter(data[i : i + length] for i in range(len(data)) if ends[i] - i >= length)
        want = [bool(ends[i] - i >= length and count[data[i : i + length]] > 1) for i in range(len(data))]
        assert repeated_starts(segments, length).tolist() == want


@pytest.mark.parametrize("operator", [near_duplicates, remove_repeats, remove_repeated_bytes])
def test_empty_table(spark, operator):
    assert operator(_docs(spark, [])).count() == 0
