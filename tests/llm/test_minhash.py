"""b-bit MinHash classes against all pairs of full shingle sets."""

from __future__ import annotations

import collections
import random
import re

import numpy as np
import pytest

from pluvio.llm import minhash
from pluvio.llm.minhash import SIGNATURE, banding, least_estimate, minima, near_classes, pack, similarity

SCHEMA = "doc_id long, text string, sid long, key string, digest int, n int"


def _set(text, shingle):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if len(w) < shingle:
        return frozenset([tuple(w)] if w else [])
    return frozenset(tuple(w[k : k + shingle]) for k in range(len(w) - shingle + 1))


def brute(rows, shingle=4, percent=80):
    sets = [_set(t, shingle) for _, t in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if group[a] != group[b] and sets[a] and sets[b]:
                if 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b]):
                    group = [group[b] if g == group[a] else g for g in group]
    least = {}
    for (i, _), g in zip(rows, group, strict=True):
        if i is not None:
            least[g] = min(i, least.get(g, i))
    return collections.Counter(
        (i, len(s), (c := least.get(g) if s else i), i == c) for (i, _), s, g in zip(rows, sets, group, strict=True)
    )


@pytest.fixture(scope="module")
def rows():
    """Near copies on both sides of the threshold, chains, short and empty texts, nulls, repeated rows."""
    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdeéF") for _ in range(r.randint(1, 7))) for _ in range(900)]
    words = lambda n: [r.choice(vocabulary) for _ in range(n)]
    out = [(None, None), (0, None), (1, ""), (2, " \n\t "), (3, "One two"), (4, "one  TWO"), (5, "one two three four"), (None, "one two")]
    out += [(k, " ".join(words(r.randint(30, 300)))) for k in range(10, 60)]
    for family in range(6):
        base = words(200)
        for k in range(25):
            w = list(base)
            for _ in range(r.choice([0, 1, 3, 5, 6, 7, 9, 12])):
                w[r.randrange(len(w))] = "changed" + str(r.randrange(50))
            out.append((100 + 40 * family + k, r.choice([" ", "\n"]).join(w)))
    chain = words(150)
    for k in range(30):  # neighbours link, far ones do not
        out.append((500 + k, " ".join(chain)))
        chain = chain[4:] + words(4)
    out += [(12, out[12][1]), (None, out[70][1]), (600, " ".join(words(20_000)))]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("options", [{}, {"block": 3, "most": 1}])
def test_matches_all_pairs(spark, rows, options):
    df = spark.createDataFrame([(i, t, 1, "k", 2, 3) for i, t in rows], SCHEMA).repartition(4)
    got = near_classes(df, **options)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert collections.Counter(map(tuple, got.collect())) == brute(rows)


def test_members_apart_from_the_smallest_are_still_linked(spark):
    """One bucket: the smallest member links with nobody, the others in pairs far down each other's lists."""
    r = random.Random(3)
    base = [f"w{k}" for k in range(400)]
    rows = []
    for k in range(40):
        w = list(base)
        for at in r.sample(range(0, 400, 4), 22 + k % 2):
            w[at] = f"v{k // 2}_{at}"
        rows.append((k, " ".join(w)))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = collections.Counter(map(tuple, near_classes(df, percent=60, most=1, block=7).collect()))
    assert got == brute(rows, percent=60)


def test_pairs_below_the_threshold_are_no_rows(spark, monkeypatch):
    """Sixty texts, each two 75 percent alike: the tables stored grow with members and bands, not with pairs."""
    r = random.Random(11)
    rows = []
    for k in range(60):
        w = [f"w{i}" for i in range(400)]
        for at in r.sample(range(4, 396, 4), 7):
            w[at] = f"v{k}_{at}"
        rows.append((k, " ".join(w)))
    stored = {}

    def store(df, name, keep=minhash.materialise):
        out = keep(df, name)
        stored[name] = max(out.count(), stored.get(name, 0))
        return out

    monkeypatch.setattr(minhash, "materialise", store)
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert collections.Counter(map(tuple, near_classes(df).collect())) == brute(rows)
    assert max(stored.values()) <= banding(80)[0] * len(rows), stored


def test_empty_table(spark):
    assert near_classes(spark.createDataFrame([], "doc_id long, text string")).collect() == []
    lonely = spark.createDataFrame([(7, None), (None, "a b c d e")], "doc_id long, text string")
    assert sorted(map(tuple, near_classes(lonely).collect()), key=str) == [(7, 0, 7, True), (None, 2, None, True)]


def test_broadcast_and_shuffled_keys_agree(spark, rows, monkeypatch):
    df = spark.createDataFrame(rows[:90], "doc_id long, text string")
    want = brute(rows[:90])
    monkeypatch.setattr(minhash, "BROADCAST_ROWS", 0)
    assert collections.Counter(map(tuple, near_classes(df).collect())) == want


def test_estimates_lie_around_the_similarity():
    r = np.random.default_rng(5)
    for share in (0.3, 0.8, 0.95):
        found = []
        for _ in range(60):
            pool = r.integers(0, 1 << 63, 800, dtype=np.int64).view(np.uint64)
            both = int(800 * share)
            rest = (800 - both) // 2
            one, two = pool[: both + rest], np.concatenate([pool[:both], pool[both + rest :]])
            sig = pack(minima(np.concatenate([one, two]), np.array([0, len(one)]), SIGNATURE))
            found.append(similarity(sig[:1], sig[1])[0])
        chance = 0.25
        p = share + (1 - share) * chance
        error = (p * (1 - p) / SIGNATURE) ** 0.5 / (1 - chance)
        assert abs(np.mean(found) - share) < 4 * error / 60**0.5 and np.std(found) < 1.5 * error
    assert 0.65 < least_estimate(80) < 0.7


def test_bands_miss_next_to_nothing_at_any_threshold():
    for percent in (50, 60, 70, 80, 90, 95):
        bands, rows = banding(percent)
        assert (1 - (percent / 100) ** rows) ** bands <= 5e-9 and bands * rows <= SIGNATURE
