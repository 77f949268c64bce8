"""Importance resampling against a plain Python version."""

from __future__ import annotations

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from pluvio.llm.resampling import _key, kth_key, resample
from pluvio.llm.scratch import materialise

SCHEMA = "doc_id long, text string, score long, key int, rank string, n_words string"


def _features(text, longest):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return len(words), [
        zlib.crc32(" ".join(words[k : k + n]).encode()) for n in range(1, longest + 1) for k in range(len(words) - n + 1)
    ]


def brute(docs, target, percent=10, least=20, longest=1, buckets=10_000, seed=2024):
    s, t = collections.Counter(), collections.Counter()
    for found, texts in ((s, [x for _, x in docs]), (t, target)):
        for x in texts:
            found.update(c % buckets for c in _features(x, longest)[1])
    big_s, big_t = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (big_s + buckets) / ((s[b] + 1) * (big_t + buckets))))
        for b in range(buckets)
    }
    out = []
    for i, text in docs:
        n, f = _features(text, longest)
        weight = sum(gain[c % buckets] for c in f)
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append([i, n, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= least), key=lambda r: (-r[4], r[0] is None, r[0] or 0, r[2], r[3]))
    for k, r in enumerate(fit[: percent * len(fit) // 100], 1):
        r[5] = k
    return collections.Counter(map(tuple, out))


@pytest.fixture(scope="module")
def docs():
    r = random.Random(8)
    vocabulary = ["".join(r.choice("abcdeé9") for _ in range(r.randint(1, 6))) for _ in range(400)]
    text = lambda n: r.choice([" ", "\n", "-"]).join(r.choice(vocabulary) for _ in range(n))
    out = [(k, text(r.randint(1, 60))) for k in range(300)]
    out += [(None, None), (400, None), (401, ""), (402, " ,.;\t"), (403, "W" * 5000 + " X"), (None, text(30)), (None, text(31))]
    out += [(410, text(25).upper())] * 40 + [(411, text(20_000)), (412, "İß" + text(40))]
    return out, [text(30) for _ in range(6)] + [None, ""]


@pytest.mark.parametrize("options", [{}, {"percent": 37, "longest": 2}, {"percent": 100, "least_words": 1, "buckets": 97}])
def test_matches_brute_force(spark, docs, options):
    rows, target = docs
    df = spark.createDataFrame([(i, t, 5, 6, "r", "w") for i, t in rows], SCHEMA).repartition(5)
    goal = spark.createDataFrame([(k, t) for k, t in enumerate(target)], "item_id long, text string")
    got = collections.Counter(tuple(r) for r in resample(df, goal, **options).collect())
    want = {"percent": options.get("percent", 10), "least": options.get("least_words", 20)}
    assert got == brute(rows, target, longest=options.get("longest", 1), buckets=options.get("buckets", 10_000), **want)


def test_empty_tables_and_no_winners(spark, docs):
    rows, target = docs
    goal = spark.createDataFrame([(0, target[0])], "item_id long, text string")
    none = spark.createDataFrame([], "doc_id long, text string")
    assert resample(none, goal).collect() == []
    few = spark.createDataFrame(rows[:3], "doc_id long, text string")
    assert [r["rank"] for r in resample(few, goal).collect()] == [None] * 3
    got = collections.Counter(tuple(r) for r in resample(few, none.withColumn("item_id", F.lit(1)), percent=50).collect())
    assert got == brute(rows[:3], [], percent=50)


def test_quickselect_finds_every_place(spark):
    r = random.Random(1)
    rows = [(r.choice([None, *range(60)]), r.randrange(9), r.randrange(3), r.randrange(2)) for _ in range(500)]
    df = spark.createDataFrame(rows, "doc_id long, score long, n_features long, weight long")
    keys = materialise(df.select(_key().alias("key")), "keys")
    want = sorted((-s, i is None, i or 0, n, w) for i, s, n, w in rows)
    for k in (1, 2, 3, 77, 250, 499, 500):
        assert kth_key(keys, k, pivots=3, seed=k) == want[k - 1]
