"""The conversation prefix trie against a plain Python trie."""

from __future__ import annotations

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm import prefixes
from pluvio.llm.prefixes import RangeMin, id_list_digests, prefix_trie, range_bounds, rebuilt

SCHEMA = "conv_id long, turn int, role string, text string, depth string, seq int, least long"


def brute(rows):
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    own = {c: [t[2:] for t in sorted(v)] for c, v in own.items()}
    members = collections.defaultdict(list)
    ends = collections.defaultdict(list)
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        seq = tuple(own.get(c - c % 20, [])[:h] + turns[h:])
        for d in range(len(seq) + 1):
            members[seq[:d]].append(c)
        ends[seq].append(c)
    kids = collections.defaultdict(list)
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = sum(leaves[k] for k in kids[node]) or 1
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
    return collections.Counter(
        (
            min(m),
            len(node),
            min(members[node[:-1]]) if node else None,
            len(m),
            len(kids[node]),
            leaves[node],
            saved[node],
            hashlib.sha256(",".join(map(str, sorted(ends[node]))).encode()).hexdigest(),
        )
        for node, m in members.items()
    )


def _frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 3, 4) for r in rows], SCHEMA)


@pytest.fixture(scope="module")
def talks():
    """Shared openings, whole copies, a long one, turns with nulls, a conversation with null turns only."""
    r = random.Random(6)
    say = lambda n: r.choice([" ", "\n", "  "]).join(r.choice(["a", "bé", "ccc"]) for _ in range(n))
    opening = [("user", "hello there"), ("assistant", "hi, what is it")]
    rows = []
    for c in range(0, 260):
        turns = list(opening) if c % 3 else []
        turns += [(r.choice(["user", "assistant", None]), r.choice(["x y", "z", None, say(3)])) for _ in range(r.randrange(0, 6))]
        if c % 20 == 0 and c % 3:
            turns = turns[: r.randrange(4)]
        if 200 <= c < 240:
            turns = opening + [("user", "copy " * 9)] * 3
        rows += [(c, k, *t) for k, t in enumerate(turns)]
    rows += [(300, None, "user", "no turn"), (301, None, None, None), (None, 0, "user", "nobody"), (320, 5, "user", "only later")]
    rows += [(400, k, "user", f"turn {k % 7}") for k in range(900)] + [(401, k, "user", f"turn {k % 7}") for k in range(950)]
    rows += [(402, 1, "user", "again"), (402, 1, "user", "again"), (403, 0, "user", "word " * 30_000)]
    rows += [(2**40 + 7, k, "user", "hello there") for k in range(2)]
    r.shuffle(rows)
    return rows


def test_matches_a_plain_trie(spark, talks):
    got = prefix_trie(_frame(spark, talks).repartition(5))
    assert got.columns == ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    assert {t for _, t in got.dtypes} == {"bigint", "string"}
    assert collections.Counter(map(tuple, got.collect())) == brute(talks)


@pytest.mark.parametrize("every", [1, 4, 40])
def test_ranges_and_blocks_do_not_change_the_nodes(spark, talks, every):
    df = _frame(spark, talks)
    seqs = sorted({bytes(r["seq"]) for r in rebuilt(df).collect()})
    got = prefix_trie(df, block_turns=1 if every == 4 else 23, bounds=seqs[::every])
    assert collections.Counter(map(tuple, got.collect())) == brute(talks)


def test_few_and_no_conversations(spark):
    assert prefix_trie(_frame(spark, [])).collect() == []
    nobody = [(None, 0, "user", "x")]
    assert prefix_trie(_frame(spark, nobody)).collect() == []
    c = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4 == 3)
    for rows in ([(c, 0, "user", "gone")], [(c, 0, "user", "gone"), (0, 0, "user", "kept")], [(0, 0, None, None)]):
        assert collections.Counter(map(tuple, prefix_trie(_frame(spark, rows)).collect())) == brute(rows)


def test_long_id_lists_are_read_in_pieces(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "PIECE_IDS", 7)
    ids = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit(b"hot")).otherwise(F.lit(b"cold")).alias("seq"), F.col("id").alias("conv_id"))
    got = {bytes(r.seq): r.ends_sha256 for r in id_list_digests(ids.repartition(6)).collect()}
    text = lambda keep: ",".join(str(k) for k in range(5000) if keep(k)).encode()
    assert got == {
        b"hot": hashlib.sha256(text(lambda k: k % 3 > 0)).hexdigest(),
        b"cold": hashlib.sha256(text(lambda k: k % 3 == 0)).hexdigest(),
    }


def test_range_minima():
    r = np.random.default_rng(1)
    x = r.integers(0, 9, 100)
    low = RangeMin(x)
    lo = r.integers(0, 100, 500)
    hi = lo + 1 + (r.random(500) * (100 - lo)).astype(int)
    assert (low(lo, hi) == [x[a:b].min() for a, b in zip(lo, hi, strict=True)]).all()


def test_bounds_come_from_the_rows(spark, monkeypatch):
    monkeypatch.setattr(prefixes, "RANGE_TURNS", 50)
    keys = [bytes([k]) * prefixes.WIDTH * (1 + k % 3) for k in range(250)]
    rows = spark.createDataFrame([(bytearray(k),) for k in keys], "seq binary")
    found = range_bounds(rows)
    assert 5 <= len(found) < 20 and found == sorted(found) and set(found) <= set(keys)
