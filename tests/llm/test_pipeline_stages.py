"""The corpus pipeline, stage by stage, against brute force on a small corpus."""

from __future__ import annotations

import collections
import os
import random
import re
import struct
import zlib

import public_tokenizers
import pytest
import xxhash
from tokenizers import Tokenizer

import corpus_pipeline
from pluvio.session import checkpoint_root

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Clean texts, failing texts, copies, near copies, a shared passage, leaked items, nulls.

    Fewer documents of one language than a perplexity band needs, so that the
    base rules alone decide in the first stage.
    """
    r = random.Random(11)
    vocabulary = ["".join(r.choice("abcdefgilmnoprstu") for _ in range(r.randint(2, 8))) for _ in range(4000)]
    words = lambda n: [r.choice(vocabulary) for _ in range(n)]
    text = lambda n: " ".join(words(n))
    items = [(k, text(30)) for k in range(5)]
    passage, base = text(70), words(400)
    out = [(k, text(120 + 9 * k)) for k in range(12)]
    out += [(20, None), (21, ""), (22, text(49)), (23, "spam eggs ham " * 40), (None, text(90)), (24, text(4000))]
    out += [(30 + k, " ".join(base)) for k in range(4)]
    near = list(base)
    near[200] = "changed"
    out.append((40, " ".join(near)))
    out += [(50 + k, f"{text(60)}\n{passage} {text(80)}") for k in range(4)]
    out += [(60 + k, f"{text(50)} {items[k][1]} {text(50)}") for k in range(3)]
    folder = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", "s", len(t or "")) for i, t in out]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return folder, dict(items)


@pytest.fixture(scope="module")
def outputs(spark, tables):
    """The rows of every stage, each from the rows of the one before."""
    docs = spark.read.parquet(f"{tables[0]}/documents.parquet")
    found = [[tuple(r) for r in docs.collect()]]
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, tables[0])
        rows = out.collect()
        found.append([r.asDict() for r in rows] if name == "packing" else [tuple(r) for r in rows])
        if name != "packing":
            assert out.columns == docs.columns
            docs = spark.createDataFrame(rows, SCHEMA)
    return found


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _passes(text):
    w = _words(text)
    grams = [tuple(w[k : k + 3]) for k in range(len(w) - 2)]
    count = collections.Counter(grams)
    twice = {k + j for k, g in enumerate(grams) if count[g] > 1 for j in range(3)}
    return len(w) >= 50 and 100 * len(twice) <= 50 * len(w)


def test_rules_reject_what_fails(outputs):
    want = [x for x in outputs[0] if _passes(x[1])]
    assert sorted(outputs[1], key=str) == sorted(want, key=str) and len(want) == 26


def _fingerprint(text):
    w = _words(re.sub("[A-Z]", lambda m: m[0].lower(), text))
    hashes = [xxhash.xxh64_intdigest(" ".join(w[k : k + 3]).encode(), 42) for k in range(len(w) - 2)]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in hashes) > len(hashes))


def test_one_document_of_each_group_stays(outputs):
    rows = sorted(outputs[1], key=lambda x: (x[0] is None, x[0] or 0))
    fps = [_fingerprint(x[1]) for x in rows]
    group = list(range(len(rows)))
    for a in range(len(rows)):
        for b in range(a):
            if (fps[a] ^ fps[b]).bit_count() <= 3:
                old, new = max(group[a], group[b]), min(group[a], group[b])
                group = [new if g == old else g for g in group]
    want = [rows[g] for g in set(group)]
    assert sorted(outputs[2], key=str) == sorted(want, key=str)
    assert not {31, 32, 33} & {x[0] for x in outputs[2]} and 30 in {x[0] for x in outputs[2]}


def test_repeats_are_cut(outputs):
    rows = [(x[0], _words(x[1])) for x in outputs[2]]
    first = {}
    for i, w in sorted(rows, key=lambda x: (x[0] is None, x[0] or 0)):
        for k in range(len(w) - 12):
            first.setdefault(tuple(w[k : k + 13]), i)
    want = {}
    for i, w in rows:
        gone = {k + j for k in range(len(w) - 12) if first[tuple(w[k : k + 13])] != i for j in range(13)}
        want[i] = [x for k, x in enumerate(w) if k not in gone]
    assert {x[0]: _words(x[1]) for x in outputs[3]} == want
    assert len(want[51]) == len(want[50]) - 70  # the shared passage stays in the smallest document alone
    assert all(x[4] == len(x[1]) for x in outputs[3])


def test_leaks_go_and_clean_documents_stay(outputs, tables):
    holds = lambda text: any(f" {item} " in f" {' '.join(_words(text))} " for item in tables[1].values())
    want = [x for x in outputs[3] if not holds(x[1])]
    assert sorted(outputs[4], key=str) == sorted(want, key=str)
    assert {x[0] for x in outputs[3]} - {x[0] for x in outputs[4]} == {60, 61, 62}


def test_packing_holds_every_token_once(outputs):
    tokenizer = Tokenizer.from_file(str(public_tokenizers.path("byte_bpe_50k.json")))
    want = collections.Counter()
    for x in outputs[4]:
        ids = [*tokenizer.encode(x[1], add_special_tokens=False).ids, 0]
        ends = range(len(ids) % 2048 or 2048, len(ids) + 1, 2048)
        for piece, end in enumerate(ends):
            start = ends[piece - 1] if piece else 0
            crc = zlib.crc32(struct.pack(f"<{end - start}I", *ids[start:end]))
            want[x[0], piece, start, end - start, crc] += 1
    got = outputs[5]
    assert collections.Counter((r["doc_id"], r["piece"], r["start"], r["length"], r["ids_crc32"]) for r in got) == want
    bins = collections.defaultdict(list)
    for r in got:
        bins[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in bins.values():
        ends = [a + n for a, n in sorted(places)]
        assert [a for a, _ in sorted(places)] == [0, *ends[:-1]] and ends[-1] <= 2048


def test_run_equals_the_stages(spark, tables, outputs):
    pieces = lambda rows: collections.Counter((r["doc_id"], r["piece"], r["length"], r["ids_crc32"]) for r in rows)
    got = corpus_pipeline.run(spark, tables[0]).collect()
    assert pieces(r.asDict() for r in got) == pieces(outputs[5])


def test_run_keeps_no_stage_that_is_done_with(spark, tables):
    """Of the stored stages only the last one's input is left, and none of the substring stage's windows."""
    root = checkpoint_root(spark).removeprefix("file:")
    before = set(os.listdir(root))
    corpus_pipeline.run(spark, tables[0]).collect()
    left = {x.rsplit("-", 1)[0] for x in set(os.listdir(root)) - before}
    stages = {f"llm-{name}" for name, _ in corpus_pipeline.STAGES}
    assert left & stages == {"llm-decontamination"}
    assert not left & {"llm-windows", "llm-repeats", "llm-shared", "llm-shared-anchors"}
