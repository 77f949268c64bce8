"""Rows whose short hashes collide, and tables whose own columns bear the names of helper columns."""

from __future__ import annotations

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from pluvio.llm.latent import drop_leaks
from pluvio.llm.perplexity import keep_good, quality_rules
from pluvio.llm.scratch import keyed
from pluvio.llm.simhash import drop_near_duplicates
from pluvio.llm.substring import cut_repeats
from pluvio.llm.suffix import remove_repeated_bytes


@pytest.fixture(scope="module")
def colliding(spark):
    """Two texts with a shared passage of 440 bytes and the same 32-bit Spark hash."""
    passage = "the quick passage of rain " * 17
    rows = spark.range(400_000).select(F.concat(F.lit(passage), F.col("id").cast("string")).alias("t"))
    pair = rows.groupBy(F.hash("t").alias("k")).agg(F.collect_list("t").alias("t")).where(F.size("t") > 1).first()["t"]
    return passage, pair[0], pair[1]


def test_rows_of_null_ids_with_equal_short_hashes_stay_apart(spark, colliding):
    passage, one, two = colliding
    docs = spark.createDataFrame([(None, one), (None, two), (7, passage)], "doc_id long, text string")
    assert keyed(docs).select("_h").distinct().count() == 3
    got = {r.kept_sha256 for r in remove_repeated_bytes(docs, length=400).where("doc_id IS NULL").collect()}
    want = set()
    for text in (one, two):
        own, others = text.encode(), [t.encode() for t in (one, two, passage) if t != text]
        gone = [False] * len(own)
        for k in range(len(own) - 399):
            s = own[k : k + 400]
            if any(s in o for o in others) or own.find(s) != k or own.find(s, k + 1) >= 0:
                gone[k : k + 400] = [True] * 400
        want.add(hashlib.sha256(bytes(b for b, g in zip(own, gone, strict=True) if not g)).hexdigest())
    assert got == want and len(got) == 2


def test_filters_keep_a_callers_columns(spark):
    words = [f"w{k}" for k in range(80)]
    texts = [" ".join(words), " ".join(words[:60]) + " tail", " ".join(f"z{k}" for k in range(70)), "short", None]
    names = ["_row_h", "kept_text", "_kept_id", "_cut_id", "_h", "row", "row_id", "row_h"]
    schema = "doc_id long, text string, lang string, source string, n_chars long, " + ", ".join(f"{n} string" for n in names)
    rows = [(k, t, "en", "s", len(t or ""), *(f"{n}{k}" for n in names)) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame([(1, " ".join(f"z{k}" for k in range(20)))], "item_id long, text string")
    for out in (keep_good(docs), drop_near_duplicates(docs), cut_repeats(docs), drop_leaks(docs, items)):
        assert out.columns == docs.columns
        got = out.collect()
        assert got
        for r in got:
            assert [r[n] for n in names] == [f"{n}{r.doc_id}" for n in names]
    assert {r.doc_id for r in drop_leaks(docs, items).collect()} == {0, 1, 3, 4}
    for k in (0, 1):
        assert {r.doc_id: r.text for r in cut_repeats(docs).collect()}[k] == [texts[0], "tail"][k]


def test_symbols_leave_out_brackets(spark):
    docs = spark.createDataFrame([(1, "a [b] c # d", "en"), (2, "#*$%&|<> []", "en")], "doc_id long, text string, lang string")
    got = {r.doc_id: r.n_symbols for r in quality_rules(docs).collect()}
    assert got == {k: len(re.findall(r"[#*$%&|<>]", t)) for k, t in ((1, "a [b] c # d"), (2, "#*$%&|<> []"))}
