"""The latent gate (operator 6) against all-pairs subsequences: short items, lists of items, changed words."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from pluvio.llm.latent import _compare, find_leaks


def _corpus(changed: float, seed: int):
    r = random.Random(seed)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(r.randint(2, 8))) for _ in range(3000)]
    plain = lambda n: [r.choice(vocabulary[:600] if r.random() < 0.6 else vocabulary) for _ in range(n)]
    items = [plain(5 + k % 15) for k in range(60)]
    docs = [plain(r.randint(5, 400)) for _ in range(150)]
    for _ in range(60):  # lists of six whole items
        parts = [list(items[k]) for k in r.sample(range(60), 6)]
        for w in parts:
            for at in range(len(w)):
                if r.random() < changed:
                    w[at] = r.choice(vocabulary)
        docs.append([x for w in parts for x in w])
    for k in range(0, 60, 3):  # one item in a long text
        docs.append(plain(150) + items[k] + plain(1500))
    return items, docs


@pytest.mark.parametrize("changed", [0.0, 0.2])
def test_recall_against_all_pairs(spark, changed):
    items, docs = _corpus(changed, 4)
    want = set()
    for d, text in enumerate(docs):
        for i, item in enumerate(items):
            if len(set(item) & set(text)) * 2 >= len(set(item)):
                ratio, answered = _compare(item, item[-5:], text)
                if ratio >= 0.8 or (ratio >= 0.6 and answered):
                    want.add((d, i))
    bench = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(items)], "item_id long, text string")
    df = spark.createDataFrame([(d, " ".join(w)) for d, w in enumerate(docs)], "doc_id long, text string").repartition(4)
    got = {(r["doc_id"], r["item_id"]) for r in find_leaks(df, bench).collect()}
    recall = len(got & want) / len(want)
    print(f"changed {changed}: {len(want)} pairs, recall {recall:.3f}, beyond {len(got - want)}")
    assert recall >= 0.95


@pytest.mark.parametrize("dense", [True, False])
def test_space_is_fitted_on_every_document(spark, monkeypatch, dense):
    """Also the words of documents beyond the 20,000 of smallest hash shape the latent space, as in brute force."""
    from pluvio.llm import latent

    if not dense:
        monkeypatch.setattr(latent, "DENSE_PAIRS", 0)
    far = {r.id for r in spark.range(20_400).orderBy(F.xxhash64("id").desc()).limit(300).collect()}
    names = [f"w{k}" for k in range(40)]
    # a few pairs of words each; the far ones hold words and pairs that no other document has
    own = lambda k: " ".join(names[(20 if k in far else 0) + (k * j) % 20] for j in (1, 3, 7, 7))
    texts = [own(k) if k in far or k % 60 == 0 else "" for k in range(20_400)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    hashes, bounds = latent._hash_words([" ".join(names[k::8]) for k in range(8)])
    vocabulary = np.unique(hashes)
    idf = np.linspace(1, 2, len(vocabulary))
    got = latent.fit_space(docs, (hashes, bounds), vocabulary, idf, 5)

    def product(h, at):
        rows = np.zeros((len(at) - 1, len(vocabulary)))
        for k in range(len(at) - 1):
            term, n = np.unique(np.searchsorted(vocabulary, h[at[k] : at[k + 1]]), return_counts=True)
            rows[k, term] = (1 + np.log(n)) * idf[term]
        rows /= np.maximum(np.linalg.norm(rows, axis=1), 1e-9)[:, None]
        return rows.T @ rows @ np.random.default_rng(5).standard_normal((len(vocabulary), 13)).astype(np.float32)

    y, items = product(*latent._hash_words(texts)), product(hashes, bounds)
    scale = max(latent.ITEM_WEIGHT * np.linalg.norm(y) / np.linalg.norm(items), 1)
    want = np.linalg.svd(y + scale * items, full_matrices=False)[0][:, :5]
    assert np.allclose(np.abs(got), np.abs(want), atol=2e-3)
