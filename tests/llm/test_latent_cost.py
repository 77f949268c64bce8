"""CPU seconds of the latent search (operator 6): the projection of passages and the vocabulary lookup."""

from __future__ import annotations

import time

import numpy as np

from pluvio.llm import latent


def _passages(rows: int, terms: int, most: int):
    """Sparse passages of 0 to about ``most`` terms, ascending by passage and term as ``_pairs_at`` gives them."""
    rng = np.random.default_rng(3)
    held = rng.random((rows, terms)) < rng.integers(0, most + 1, rows)[:, None] / terms
    passage, term = np.nonzero(held)
    return (passage, term, np.ones(len(term), np.int64)), rng.random(len(term)) + 0.1


def _seconds(run) -> float:
    times = []
    for _ in range(3):
        start = time.process_time()
        run()
        times.append(time.process_time() - start)
    return min(times)


def _segment_sums(pairs, weight, basis, rows, chunk=1024):
    """What ``_project`` returns, one segment of ``np.add.reduceat`` for each passage."""
    out = np.zeros((rows, basis.shape[1]), np.float32)
    starts = np.append(np.flatnonzero(np.diff(pairs[0], prepend=-1)), len(weight))
    for lo in range(0, len(starts) - 1, chunk):
        hi = min(lo + chunk, len(starts) - 1)
        a, b = starts[lo], starts[hi]
        part = basis[pairs[1][a:b]] * weight[a:b, None].astype(np.float32)
        out[pairs[0][starts[lo:hi]]] = np.add.reduceat(part, starts[lo:hi] - a, 0)
    return out


def test_projection_matches_dense_product():
    pairs, weight = _passages(1500, 90, 60)
    basis = np.random.default_rng(4).standard_normal((90, 24)).astype(np.float32)
    dense = np.zeros((1503, 90))
    dense[pairs[0], pairs[1]] = weight
    for chunk in (1, 7, 512):
        found = latent._project(pairs, weight, basis, 1503, chunk)
        assert np.allclose(found, dense @ basis, atol=1e-4)
        assert np.array_equal(found, _segment_sums(pairs, weight, basis, 1503))
    none = tuple(x[:0] for x in pairs)
    assert not latent._project(none, weight[:0], basis, 3).any()


def test_projection_costs_less_than_half_of_segment_sums():
    pairs, weight = _passages(20_000, 400, 8)
    basis = np.random.default_rng(4).standard_normal((400, 192)).astype(np.float32)
    given = pairs, weight, basis, 20_000
    assert _seconds(lambda: latent._project(*given)) < 0.5 * _seconds(lambda: _segment_sums(*given))


def test_places_of_words_with_equal_first_bits():
    rng = np.random.default_rng(5)
    vocabulary = np.unique(rng.integers(0, 1 << 63, 500, np.uint64))
    ends = np.array([0, (1 << 64) - 1], np.uint64)
    near = np.concatenate([vocabulary + np.uint64(1), vocabulary ^ np.uint64(1 << 47)])
    words = rng.permutation(np.concatenate([vocabulary, vocabulary, near, ends, rng.integers(0, 1 << 63, 5000, np.uint64)]))
    place, term = latent._places(words, vocabulary)
    known = {int(v): k for k, v in enumerate(vocabulary)}
    want = [(k, known[int(w)]) for k, w in enumerate(words) if int(w) in known]
    assert list(zip(place.tolist(), term.tolist(), strict=True)) == want
