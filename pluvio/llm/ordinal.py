"""Quality classifier: ordinal cumulative-link regression on hashed text (operator 1).

One weight vector over hashed words and word endings scores a text; ordered
thresholds cut the score into grades: ``P(grade > k) = sigmoid(score - t_k)``.
The expected grade and the tail probability follow and select documents.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pluvio.llm import text as tx
from pluvio.llm.scratch import materialise

BUCKETS = 1 << 18
GRADES = 3
#: Bound of the labelled sample that the model is fitted on.
SAMPLE_DOCS = 20_000


def graded(labels: DataFrame) -> DataFrame:
    """``doc_id, grade`` from ratings: 0 toxic, 1 poor, 2 good; rows with nulls are left out."""
    rating = F.when(F.col("toxic") != 0, 0).when(F.col("quality") == 0, 1).otherwise(2)
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL AND quality IS NOT NULL")
    return known.groupBy(F.col("doc_id").cast("long").alias("doc_id")).agg(F.min(rating).cast("int").alias("grade"))


def features(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct hashed features of each row (words and last three bytes, A-Z folded) and their bounds."""
    s, e, row = tx.words(data, bounds)
    word = tx.word_hashes(data, s, e, lower=True)
    end = tx.word_hashes(data, np.maximum(s, e - 3), e, lower=True)
    end = tx.mix(end + np.uint64(1))
    mask = np.uint64(BUCKETS - 1)
    both = np.concatenate([word & mask, end & mask]).astype(np.int64)
    code = np.unique(np.concatenate([row, row]) * BUCKETS + both)
    return code % BUCKETS, np.searchsorted(code // BUCKETS, np.arange(len(bounds)))


def _scores(weights: np.ndarray, idx: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sum of the weights of each row's features over the fourth root of their number."""
    total = np.zeros(len(idx) + 1)
    np.cumsum(weights[idx], out=total[1:])
    return np.diff(total[bounds]) / np.maximum(np.diff(bounds), 1) ** 0.25


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(0.5 * x))


def exceed(score: np.ndarray, thresholds: np.ndarray) -> np.ndarray:
    """``P(grade > k)`` for each threshold; falls with k as the thresholds are ordered."""
    return _sigmoid(score[:, None] - thresholds[None, :])


def fit(
    rows: list[np.ndarray],
    grades: np.ndarray,
    epochs: int = 20,
    batch: int = 256,
    rate: float = 0.3,
    decay: float = 2e-5,
    least_docs: int = 15,
):
    """Weights and ordered thresholds by adaptive gradient steps on the cumulative-link likelihood.

    Features of fewer than ``least_docs`` sample documents keep weight 0, and
    every step pulls the weights that it touches towards 0 by ``decay`` (an
    absolute-value penalty): without that, chance would rule rare words. The order of the rows is shuffled by a fixed seed, so the
    same sample gives the same model.
    """
    common = np.bincount(np.concatenate(rows), minlength=BUCKETS) >= least_docs
    weights = np.zeros(BUCKETS)
    base, gaps = -1.0, np.zeros(GRADES - 2)  # t_0 and the logs of the gaps
    sq_w, sq_b, sq_g = np.full(BUCKETS, 1e-8), 1e-8, np.full(GRADES - 2, 1e-8)
    rng = np.random.default_rng(17)
    for _ in range(epochs):
        order = rng.permutation(len(rows))
        for lo in range(0, len(order), batch):
            pick = order[lo : lo + batch]
            idx = np.concatenate([rows[i] for i in pick])
            size = np.array([len(rows[i]) for i in pick])
            bounds = np.concatenate([[0], np.cumsum(size)])
            y = grades[pick]
            t = base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])
            s = _scores(weights, idx, bounds)
            up = np.concatenate([np.ones((len(y), 1)), exceed(s, t), np.zeros((len(y), 1))], 1)
            slope = up * (1 - up)
            k = np.arange(len(y))
            p = np.maximum(up[k, y] - up[k, y + 1], 1e-9)
            lower, upper = slope[k, y] / p, slope[k, y + 1] / p
            ds = -(lower - upper) / len(y)  # of the loss
            dt = np.zeros(GRADES - 1)
            np.add.at(dt, np.maximum(y - 1, 0), np.where(y > 0, lower, 0.0) / len(y))
            np.add.at(dt, np.minimum(y, GRADES - 2), -np.where(y < GRADES - 1, upper, 0.0) / len(y))
            per = np.repeat(ds / np.maximum(size, 1) ** 0.25, size)
            grad = np.bincount(idx, per, BUCKETS)
            seen = np.flatnonzero((grad != 0) & common)
            step = grad[seen]
            sq_w[seen] += step * step
            pace = rate / np.sqrt(sq_w[seen])
            moved = weights[seen] - pace * step
            weights[seen] = np.sign(moved) * np.maximum(np.abs(moved) - pace * decay, 0.0)
            gb = dt.sum()
            gg = np.array([dt[j + 1 :].sum() * np.exp(gaps[j]) for j in range(GRADES - 2)])
            sq_b += gb * gb
            sq_g += gg * gg
            base -= rate * gb / np.sqrt(sq_b)
            gaps -= rate * gg / np.sqrt(sq_g)
    return weights.astype(np.float32), base + np.concatenate([[0.0], np.cumsum(np.exp(gaps))])


def train(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS) -> DataFrame:
    """One row ``weights, thresholds`` (bytes), fitted on at most ``sample_docs`` labelled documents.

    The sample is those of smallest hash of the doc_id; no labels, no row.
    """
    sample = graded(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    texts = texts.join(F.broadcast(sample), "doc_id")  # at most sample_docs rows of two numbers

    def featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column(0)):
                idx, at = features(data, bounds)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(1)[lo:hi], batch.column(2)[lo:hi], tx.lists(idx, at, pa.int32())], ["doc_id", "grade", "idx"]
                )

    def learn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[int, tuple[int, np.ndarray]] = {}
        for batch in batches:
            for doc_id, grade, idx in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), strict=True):
                seen.setdefault(doc_id, (grade, idx.values.to_numpy().copy()))
        if seen:
            items = [seen[d] for d in sorted(seen)]
            weights, thresholds = fit([x for _, x in items], np.array([g for g, _ in items]))
            yield pa.RecordBatch.from_pydict({"weights": [weights.tobytes()], "thresholds": [thresholds.tobytes()]})

    rows = materialise(texts.select("text", "doc_id", "grade").mapInArrow(featurise, "doc_id long, grade int, idx array<int>"), "features")
    return materialise(rows.coalesce(1).mapInArrow(learn, "weights binary, thresholds binary"), "ordinal-model")


def grade_documents(docs: DataFrame, labels: DataFrame, tail: int = 2, least: float = 0.5) -> DataFrame:
    """Expected grade and tail probability of all documents (operator 1).

    Returns per row ``doc_id, n_features, score, expected_grade, tail_probability``
    (``P(grade >= tail)``) ``, grade`` (the likeliest) ``, kept`` (tail probability
    of ``least`` or more). A text without words (or null) is not kept. Without
    any labels nothing is known: the figures are null and every text with words is kept.
    """
    model = train(docs, labels).collect()  # at most one row of BUCKETS weights
    weights = np.frombuffer(model[0]["weights"], np.float32) if model else None
    thresholds = np.frombuffer(model[0]["thresholds"], np.float64) if model else None

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, hi, data, bounds in tx.slices(batch.column(1)):
                idx, at = features(data, bounds)
                some = np.diff(at) > 0
                if weights is None:
                    blank = pa.nulls(hi - lo, pa.float64())
                    cols = [blank, blank, blank, pa.nulls(hi - lo, pa.int32()), pa.array(some)]
                else:
                    score = _scores(weights, idx, at)
                    over = exceed(score, thresholds)
                    up = np.concatenate([np.ones((hi - lo, 1)), over, np.zeros((hi - lo, 1))], 1)
                    cols = [
                        pa.array(score),
                        pa.array(over.sum(1)),
                        pa.array(up[:, tail]),
                        pa.array((up[:, :-1] - up[:, 1:]).argmax(1), pa.int32()),
                        pa.array(some & (up[:, tail] >= least)),
                    ]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[lo:hi], pa.array(np.diff(at), pa.int64()), *cols],
                    ["doc_id", "n_features", "score", "expected_grade", "tail_probability", "grade", "kept"],
                )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(
        compute,
        "doc_id long, n_features long, score double, expected_grade double, tail_probability double, grade int, kept boolean",
    )
