"""Quality classifier by positive-unlabelled learning.

A linear model with logistic loss minimises the non-negative unbiased risk
``prior * R_p(+) + max(0, R_u(-) - prior * R_p(-))`` from trusted positives and unlabelled texts: where
the second term turns negative on a batch, its gradient is turned back. The class prior is
estimated first, from a plain positive-against-unlabelled model on the other half of the sample: the
least ratio of unlabelled to positive texts above a threshold, where a margin for the size of the sample is added when
thresholds are compared, and of that ratio the lower end: the least ratio errs upwards, and a prior that is
too high takes junk for good. Nothing is assumed of it, so from few texts it is low.
Known negatives are never used.

Features are shares of bytes and of hashed byte pairs, and measures of a text's shape: length, cases,
digits, marks, repeated words and lines. They are read from the whole text in Arrow batches.

The sample is bounded: about ``POSITIVES`` and ``UNLABELLED`` texts by a hash of the text, copies once.

Defined results: null text is empty; an empty text has the features 0 and is scored like any
other. Without a positive or without an unlabelled text the score is the prior 0.5 for all. Repeated
rows get equal scores. An empty table gives an empty table. Columns of the input named
``score`` are replaced, all others pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newslens.llm.arrays import lowered, pieces, rows_of, runs, string_buffer, word_hashes, words
from newslens.llm.common import or_empty

POSITIVES, UNLABELLED = 6_000, 10_000
PAIRS = 1024
SHAPES = 16
WIDTH = 256 + PAIRS + SHAPES
ROUNDS, BATCH, RATE = 40, 512, 0.02
#: The penalty on the squared weights, divided by the number of unlabelled texts.
PENALTY = 80.0


def features(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """(text, feature) of UTF-8 texts that lie end to end."""
    rows = len(offsets) - 1
    size = np.diff(offsets)
    out = np.zeros((rows, WIDTH), dtype=np.float32)
    if not len(data):
        return out
    row = np.repeat(np.arange(rows), size)
    shares = np.bincount(row * 256 + data, minlength=rows * 256).reshape(rows, 256)
    n = np.maximum(size, 1)[:, None]
    out[:, :256] = np.sqrt(shares / n)
    pair = (data[:-1].astype(np.int64) * 31 + data[1:] * 7) % PAIRS
    within = row[:-1] == row[1:]
    pairs = np.bincount((row[:-1] * PAIRS + pair)[within], minlength=rows * PAIRS).reshape(rows, PAIRS)
    out[:, 256 : 256 + PAIRS] = np.sqrt(pairs / n)

    low = lowered(data)
    starts, ends = words(data, offsets)
    owner = rows_of(starts, offsets)
    count = np.bincount(owner, minlength=rows)
    hashes = word_hashes(low, starts, ends)
    l_starts, l_ends = runs(data != 10, offsets)
    l_owner = rows_of(l_starts, offsets)
    lines = np.bincount(l_owner, minlength=rows)
    l_hashes = word_hashes(data, l_starts, l_ends)
    triples = hashes[:-2] * np.uint64(3) + hashes[1:-1] * np.uint64(5) + hashes[2:] * np.uint64(7)
    t_owner = np.where(owner[:-2] == owner[2:], owner[:-2], rows)[: max(0, len(owner) - 2)]
    t_all = np.bincount(t_owner, minlength=rows + 1)[:rows]
    kinds = _distinct(owner, hashes, rows) / np.maximum(count, 1)
    phrases = _distinct(t_owner, triples, rows + 1)[:rows] / np.maximum(t_all, 1)
    letter = ((low >= 97) & (low <= 122)) | (data >= 128)
    spelled = np.concatenate([[0], np.cumsum(letter)])
    bare = spelled[ends] == spelled[starts]
    last = data[np.maximum(ends - 1, 0)]
    marked = ~(((last | 32) >= 97) & ((last | 32) <= 122)) & (last < 128)
    upper = (data >= 65) & (data <= 90)
    shape = [
        np.log1p(size) / 10.0,
        np.log1p(count) / 8.0,
        np.log1p(lines) / 6.0,
        size / np.maximum(count, 1) / 20.0,
        count / np.maximum(lines, 1) / 100.0,
        kinds,
        phrases,
        -np.log(kinds + 0.02),
        -np.log(phrases + 0.02),
        np.bincount(owner, weights=bare, minlength=rows) / np.maximum(count, 1),
        np.sqrt(np.bincount(owner, weights=bare, minlength=rows) / np.maximum(count, 1)),
        _distinct(l_owner, l_hashes, rows) / np.maximum(lines, 1),
        np.bincount(owner, weights=marked, minlength=rows) / np.maximum(count, 1),
        np.bincount(row, weights=upper, minlength=rows) / n[:, 0],
        np.bincount(row, weights=(data >= 48) & (data <= 57), minlength=rows) / n[:, 0],
        np.bincount(row, weights=data >= 128, minlength=rows) / n[:, 0],
    ]
    out[:, 256 + PAIRS :] = np.minimum(np.stack(shape, axis=1), 5.0)
    out[size == 0] = 0.0
    return out


def _distinct(owner: np.ndarray, values: np.ndarray, rows: int) -> np.ndarray:
    """Number of distinct values of each owner."""
    if not len(owner):
        return np.zeros(rows)
    order = np.lexsort((values, owner))
    o, v = owner[order], values[order]
    first = np.ones(len(o), dtype=bool)
    first[1:] = (o[1:] != o[:-1]) | (v[1:] != v[:-1])
    return np.bincount(o[first], minlength=rows)


@dataclass
class Classifier:
    weights: np.ndarray
    bias: float
    mean: np.ndarray
    scale: np.ndarray
    prior: float

    def score(self, x: np.ndarray) -> np.ndarray:
        # summed row by row: a matrix product would round by the number of rows
        return _sigmoid((((x - self.mean) / self.scale) * self.weights).sum(axis=1) + self.bias)


def _sigmoid(z: np.ndarray) -> np.ndarray:
    return 1.0 / (1.0 + np.exp(-np.clip(z, -60, 60)))


def slopes(zp: np.ndarray, zu: np.ndarray, prior: float | None) -> tuple[np.ndarray, np.ndarray]:
    """Slopes of the risk by the margins of positive and of unlabelled texts: of all of it, or, where the risk of
    negatives is below zero, of that term alone, turned round. Without a prior those of the logistic loss."""
    sp, su = _sigmoid(zp), _sigmoid(zu)
    # logistic loss: log(1+exp(-z)) for +, log(1+exp(z)) for -
    if prior is None:
        return (sp - 1.0) / len(zp), su / len(zu)
    negative = np.logaddexp(0, zu).mean() - prior * np.logaddexp(0, zp).mean()
    if negative >= 0:
        return prior * (sp - 1.0) / len(zp) - prior * sp / len(zp), su / len(zu)
    return prior * sp / len(zp), -su / len(zu)


def _fit(p: np.ndarray, u: np.ndarray, prior: float | None, seed: int) -> tuple[np.ndarray, float]:
    """Weights by Adam; without a prior, plain logistic regression of positive against unlabelled."""
    rng = np.random.default_rng(seed)
    w, b = np.zeros(p.shape[1]), 0.0
    m, v = np.zeros(len(w) + 1), np.zeros(len(w) + 1)
    step, decay = 0, PENALTY / len(u)
    size_p, size_u = min(BATCH, len(p)), min(2 * BATCH, len(u))
    per_round = max(1, len(u) // size_u)
    for _ in range(ROUNDS):
        for _ in range(per_round):
            x = p[rng.integers(0, len(p), size_p)]
            y = u[rng.integers(0, len(u), size_u)]
            zp, zu = x @ w + b, y @ w + b
            gp, gu = slopes(zp, zu, prior)
            grad = np.concatenate([x.T @ gp + y.T @ gu + decay * w, [gp.sum() + gu.sum()]])
            step += 1
            m = 0.9 * m + 0.1 * grad
            v = 0.999 * v + 0.001 * grad * grad
            move = RATE * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
            w, b = w - move[:-1], b - move[-1]
    return w, b


def class_prior(p: np.ndarray, u: np.ndarray, confidence: float = 0.1, doubt: float = 0.25) -> float:
    """Least ratio of the shares above a threshold, of unlabelled to positive scores, at its lower end: each share
    is off by as much as it is with a chance of ``doubt`` at most (Hoeffding)."""
    cuts = np.unique(np.quantile(p, np.linspace(0.02, 0.98, 97)))
    qp = np.array([(p >= c).mean() for c in cuts])
    qu = np.array([(u >= c).mean() for c in cuts])
    off = lambda chance, n: np.sqrt(np.log(1 / chance) / (2 * n))
    margin = off(confidence / 4, len(u)) + off(confidence / 4, len(p))
    best = np.argmin((qu + margin) / np.maximum(qp, 1e-9))
    return float(np.clip((qu[best] - off(doubt, len(u))) / (qp[best] + off(doubt, len(p))), 0.02, 0.98))


def train(p: np.ndarray, u: np.ndarray, seed: int = 17) -> Classifier:
    """A classifier from the features of positive and of unlabelled texts."""
    width = WIDTH if not len(p) else p.shape[1]
    if not len(p) or not len(u):
        return Classifier(np.zeros(width), 0.0, np.zeros(width), np.ones(width), 0.5)
    mean = u.mean(axis=0)
    scale = u.std(axis=0) + 0.02
    p, u = (p - mean) / scale, (u - mean) / scale
    # one half for the plain model, the other for the prior; a single text is both
    w, b = _fit(p[::2], u[::2], None, seed)
    prior = class_prior(_sigmoid(p[len(p) > 1 :: 2] @ w + b), _sigmoid(u[len(u) > 1 :: 2] @ w + b))
    w, b = _fit(p, u, prior, seed + 1)
    return Classifier(w, b, mean, scale, prior)


def _feature_rows(rows: DataFrame) -> DataFrame:
    """(x: binary float32 features) of a column ``text``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = string_buffer(batch.column(0))
            for start, end in pieces(offsets):
                at = offsets[start : end + 1]
                x = features(data[at[0] : at[-1]], at - at[0])
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in x], pa.binary())], names=["x"])

    return rows.mapInArrow(run, "x binary")


def _drawn(texts: DataFrame, rows: int, seed: int) -> np.ndarray:
    """Features of about ``rows`` distinct texts, drawn by a hash of the text."""
    n = texts.count()
    if not n:
        return np.zeros((0, WIDTH), dtype=np.float32)
    draw = F.pmod(F.xxhash64(F.lit(seed), "text"), F.lit(1 << 40)) / float(1 << 40)
    found = _feature_rows(texts.filter(draw < min(1.0, rows / n)).dropDuplicates(["text"])).toArrow()
    column = found.column(0).to_pylist()
    return np.stack([np.frombuffer(x, np.float32) for x in sorted(column)]) if column else np.zeros((0, WIDTH), np.float32)


def learn(positive: DataFrame, unlabelled: DataFrame, text: str = "text", seed: int = 17) -> Classifier:
    """Train on trusted positive and unlabelled texts, at most about the sample's bounds of each."""
    p = _drawn(positive.select(or_empty(text).alias("text")), POSITIVES, seed)
    u = _drawn(unlabelled.select(or_empty(text).alias("text")), UNLABELLED, seed + 1)
    return train(p, u, seed)


def score(docs: DataFrame, model: Classifier, text: str = "text") -> DataFrame:
    """Adds ``score``: the probability that a text is of good quality."""
    parts = docs.sparkSession.sparkContext.broadcast(model.__dict__)
    kept = [c for c in docs.columns if c.lower() != "score"]
    rows = docs.select(*kept, F.col(text).alias("_seen"))
    schema = T.StructType([*docs.select(*kept).schema.fields, T.StructField("score", T.DoubleType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = Classifier(**parts.value)
        for batch in batches:
            data, offsets = string_buffer(batch.column(batch.num_columns - 1))
            others = [batch.column(k) for k in range(batch.num_columns - 1)]
            for start, end in pieces(offsets):
                at = offsets[start : end + 1]
                found = own.score(features(data[at[0] : at[-1]], at - at[0]))
                columns = [c.slice(start, end - start) for c in others]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(found, pa.float64())], names=[*kept, "score"])

    return rows.mapInArrow(run, schema)
