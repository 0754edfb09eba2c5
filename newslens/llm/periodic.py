"""Periodic runs of words, found by block convolution.

A run is a stretch of words with smallest period ``q`` (words ``q`` apart are equal) of at least
``max(6, 4 * q)`` words that no neighbouring word extends. At each dyadic scale ``B`` a text is cut into
aligned blocks of ``B`` words. A run of period ``q``, ``B <= q < 2 * B``, holds a whole block within its first
``2 * B`` words, and that block comes again ``q`` words later. So for each block the sums of squared
differences to all places at distances ``B`` to ``2 * B - 1`` are taken at once, as a convolution by number-theoretic
transforms of ``2 * B`` integers; a sum of zero is an occurrence, and its distance a seed, which is extended both
ways word by word. The sums are taken modulo primes whose product is over the largest possible sum, so
that zero modulo each means zero: nothing is estimated, and each extension compares words.

A block is transformed only if words of it come again in its window, a necessary condition
read from one sorted index of word places; in ordinary text nearly all blocks end there. Seeds inside a
known run whose period divides their distance belong to that run and are not extended again.

Texts are worked on in Arrow batches, a bounded number of words at a time (a longer text alone). No rows are
shuffled; a hot group of copies is spread as its files are.

Defined results: null text has no words. Empty texts, texts of fewer than six words and texts without
a run have an empty list, and all their words are kept. Texts of any length are read whole; one of 2**25 words
or more is searched for periods under 2**24. Repeated rows get equal results each. An empty table
gives an empty table. Input columns pass through; those named like a result column are replaced.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

LEAST, TIMES = 6, 4  # a run has max(LEAST, TIMES * period) words at least
WORDS = 400_000  # words worked on at once
CELLS = 1 << 20  # numbers of a transform at once
PROBES = 16  # words of a block that are looked up before it is transformed
#: Primes under 2**31 with a generator each; p - 1 is divisible by 2**25 in all of them.
PRIMES = ((2013265921, 31), (469762049, 3), (1811939329, 13), (2113929217, 5))
LONGEST = 1 << 25  # numbers of the longest transform

RUNS = T.ArrayType(
    T.StructType([T.StructField(n, T.LongType(), False) for n in ("start", "length", "period")]), False
)


def _roots(size: int, prime: int, generator: int, store: dict = {}) -> np.ndarray:  # noqa: B006  kept for the worker's life
    """The first half of the powers of a root of unity of this order."""
    key = size, prime, generator
    if key not in store:
        root, powers = pow(generator, (prime - 1) // size, prime), np.ones(1, dtype=np.uint64)
        while len(powers) < size // 2:
            powers = np.concatenate([powers, powers * np.uint64(pow(root, len(powers), prime)) % np.uint64(prime)])
        store[key] = powers[: max(1, size // 2)]
    return store[key]


def _inverse_roots(size: int, prime: int, generator: int) -> np.ndarray:
    return _roots(size, prime, pow(generator, -1, prime))


def transform(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """The transform of each row, in bit-reversed order."""
    p, (m, n) = np.uint64(prime), rows.shape
    out, width = rows, n
    while width > 1:
        half = width // 2
        pair = out.reshape(m, n // width, 2, half)
        first, second = pair[:, :, 0], pair[:, :, 1]
        out = np.empty_like(pair)
        out[:, :, 0] = (first + second) % p
        out[:, :, 1] = (first + (p - second)) % p * _roots(width, prime, generator) % p
        out, width = out.reshape(m, n), half
    return out


def inverse(rows: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """The rows whose ``transform`` is given."""
    p, (m, n) = np.uint64(prime), rows.shape
    out, width = rows, 2
    while width <= n:
        half = width // 2
        pair = out.reshape(m, n // width, 2, half)
        first, second = pair[:, :, 0], pair[:, :, 1] * _inverse_roots(width, prime, generator) % p
        out = np.empty_like(pair)
        out[:, :, 0] = (first + second) % p
        out[:, :, 1] = (first + (p - second)) % p
        out, width = out.reshape(m, n), width * 2
    return out * np.uint64(pow(n, -1, prime)) % p


def squared_differences(block: np.ndarray, window: np.ndarray, prime: int, generator: int) -> np.ndarray:
    """For rows of B and 2 B - 1 numbers: the sum of squared differences at each of B shifts, modulo the prime."""
    p, (m, b) = np.uint64(prime), block.shape
    x = np.zeros((m, 2 * b), dtype=np.uint64)
    x[:, 0] = block[:, 0] % p
    x[:, b + 1 :] = block[:, :0:-1] % p  # reversed, so that the product is a correlation
    y = np.zeros((m, 2 * b), dtype=np.uint64)
    y[:, :-1] = window % p
    product = transform(x, prime, generator) * transform(y, prime, generator) % p
    cross = inverse(product, prime, generator)[:, :b]
    squares = np.zeros((m, 2 * b), dtype=np.uint64)
    np.cumsum(y[:, :-1] * y[:, :-1] % p, axis=1, out=squares[:, 1:])
    whole = (x * x % p).sum(axis=1, keepdims=True) + squares[:, b:] - squares[:, :b]
    return (whole % p + (p - cross) * np.uint64(2)) % p


class Places:
    """Where each word stands, sorted, so that its next place after a given one is a binary search."""

    def __init__(self, ids: np.ndarray):
        self.ids, self.n = ids, len(ids)
        order = np.argsort(ids, kind="stable")
        self.keys = ids[order] * self.n + order

    def again(self, at: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
        """Whether the word at ``at`` also stands in [low, high)."""
        word = self.ids[at] * self.n
        found = np.searchsorted(self.keys, word + low)
        return (found < self.n) & (self.keys[np.minimum(found, self.n - 1)] < word + high)


def seeds(places: Places, starts: np.ndarray, ends: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray]:
    """(place, distance) of each aligned block of ``b`` words that comes again ``b`` to ``2 * b - 1`` words later."""
    ids = places.ids
    long_enough = ends - starts >= max(LEAST, TIMES * b)
    starts, ends = starts[long_enough], ends[long_enough]
    blocks = (ends - starts) // b - 1
    first = np.cumsum(blocks) - blocks
    at = np.repeat(starts - first * b, blocks) + np.arange(blocks.sum()) * b
    end = np.repeat(ends, blocks)
    for probe in range(min(b, PROBES)):
        word = at + (probe * (b // min(b, PROBES)) + b - 1) % b
        again = places.again(word, word + b, np.minimum(word + 2 * b, end))
        at, end = at[again], end[again]
    most = b * max(1, int(ids.max(initial=0))) ** 2
    primes, product = [], 1
    for prime in PRIMES:
        primes.append(prime)
        product *= prime[0]
        if product > most:
            break
    found = []
    step = max(1, CELLS // (2 * b))
    for i in range(0, len(at), step):
        a, e = at[i : i + step], end[i : i + step]
        block = ids[a[:, None] + np.arange(b)].astype(np.uint64)
        shift = np.arange(2 * b - 1) + b
        window = ids[np.minimum(a[:, None] + shift, e[:, None] - 1)].astype(np.uint64)
        row, d = np.nonzero(a[:, None] + shift[None, :b] + b <= e[:, None])
        for prime, generator in primes:
            still = np.unique(row)
            if not len(still):
                break
            sums = squared_differences(block[still], window[still], prime, generator)
            zero = sums[np.searchsorted(still, row), d] == 0
            row, d = row[zero], d[zero]
        found.append((a[row], d + b))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.concatenate(x) for x in zip(*found))


def _forward(ids: np.ndarray, at: int, d: int, end: int) -> int:
    """The first place from ``at`` on whose word differs from the one ``d`` later."""
    step = 64
    while at < end - d:
        stop = min(at + step, end - d)
        same = ids[at:stop] == ids[at + d : stop + d]
        if not same.all():
            return at + int(same.argmin())
        at, step = stop, step * 2
    return at


def _backward(ids: np.ndarray, at: int, d: int, start: int) -> int:
    """The least place down from ``at`` from which on all words equal the ones ``d`` later."""
    step = 64
    while at > start:
        stop = max(at - step, start)
        same = ids[stop:at] == ids[stop + d : at + d]
        if not same.all():
            return at - int(same[::-1].argmin())
        at, step = stop, step * 2
    return at


def find_runs(ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, length, period) of all runs of the texts that lie end to end, by start, then period."""
    ids = ids.astype(np.int64)
    starts, ends = offsets[:-1].astype(np.int64), offsets[1:].astype(np.int64)
    runs, extents = [], set()
    if len(ids) < LEAST:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    places = Places(ids)
    # of the known run over each word that reaches furthest: its end and period
    reach, period = np.zeros(len(ids), np.int64), np.ones(len(ids), np.int64)
    b, longest = 1, int((ends - starts).max())
    while max(LEAST, TIMES * b) <= longest and 2 * b <= LONGEST:
        at, d = seeds(places, starts, ends, b)
        new = ~((at + d <= reach[at]) & (d % period[at] == 0))
        order = np.lexsort((at[new], d[new]))
        at, d = at[new][order], d[new][order]
        heads = np.ones(len(at), dtype=bool)  # the next block of the same stretch is no seed of its own
        heads[1:] = (d[1:] != d[:-1]) | (at[1:] != at[:-1] + b)
        at, d = at[heads], d[heads]
        text = np.searchsorted(starts, at, side="right") - 1
        # empty texts share their start with the next; the last of them is the text itself
        last_d, last_end = -1, -1
        for i, q, begin, end in zip(at.tolist(), d.tolist(), starts[text].tolist(), ends[text].tolist()):
            if q == last_d and i < last_end:
                continue
            low, high = _backward(ids, i, q, begin), _forward(ids, i + b, q, end)
            last_d, last_end = q, high
            high += q
            if high - low >= max(LEAST, TIMES * q) and (low, high) not in extents:
                extents.add((low, high))
                runs.append((low, high - low, q))
                part = reach[low:high]
                period[low:high][part < high] = q
                part[part < high] = high
        b *= 2
    if not runs:
        return tuple(np.zeros(0, np.int64) for _ in range(3))
    start, length, q = np.array(sorted(runs, key=lambda r: (r[0], r[2])), dtype=np.int64).T
    return start, length, q


def _collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words that are no repetition of a run's first period, joined by one space."""
    if runs:
        kept = np.ones(len(words), dtype=bool)
        for start, length, period in runs:
            kept[start + period : start + length] = False
        words = [words[i] for i in np.flatnonzero(kept)]
    return b" ".join(words)


def _piece(texts: list[list[bytes]]) -> Iterator[tuple[list[tuple[int, int, int]], bytes]]:
    flat = [w for words in texts for w in words]
    offsets = np.cumsum([0, *map(len, texts)])
    ids = pa.array(flat, pa.large_binary()).dictionary_encode().indices.to_numpy()
    found = find_runs(ids, offsets)
    text = np.searchsorted(offsets, found[0], side="right") - 1
    upto = np.searchsorted(text, np.arange(len(texts) + 1))
    for k, words in enumerate(texts):
        part = slice(upto[k], upto[k + 1])
        runs = list(zip((found[0][part] - offsets[k]).tolist(), found[1][part].tolist(), found[2][part].tolist()))
        yield runs, _collapsed(words, runs)


def _rows(texts: pa.Array) -> Iterator[tuple[int, list, bytes]]:
    waiting, size = [], 0
    for text in texts:
        words = (text.as_py() or b"").split()  # of bytes: at [\x20\x09-\x0D] only
        waiting.append(words)
        size += len(words)
        if size >= WORDS:
            for words, (runs, kept) in zip(waiting, _piece(waiting)):
                yield len(words), runs, kept
            waiting, size = [], 0
    for words, (runs, kept) in zip(waiting, _piece(waiting)):
        yield len(words), runs, kept


def with_runs(docs: DataFrame, text: str = "text", words: str = "n_words", runs: str = "runs", collapsed: str = "collapsed") -> DataFrame:
    """``docs`` with the number of words, the runs by start and period, and the text without their repetitions."""
    rest = [c for c in docs.columns if c not in (words, runs, collapsed)]
    named = [F.col(f"`{c}`") for c in rest]
    read = docs.select(F.struct(*named).alias("row"), F.col(f"`{text}`").cast("binary").alias("text"))
    schema = T.StructType([
        read.schema["row"],
        T.StructField("words", T.LongType(), False),
        T.StructField("runs", RUNS, False),
        T.StructField("collapsed", T.StringType(), False),
    ])
    of_run = pa.list_(pa.struct([pa.field(n, pa.int64(), False) for n in ("start", "length", "period")]))

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = list(_rows(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("row"),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([[dict(zip(("start", "length", "period"), r)) for r in f[1]] for f in found], of_run),
                    pa.array([f[2] for f in found], pa.binary()).cast(pa.string()),
                ],
                names=["row", "words", "runs", "collapsed"],
            )

    made = read.mapInArrow(step, schema)
    return made.select(
        *[F.col(f"row.`{c}`") for c in rest],
        F.col("words").alias(words), F.col("runs").alias(runs), F.col("collapsed").alias(collapsed),
    )


def best_run(runs: str):
    """The run with the greatest length / period, compared as whole numbers; the first of equal ones; null if none."""
    better = lambda a, x: x["length"] * a["period"] > a["length"] * x["period"]
    return F.when(
        F.size(runs) > 0,
        F.aggregate(runs, F.col(runs)[0], lambda a, x: F.when(better(a, x), x).otherwise(a)),
    )
