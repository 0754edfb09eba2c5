"""Hard-negative mining by rotated one-bit codes.

Vectors hold whole numbers; a row's score is its inner product with the anchor. An anchor's positives are
the ``positives`` best other rows of its label; for each of them, the ``negatives`` best rows of other labels
whose score lies between two percentages of the positive's are its hard negatives. Higher scores come
first, ties by smaller id.

Each vector is turned by a random rotation (sign flips and Hadamard transforms), and only the signs are
kept: a one-bit code. With it is stored the alignment ``a``, the cosine between vector and code. The vector is
then its length times ``a`` along the code, plus a residual of known length at right angles to it.
The residual gets a code of its own by another rotation, and so on ``STAGES`` times; each leaves about 0.6 of the length. For
a query ``q`` in ``PLANES`` bit planes, popcounts of codes and planes give its parts along the codes, up to
a known rounding error. By Cauchy and Schwarz the last residual ``r`` adds at most ``|r| * sqrt(|q|^2 - m^2)``, where ``m`` is
the part of ``q`` along the last code. The interval so found always holds the score, so a row
is dropped only if it cannot count: below the k-th largest lower bound, or outside the band. Rows that are left are
scored exactly, in whole numbers. The result is the one of scoring all pairs.

The anchors, a stated query set, meet all rows in blocks (``ROWS`` by ``ANCHORS``); a pair of blocks sends on at most k rows for
each anchor, which windows with a group limit merge. Labels and equal vectors may be as frequent as they
like: blocks are dealt by a hash of the whole row.

Defined results: rows with a null id, label or vector, or with a null or infinite component or NaN, take no
part. Rows that agree in id, label and vector are one row; rows that agree in the id only are different rows, ordered by a
hash of the row. Only vectors of equal length are compared. A positive with a negative score has no
negatives. Scores beyond a long are cut to its range. An empty table gives an empty table. Other
columns are not read, so their names cannot clash.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm.blocks import block_count, each_with_each, whole_vector
from newslens.llm.common import written

ROWS, ANCHORS = 4096, 2048  # rows of a block, anchors of a block
STAGES, PLANES, ROUNDS = 6, 7, 3
CELLS = 1 << 16  # pairs estimated at once
SLACK = 1e-9  # of |v| |q|, for the rounding of doubles
EXACT = 2**53


def _signs(size: int, stage: int, store: dict = {}) -> np.ndarray:  # noqa: B006  kept for the worker's life
    if (size, stage) not in store:
        store[size, stage] = np.random.default_rng([17, size, stage]).integers(0, 2, (ROUNDS, size)) * 2.0 - 1.0
    return store[size, stage]


def code_size(dims: int) -> int:
    return max(64, 1 << max(0, dims - 1).bit_length())


def _matrix(size: int, store: dict = {}) -> np.ndarray:  # noqa: B006  kept as above
    if size not in store:
        k = np.arange(size, dtype=np.uint64)
        store[size] = 1.0 - 2.0 * (np.bitwise_count(k[:, None] & k) % 2)
    return store[size]


def _hadamard(x: np.ndarray) -> np.ndarray:
    """The transform of each row, 64 coordinates at a time."""
    rows, n = x.shape
    width = 1
    while width < n:
        m = min(64, n // width)
        if width == 1:
            x = x.reshape(-1, m) @ _matrix(m)
        else:
            x = _matrix(m) @ x.reshape(rows, n // (m * width), m, width)
        width *= m
    return x.reshape(rows, n) / np.sqrt(n)


def rotate(vectors: np.ndarray, stage: int) -> np.ndarray:
    """Each row in ``code_size`` coordinates; lengths and inner products stay."""
    rows, dims = vectors.shape
    size = code_size(dims)
    x = np.zeros((rows, size))
    x[:, :dims] = vectors
    for signs in _signs(size, stage):
        x = _hadamard(x * signs)
    return x


def back(x: np.ndarray, dims: int, stage: int) -> np.ndarray:
    """The transpose of ``rotate``."""
    for signs in _signs(x.shape[1], stage)[::-1]:
        x = _hadamard(x) * signs
    return x[:, :dims]


def _packed(bits: np.ndarray) -> np.ndarray:
    return np.packbits(bits, axis=1, bitorder="little").view("<u8")


def encode(vectors: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(code words by stage, length, alignments, code lengths) of each row."""
    rest, words, aligned, lengths = vectors.astype(float), [], [], []
    for stage in range(STAGES):
        bits = rotate(rest, stage) >= 0
        code = back(bits * 2.0 - 1.0, vectors.shape[1], stage)
        length = np.linalg.norm(code, axis=1)
        direction = code / np.where(length > 0, length, 1.0)[:, None]
        size = np.linalg.norm(rest, axis=1)
        along = np.einsum("ij,ij->i", rest, direction)
        words.append(_packed(bits))
        aligned.append(np.clip(along / np.where(size > 0, size, 1.0), -1.0, 1.0))
        lengths.append(np.where(length > 0, length, 1.0))
        rest = rest - along[:, None] * direction
    return np.stack(words, axis=1), np.linalg.norm(vectors, axis=1), np.stack(aligned, axis=1), np.stack(lengths, axis=1)


class Codes:
    """The codes of a block, by stage and word, with what their intervals need."""

    def __init__(self, words: np.ndarray, length: np.ndarray, aligned: np.ndarray, lengths: np.ndarray):
        self.words = np.ascontiguousarray(words.transpose(1, 2, 0))
        self.ones = np.bitwise_count(self.words).sum(axis=1, dtype=np.int64)
        self.length, self.lengths = length, lengths.T
        across = np.cumprod(np.sqrt(np.maximum(0.0, 1.0 - aligned * aligned)), axis=1).T
        before = np.concatenate([np.ones((1, len(length))), across[:-1]])
        self.along, self.rest = length * before * aligned.T, length * across[-1]

    def intervals(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(lower, upper) bound of the inner product of each query with each row."""
        shape = len(queries), len(self.length)
        size = np.linalg.norm(queries, axis=1)[:, None]
        middle = np.zeros(shape)
        for_rows, of_queries, errors = [], [], []
        for stage, words in enumerate(self.words):
            turned = rotate(queries, stage)
            low, high = turned.min(axis=1, keepdims=True), turned.max(axis=1, keepdims=True)
            step = np.maximum((high - low) / (2**PLANES - 1), np.finfo(float).tiny)
            whole = np.rint((turned - low) / step).astype(np.int64)
            errors.append(np.abs(turned - low - whole * step).sum(axis=1))
            # code . query = 2 step counts + 2 low ones - sum of the rounded query
            part = np.multiply(_weighed(words, whole), 1.0 / self.lengths[stage])
            part *= 2.0 * step
            known = np.concatenate([2.0 * low, -(low + whole * step).sum(axis=1, keepdims=True)], axis=1)
            if stage == STAGES - 1:
                last = part + known @ (np.stack([self.ones[stage], np.ones(shape[1])]) / self.lengths[stage])
            part *= self.along[stage]
            middle += part
            of_queries.append(known)
            for_rows.append(np.stack([self.ones[stage], np.ones(shape[1])]) * (self.along[stage] / self.lengths[stage]))
        middle += np.concatenate(of_queries, axis=1) @ np.concatenate(for_rows)
        off = errors[-1][:, None] / self.lengths[-1]
        wide = self.rest * np.sqrt(np.maximum(0.0, size * size - np.square(np.maximum(0.0, np.abs(last) - off))))
        wide += np.stack(errors, axis=1) @ np.abs(self.along / self.lengths)
        wide += SLACK * size * self.length
        return middle - wide, middle + wide


def _weighed(words: np.ndarray, whole: np.ndarray) -> np.ndarray:
    """For each query and row: the sum of the query's whole numbers where the row's code has a one, by popcounts."""
    kind = np.int16 if 64 * len(words) * 2**PLANES < 2**15 else np.int64
    counts = np.zeros((len(whole), words.shape[1]), dtype=kind)
    both, ones = np.empty(counts.shape, dtype="<u8"), np.empty(counts.shape, dtype=np.uint8)
    for plane in reversed(range(PLANES)):
        bits = _packed((whole >> plane & 1).astype(bool))
        np.left_shift(counts, 1, out=counts)
        for k, row in enumerate(words):
            np.bitwise_and(row, bits[:, k, None], out=both)
            np.bitwise_count(both, out=ones)
            np.add(counts, ones, out=counts)
    return counts


def scores(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact inner products of rows of whole numbers, as int64; beyond its range they are cut to it."""
    top = lambda x: float(np.abs(x).max(initial=0.0))
    if top(left) * top(right) * max(1, left.shape[1]) < EXACT:
        return np.einsum("ij,ij->i", left, right).astype(np.int64)
    most = 2**63 - 1
    sums = (sum(int(a) * int(b) for a, b in zip(x, y)) for x, y in zip(left.tolist(), right.tolist()))
    return np.array([max(-most - 1, min(most, s)) for s in sums], dtype=np.int64)


def _first(k: int, group: np.ndarray, score: np.ndarray, id: np.ndarray, key: np.ndarray) -> np.ndarray:
    """The k best of each group: by score down, then id, then key."""
    order = np.lexsort((key, id, ~score, group))
    g = group[order]
    starts = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]])) if len(g) else np.zeros(0, int)
    rank = np.arange(len(g)) - np.repeat(starts, np.diff(np.append(starts, len(g))))
    return order[rank < k]


def _kth(values: np.ndarray, k: int) -> np.ndarray:
    """The k-th largest of each row, -inf if there are fewer."""
    if values.shape[1] < k:
        return np.full(len(values), -np.inf)
    return np.partition(values, -k, axis=1)[:, -k]


class Block:
    """Rows of one vector length as arrays."""

    def __init__(self, table: pa.Table, dims: int):
        rows = table.filter(pc.equal(table.column("dims"), dims))
        self.rows = rows
        self.n, self.dims = rows.num_rows, dims
        column = lambda name: rows.column(name).to_numpy()
        self.id, self.key, self.label = column("id"), column("key"), column("label")
        joined = lambda name, kind, *shape: np.frombuffer(b"".join(rows.column(name).to_pylist()), kind).reshape(self.n, *shape)
        self.vectors = joined("vector", "<f8", dims)
        self.words = joined("code", "<u8", STAGES, code_size(dims) // 64)
        self.aligned, self.lengths = joined("aligned", "<f8", STAGES), joined("lengths", "<f8", STAGES)
        self.length = column("length")

    def codes(self, part: np.ndarray | slice = slice(None)) -> Codes:
        return Codes(self.words[part], self.length[part], self.aligned[part], self.lengths[part])


def _shared(left: pa.Table, right: pa.Table) -> Iterator[tuple[Block, Block]]:
    both = set(left.column("dims").to_pylist()) & set(right.column("dims").to_pylist())
    for dims in sorted(both):
        yield Block(left, dims), Block(right, dims)


def _chunks(n: int, width: int) -> Iterator[slice]:
    step = max(1, CELLS // max(1, width))
    for i in range(0, n, step):
        yield slice(i, i + step)


_POSITIVE = "anchor long, anchor_key long, id long, key long, score long"
_NEGATIVE = "anchor long, anchor_key long, place int, positive long, positive_score long, id long, key long, score long"


def _table(names: str, columns: list[list[np.ndarray]]) -> pa.Table:
    kinds = {"long": pa.int64(), "int": pa.int32()}
    fields = [f.split() for f in names.split(", ")]
    joined = [np.concatenate(c) if c else np.zeros(0, np.int64) for c in columns] or [np.zeros(0, np.int64)] * len(fields)
    return pa.table({n: pa.array(c, kinds[k]) for (n, k), c in zip(fields, joined)})


def _positives(k: int):
    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [[] for _ in range(5)]
        for anchors, rows in _shared(left, right):
            for label in np.intersect1d(anchors.label, rows.label):
                mine, other = np.flatnonzero(anchors.label == label), np.flatnonzero(rows.label == label)
                codes = rows.codes(other)
                for part in _chunks(len(mine), len(other)):
                    a = mine[part]
                    lower, upper = codes.intervals(anchors.vectors[a])
                    itself = (anchors.id[a][:, None] == rows.id[other]) & (anchors.key[a][:, None] == rows.key[other])
                    lower[itself] = -np.inf
                    i, j = np.nonzero((upper >= _kth(lower, k)[:, None]) & ~itself)
                    i, j = a[i], other[j]
                    score = scores(anchors.vectors[i], rows.vectors[j])
                    best = _first(k, i, score, rows.id[j], rows.key[j])
                    i, j = i[best], j[best]
                    for out, values in zip(found, (anchors.id[i], anchors.key[i], rows.id[j], rows.key[j], score[best])):
                        out.append(values)
        return _table(_POSITIVE, found)

    return step


def _may_count(i: np.ndarray, lower: np.ndarray, upper: np.ndarray, least: np.ndarray, most: np.ndarray, k: int) -> np.ndarray:
    """Which intervals may hold one of the k best scores from ``least`` to ``most`` (by anchor ``i``)."""
    low, high = _rounded(least, -1)[i], _rounded(most, 1)[i]
    sure = np.flatnonzero((lower >= _rounded(least, 1)[i]) & (upper <= _rounded(most, -1)[i]))
    sure = sure[np.lexsort((-lower[sure], i[sure]))]
    kth = np.full(len(least), -np.inf)
    if len(sure) >= k:
        same = i[sure[k - 1 :]] == i[sure[: len(sure) - k + 1]]
        # the first such place of each anchor is its k-th best; later ones are lower
        np.maximum.at(kth, i[sure[k - 1 :]][same], lower[sure[k - 1 :]][same])
    return (lower <= high) & (upper >= np.maximum(low, kth[i]))


def _rounded(bound: np.ndarray, way: int) -> np.ndarray:
    """The bound in doubles, moved by more than its rounding."""
    return bound.astype(float) + way * 1e-12 * np.abs(bound.astype(float))


def _negatives(k: int, low: int, high: int):
    def step(left: pa.Table, right: pa.Table) -> pa.Table:
        found = [[] for _ in range(8)]
        for anchors, rows in _shared(left, right):
            codes, bands = rows.codes(), []
            low_end, high_end = np.full(anchors.n, np.inf), np.full(anchors.n, -np.inf)
            lists = anchors.rows.column("positives").to_pylist()
            for place in range(max(map(len, lists))):
                has = np.array([len(p) > place for p in lists])
                positive, value = (
                    np.array([p[place][c] if len(p) > place else 0 for p in lists], dtype=np.int64) for c in ("id", "score")
                )
                parts = [int(v) for v in value]
                least = np.array([-(-low * v // 100) for v in parts], dtype=np.int64)
                most = np.array([high * v // 100 for v in parts], dtype=np.int64)
                has &= least <= most
                bands.append((place, has, positive, value, least, most))
                low_end[has] = np.minimum(low_end[has], _rounded(least, -1)[has])
                high_end[has] = np.maximum(high_end[has], _rounded(most, 1)[has])
            for part in _chunks(anchors.n, rows.n):
                lower, upper = codes.intervals(anchors.vectors[part])
                i, j = np.nonzero((upper >= low_end[part, None]) & (lower <= high_end[part, None]))
                other = anchors.label[part][i] != rows.label[j]
                i, j = i[other], j[other]
                lower, upper = lower[i, j], upper[i, j]
                i += part.start
                wanted = np.zeros(len(i), dtype=bool)
                for _, has, _, _, least, most in bands:
                    mine = np.flatnonzero(has[i])
                    wanted[mine] |= _may_count(i[mine], lower[mine], upper[mine], least, most, k)
                i, j = i[wanted], j[wanted]
                score = scores(anchors.vectors[i], rows.vectors[j])
                for place, has, positive, value, least, most in bands:
                    inside = np.flatnonzero(has[i] & (score >= least[i]) & (score <= most[i]))
                    best = inside[_first(k, i[inside], score[inside], rows.id[j[inside]], rows.key[j[inside]])]
                    a, r = i[best], j[best]
                    columns = (
                        anchors.id[a], anchors.key[a], np.full(len(a), place, np.int32), positive[a],
                        value[a], rows.id[r], rows.key[r], score[best],
                    )
                    for out, values in zip(found, columns):
                        out.append(values)
        return _table(_NEGATIVE, found)

    return step


_CODED = "id long, key long, label long, anchor boolean, dims int, vector binary, code binary, length double, aligned binary, lengths binary"


def _coded(rows: DataFrame) -> DataFrame:
    """Rows (id, key, label, anchor, vector) with their codes; the vector as bytes of doubles."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            sizes = pc.list_value_length(vectors).to_numpy(zero_copy_only=False)
            for dims in np.unique(sizes):
                which = pa.array(np.flatnonzero(sizes == dims))
                part, n = batch.take(which), len(which)
                values = part.column("vector").flatten().to_numpy(zero_copy_only=False).astype("<f8").reshape(n, dims)
                words, length, aligned, lengths = encode(values)
                as_bytes = lambda x: pa.array([r.tobytes() for r in x], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("id", "key", "label", "anchor")), pa.array(np.full(n, dims, np.int32)),
                     as_bytes(values), as_bytes(words), pa.array(length), as_bytes(aligned), as_bytes(lengths)],
                    names=[f.split()[0] for f in _CODED.split(", ")],
                )

    return rows.mapInArrow(step, _CODED)


def hard_negatives(
    rows: DataFrame, anchors: str | Column, id: str = "vec_id", vector: str = "vector", label: str = "label",
    positives: int = 5, negatives: int = 3, low: int = 50, high: int = 95,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score, positive_rank).

    ``anchors`` is a condition on ``rows``; ``low`` and ``high`` are percentages of the positive's score.
    """
    condition = F.expr(anchors) if isinstance(anchors, str) else anchors
    name = lambda c: F.col(f"`{c}`")
    used = rows.filter(name(id).isNotNull() & name(label).isNotNull() & whole_vector(vector)).select(
        name(id).cast("long").alias("id"), name(label).cast("long").alias("label"),
        name(vector).cast("array<double>").alias("vector"), F.coalesce(condition, F.lit(False)).alias("anchor"),
    )
    used = used.dropDuplicates(["id", "label", "vector"]).withColumn("key", F.xxhash64("id", "label", "vector"))
    coded = written(_coded(used.select("id", "key", "label", "anchor", "vector")), "codes")
    asking = coded.filter("anchor")
    sizes = coded.agg(F.count(F.lit(1)).alias("rows"), F.count_if("anchor").alias("anchors")).first()
    row_blocks, anchor_blocks = block_count(sizes["rows"], ROWS), block_count(sizes["anchors"], ANCHORS)

    def meet(left: DataFrame, step, schema: str) -> DataFrame:
        return each_with_each(left, anchor_blocks, coded, row_blocks, step, schema, ["id", "key"], ["id", "key"])

    def ranked(found: DataFrame, *group: str) -> DataFrame:
        order = Window.partitionBy(*group).orderBy(F.desc("score"), "id", "key")
        return found.withColumn("rank", F.row_number().over(order))

    best = ranked(meet(asking, _positives(positives), _POSITIVE), "anchor", "anchor_key").filter(F.col("rank") <= positives)
    best = best.groupBy(F.col("anchor").alias("id"), F.col("anchor_key").alias("key")).agg(
        F.transform(
            F.sort_array(F.collect_list(F.struct("rank", "id", "score"))), lambda p: F.struct(p["id"].alias("id"), p["score"].alias("score"))
        ).alias("positives")
    )
    asking = written(asking.join(best, ["id", "key"]), "positives")
    found = meet(asking, _negatives(negatives, low, high), _NEGATIVE)
    found = ranked(found, "anchor", "anchor_key", "place").filter(F.col("rank") <= negatives)
    return found.select(
        F.col("anchor").alias("anchor_id"), F.col("positive").alias("positive_id"), "rank",
        F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"),
        (F.col("place") + 1).alias("positive_rank"),
    )
