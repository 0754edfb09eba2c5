"""Packing into length buckets with the least padding, then into batches by token budget.

A dynamic program over the global histogram of lengths picks the bucket bounds; inside each
bucket rows are dealt in seeded order into batches of ``budget // bound`` rows, at least one.

The histogram is the only thing that reaches the driver. Its cells are exact up to
``EXACT`` tokens and then as fine as 1/``EXACT`` of the length (rounded up to the cell's
end), so it has at most ``EXACT`` * 53 cells whatever the corpus; the bounds are optimal on these cells.
No bucket is gathered: it is dealt into slices of about ``SLICE_ROWS`` rows by a hash, rows are
numbered inside their slice, and the slices' sizes give where each slice starts.

Defined results: null text is empty and has 0 tokens; it takes a slot of the shortest bucket.
A row longer than the budget is whole in a batch of its own. Repeated rows each take a slot. An
empty table gives an empty table. Only the id and the text (or the length) are read, so names of
other columns cannot clash; the id may be null. Rows of one id spread by their texts.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newslens.llm.common import or_empty, word_count, written

EXACT = 4096
SLICE_ROWS = 50_000


def cell(n: Column) -> Column:
    """The end of the histogram cell of a length."""
    step = F.greatest(F.lit(1.0), F.pow(2.0, F.floor(F.log2(F.greatest(n, F.lit(1)))) - 11))
    return F.when(n <= EXACT, n).otherwise((F.ceil(n / step) * step).cast("bigint"))


def best_bounds(lengths: list[int], counts: list[int], buckets: int) -> list[int]:
    """Upper bounds of at most ``buckets`` buckets with the least total padding.

    The cost of one bucket over cells i..j is len_j * rows - tokens. It meets the quadrangle
    inequality, so the best last cut moves right with j and each layer is solved by halving.
    """
    order = np.argsort(lengths)
    size = np.asarray(lengths, dtype=np.float64)[order]
    rows = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64)[order])])
    tokens = np.concatenate([[0.0], np.cumsum(np.asarray(counts, dtype=np.float64)[order] * size)])
    n = len(size)
    if not n:
        return []
    best = np.concatenate([[0.0], size * rows[1:] - tokens[1:]])  # one bucket for the first j cells
    cuts = []
    for _ in range(1, min(buckets, n)):
        layer, cut = np.full(n + 1, np.inf), np.zeros(n + 1, dtype=np.int64)
        layer[0] = 0.0
        todo = [(1, n, 0, n - 1)]
        while todo:
            low, high, first, last = todo.pop()
            if low > high:
                continue
            j = (low + high) // 2
            i = np.arange(first, min(j - 1, last) + 1)
            cost = best[i] + size[j - 1] * (rows[j] - rows[i]) - (tokens[j] - tokens[i])
            k = int(np.argmin(cost))
            layer[j], cut[j] = cost[k], i[k]
            todo += [(low, j - 1, first, int(i[k])), (j + 1, high, int(i[k]), last)]
        cuts.append(cut)
        best = layer
    bounds, j = [], n
    for cut in reversed(cuts):
        if j == 0:
            break
        bounds.append(int(size[j - 1]))
        j = int(cut[j])
    if j:
        bounds.append(int(size[j - 1]))
    return sorted(set(bounds))


def pack(
    docs: DataFrame,
    id: str = "doc_id",
    tokens: Column | None = None,
    buckets: int = 16,
    budget: int = 16_384,
    seed: int = 17,
    text: str = "text",
) -> DataFrame:
    """(id, n_tokens, bucket, bucket_tokens, batch, slot, batch_rows) for every row.

    ``batch`` counts from 0 inside its bucket; each row of a batch is padded to
    ``bucket_tokens``. ``tokens`` gives the length of a row, by default its words.
    """
    length = word_count(or_empty(text)) if tokens is None else F.coalesce(tokens.cast("bigint"), F.lit(0))
    salt = F.xxhash64(or_empty(text)) if text in docs.columns else F.lit(0).cast("bigint")
    rows = docs.select(F.col(id).alias("id"), length.alias("n_tokens"), salt.alias("salt"))
    rows = written(rows, "lengths")
    rows = rows.withColumn("cell", cell(F.col("n_tokens")))
    histogram = rows.groupBy("cell").count().collect()  # bounded: see above
    cells = sorted((r["cell"], r["count"]) for r in histogram)
    bounds = best_bounds([c for c, _ in cells], [n for _, n in cells], buckets) or [0]
    held = [sum(n for c, n in cells if low < c <= high) for low, high in zip([-1, *bounds], bounds)]

    def by_bucket(values: list[int]) -> Column:
        return F.element_at(F.array(*[F.lit(int(v)) for v in values]), F.col("bucket") + 1)

    bucket = F.lit(0)
    for k, bound in enumerate(bounds[:-1]):
        bucket = F.when(F.col("cell") > bound, k + 1).otherwise(bucket)
    mixed = F.xxhash64(F.lit(seed), "id", "n_tokens", "salt")
    rows = rows.withColumn("bucket", bucket).withColumn("mixed", mixed)
    slices = by_bucket([-(-n // SLICE_ROWS) or 1 for n in held])
    # the high bits choose the slice, the whole hash the order inside it
    rows = rows.withColumn("slice", F.pmod(F.shiftrightunsigned("mixed", 20), slices))
    sizes = rows.groupBy("bucket", "slice").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("bucket").orderBy("slice")
    starts = sizes.select("bucket", "slice", (F.sum("n").over(before) - F.col("n")).alias("start"))
    inside = Window.partitionBy("bucket", "slice").orderBy("mixed", "id", "n_tokens", "salt")
    placed = rows.withColumn("place", F.row_number().over(inside) - 1).join(starts, ["bucket", "slice"])
    place = (F.col("start") + F.col("place")).cast("bigint")
    fit = by_bucket([max(1, budget // max(1, bound)) for bound in bounds]).cast("bigint")
    total = by_bucket(held).cast("bigint")
    batch = F.floor(place / fit).cast("bigint")
    return placed.select(
        F.col("id").alias(id),
        "n_tokens",
        "bucket",
        by_bucket(bounds).cast("bigint").alias("bucket_tokens"),
        batch.alias("batch"),
        F.pmod(place, fit).cast("int").alias("slot"),
        F.least(fit, total - batch * fit).cast("int").alias("batch_rows"),
    )
