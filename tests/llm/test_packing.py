import itertools
import random

from pyspark.sql import functions as F

from newslens.llm.packing import best_bounds, cell, pack


def padding(bounds, lengths, counts):
    return sum(n * (min(b for b in bounds if b >= x) - x) for x, n in zip(lengths, counts))


def test_bounds_have_the_least_padding():
    random.seed(1)
    for _ in range(60):
        lengths = random.sample(range(60), random.randint(1, 8))
        counts = [random.randint(1, 9) for _ in lengths]
        for k in (1, 2, 3, 5):
            bounds = best_bounds(lengths, counts, k)
            assert len(bounds) <= k and max(bounds) == max(lengths)
            others = itertools.combinations(sorted(lengths), min(k, len(lengths)))
            best = min(padding(c, lengths, counts) for c in others if max(c) == max(lengths))
            assert padding(bounds, lengths, counts) == best
    assert best_bounds([], [], 4) == []


def test_cells_are_exact_and_then_fine(spark):
    df = spark.range(0, 300_000, 7).select("id", cell(F.col("id")).alias("c"))
    assert df.filter("c < id OR (id <= 4096 AND c != id) OR c > id * 1.0005 + 1").count() == 0
    assert df.filter("id > 4096").select("c").distinct().count() <= 2048 * 7


def test_odd_rows(spark):
    rows = [(1, None), (2, ""), (3, "a " * 40_000), (4, "b c"), (4, "b c"), (None, "d"), (None, "e f")]
    df = spark.createDataFrame([(*r, 9) for r in rows], "doc_id int, text string, slice int")
    got = pack(df, buckets=3, budget=64).collect()
    assert sorted(r.n_tokens for r in got) == [0, 0, 1, 2, 2, 2, 40_000]
    assert len({(r.bucket, r.batch, r.slot) for r in got}) == len(rows)
    assert [r.batch_rows for r in got if r.doc_id == 3] == [1]
    assert pack(df.limit(0)).collect() == []


def test_slices_number_a_large_bucket_without_gaps(spark, monkeypatch):
    monkeypatch.setattr("newslens.llm.packing.SLICE_ROWS", 10)
    df = spark.range(500).select(F.col("id").alias("doc_id"), F.lit("a b c").alias("text"))
    got = pack(df, budget=12).collect()
    assert sorted((r.batch, r.slot) for r in got) == [(b, s) for b in range(125) for s in range(4)]
    assert got == pack(df.repartition(7), budget=12).collect() or sorted(got) == sorted(pack(df.repartition(7), budget=12).collect())
