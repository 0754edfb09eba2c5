import random

import numpy as np
import pytest

from newslens.llm import negatives


@pytest.mark.parametrize("dims", [1, 3, 16, 64, 100, 300])
def test_rotation_and_intervals(dims):
    rng = np.random.default_rng(dims)
    rows = np.floor(256 * rng.standard_normal((300, dims)))
    rows[0], rows[1], rows[2] = 0, 1, rows[3]
    asked = np.floor(256 * np.concatenate([rng.standard_normal((20, dims)), np.zeros((1, dims))]))
    asked[5], asked[6] = rows[3], -rows[3]
    for stage in range(negatives.STAGES):
        assert np.allclose(negatives.back(negatives.rotate(rows, stage), dims, stage), rows)
    codes = negatives.Codes(*negatives.encode(rows))
    lower, upper = codes.intervals(asked)
    exact = asked @ rows.T
    assert (lower <= exact).all() and (exact <= upper).all()
    if dims == 64:  # the intervals are narrow enough to drop most rows of a random set
        scale = np.linalg.norm(asked[:20], axis=1)[:, None] * np.linalg.norm(rows[3:], axis=1)
        assert np.median((upper - lower)[:20, 3:] / scale) < 0.2


def brute(rows, positives=5, negatives=3):
    rows = sorted({(i, l, tuple(v)) for i, l, v in rows if i is not None and l is not None and whole(v)})
    out = []
    for a in rows:
        if a[0] % 50:
            continue
        scored = [(-sum(int(x) * int(y) for x, y in zip(a[2], r[2])), r[0], r[1]) for r in rows if r != a and len(r[2]) == len(a[2])]
        scored.sort()
        best = [s for s in scored if s[2] == a[1]][:positives]
        for ps, p, _ in best:
            near = [s for s in scored if s[2] != a[1] and 50 * -ps <= 100 * -s[0] <= 95 * -ps]
            out += [(a[0], p, k + 1, n, -ps, -ns) for k, (ns, n, _) in enumerate(near[:negatives])]
    return sorted(out)


def whole(v):
    return v is not None and all(x is not None and np.isfinite(x) for x in v)


def test_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(negatives, "ROWS", 60)
    monkeypatch.setattr(negatives, "ANCHORS", 5)
    random.seed(2)
    hot = [float(random.randrange(-40, 60)) for _ in range(8)]
    rows = []
    for i in range(400):
        v = hot if i % 3 == 0 else [float(random.randrange(-40, 60)) for _ in range(8)]
        rows.append((i, random.choice([1, 1, 1, 2, 3]), v))
    rows += [rows[50], rows[50], rows[51]]  # repeated rows are one
    rows += [(None, 1, hot), (900, None, hot), (950, 1, None), (1000, 1, [*hot[:7], None]), (1050, 1, [float("nan")] * 8)]
    rows += [(1100, 2, [float("inf")] * 8), (1150, 1, [1.0, 2.0]), (1151, 1, [3.0, 1.0]), (1152, 2, [1.0, 1.0]), (1200, 3, [])]
    rows += [(1250, 1, [0.0] * 8), (1300, 9, hot)]
    schema = "vec_id long, label int, vector array<double>"
    df = spark.createDataFrame(rows, schema).selectExpr("*", "'x' AS key", "1 AS anchor", "2 AS dims")
    got = negatives.hard_negatives(df, "vec_id % 50 = 0").drop("positive_rank")
    assert sorted(map(tuple, got.collect())) == brute(rows)
    assert len(brute(rows)) > 50
    assert negatives.hard_negatives(df.limit(0), "vec_id % 50 = 0").collect() == []


def test_scores_beyond_the_exact_range_of_doubles(spark):
    big = float(2**30)
    rows = [(0, 1, [big + 1, big]), (1, 1, [big, big]), (2, 2, [big - 2**24, big - 2**23 - 1]), (3, 2, [1e30, 1e30]), (4, 2, [big, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>")
    got = negatives.hard_negatives(df, "vec_id = 0").collect()
    assert sorted((r.rank, r.negative_id, r.positive_score, r.negative_score) for r in got) == [
        (n, i, (2**30 + 1) * 2**30 + 2**60, s)
        for n, i, s in ((1, 4, 2**30 * (2**30 + 1)),)
    ]


def test_ties_and_rows_with_one_id(spark):
    rows = [(0, 1, [10.0]), (0, 1, [8.0]), (7, 1, [5.0]), (3, 1, [5.0]), (9, 2, [4.0]), (8, 2, [4.0]), (6, 2, [4.0]), (5, 2, [3.0])]
    df = spark.createDataFrame(rows, "vec_id long, label int, vector array<double>")
    got = [r for r in negatives.hard_negatives(df, "vec_id = 0").collect() if r.positive_id == 3]
    assert sorted((r.positive_score, r.rank, r.negative_id) for r in got) == [
        (40, 1, 6), (40, 2, 8), (40, 3, 9), (50, 1, 6), (50, 2, 8), (50, 3, 9)
    ]
