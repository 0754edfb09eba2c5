import random

import numpy as np

from newslens.llm import hnsw


def points(n, dims, seed, clusters=0):
    rng = np.random.default_rng(seed)
    if clusters:
        centres = rng.standard_normal((clusters, dims))
        return centres[rng.integers(0, clusters, n)] + 0.01 * rng.standard_normal((n, dims))
    return rng.standard_normal((n, dims))


def recall(vectors, width, k=10):
    order, sizes = hnsw.level_sizes(np.random.default_rng(5).integers(-(2**63), 2**63, len(vectors)))
    vectors = np.ascontiguousarray(vectors[order])
    layers = hnsw.build(vectors, sizes)
    assert [len(x) for x in layers] == sizes
    for n, links in zip(sizes, layers):
        assert links.max(initial=-1) < n and (links != np.arange(n)[:, None]).all()
        assert all(len(set(row[row >= 0])) == (row >= 0).sum() for row in links)
    asked = vectors[::7]
    exact = ((asked[:, None] - vectors) ** 2).sum(axis=2)
    node, far = hnsw.search(vectors, layers, asked, width)
    assert (far[:, :-1] <= far[:, 1:]).all()
    i, j = np.nonzero(node >= 0)
    assert np.allclose(far[i, j], exact[i, node[i, j]])
    best = np.argsort(exact, axis=1, kind="stable")[:, :k]
    return np.mean([len(set(a) & set(b[:k])) / len(a) for a, b in zip(best, node)])


def test_recall_of_one_graph():
    assert recall(points(1500, 32, 1), 96) > 0.98
    assert recall(points(1200, 16, 2, clusters=40), 96) > 0.95
    assert recall(points(300, 2, 3), 48) > 0.98
    assert recall(points(1, 4, 4), 8) == 1
    assert recall(points(5, 4, 4), 8) == 1


def test_layers_are_prefixes():
    order, sizes = hnsw.level_sizes(np.random.default_rng(1).integers(-(2**63), 2**63, 5000))
    assert sorted(order) == list(range(5000)) and sizes[0] == 5000 and sizes == sorted(sizes, reverse=True)
    assert 300 < sizes[1] < 550  # a twelfth


def test_small_tables_against_brute_force(spark):
    random.seed(1)
    hot = [1.0, 2.0, -1.0]
    rows = [(i, hot if i % 3 == 0 else [random.gauss(0, 1) for _ in range(3)]) for i in range(240)]
    rows += [rows[100], rows[100], (100, [0.0, 1.0, 1.0]), (None, hot), (300, None), (400, [0.0, 0.0, 0.0]), (500, [1.0, None, 0.0])]
    rows += [(600, [float("inf"), 0.0, 0.0]), (700, [float("nan"), 0.0, 0.0]), (800, [1.0, 2.0]), (801, [1.0, 4.0]), (900, [])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "'x' AS node", "1 AS shard", "2 AS dims")
    got = {}
    for r in hnsw.nearest(df, "vec_id % 100 = 0", shard=60).collect():
        got.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    used = sorted({(i, tuple(v)) for i, v in rows if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)})
    want = {}
    for i, v in used:
        if i % 100 == 0:
            near = sorted((float(np.sqrt(sum((a - b) ** 2 for a, b in zip(v, w)))), j) for j, w in used if (j, w) != (i, v) and len(w) == len(v))
            want.setdefault(i, []).extend((k + 1, j, s) for k, (s, j) in enumerate(near[:10]))
    assert got.keys() == want.keys() == {0, 100, 200, 800}
    for q in got:
        assert [x[:2] for x in sorted(got[q])] == [x[:2] for x in sorted(want[q])]
        assert np.allclose([x[2] for x in sorted(got[q])], [x[2] for x in sorted(want[q])])
    assert hnsw.nearest(df.limit(0), "vec_id % 100 = 0").collect() == []
    assert hnsw.nearest(df, "vec_id < 0").collect() == []
