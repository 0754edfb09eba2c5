import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from newslens.llm import periodic


def brute(words):
    """All runs, from the definition."""
    n, found = len(words), {}
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and words[j] == words[j + q]:
                j += 1
            start, end = i, j + q
            if end - start >= max(6, 4 * q):
                smallest = next(p for p in range(1, q + 1) if all(words[k] == words[k + p] for k in range(start, end - p)))
                if smallest == q:
                    found[start, q] = end - start
            i = j
    return sorted((s, n, q) for (s, q), n in found.items())


def fast(texts):
    ids = {w: i for i, w in enumerate(sorted({w for t in texts for w in t}))}
    offsets = np.cumsum([0, *map(len, texts)])
    flat = np.array([ids[w] for t in texts for w in t], dtype=np.int64)
    out = [[] for _ in texts]
    for s, n, q in zip(*periodic.find_runs(flat, offsets)):
        text = np.searchsorted(offsets, s, side="right") - 1
        out[text].append((int(s - offsets[text]), int(n), int(q)))
    return out


@settings(max_examples=150, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=60), max_size=6))
def test_small_alphabets_against_the_definition(texts):
    assert fast(texts) == [brute(t) for t in texts]


def test_planted_runs_against_the_definition():
    random.seed(3)
    texts = []
    for _ in range(40):
        words = [random.randrange(50) for _ in range(random.randrange(0, 300))]
        for _ in range(3):
            q = random.choice([1, 2, 3, 5, 8, 17, 31, 32, 33, 60])
            at = random.randrange(len(words) + 1)
            unit = [random.randrange(50) for _ in range(q)]
            words[at:at] = (unit * 6)[: random.randrange(3 * q, 6 * q)]
        texts.append(words)
    assert fast(texts) == [brute(t) for t in texts]


def test_long_periods():
    random.seed(4)
    for q in (511, 512, 1000, 1023):
        words = [random.randrange(9000) for _ in range(777)] + [random.randrange(9000) for _ in range(q)] * 5
        words[-40:] = [random.randrange(9000) for _ in range(40)]
        assert [(r[1] >= 4 * q, r[2]) for r in fast([words])[0]] == [(True, q)]


def test_one_word_and_nested_runs():
    assert fast([["a"] * 5000]) == [[(0, 5000, 1)]]
    unit = ["a"] * 8 + ["b"] * 7 + ["c", "d", "c", "d", "c", "d", "c", "d"]
    assert fast([unit * 7]) == [brute(unit * 7)]


@pytest.mark.parametrize(("prime", "generator"), periodic.PRIMES)
def test_transforms(prime, generator):
    rng = np.random.default_rng(1)
    for size in (1, 2, 8, 64):
        rows = rng.integers(0, prime, (3, size)).astype(np.uint64)
        assert (periodic.inverse(periodic.transform(rows, prime, generator), prime, generator) == rows).all()
    block, window = rng.integers(0, 5000, (4, 16)), rng.integers(0, 5000, (4, 31))
    got = periodic.squared_differences(block.astype(np.uint64), window.astype(np.uint64), prime, generator)
    want = [[((b - w[d : d + 16]) ** 2).sum() for d in range(16)] for b, w in zip(block, window)]
    assert (got == np.array(want) % prime).all()


def test_primes_hold_the_longest_transform():
    for prime, generator in periodic.PRIMES:
        assert prime < 1 << 31 and (prime - 1) % periodic.LONGEST == 0
        assert pow(generator, (prime - 1) // 2, prime) == prime - 1


def test_odd_rows(spark):
    long = " ".join(f"w{i % 700}" for i in range(60_000))
    data = [
        (1, None, "k", 0), (None, "", "k", 0), (3, " \n", None, 0), (4, "x x x x x", "k", 0), (4, "x x x x x", "k", 0),
        (5, "  x x x x x x y", "k", 0), (6, long, "k", 0), (7, "p q\tp q\np q p\x0bq r", "k", 0),
    ]
    df = spark.createDataFrame(data, "doc_id long, text string, runs string, row int")
    rows = periodic.with_runs(df).collect()
    assert len(rows) == len(data)
    got = {}
    for r in rows:
        got.setdefault(r.doc_id, set()).add((r.n_words, tuple(map(tuple, r.runs)), r.collapsed))
    assert got[1] == got[None] == got[3] == {(0, (), "")}
    assert got[4] == {(5, (), "x x x x x")}
    assert got[5] == {(8, ((1, 6, 1),), "  x y")}
    assert got[6] == {(60_000, ((0, 60_000, 700),), " ".join(f"w{i}" for i in range(700)))}
    assert got[7] == {(9, ((0, 8, 2),), "p q r")}
    assert periodic.with_runs(df).columns == ["doc_id", "text", "row", "n_words", "runs", "collapsed"]
    assert periodic.with_runs(df.limit(0)).collect() == []


def test_best_run(spark):
    df = spark.createDataFrame(
        [(1, [(0, 8, 2), (20, 30, 7), (60, 12, 3), (90, 6, 1)]), (2, []), (3, [(5, 9, 2), (40, 18, 4)])],
        "k int, runs array<struct<start:bigint,length:bigint,period:bigint>>",
    )
    got = {r.k: r.b and tuple(r.b) for r in df.select("k", periodic.best_run("runs").alias("b")).collect()}
    assert got == {1: (90, 6, 1), 2: None, 3: (5, 9, 2)}
