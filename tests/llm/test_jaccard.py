import random
import re

import numpy as np
import pytest

from newslens.llm.components import components
from newslens.llm.jaccard import band_count, near_duplicates, one_of_each, shared_grams


def grams(text):
    words = re.findall(rb"[0-9A-Za-z\x80-\xff]+", (text or "").lower().encode())
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))) if words else frozenset()


def brute(rows, threshold=0.8):
    """{text: (class id, class size, number of near texts)}."""
    texts = sorted({t or "" for _, t in rows})
    sets = {t: grams(t) for t in texts}
    near = {t: [] for t in texts}
    for k, a in enumerate(texts):
        for b in texts[:k]:
            if sets[a] and len(sets[a] & sets[b]) >= threshold * len(sets[a] | sets[b]):
                near[a].append(b)
                near[b].append(a)
    out, seen = {}, set()
    for t in texts:
        if t in seen:
            continue
        group, todo = set(), [t]
        while todo:
            x = todo.pop()
            if x not in group:
                group.add(x)
                todo += near[x]
        seen |= group
        mine = [i for i, x in rows if (x or "") in group]
        least = min((i for i in mine if i is not None), default=None)
        out |= {x: (least, len(mine), len(near[x])) for x in group}
    return out


def edited(words, rng, n):
    words = list(words)
    for _ in range(n):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return " ".join(words)


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(11)
    vocabulary = [f"w{k}" for k in range(500)]
    out, id = [], 0
    for _ in range(25):
        base = rng.choices(vocabulary, k=rng.randint(60, 300))
        texts = [" ".join(base)] + [edited(base, rng, rng.randint(0, 4)) for _ in range(rng.randint(0, 12))]
        for t in texts:
            out += [(id := id + 1, t) for _ in range(rng.choice([1, 1, 1, 4]))]
    base = rng.choices(vocabulary, k=200)
    for _ in range(150):  # a chain: each copy is made of the one before
        base = edited(base, rng, 1).split()
        out.append((id := id + 1, " ".join(base)))
    out += [(900_000 + k, t) for k, t in enumerate([None, "", "!!", "!!", "?", "one two", "One, two!", "one two three four five six"])]
    out += [(None, out[0][1]), (None, "no id at all here"), (5, out[4][1])]
    rng.shuffle(out)
    return out


@pytest.mark.parametrize("block", [1024, 16])
def test_against_brute_force(spark, rows, block, monkeypatch):
    monkeypatch.setattr("newslens.llm.jaccard.BLOCK", block)
    monkeypatch.setattr("newslens.llm.jaccard.COMMON", 6)
    want = brute(rows)
    df = spark.createDataFrame([(*r, "x") for r in rows], "doc_id long, text string, node string")
    import hashlib

    names = {hashlib.md5(t.encode()).digest(): w for t, w in want.items()}
    got = near_duplicates(df).collect()
    assert len(got) == len(rows)
    for r in got:
        assert (r.class_id, r.class_size, r.n_links) == names[bytes(r.copy)]
    assert one_of_each(df).count() == len({w[0] if w[0] is not None else t for t, w in want.items()})


def test_one_of_each_keeps_rows_whole(spark):
    text = " ".join(f"w{k}" for k in range(50))
    df = spark.createDataFrame([(2, text, 1), (1, text.upper(), 2), (1, text.upper(), 2), (3, None, 3), (3, "", 4)], "doc_id int, text string, n int")
    got = sorted((r.doc_id, r.n) for r in one_of_each(df).collect())
    assert got[0] == (1, 2) and [g[0] for g in got] == [1, 3]
    assert one_of_each(df).columns == df.columns
    assert near_duplicates(df.limit(0)).collect() == []


def test_intersections(monkeypatch):
    monkeypatch.setattr("newslens.llm.jaccard.COMMON", 3)
    rng = random.Random(1)
    sets = [np.array(sorted(rng.sample(range(40), rng.randint(1, 30))), dtype=np.uint64) for _ in range(17)]
    got = shared_grams(sets)
    for a in range(17):
        for b in range(17):
            assert got[a, b] == (len(set(sets[a]) & set(sets[b])) if a != b else 0)


def test_band_count_meets_the_recall():
    n = band_count(0.8, 0.999, 5)
    assert 1 - (1 - 0.8**5) ** n >= 0.999 > 1 - (1 - 0.8**5) ** (n - 1)


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(k, k + 1) for k in range(1000, 1100)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    df = spark.createDataFrame(links, "a long, b long")
    got = {r.node: r.root for r in components(df).collect()}
    assert got == {x: find(x) for x in {y for a, b in links if a != b for y in (a, b)}}
    assert components(df.limit(0)).collect() == []
