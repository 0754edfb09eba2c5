import hashlib
import random

import pytest

from newslens.llm.mixing import mix

LEVELS = {"domain": "substring(source, 1, 1)", "language": "lang", "source": "source"}
WEIGHTS = ({"a": 3, "b": 1}, {"en": 2}, {"a1": 5})


def share(budget, children):
    """{child: tokens} by repeated filling: (capacity, weight) of each child."""
    given, live = dict.fromkeys(children, 0), {c for c, (_, w) in children.items() if w}
    left = min(budget, sum(children[c][0] for c in live))
    while live:
        rate = left / sum(children[c][1] for c in live)
        full = {c for c in live if children[c][0] <= children[c][1] * rate + 1e-9}
        if not full:
            return given | {c: int(children[c][1] * left / sum(children[d][1] for d in live)) for c in live}
        for c in full:
            given[c] = children[c][0]
            left -= children[c][0]
        live -= full
    return given


def brute(rows, percent, epochs, seed=17):
    leaves = {}
    for i, lang, source, text in rows:
        path = ((source or "?")[:1] if source else "unknown", lang or "unknown", source or "unknown")
        leaves.setdefault(path, []).append((i, len((text or "").split()), text or ""))
    budget = sum(n for docs in leaves.values() for _, n, _ in docs) * percent // 100

    def descend(prefix, tokens, out):
        depth = len(prefix)
        if depth == 3:
            out[prefix] = tokens
            return
        children = {}
        for path, docs in leaves.items():
            if path[:depth] == prefix:
                c, _ = children.get(path[depth], (0, 0))
                children[path[depth]] = (c + epochs * sum(n for _, n, _ in docs), WEIGHTS[depth].get(path[depth], 1))
        for child, given in share(tokens, children).items():
            descend((*prefix, child), given, out)

    granted = {}
    descend((), budget, granted)
    chosen = []
    for path, docs in leaves.items():
        total = sum(n for _, n, _ in docs)
        passes, left = divmod(granted[path], total) if total else (0, 0)
        key = lambda d: (hashlib.md5(f"{seed}:{passes}:{'' if d[0] is None else d[0]}".encode()).hexdigest(), d[0] or -1, d[2])
        upto = 0
        for i, n, _ in sorted(docs, key=key):
            upto += n
            extra = upto <= left and (left > 0 or total == 0)
            chosen += [(i, epoch, n) for epoch in range(min(epochs, passes + extra))]
    return sorted(chosen, key=repr)


@pytest.mark.parametrize("percent", [0, 10, 60, 150, 400])
def test_against_brute_force(spark, monkeypatch, percent):
    monkeypatch.setattr("newslens.llm.mixing.SLICE_ROWS", 4)
    random.seed(2)
    rows = []
    for i in range(150):
        source = random.choice(["a1"] * 6 + ["a2", "b1", None])
        lang = random.choice(["en", "en", "de", None])
        rows.append((i, lang, source, random.choice([None, "", "w " * random.randint(1, 30)])))
    rows += [(None, "en", "a1", "null id"), (7, "en", "a1", "repeated id"), (1000, "xx", "c9", "")]
    df = spark.createDataFrame([(*r, 5) for r in rows], "doc_id long, lang string, source string, text string, epoch int")
    got = mix(df, LEVELS, WEIGHTS, percent, 3)
    assert got.columns == ["doc_id", "lang", "source", "text", "epoch", "n_tokens"]
    assert sorted(((r.doc_id, r.epoch, r.n_tokens) for r in got.collect()), key=repr) == brute(rows, percent, 3)


def test_shortage_goes_to_siblings_first(spark):
    rows = [(i, "en", "a1", "w") for i in range(10)] + [(100 + i, "en", "a2", "w") for i in range(200)]
    rows += [(1000 + i, "en", "b1", "w") for i in range(200)]
    df = spark.createDataFrame(rows, "doc_id long, lang string, source string, text string")
    got = mix(df, LEVELS, WEIGHTS, 50, 1).groupBy("source").count().collect()
    total = {r.source: r["count"] for r in got}
    assert total == {"a1": 10, "a2": 143, "b1": 51}  # a gets its three quarters of 205 in spite of a1


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, lang string, source string, text string")
    assert mix(df, LEVELS, WEIGHTS).collect() == []
