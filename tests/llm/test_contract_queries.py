"""Every registered query of the subpackage: against its SQL, or its contract's columns by hand."""

import hashlib
import math
import re
import zlib
from collections import Counter
from fractions import Fraction

import duckdb
import numpy as np
import pytest

from newslens.llm import queries as llm

SF = "/root/testdata/sf0.001"
QUERIES, SQL = llm.queries(), llm.oracle_sql()
TABLES = ("documents", "pages", "labels", "embeddings")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    yield con
    con.close()


@pytest.fixture(scope="module")
def texts(duck):
    return {i: t or "" for i, t in duck.sql("SELECT doc_id, text FROM documents").fetchall()}


def rows(names, values):
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(repr([row[i] for i in order]) for row in values)


def part(doc_id, parts):
    return zlib.crc32(str(doc_id).encode()) % parts


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text)


@pytest.mark.parametrize("name", SQL)
def test_query_against_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(SQL[name])
    names = [d[0] for d in result.description]
    assert rows(df.columns, df.collect()) == rows(names, result.fetchall())


def test_one_query_per_operator():
    assert sorted(int(re.match(r"op(\d+)_", name)[1]) for name in QUERIES) == list(range(1, 14))


def test_native_queries_run_no_python(spark):
    for name in ("op2_closed_syncmers", "op4_hierarchical_mix"):
        plan = QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
        assert not re.search("Python|Arrow|Pandas|CartesianProduct|NestedLoop", plan)


def test_length_buckets(spark, texts):
    found = QUERIES["op1_length_buckets"](spark, SF).collect()
    assert {r.doc_id: r.n_tokens for r in found} == {i: len(words(t)) for i, t in texts.items()}
    batches = {}
    for r in found:
        assert r.n_tokens <= r.bucket_tokens
        batches.setdefault((r.bucket, r.batch), []).append(r)
    for batch in batches.values():
        assert sorted(r.slot for r in batch) == list(range(len(batch)))
        assert {r.batch_rows for r in batch} == {len(batch)}
        assert len(batch) == 1 or len(batch) * batch[0].bucket_tokens <= 16_384
    for bucket in {b for b, _ in batches}:  # only the last batch of a bucket may have room
        sizes = [len(batches[k]) for k in sorted(k for k in batches if k[0] == bucket)]
        assert len(set(sizes[:-1])) <= 1


def test_closed_syncmers(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op2_closed_syncmers"](spark, SF).collect()}
    assert found.keys() == texts.keys()
    order = sorted(texts)
    prints = {}
    for i, j in zip(order, order[1:] + order[:1]):
        n = len(texts[i])
        edited = texts[i][: n - n // 4] + texts[j][: n // 4]
        assert found[i].n_chars == n
        assert found[i].edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        prints.setdefault(texts[i], set()).add(found[i].fingerprint)
        if texts[i] != texts[j] and n > 400:
            assert found[i].near_next < found[i].near_edited
    assert all(len(p) == 1 for p in prints.values())


def test_pitman_yor(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op3_pitman_yor"](spark, SF).collect()}
    assert found.keys() == texts.keys()
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    tokens = {i: [*words(t.translate(lower)), ""] for i, t in texts.items()}
    count = Counter(w for i, ws in tokens.items() if part(i, 10) for w in ws)
    total, kinds = sum(count.values()), len(count)
    model, base = 0.0, 0.0
    for i, ws in tokens.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.train_tokens) == (part(i, 10) == 0, len(ws), total)
        assert r.n_known == sum(count[w] > 0 for w in ws)
        assert r.base_score == pytest.approx(
            sum(math.log10((count[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in ws)
        )
        assert r.score < 0
        model, base = model + r.score, base + r.base_score
    assert model > base


def test_quality(spark, duck):
    larger = SF.replace("0.001", "0.01")
    found = {r.doc_id: r for r in QUERIES["op6_pu_quality"](spark, larger).collect()}
    ids = duck.sql(f"SELECT doc_id FROM '{larger}/documents.parquet'").fetchall()
    assert sorted(found) == sorted(i for i, in ids)
    labels = dict(duck.sql(f"SELECT doc_id, quality FROM '{larger}/labels.parquet'").fetchall())
    for i, r in found.items():
        assert r.held_out == (part(i, 5) == 0) and 0 <= r.score <= 1
        assert r.predicted == int(r.score >= 0.3)
    good = [found[i].score for i, q in labels.items() if q == 1]
    bad = [found[i].score for i, q in labels.items() if q == 0]
    pairs = [(g > b) + 0.5 * (g == b) for g in good for b in bad]
    assert sum(pairs) / len(pairs) > 0.9


def test_languages(spark, duck, texts):
    found = {r.doc_id: r for r in QUERIES["op7_kneser_ney"](spark, SF).collect()}
    assert found.keys() == texts.keys()
    truth = dict(duck.sql("SELECT doc_id, lang FROM documents").fetchall())
    held = [i for i in found if found[i].held_out]
    assert set(held) == {i for i in texts if part(i, 4) == 2}
    assert sum(found[i].lang_pred == truth[i] for i in held) >= 0.95 * len(held)
    assert all(0 <= r.score <= 1 for r in found.values())


def test_periodic_runs(spark, texts):
    found = {r.doc_id: r for r in QUERIES["op13_periodic_runs"](spark, SF).collect()}
    assert found.keys() == texts.keys()
    edited = 0
    for i, text in texts.items():
        ws, h = words(text), zlib.crc32(str(i).encode())
        n, g = len(ws), h // 10
        if h % 10 == 0 and n:
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            ws = [ws[j if j < a else a + (j - a) % p] for j in range(n)]
            edited += 1
        runs = periods(ws)
        best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=(None,) * 3)
        gone = {j for s, m, q in runs for j in range(s + q, s + m)}
        r = found[i]
        assert (r.n_runs, r.start, r.length, r.period) == (len(runs), *best)
        assert r.exponent_milli == (1000 * best[1] // best[2] if runs else None)
        listed = "".join(f"{s},{m},{q}\n" for s, m, q in runs)
        assert r.runs_sha256 == hashlib.sha256(listed.encode()).hexdigest()
        kept = " ".join(w for j, w in enumerate(ws) if j not in gone)
        assert r.collapsed_sha256 == hashlib.sha256(kept.encode()).hexdigest()
    assert edited > 5


def periods(ws):
    """Every run, by comparing words at each distance."""
    ids = {w: k for k, w in enumerate(dict.fromkeys(ws))}
    w, runs, seen = np.array([ids[x] for x in ws]), [], set()
    for q in range(1, len(ws) // 4 + 1):
        same = np.concatenate([[0], w[:-q] == w[q:], [0]]).astype(int)
        for s, e in zip(np.flatnonzero(np.diff(same) == 1), np.flatnonzero(np.diff(same) == -1)):
            if e + q - s >= max(6, 4 * q) and (s, e + q) not in seen:  # periods ascend: the smallest counts
                seen.add((s, e + q))
                runs.append((int(s), int(e + q - s), q))
    return sorted(runs, key=lambda r: (r[0], r[2]))


def test_hnsw(spark, duck):
    larger = SF.replace("0.001", "0.1")
    table = duck.sql(f"SELECT vec_id, embedding FROM '{larger}/embeddings.parquet' ORDER BY vec_id").fetchall()
    vectors = np.array([v for _, v in table], dtype=np.float64)
    ids = np.array([i for i, _ in table])
    found = {}
    for r in QUERIES["op12_hnsw"](spark, larger).collect():
        found.setdefault(r.query_id, []).append((r.rank, r.vec_id, r.score))
    assert sorted(found) == [i for i in ids if i % 100 == 0]
    hits = 0
    for q, rows in found.items():
        far = np.sqrt(((vectors - vectors[q]) ** 2).sum(axis=1))
        far[q] = np.inf
        assert [k for k, _, _ in sorted(rows)] == list(range(1, 11))
        assert all(s == pytest.approx(far[i], rel=1e-12) for _, i, s in rows)
        order = sorted((s, i) for _, i, s in rows)
        assert [i for _, i, _ in sorted(rows)] == [i for _, i in order] and q not in {i for _, i in order}
        hits += len({i for _, i, _ in rows} & set(ids[np.lexsort((ids, far))[:10]]))
    assert hits >= 0.98 * 10 * len(found)
