import hashlib
import random
import re

from newslens.llm.exact_dedup import copy_groups, exact_dedup


def test_against_brute_force(spark):
    random.seed(5)
    pool = ["a b c", "abc", " abc\n", "a\u00a0b", "", None, " \t", "x" * 64 + "1", "x" * 64 + "2", "x" * 63 + " x1", "é" * 100_000]
    rows = [(i, random.choice(pool)) for i in range(200)] + [(None, "abc"), (None, "only here")]
    rows += [(3, rows[3][1])] * 2
    df = spark.createDataFrame([(*r, "z") for r in rows], "doc_id long, text string, digest string")
    found = exact_dedup(df).collect()
    got = {(r.doc_id, r.digest, r.n_chars): r for r in found}
    plain = [(i, len(t or ""), re.sub(r"[\x20\x09-\x0D]", "", t or "")) for i, t in rows]
    assert len(found) == len(rows) and len(got) == len(set(plain))
    for i, n, text in set(plain):
        group = [p for p in plain if p[2] == text]
        best = min(group, key=lambda p: (-p[1], p[0] is None, p[0] or 0))
        row = got[i, hashlib.sha256(text.encode()).hexdigest(), n]
        assert (row.keep_id, row.group_size, row.kept) == (best[0], len(group), (i, n) == best[:2])
    assert exact_dedup(df.limit(0)).collect() == []


def test_only_shared_texts_form_groups(spark):
    df = spark.createDataFrame([(1, "same"), (2, "sa me"), (3, "meas"), (4, "other")], "doc_id int, text string")
    assert [(r.keep_id, r.group_size) for r in copy_groups(df).collect()] == [(2, 2)]


def test_no_text_is_shuffled(spark):
    from pyspark.sql import functions as F

    from newslens.llm import exact_dedup as module

    df = spark.range(50).select("id", F.concat(F.lit("text "), F.col("id") % 20).alias("text"))
    starts, key, plain = module._survivors(df, "text", 64)
    rows = module._told(df.select("id", key.alias("key"), plain.alias("plain")), starts, F.col("key"))
    plan = rows._jdf.queryExecution().executedPlan().toString().split("Subquery")[0]
    assert "Exchange" not in plan and "Join" not in plan


def test_one_text_on_most_rows(spark):
    df = spark.range(3000).selectExpr("id AS doc_id", "if(id % 3 < 2, 'hot', concat('t', id)) AS text")
    rows = exact_dedup(df).collect()
    assert len(rows) == 3000 and sum(r.kept for r in rows) == 1001
    assert {r.group_size for r in rows if r.keep_id == 0} == {2000}
